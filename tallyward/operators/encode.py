"""One-hot blocks."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward import schemas as S
from tallyward.functions.codec import plain_name, plain_name_of
from tallyward.operators.columns import is_one_hot

FIXED = {
    "device_type": S.DEVICE_TYPES,
    "card_type": S.CARD_TYPES,
    "status": S.STATUSES,
    "location": S.LOCATIONS,
}

# a live record without a location has one of its own
SERVED = {**FIXED, "location": [*S.LOCATIONS, S.MISSING_CATEGORY["location"]]}

MAX_VALUES = 1_000  # of a column that is one-hot encoded; pass another ``limit`` for wider ones


def vocabulary(df: DataFrame, columns: list[str] = S.CATEGORICAL, limit: int = MAX_VALUES) -> dict[str, list[str]]:
    """Distinct non-null values per column, sorted: one pass, one small result.

    Each value becomes a column, so a column with more than ``limit`` values is
    not a category and is refused.
    """
    found = (
        df.groupBy(*columns).count()
        .unpivot([], [F.col(c) for c in columns], "category", "value")
        .filter(F.col("value").isNotNull())
        .distinct()
        .limit(limit * len(columns) + 1)
        .collect()
    )
    by_column = {c: sorted(r.value for r in found if r.category == c) for c in columns}
    check_width(by_column, limit)
    return by_column


def check_width(by_column: dict[str, list[str]], limit: int = MAX_VALUES) -> None:
    wide = [c for c, values in by_column.items() if len(values) > limit]
    if wide:
        raise ValueError(f"too many values to one-hot encode: {wide}")


def column_name(column: str, value: str) -> str:
    return f"{column}_{plain_name_of(value)}"


def one_hot_named(df: DataFrame, names: list[str]) -> DataFrame:
    """The 0/1 columns of these names, whatever values they stand for; other names are left out.

    A row has 1 where its value's plain name is in the column's name, which is the rule the columns were named by.
    """
    made = {}
    for name in names:
        source = next((c for c in S.CATEGORICAL if is_one_hot(name) and name.startswith(f"{c}_")), None)
        if source:
            hit = plain_name(F.col(source)) == F.lit(name.removeprefix(f"{source}_"))
            made[name] = F.coalesce(hit, F.lit(False)).cast("int")
    return df.withColumns(made)


def one_hot(df: DataFrame, values: dict[str, list[str]], keep_source: bool = False) -> DataFrame:
    """One 0/1 column per value; null or unseen gives all zeros."""
    made = {
        column_name(c, v): F.coalesce(F.col(c) == F.lit(v), F.lit(False)).cast("int")
        for c, vs in values.items() for v in vs
    }
    out = df.withColumns(made)
    return out if keep_source else out.drop(*values)
