"""Column-level helpers: presence, prefixes, duplicates, kinds, merging."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward import schemas as S

_ONE_HOT_PREFIXES = tuple(f"{c}_" for c in S.CATEGORICAL)
_NOT_ONE_HOT = {"location_fraud_rate", "location_risk"}


def require(df: DataFrame, names: list[str]) -> DataFrame:
    """Fail before any job runs when a column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def available(names: list[str], df: DataFrame) -> tuple[list[str], list[str]]:
    """Names that exist (first mention only, order kept) and names that do not."""
    have = set(df.columns)
    wanted = list(dict.fromkeys(names))
    return [n for n in wanted if n in have], [n for n in wanted if n not in have]


def is_one_hot(name: str) -> bool:
    return name.startswith(_ONE_HOT_PREFIXES) and name not in _NOT_ONE_HOT


def one_hot_columns(names: list[str]) -> list[str]:
    return [n for n in names if is_one_hot(n)]


def numeric_columns(df: DataFrame) -> list[str]:
    """Numbers only; a boolean is not a number."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def model_columns(df: DataFrame) -> list[str]:
    """Model inputs in their one fixed order: numeric list, then the one-hot blocks."""
    return available(S.NUMERIC_FEATURES + one_hot_columns(df.columns), df)[0]


def manifest_of(names: list[str]) -> dict[str, list[str]]:
    return {
        "feature_names": names,
        "categorical_features": one_hot_columns(names),
        "numeric_features": [n for n in names if not is_one_hot(n)],
    }


def merge(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Join two records of one key; on a common name the right side wins."""
    keep = [c for c in left.columns if c == key or c not in right.columns]
    return left.select(*keep).join(right, key)


def merge_structs(df: DataFrame, left: str, right: str) -> DataFrame:
    """Two records of one row side by side; on a common name the right one wins. No join."""
    names = {side: df.schema[side].dataType.names for side in (left, right)}
    kept = [F.col(left)[c].alias(c) for c in names[left] if c not in names[right]]
    return df.select(*kept, *[F.col(right)[c].alias(c) for c in names[right]])


def public_entries(entries):
    """Map column without the entries whose key starts with ``_``."""
    return F.map_filter(entries, lambda k, _: ~k.startswith("_"))
