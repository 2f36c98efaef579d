"""Fraud rate per category value: fit once, apply by lookup."""

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward import schemas as S
from tallyward.operators.skew import attach, small_rows
from tallyward.session import local_table

COLUMNS = list(S.RATE_FEATURES)
_EVERY = "_every"
SERVED = -1


def cells(df: DataFrame, columns: list[str], label: str = S.LABEL) -> DataFrame:
    """Rows and frauds per combination of the columns.

    The only pass over the rows; every other table is made from this one, which
    is as small as the categories are.
    """
    return df.groupBy(*columns).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(label).alias("labelled"),
        F.coalesce(F.sum(F.col(label).cast("int")), F.lit(0)).cast("long").alias("frauds"),
    )


def _long(cell_table: DataFrame, columns: list[str]) -> DataFrame:
    return cell_table.unpivot(
        ["rows", "labelled", "frauds"], [F.col(c) for c in columns], "category", "value"
    )


def _rate():
    return F.when(F.col("labelled") > 0, F.col("frauds") / F.col("labelled"))


def category_rates(df: DataFrame, columns: list[str] = COLUMNS, label: str = S.LABEL) -> DataFrame:
    """(category, value, rows, rate) of all columns in one pass; null values have no rate."""
    return (
        _long(cells(df, columns, label), columns)
        .filter(F.col("value").isNotNull())
        .groupBy("category", "value")
        .agg(*[F.sum(c).alias(c) for c in ("rows", "labelled", "frauds")])
        .select("category", "value", "rows", _rate().alias("rate"))
    )


@dataclass
class Rates:
    """A fitted rate table, the label's overall mean and the values seen."""

    table: DataFrame
    overall: float | None
    small: bool
    seen: dict[str, list[str]]
    folds: "Folds | None" = None


@dataclass
class Folds:
    """How rows are dealt to folds; with it a rate table has a column ``fold``, ``SERVED`` for rows that taught nothing."""

    count: int
    seed: int
    among: Column

    def of_row(self) -> Column:
        digits = F.substring(F.md5(F.concat(F.col("transaction_id"), F.lit(f":fold:{self.seed}"))), 1, 8)
        fold = F.conv(digits, 16, 10).cast("long") % self.count
        return F.when(F.coalesce(self.among, F.lit(False)), fold).otherwise(SERVED).cast("int")


def fit(
    df: DataFrame, columns: list[str] = S.CATEGORICAL, label: str = S.LABEL, limit: int = 100_000
) -> Rates:
    """Fit rates, overall rate and vocabularies together, from one pass.

    The driver sees at most ``limit`` fitted rows. With more values than that the
    table stays distributed and is attached by a shuffled join.
    """
    spark = df.sparkSession
    counted = cells(df, columns, label).withColumn(_EVERY, F.lit(""))
    fitted = (
        _long(counted, [_EVERY, *columns])
        .groupBy("category", "value")
        .agg(*[F.sum(c).alias(c) for c in ("rows", "labelled", "frauds")])
        .select("category", "value", _rate().alias("rate"))
    )
    rows = small_rows(fitted, limit)
    if rows is None:
        # too many values for the driver: keep the rates as a distributed table
        overall = df.agg(F.avg(F.col(label).cast("int"))).first()[0]
        return Rates(fitted.filter(F.col("category") != _EVERY), overall, False, {})
    seen: dict[str, list[str]] = {c: [] for c in columns}
    overall = None
    kept = []
    for r in rows:
        if r.category == _EVERY:
            overall = r.rate
        elif r.value is not None:
            seen[r.category].append(r.value)
            kept.append((r.category, r.value, r.rate))
    return Rates(
        _table(spark, kept), overall, True, {c: sorted(v) for c, v in seen.items()}
    )


def fit_folds(
    df: DataFrame, columns: list[str] = S.CATEGORICAL, label: str = S.LABEL, folds: int = 5, shrink: float = 20.0, seed: int = 42,
    among: Column | None = None, limit: int = 100_000,
) -> Rates:
    """Rates that no row has a say in for itself: each fold is encoded by the rows of the others.

    A fold's sums are subtracted from the total, so this is one pass over the rows as well. Rates are drawn to the overall rate
    of the same rows as if ``shrink`` more rows had it, so a value that only one fold has gets the overall rate.
    Rows that are not ``among`` those that teach are encoded by all that do.
    """
    dealt = Folds(folds, seed, F.lit(True) if among is None else among)
    counted = cells(df.withColumn("_fold", dealt.of_row()).filter(F.col("_fold") != SERVED), ["_fold", *columns], label)
    sums = counted.withColumn(_EVERY, F.lit("")).unpivot(
        ["_fold", "labelled", "frauds"], [F.col(c) for c in [_EVERY, *columns]], "category", "value"
    ).filter(F.col("value").isNotNull()).groupBy("category", "value", "_fold").agg(F.sum("labelled").alias("labelled"), F.sum("frauds").alias("frauds"))
    whole = sums.groupBy("category", "value").agg(F.sum("labelled").alias("all"), F.sum("frauds").alias("all_frauds"))
    whole = whole.withColumn("fold", F.explode(F.array(*[F.lit(f) for f in [SERVED, *range(folds)]])))
    own = sums.withColumnRenamed("_fold", "fold")
    others = whole.join(own, ["category", "value", "fold"], "left").select(
        "category", "value", "fold", (F.col("all") - F.coalesce("labelled", F.lit(0))).alias("n"),
        (F.col("all_frauds") - F.coalesce("frauds", F.lit(0))).alias("s"))
    every = others.filter(F.col("category") == _EVERY).select("fold", F.when(F.col("n") > 0, F.col("s") / F.col("n")).alias("overall"))
    rate = F.when(F.col("category") == _EVERY, F.col("overall")).otherwise((F.col("s") + shrink * F.col("overall")) / (F.col("n") + shrink))
    fitted = others.join(F.broadcast(every), "fold").select("category", "value", "fold", rate.alias("rate"))  # a row per fold
    rows = small_rows(fitted, limit)
    if rows is None:
        overall = fitted.filter((F.col("category") == _EVERY) & (F.col("fold") == SERVED)).first()
        return Rates(fitted, overall.rate if overall else None, False, {}, dealt)
    overall = next((r.rate for r in rows if r.category == _EVERY and r.fold == SERVED), None)
    seen = {c: sorted(r.value for r in rows if r.category == c and r.fold == SERVED) for c in columns}
    schema = pa.schema([("category", pa.string()), ("value", pa.string()), ("fold", pa.int32()), ("rate", pa.float64())])
    return Rates(local_table(df.sparkSession, [tuple(r) for r in rows], schema), overall, True, seen, dealt)


def served(rates: Rates) -> Rates:
    """The rates for rows that taught nothing, without folds."""
    if rates.folds is None:
        return rates
    kept = rates.table.filter((F.col("fold") == SERVED) & (F.col("category") != _EVERY)).drop("fold")
    return Rates(kept, rates.overall, rates.small, rates.seen)


def _table(spark: SparkSession, rows: list[tuple[str, str, float]]) -> DataFrame:
    return local_table(
        spark, rows, pa.schema([("category", pa.string()), ("value", pa.string()), ("rate", pa.float64())])
    )


def of_rows(spark: SparkSession, rows: list, overall: float | None = None) -> Rates:
    """Rates from the few rows of a rate table."""
    seen: dict[str, list[str]] = {}
    for category, value, _ in rows:
        seen.setdefault(category, []).append(value)
    return Rates(_table(spark, rows), overall, True, seen)


def defaults(spark: SparkSession) -> Rates:
    """The built-in rates, for when no fitted table can be read."""
    rows = [(c, v, r) for c, by_value in S.DEFAULT_RATES.items() for v, r in by_value.items()]
    return of_rows(spark, rows)


def encode(df: DataFrame, rates: Rates) -> DataFrame:
    """Batch meaning: a missing location gets the overall rate, other misses stay null."""
    if rates.folds is not None:
        return _encode_folds(df, rates)
    out = _lookup(df, rates, dict(S.RATE_FEATURES))
    return out.withColumn("location_fraud_rate", F.coalesce("location_fraud_rate", F.lit(rates.overall)))


def _encode_folds(df: DataFrame, rates: Rates) -> DataFrame:
    out = df.withColumn("_fold", rates.folds.of_row())
    every = rates.table.filter(F.col("category") == _EVERY).select(F.col("fold").alias("_fold"), F.col("rate").alias("_overall"))
    out = out.join(F.broadcast(every), "_fold", "left")  # a row per fold
    for column, target in S.RATE_FEATURES.items():
        side = rates.table.filter(F.col("category") == column).select(
            F.col("fold").alias("_fold"), F.col("value").alias(column), F.col("rate").alias(target))
        out = out.join(F.broadcast(side) if rates.small else side, ["_fold", column], "left")
        missing = F.col("_overall") if column == "location" else F.when(F.col(column).isNotNull(), F.col("_overall"))
        out = out.withColumn(target, F.coalesce(F.col(target), missing))
    return out.drop("_fold", "_overall")


def encode_or_default(df: DataFrame, rates: Rates) -> DataFrame:
    """Extractor meaning: every miss gets a fixed rate, a missing text a fixed name."""
    named = df.withColumns({
        f"_{c}": F.coalesce(F.col(c), F.lit(S.MISSING_CATEGORY[c])) for c in COLUMNS
    })
    out = _lookup(named, rates, {f"_{c}": S.RATE_FEATURES[c] for c in COLUMNS})
    return out.withColumns({
        S.RATE_FEATURES[c]: F.coalesce(F.col(S.RATE_FEATURES[c]), F.lit(S.RATE_ON_MISS[c]))
        for c in COLUMNS
    }).drop(*[f"_{c}" for c in COLUMNS])


def _lookup(df: DataFrame, rates: Rates, targets: dict[str, str]) -> DataFrame:
    for column, target in targets.items():
        side = rates.table.filter(F.col("category") == column.lstrip("_")).select(
            F.col("value").alias(column), F.col("rate").alias(target)
        )
        if rates.small:
            df = df.join(F.broadcast(side), column, "left")
        else:
            df = attach(df, side, column)
    return df


def with_location_risk(df: DataFrame) -> DataFrame:
    """Fixed 11-row lookup: a missing location is ``Unknown``, an unlisted one 0.7."""
    table = local_table(
        df.sparkSession, list(S.LOCATION_RISK.items()),
        pa.schema([("_place", pa.string()), ("location_risk", pa.float64())]),
    )
    place = F.coalesce(F.col("location"), F.lit(S.MISSING_CATEGORY["location"]))
    return (
        df.join(F.broadcast(table), place == F.col("_place"), "left")
        .drop("_place")
        .withColumn("location_risk", F.coalesce("location_risk", F.lit(S.UNLISTED_LOCATION_RISK)))
    )
