"""Store of scored rows: one current row per transaction id, each with an expiry time.

A micro-batch only ever appends, into a folder of its own, so a repeated batch
replaces itself and nothing that was stored before is rewritten. Readers resolve
the current row per id. Data is laid out by expiry date, so expired rows are
pruned as whole folders. ``merge``, run on a schedule, brings the batches so far into one
row per id, so that readers rank only what came after; ``compact`` starts a new store.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyward import schemas as S
from tallyward.functions import clock
from tallyward.functions.amounts import exact
from tallyward.session import new_folder

VERSION = "version"


def stored_form(scored: DataFrame, now: Column | None = None) -> DataFrame:
    """Adds prediction time, ``ttl`` (epoch seconds, 30 days on) and the expiry date."""
    ttl = clock.epoch_now(now) + F.lit(S.TTL_SECONDS)
    return scored.withColumns({
        "prediction_timestamp": clock.iso_now(now),
        "ttl": ttl,
        "expiry_date": clock.utc_date(ttl),
    })


def exact_floats(df: DataFrame) -> DataFrame:
    """Every double as the decimal its shortest text names."""
    doubles = [name for name, kind in df.dtypes if kind in ("double", "float")]
    return df.withColumns({c: exact(F.col(c)) for c in doubles})


def latest(df: DataFrame, key: str = "transaction_id", version: str = VERSION) -> DataFrame:
    """Current row per key. Spark drops all but one row per key before it shuffles."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(version)))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def upsert(old: DataFrame, new: DataFrame, key: str = "transaction_id", version: str = VERSION) -> DataFrame:
    """Old rows whose key is not in ``new``, and the current row of each new key."""
    fresh = latest(new, key, version)
    return old.join(fresh.select(key), key, "left_anti").unionByName(fresh)


def live(df: DataFrame, now: Column | None = None) -> DataFrame:
    return df.filter(F.col("ttl") > clock.epoch_now(now))


def append(batch: DataFrame, batch_id: int, path: str, query: str = "0", started: int = 0) -> None:
    """Idempotent append: a batch overwrites its own folder only, that of its query and number.

    Numbers are stored as exact decimals. Versions rise with the time a query was ``started`` (milliseconds), then
    with the batch, so a query with a new checkpoint comes after what was there.
    """
    (
        exact_floats(batch).withColumn(VERSION, F.lit((started << 20) + batch_id).cast("long"))
        .sortWithinPartitions("expiry_date", "user_id")
        .write.mode("overwrite").partitionBy("expiry_date").parquet(f"{path}/query={query}/batch_id={batch_id}")
    )


_EPOCH = "epoch int, base string, query string, upto long"


def _epoch(spark: SparkSession, path: str) -> tuple[int, str | None, dict[str, int]]:
    """The last merge: its number, where its rows are, and the last batch of each query that is in it."""
    try:
        rows = spark.read.schema(_EPOCH).json(f"{path}_merges").collect()  # a row per merge and query
    except AnalysisException:
        rows = []
    now = max((r.epoch for r in rows), default=0)
    return now, next((r.base for r in rows if r.epoch == now), None), {r.query: r.upto for r in rows if r.epoch == now}


def _unexpired(spark: SparkSession, path: str, now: Column | None) -> DataFrame:
    """Rows that have not expired. The date filter prunes folders of expired rows."""
    today = clock.utc_date(clock.epoch_now(now))
    return spark.read.parquet(path).filter(F.col("expiry_date").cast("string") >= today)


def _as_doubles(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c, kind in df.dtypes if kind.startswith("decimal")})


def _since(spark: SparkSession, path: str, merged: dict[str, int], now: Column | None) -> DataFrame:
    """All versions of the batches that came after the last merge, by folder."""
    old = F.lit(False)
    for query, upto in merged.items():
        old = old | ((F.col("query") == query) & (F.col("batch_id") <= upto))
    return _unexpired(spark, path, now).filter(~old)


def _resolved(spark: SparkSession, path: str, now: Column | None) -> DataFrame:
    """The current row per id, as stored. Versions are compared only where a batch since the last merge has the id; all other
    rows come from the merge, which has one of each."""
    _, base, merged = _epoch(spark, path)
    fresh = _since(spark, path, merged, now).drop("query", "batch_id")
    if base is None:
        return latest(fresh)
    one_each = _unexpired(spark, base, now)
    ids = fresh.select("transaction_id").distinct()
    touched = one_each.join(ids, "transaction_id", "left_semi").unionByName(fresh, allowMissingColumns=True)
    return one_each.join(ids, "transaction_id", "left_anti").unionByName(latest(touched), allowMissingColumns=True)


def read(spark: SparkSession, path: str, now: Column | None = None) -> DataFrame:
    """Current, unexpired rows, numbers as doubles."""
    return live(_as_doubles(_resolved(spark, path, now)), now)


def _laid_out(df: DataFrame, path: str) -> None:
    (
        df.repartitionByRange("expiry_date", "user_id", "transaction_id").sortWithinPartitions("expiry_date", "user_id")
        .write.partitionBy("expiry_date").parquet(path)
    )


def merge(spark: SparkSession, path: str, now: Column | None = None) -> None:
    """Bring the batches so far into one table with one row per id; later reads rank only what comes after.

    The merge counts once its row is written, which comes last, so a reader sees the state before or after it. A batch
    that is merged already may be written again: it is not read any more.
    """
    epoch, _, merged = _epoch(spark, path)
    since = spark.read.parquet(path).groupBy("query").agg(F.max("batch_id").alias("upto")).collect()  # a row per query
    upto = merged | {r["query"]: r.upto for r in since}
    base = new_folder(spark, "store-merge")
    _laid_out(live(_resolved(spark, path, now), now), base)
    spark.createDataFrame([(epoch + 1, base, q, b) for q, b in upto.items()], _EPOCH).coalesce(1).write.mode("append").json(f"{path}_merges")


def compact(spark: SparkSession, path: str, target: str, now: Column | None = None) -> None:
    """Write the live rows to a new store, laid out for access by user."""
    _laid_out(exact_floats(read(spark, path, now)), f"{target}/query=compacted/batch_id=-1")


def of_user(spark: SparkSession, path: str, user_id: str, now: Column | None = None) -> DataFrame:
    """Current rows of one user: out of a merge by its files sorted by user, and out of the batches since."""
    _, base, merged = _epoch(spark, path)
    fresh = _since(spark, path, merged, now)
    every = fresh.drop("query", "batch_id")
    if base is not None:
        every = every.unionByName(_unexpired(spark, base, now), allowMissingColumns=True)
    ids = every.filter(F.col("user_id") == F.lit(user_id)).select("transaction_id").distinct()
    current = latest(every.join(ids, "transaction_id", "left_semi"))
    return live(_as_doubles(current), now).filter(F.col("user_id") == F.lit(user_id))


def found(stored: DataFrame, ids: DataFrame, key: str = "transaction_id") -> DataFrame:
    return stored.join(ids, key, "left_semi")


def missing(stored: DataFrame, ids: DataFrame, key: str = "transaction_id") -> DataFrame:
    return ids.join(stored, key, "left_anti")


def round_trip(sent: DataFrame, stored: DataFrame, key: str = "transaction_id", share: float = 0.5) -> DataFrame:
    """Sent, processed, flagged, mean probability, and whether enough came back."""
    one = stored.select(key, "is_fraud", "fraud_probability", F.lit(True).alias("_stored"))
    n, m = F.col("sent"), F.col("processed")
    return (
        sent.select(key).join(one, key, "left")
        .agg(
            F.count(F.lit(1)).alias("sent"),
            F.count("_stored").alias("processed"),
            F.count_if(F.col("is_fraud")).alias("fraud_detected"),
            F.avg("fraud_probability").alias("avg_fraud_probability"),
        )
        .withColumn("complete_enough", F.coalesce(m / F.nullif(n, F.lit(0)) >= F.lit(share), F.lit(False)))
    )


def summary(scored: DataFrame) -> DataFrame:
    """Counts of one batch and the sentence about them."""
    return scored.agg(
        F.count(F.lit(1)).alias("processed_count"), F.count_if(F.col("is_fraud")).alias("fraud_count")
    ).withColumn(
        "message",
        F.format_string(S.SUMMARY_TEXT, F.col("processed_count"), F.col("fraud_count")),
    )
