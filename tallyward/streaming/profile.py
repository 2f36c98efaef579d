"""User statistics kept fresh by the stream.

Learning is a stream of its own beside scoring. Each id counts once within a horizon: the engine's state keeps the ids that
arrived within it and forgets older ones, so neither state nor batch time grows with the age of the stream. A micro-batch
adds the exact sums of its users as a small table of its own; a repeated batch replaces it. Every so many batches the
sums are merged into a new base, laid out by a hash of the user, and a new epoch of small tables begins.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyward import schemas as S
from tallyward.operators import stats
from tallyward.session import new_folder
from tallyward.sources import envelopes, side_files

HORIZON = "24 hours"  # of arrival: as long as the source may deliver a record again
MERGE_EVERY = 100  # batches

_EPOCH = "epoch int, base string, query string, upto long"
_DELTA = T.StructType([*S.USER_PARTIALS.fields, T.StructField("query", T.StringType()), T.StructField("batch_id", T.LongType())])


def query_of(batch: DataFrame) -> str:
    """The id that a query keeps over restarts from one checkpoint; it names the query's folders."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "0"


def _epoch(spark: SparkSession, path: str) -> tuple[int, str | None, dict[str, int]]:
    """The current epoch, its base, and the last batch of each query that is in the base."""
    try:
        rows = spark.read.schema(_EPOCH).json(f"{path}/epochs").collect()  # a row per merge and query
    except AnalysisException:
        rows = []
    now = max((r.epoch for r in rows), default=0)
    base = next((r.base for r in rows if r.epoch == now), None)
    return now, base, {r.query: r.upto for r in rows if r.epoch == now and r.query is not None}


def _deltas(spark: SparkSession, path: str, epoch: int) -> DataFrame:
    folder = f"{path}/deltas/epoch={epoch}"
    try:
        return spark.read.schema(_DELTA).option("basePath", folder).parquet(folder)
    except AnalysisException:
        return spark.createDataFrame([], _DELTA)


def learn(transactions: DataFrame, batch_id: int, path: str, base: str | None = None, query: str | None = None,
          merge_every: int = MERGE_EVERY) -> None:
    """Adds the sums of one batch, whose ids are new; merges after every ``merge_every`` batches."""
    spark = transactions.sparkSession
    query = query_of(transactions) if query is None else query
    epoch, _, merged = _epoch(spark, path)
    if batch_id > merged.get(query, -1):  # else a repeated batch that is in the base already
        stats.partials(transactions).sortWithinPartitions("user_id").write.mode("overwrite").parquet(
            f"{path}/deltas/epoch={epoch}/query={query}/batch_id={batch_id}")
        if (batch_id + 1) % merge_every == 0:
            merge(spark, path, base)


def merge(spark: SparkSession, path: str, base: str | None = None) -> None:
    """All sums as a new base. The epoch counts once its row is written, which comes last."""
    epoch, own, merged = _epoch(spark, path)
    deltas = _deltas(spark, path, epoch)
    upto = merged | {r.query: r.upto for r in deltas.groupBy("query").agg(F.max("batch_id").alias("upto")).collect()}
    target = new_folder(spark, "user-partials")
    earlier = side_files.read_user_partials(spark, own or base or f"{path}/base")
    side_files.write_user_partials(stats.merge_partials(earlier, deltas.drop("query", "batch_id")), target)
    rows = [(epoch + 1, target, q, b) for q, b in upto.items()] or [(epoch + 1, target, None, None)]
    spark.createDataFrame(rows, _EPOCH).coalesce(1).write.mode("append").json(f"{path}/epochs")


def current(spark: SparkSession, path: str, base: str | None = None, users: DataFrame | None = None) -> DataFrame:
    """Statistics per user from the base sums (``base``, or ``path``'s own) and what was learned since.

    With ``users`` (a column ``user_id``) only theirs: of the base the folders of these users are read.
    """
    epoch, own, _ = _epoch(spark, path)
    sums = side_files.read_user_partials(spark, own or base or f"{path}/base", users)
    deltas = _deltas(spark, path, epoch).drop("query", "batch_id")
    if users is not None:
        deltas = deltas.join(users.select("user_id").distinct(), "user_id", "left_semi")
    return stats.finish(stats.merge_partials(sums, deltas))


def compact(spark: SparkSession, path: str, target: str, base: str | None = None) -> None:
    """All that is known as base sums in a new place."""
    epoch, own, _ = _epoch(spark, path)
    sums = side_files.read_user_partials(spark, own or base or f"{path}/base")
    side_files.write_user_partials(stats.merge_partials(sums, _deltas(spark, path, epoch).drop("query", "batch_id")), f"{target}/base")


def once_per_id(transactions: DataFrame, horizon: str = HORIZON) -> DataFrame:
    """The first delivery of each id within the horizon, by time of arrival: no record is late."""
    arrived = transactions.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", horizon)
    return arrived.dropDuplicatesWithinWatermark(["transaction_id"]).drop("_arrived")


def start(spark: SparkSession, source: str, path: str, checkpoint: str, base: str | None = None, horizon: str = HORIZON,
          merge_every: int = MERGE_EVERY, files_per_batch: int = 100, once: bool = False) -> StreamingQuery:
    """Learn from the envelopes at ``source``: valid records, each id once."""
    valid = envelopes.accepted(envelopes.decode(envelopes.read_stream(spark, source, files_per_batch)))
    writer = (
        once_per_id(valid.select(*stats.GIVEN), horizon).writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: learn(batch, batch_id, path, base, merge_every=merge_every))
    )
    return (writer.trigger(availableNow=True) if once else writer).start()
