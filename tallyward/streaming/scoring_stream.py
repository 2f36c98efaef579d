"""The scoring stream: envelopes in; stored rows, alerts, rejects and summaries out.

Every sink writes into a folder named after the query and the micro-batch, so a batch that
is run again after a failure replaces its own output, and nothing else: at-least-once
delivery gives each result once, a query with a new checkpoint adds to what is there.
"""

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyward.operators import alerts, store
from tallyward.sources import envelopes, side_files
from tallyward.streaming import profile
from tallyward.streaming.scorer import Scorer


@dataclass
class Places:
    """Folders of one stream, all below one root on shared storage."""

    root: str

    def at(self, name: str) -> str:
        return f"{self.root}/{name}"


def one_per_id(rows: DataFrame) -> DataFrame:
    """Inside one batch the row with the latest time stands for its id."""
    order = Window.partitionBy("transaction_id").orderBy(F.desc("timestamp"), F.desc("amount"))
    return rows.withColumn("_place", F.row_number().over(order)).filter("_place = 1").drop("_place")


def handle(
    batch: DataFrame, batch_id: int, places: Places, scorer: Scorer, now: Column | None = None,
    learn: bool = False, started: int = 0,
) -> None:
    """All work of one micro-batch. With ``learn`` rows are scored with what the learning stream knows by now."""
    spark, query = batch.sparkSession, profile.query_of(batch)
    sink = f"query={query}/batch_id={batch_id}"
    decoded = envelopes.decode(batch).persist()
    try:
        transactions = envelopes.accepted(decoded)
        if learn:
            statistics = profile.current(spark, places.at("profile"), places.at("user_partials"), transactions)
        else:
            statistics = side_files.read_user_stats(spark, places.at("user_stats"), transactions)
        scored = scorer.score(transactions, statistics, now).persist()
        try:
            store.append(one_per_id(scored), batch_id, places.at("store"), query, started)
            alerts.alerts(scored).write.mode("overwrite").json(f"{places.at('alerts')}/{sink}")
            envelopes.rejected(decoded).write.mode("overwrite").json(f"{places.at('rejects')}/{sink}")
            store.summary(scored).coalesce(1).write.mode("overwrite").json(f"{places.at('summaries')}/{sink}")
        finally:
            scored.unpersist()
    finally:
        decoded.unpersist()


def start(
    spark: SparkSession, places: Places, scorer: Scorer, now: Column | None = None, learn: bool = False,
    files_per_batch: int = 100, once: bool = False, lines: DataFrame | None = None,
) -> StreamingQuery:
    """Start the scoring stream; ``once`` works off what is there and stops.

    ``lines`` are other envelopes than the files in their place, as from ``envelopes.read_log``; of such a log ``once``
    works off one batch, so it is read with ``records=0`` then. With ``learn`` the statistics are those of the learning stream, see ``start_learning``.
    """
    if lines is None:
        lines = envelopes.read_stream(spark, places.at("envelopes"), files_per_batch)
    started = int(time.time() * 1000)
    writer = (
        lines.writeStream.option("checkpointLocation", places.at("checkpoint"))
        .foreachBatch(lambda batch, batch_id: handle(batch, batch_id, places, scorer, now, learn, started))
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def start_learning(spark: SparkSession, places: Places, files_per_batch: int = 100, once: bool = False, **options) -> StreamingQuery:
    """The stream beside it that learns user statistics from the same envelopes; ``options`` as in ``profile.start``."""
    return profile.start(spark, places.at("envelopes"), places.at("profile"), places.at("profile_checkpoint"), places.at("user_partials"),
                         files_per_batch=files_per_batch, once=once, **options)


def replay(spark: SparkSession, places: Places, scorer: Scorer, now: Column | None = None,
           files_per_batch: int = 100, learn: bool = False) -> DataFrame:
    """Work the waiting envelopes off, then learn from them, then give the current stored rows."""
    start(spark, places, scorer, now, learn, files_per_batch, once=True).awaitTermination()
    if learn:
        start_learning(spark, places, files_per_batch, once=True).awaitTermination()
    return store.read(spark, places.at("store"), now)


def try_out(spark: SparkSession, places: Places, sent: DataFrame, scorer: Scorer, now: Column | None = None,
            files_per_batch: int = 100) -> DataFrame:
    """Sends records through a stream of their own and keeps what came back, as one row in ``stream_test``."""
    envelopes.publish(sent, places.at("envelopes"))
    stored = replay(spark, places, scorer, now, files_per_batch)
    side_files.write_small(store.round_trip(sent, stored), places.at("stream_test"))
    return spark.read.json(places.at("stream_test"))
