"""A log in shards: where it starts, how much a batch takes, and what a restart goes on with."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyward.operators import rates, stats
from tallyward.plans import queries as q
from tallyward.session import new_folder
from tallyward.sources import envelopes, history, shard_log, side_files
from tallyward.streaming import scoring_stream
from tallyward.streaming.scorer import Scorer


def records(spark, first, n):
    return spark.range(first, first + n).select(F.concat(F.lit("k"), F.col("id") % 37).alias("key"), F.col("id").cast("string").alias("value"))


def drain(spark, path, seen, checkpoint, **options):
    """Runs the stream until nothing waits, with the sizes of its batches by shard."""
    sizes = []

    def keep(batch, batch_id):
        rows = batch.collect()
        sizes.append(Counter(r.shard for r in rows))
        seen.setdefault(batch_id, []).append([int(r.value) for r in rows])

    stream = shard_log.read_stream(spark, path, **options)
    query = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(keep).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return sizes


def values(seen):
    return sorted(v for runs in seen.values() for v in runs[-1])


def test_batches_are_bounded_and_a_restart_loses_and_repeats_nothing(spark):
    path, checkpoint, seen = new_folder(spark, "log"), new_folder(spark, "checkpoint"), {}
    shard_log.append(records(spark, 0, 250), path, at=1_000)
    shard_log.append(records(spark, 250, 150), path, at=2_000)
    sizes = drain(spark, path, seen, checkpoint, start="trim", records=30)
    assert max(n for batch in sizes for n in batch.values()) == 30 and len(sizes) >= 4
    assert values(seen) == list(range(400))
    shard_log.append(records(spark, 400, 90), path, at=3_000)
    drain(spark, path, seen, checkpoint, start="latest", records=30)  # the checkpoint counts, not the start
    shard_log.append(records(spark, 490, 10).withColumn("key", F.lit("new")), path, at=4_000, shards=9)  # perhaps a new shard
    drain(spark, path, seen, checkpoint, records=0)
    assert values(seen) == list(range(500))


def test_a_failed_batch_is_read_again(spark):
    path, checkpoint, seen = new_folder(spark, "log"), new_folder(spark, "checkpoint"), {}
    shard_log.append(records(spark, 0, 200), path, at=1_000)

    def fail(batch, batch_id):
        seen.setdefault(batch_id, []).append([int(r.value) for r in batch.collect()])
        if batch_id == 1:
            raise RuntimeError("lost")

    stream = shard_log.read_stream(spark, path, "trim", records=20)
    query = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(fail).start()
    with pytest.raises(Exception, match="lost"):
        query.processAllAvailable()
    query.stop()
    shard_log.append(records(spark, 200, 40), path, at=2_000)
    drain(spark, path, seen, checkpoint, records=50)
    assert len(seen[1]) == 2 and sorted(seen[1][0]) == sorted(seen[1][1])
    assert values(seen) == list(range(240))


def test_latest_and_the_last_hours(spark):
    import time

    path = new_folder(spark, "log")
    now = int(time.time() * 1000)
    shard_log.append(records(spark, 0, 50), path, at=now - 30 * 3_600_000)
    shard_log.append(records(spark, 50, 50), path, at=now - 2 * 3_600_000)
    day, late, checkpoint = {}, {}, new_folder(spark, "checkpoint")
    drain(spark, path, day, new_folder(spark, "checkpoint"), hours=24)
    assert values(day) == list(range(50, 100))
    drain(spark, path, late, checkpoint)
    shard_log.append(records(spark, 100, 5), path)
    drain(spark, path, late, checkpoint)
    assert values(late) == list(range(100, 105))


def test_unfinished_appends_and_empty_logs(spark):
    path, seen = new_folder(spark, "log"), {}
    drain(spark, path, seen, new_folder(spark, "checkpoint"), start="trim")
    assert values(seen) == []
    records(spark, 0, 5).select(F.lit(0).alias("shard"), "value").write.partitionBy("shard").parquet(f"{path}/log/at=1")  # no index
    drain(spark, path, seen, new_folder(spark, "checkpoint"), start="trim")
    assert values(seen) == []
    shard_log.append(records(spark, 5, 0), path, at=2)
    shard_log.append(records(spark, 5, 3), path, at=3)
    drain(spark, path, seen, new_folder(spark, "checkpoint"), start="trim")
    assert values(seen) == [5, 6, 7]
    with pytest.raises(ValueError, match="forward"):
        shard_log.append(records(spark, 0, 1), path, at=3)
    with pytest.raises(ValueError, match="start"):
        shard_log.read_stream(spark, path, "soon")


def test_scoring_from_a_log(spark, tx):
    places = scoring_stream.Places(new_folder(spark, "stream"))
    rows = history.wire_form(tx)
    side_files.write_user_stats(stats.user_stats(tx), places.at("user_stats"))
    envelopes.publish_to_log(rows, places.at("log"))
    lines = envelopes.read_log(spark, places.at("log"), "trim", records=0)
    scoring_stream.start(spark, places, Scorer(rates.defaults(spark)), q.at(q.NOW), once=True, lines=lines).awaitTermination()
    stored = scoring_stream.store.read(spark, places.at("store"), q.at(q.NOW))
    assert stored.count() == stored.select("transaction_id").distinct().count() == rows.count()
