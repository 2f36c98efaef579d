"""Rendezvous hashing of stable record keys over weighted shards."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.tables import partitions, text_or_empty, without

CHUNK = 65_536  # rows of one repeated record that one task may write out


def place(keys: list[Column], weights: list[float]) -> Column:
    """The shard whose score for the key is largest: weight / -ln(u), u hashed from key and shard.

    A shard's scores don't depend on the other shards, so a new one only takes records into itself, a dropped one only
    gives up its own, and each shard's share of the keys is its share of the weights.
    """
    scores = []
    for shard, weight in enumerate(weights):
        u = (F.shiftrightunsigned(F.xxhash64(*keys, F.lit(f"shard {shard}")), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
        scores.append(F.struct((F.lit(-float(weight)) / F.ln(u)).alias("score"), F.lit(shard).alias("shard")))
    return F.array_max(F.array(*scores))["shard"] if len(scores) > 1 else F.lit(0)


def assign(df: DataFrame, key: str, weights: list[float]) -> DataFrame:
    """Adds ``shard`` to every row, from the key alone; no shuffle. Null keys are a key like any other."""
    return without(df, "shard").withColumn("shard", place([F.col(key)], weights))


def write(df: DataFrame, key: str, weights: list[float], path: str) -> None:
    """The rows, whole, as one Parquet folder per shard."""
    assign(df, key, weights).write.partitionBy("shard").parquet(path)


def slots(docs: DataFrame, shards: int = 8) -> DataFrame:
    """A row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    ``size`` is the text's UTF-8 bytes plus 1 (a null text has none). ``slot`` numbers the rows of a shard from 0
    without gaps, in the order of a hash bin, then doc_id, checksum and size (nulls first); rows alike in all these
    take the slots in a row. Rows are counted per bin first, so no task needs a whole shard, and rows that repeat
    travel as one row with a count. Other columns are ignored.
    """
    bins = partitions(docs.sparkSession)
    text = text_or_empty()
    record = ["doc_id", "size", "text_crc32"]
    rows = (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
        )
        .groupBy(*record).agg(F.count("*").alias("rows"))
        .withColumn("shard", place([F.col("doc_id")], [1.0] * shards))
        .withColumn("bin", F.pmod(F.xxhash64(*record), F.lit(bins)).cast("int"))
    )
    within = Window.partitionBy("shard", "bin").orderBy(*record).rowsBetween(Window.unboundedPreceding, 0)
    # at most shards x bins rows, whatever the number of documents
    size_of = rows.groupBy("shard", "bin").agg(F.sum("rows").alias("in_bin"))
    before = Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    begins = size_of.select("shard", "bin", (F.sum("in_bin").over(before) - F.col("in_bin")).alias("begin"))
    ranged = (
        rows.withColumn("upto", F.sum("rows").over(within))
        .join(F.broadcast(begins), ["shard", "bin"])
        .withColumn("first", F.col("begin") + F.col("upto") - F.col("rows"))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("rows") - 1) / CHUNK).cast("int"))))
    )
    spread = ranged.repartition(bins, "doc_id", "text_crc32", "chunk")  # narrow rows; deals out a record repeated often
    here = F.col("chunk").cast("long") * CHUNK
    return spread.withColumn("at", F.explode(F.sequence(here, F.least(here + CHUNK, F.col("rows")) - 1))).select(
        *record, F.lit("key").alias("law"), "shard", (F.col("first") + F.col("at")).alias("slot"),
        place([F.col("doc_id")], [1.0] * (shards + 1)).alias("grown_shard"),
    )
