"""Mixing sources to target weights by repetition: floor(rate) copies and one more by a hashed coin."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.tables import fresh, partitions, stored

MOST = 3.0  # a source may be repeated so often on average
WEIGHTS = (1, 2, 3)  # of the sources in order, over and over
SMALL = 100_000  # a table of so many sources may be broadcast
SEED = "mix"
CHUNK = 65_536  # rows of one repeated record that one task writes out at a time
WORD = r"[^\x20\x09-\x0D]+"


def words(column: str = "text"):
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sized: DataFrame) -> DataFrame:
    """A row per source: ``source, source_size, target, rate``.

    A target is ``least(3 * size, level * weight)``; the level is where the targets add up to all sizes, which is the
    largest of the levels found when the sources that cap first are left out one by one. One row per source goes
    through one task here; their number doesn't follow the number of documents.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sums.withColumn("weight", F.element_at(
        F.array(*[F.lit(w) for w in WEIGHTS]), ((F.row_number().over(named) - 1) % len(WEIGHTS) + 1).cast("int")))
    everything = Window.partitionBy()
    earlier = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - MOST * F.coalesce(F.sum("source_size").over(earlier), F.lit(0))
    weights = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0))
    levels = ranked.withColumn("level", left / weights)
    return levels.withColumn("level", F.max("level").over(everything)).select(
        "source", "source_size",
        F.least(MOST * F.col("source_size"), F.col("level") * F.col("weight")).alias("target"),
    ).withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))


def _sized(docs: DataFrame, *columns) -> DataFrame:
    return docs.select(*columns, "doc_id", "source", words().alias("size"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest"))


_RECORD = ["doc_id", "source", "size", "digest"]


def _coin(seed: str, number) -> Column:
    """A number in [0, 1) from seed, id, text and the number among rows alike in these."""
    key = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "digest", number.cast("string"))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def _copies(seed: str, number) -> Column:
    whole = F.floor("rate")
    return (whole + (_coin(seed, number) < F.col("rate") - whole).cast("long")).cast("long")


def _sides(sized: DataFrame) -> DataFrame:
    table = stored(targets(sized.select("source", "size")), "mix-sources")
    side = table.select(F.col("source").alias("_source"), "source_size", "target", "rate")
    return F.broadcast(side) if table.count() <= SMALL else side


def _with_targets(sized: DataFrame, side: DataFrame) -> DataFrame:
    return sized.join(side, sized["source"].eqNullSafe(side["_source"]), "left").drop("_source")


def _numbered(records: DataFrame) -> DataFrame:
    """Records with their number of ``rows`` as that many rows, numbered; many rows of one record are dealt out."""
    chunks = records.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("rows") - 1) / CHUNK).cast("int"))))
    chunks = chunks.repartition(partitions(records.sparkSession), "doc_id", "digest", "chunk")
    here = F.col("chunk").cast("long") * CHUNK
    return chunks.withColumn("number", F.explode(F.sequence(here, F.least(here + CHUNK, F.col("rows")) - 1)))


def taken(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """``doc_id, size, source_size, target, taken``: what the mix takes of each row, in words.

    ``size`` is the number of words (0 for a null text). A row is taken ``floor(rate)`` times and once more where a number
    in [0, 1) hashed from seed, doc_id and text is below the rate's fraction: the same in every run. Rows alike in
    id, source and text have numbers of their own, so that each has a coin of its own, also without ids. A null source
    is a source, the last one; a source without words has target 0 and no copies. Other columns are ignored.
    """
    sized = _sized(docs)
    records = _with_targets(sized, _sides(sized)).groupBy(*_RECORD, "source_size", "target", "rate").agg(F.count("*").alias("rows"))
    rows = _numbered(records).withColumn("copies", _copies(seed, F.col("number")))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def emit(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The mix itself: each row of ``docs``, with its own columns, as often as ``taken`` has it.

    Of rows alike in id, source and text one stands for all, as often as they are taken together.
    """
    row = fresh(docs, "_row")
    narrow = _sized(docs)
    side = _sides(narrow)
    sized = _with_targets(_sized(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row)), side)
    key = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in _RECORD], *[F.col(c).isNull() for c in _RECORD])
    repeated = _with_targets(narrow, side).groupBy(*_RECORD, "rate").agg(F.count("*").alias("rows")).filter("rows > 1")
    repeated = _numbered(repeated).withColumn("copies", _copies(seed, F.col("number"))).groupBy(*_RECORD).agg(F.sum("copies").alias("together"))
    repeated = stored(repeated.select(key.alias("_key"), "together"), "mix-repeated")  # rows without an id, as a rule
    sized = sized.withColumn("_key", key).join(repeated, "_key", "left")
    alone = sized.filter("together IS NULL").withColumn("copies", _copies(seed, F.lit(0)))
    first = F.row_number().over(Window.partitionBy("_key").orderBy(F.lit(0)))
    shared = sized.filter("together IS NOT NULL").withColumn("_at", first).filter("_at = 1").withColumn("copies", F.col("together"))
    rows = alone.select(row, "copies").unionByName(shared.select(row, "copies")).filter("copies > 0")
    parts = rows.withColumn("_part", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / CHUNK).cast("int"))))
    here = F.least(F.col("copies") - F.col("_part").cast("long") * CHUNK, F.lit(CHUNK)).cast("int")
    return parts.select(row, F.explode(F.sequence(F.lit(1), here))).select(f"{row}.*")
