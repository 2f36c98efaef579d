"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

For a term of weight w, sample k draws from the hash of (term, k): r and c of Gamma(2, 1), b uniform. With
t = floor(ln w / r + b) the term's value is c * exp(-r * (t - b + 1)), and the term with the smallest value gives the
sample (term, t). Two weighted sets have the same sample with a probability equal to their generalised Jaccard
similarity, sum of minima over sum of maxima, so the share of equal samples estimates it.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.tables import partitions, stored, text_or_empty

SAMPLES = 32
TASKS = 8  # as many tasks as this for each shuffle partition: a task counts the terms of its texts in memory
BLANK = " \t\n\x0b\f\r"
COARSE = 16


def sample(term: Column, log_weight: Column, k: int) -> Column:
    """The sample's value and name in one number: 2^-22 steps of ln(value), then 24 bits of the hash of (term, t)."""
    first = F.xxhash64(term, F.lit(k))
    second = F.xxhash64(first)

    def uniform(h: Column, part: int) -> Column:
        return (F.shiftright(h, 21 * part).bitwiseAND(F.lit((1 << 21) - 1)).cast("double") + 0.5) / F.lit(float(1 << 21))

    r = -F.ln(uniform(first, 0) * uniform(first, 1))
    c = -F.ln(uniform(first, 2) * uniform(second, 0))
    b = uniform(second, 1)
    t = F.floor(log_weight / r + b)
    value = F.ln(c) - r * (t - b + 1)
    return F.shiftleft(F.floor(value * F.lit(float(1 << 22))).cast("long"), 24) + F.xxhash64(second, t).bitwiseAND(F.lit((1 << 24) - 1))


def _terms(text: Column) -> Column:
    """Lower-case words; a text without any has the empty word."""
    return F.split(F.lower(F.btrim(text, F.lit(BLANK))), r"[\x20\x09-\x0D]+")


def _bins(docs: DataFrame, n: int) -> Column:
    """A number for ``doc_id`` that never falls as ids rise and deals rows out about evenly.

    Some approximate quantiles, at equal steps in between; null ids come last.
    """
    id_ = F.col("doc_id")
    cuts = docs.approxQuantile("doc_id", [i / COARSE for i in range(COARSE + 1)], 1 / (4 * COARSE))
    cuts = sorted({int(c) for c in cuts})
    steps = -(-n // COARSE)
    if len(cuts) < 2:
        return F.when(id_.isNull(), 1).otherwise(0)

    def within(i: int) -> Column:
        share = (id_ - F.lit(cuts[i])).cast("double") / F.lit(float(cuts[i + 1] - cuts[i]))
        return F.lit(i * steps) + F.greatest(F.lit(0), F.least(F.lit(steps - 1), F.floor(share * steps).cast("int")))

    def tree(lo: int, hi: int) -> Column:
        if hi - lo == 1:
            return within(lo)
        mid = (lo + hi) // 2
        return F.when(id_ < cuts[mid], tree(lo, mid)).otherwise(tree(mid, hi))

    return F.when(id_.isNull(), len(cuts) * steps).otherwise(tree(0, len(cuts) - 1))


def with_next(docs: DataFrame) -> DataFrame:
    """``bin, rid, doc_id, text, next_text``: each text beside the next one by ``doc_id``, the first after the last.

    Ids that repeat are in the order of their texts, null ids come last. Texts move once, to the bin of their id;
    the first text of a bin moves to the bin before as well.
    """
    spark = docs.sparkSession
    n = TASKS * partitions(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.withColumn("bin", _bins(rows, n))
    # a row per bin
    firsts = rows.groupBy("bin").agg(F.min("doc_id").alias("first_id"))
    order = Window.orderBy("bin")
    back = firsts.withColumn("before", F.coalesce(F.lag("bin").over(order), F.max("bin").over(Window.partitionBy())))
    back = stored(back, "fingerprint-bins")
    guests = (
        rows.join(F.broadcast(back), (rows["bin"] == back["bin"]) & rows["doc_id"].eqNullSafe(back["first_id"]))
        .groupBy("before").agg(F.min("text").alias("text"))
        .select(F.lit(None).cast("long").alias("doc_id"), "text", F.col("before").alias("bin"), F.lit(1).alias("guest"))
    )
    together = rows.withColumn("guest", F.lit(0)).unionByName(guests).repartition(n, "bin")
    order = Window.partitionBy("bin").orderBy("guest", F.col("doc_id").asc_nulls_last(), "text")
    return together.select(
        "bin", "guest", "doc_id", "text", F.row_number().over(order).alias("rid"), F.lead("text").over(order).alias("next_text")
    ).filter("guest = 0").drop("guest")


def edited(text: Column, following: Column) -> Column:
    """The text with its last floor(n / 4) code points replaced by the first as many of the following one."""
    n = F.char_length(text)
    cut = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - cut), F.substring(following, F.lit(1), cut))


def signatures(pairs: DataFrame, keys: list[str], first: str, second: str, samples: int = SAMPLES) -> DataFrame:
    """``keys..., a, b``: the samples of two texts of each row; ``keys`` name the row.

    Rows must lie together by the first key already: then nothing moves here. A term with one weight in both texts is
    drawn once. Equal texts have equal samples.
    """
    words = pairs.select(*keys, F.inline(F.array(
        F.struct(F.lit(1).alias("in_a"), F.lit(0).alias("in_b"), _terms(F.col(first)).alias("words")),
        F.struct(F.lit(0).alias("in_a"), F.lit(1).alias("in_b"), _terms(F.col(second)).alias("words")))))
    weights = (
        words.select(*keys, "in_a", "in_b", F.explode("words").alias("word"))
        .groupBy(*keys, F.xxhash64("word").alias("term")).agg(F.sum("in_a").alias("a"), F.sum("in_b").alias("b"))
    )
    side = weights.select(*keys, "term", F.explode(
        F.when(F.col("a") == F.col("b"), F.array(F.struct(F.lit(2).alias("of"), F.col("a").alias("w"))))
        .otherwise(F.array(F.struct(F.lit(0).alias("of"), F.col("a").alias("w")), F.struct(F.lit(1).alias("of"), F.col("b").alias("w"))))
    ).alias("s")).select(*keys, "term", "s.of", F.ln("s.w").alias("log_w")).filter("log_w IS NOT NULL")
    low = side.groupBy(*keys, "of").agg(*[F.min(sample(F.col("term"), F.col("log_w"), k)).alias(f"s{k}") for k in range(samples)])
    both = low.groupBy(*keys).agg(
        *[F.min(F.when(F.col("of") != 1, F.col(f"s{k}"))).alias(f"a{k}") for k in range(samples)],
        *[F.min(F.when(F.col("of") != 0, F.col(f"s{k}"))).alias(f"b{k}") for k in range(samples)])
    return both.select(*keys, *[F.array(*[
        F.xxhash64(f"{x}{k}").bitwiseAND(F.lit(0xFFFFFFFF)) for k in range(samples)]).alias(x) for x in "ab"])


def as_text(samples: Column) -> Column:
    """8 hexadecimal digits per sample, which has 32 bits."""
    return F.lower(F.array_join(F.transform(samples, lambda x: F.lpad(F.hex(x), 8, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """The share of equal samples."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)).cast("double") / F.size(a)


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """A row per document: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    Terms are the whole text's lower-case words, weighted by how often they occur. A null text counts as empty; a text
    without words has one term of its own, so such texts are alike (1.0) and differ from all others (0.0). The next
    document is by ascending ``doc_id``, see ``with_next``; a table of one row has itself as the next. Other columns
    are ignored.
    """
    pairs = with_next(docs)
    pairs = pairs.withColumn("edited", edited(F.col("text"), F.col("next_text")))
    signed = signatures(pairs.select("bin", "rid", "text", "edited"), ["bin", "rid"], "text", "edited", samples)
    base = pairs.select(
        "bin", "rid", "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"))
    rows = stored(base.join(signed, ["bin", "rid"]), "fingerprint-samples")
    # the next row's samples: in the same bin, or the first row of the next bin
    firsts = rows.filter("rid = 1").select("bin", F.col("a").alias("first_a"))
    order = Window.orderBy("bin")
    # a row per bin
    firsts = firsts.select("bin", F.coalesce(F.lead("first_a").over(order), F.first("first_a").over(order)).alias("first_a"))
    inside = Window.partitionBy("bin").orderBy("rid")
    rows = rows.withColumn("next_a", F.lead("a").over(inside)).join(F.broadcast(firsts), "bin", "left")
    following = F.coalesce("next_a", "first_a")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("a")).alias("fingerprint"), as_text(F.col("b")).alias("edited_fingerprint"),
        likeness(F.col("a"), F.col("b")).alias("near_edited"), likeness(F.col("a"), following).alias("near_next"))
