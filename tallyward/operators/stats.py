"""Per-user statistics.

Kept as partial sums of whole numbers: partial tables of any two sets of rows add
up to the table of their union, to the last bit, in any order. That is what lets
a stream keep the statistics fresh without reading history again.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions.amounts import LIMB, UNITS, limbs, mean_of
from tallyward.operators.skew import attach

_SUMS = ["high", "low", "high_high", "high_low", "low_low"]  # of the two parts of each amount, and of their products
GIVEN = ["transaction_id", "user_id", "amount", "is_vpn"]  # what the sums are made of
PARTIAL_COLUMNS = ["user_id", "n", "n_amount", *_SUMS, "lowest", "highest", "n_vpn", "vpn"]
_WIDE = "decimal(38,0)"


def partials(df: DataFrame) -> DataFrame:
    """One row per user; a null user is no user, an amount that is not finite or out of range no amount."""
    high, low = (x.cast("decimal(13,0)") for x in limbs(F.col("amount")))
    amount = F.when(high.isNotNull(), F.col("amount"))
    sums = dict(zip(_SUMS, (high, low, high * high, high * low, low * low), strict=True))
    return df.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        F.count("transaction_id").alias("n"),
        F.count(high).alias("n_amount"),
        *[F.sum(x).cast(_WIDE).alias(name) for name, x in sums.items()],
        F.min(amount).alias("lowest"),
        F.max(amount).alias("highest"),
        F.count("is_vpn").alias("n_vpn"),
        F.sum(F.col("is_vpn").cast("int")).alias("vpn"),
    )


def merge_partials(*tables: DataFrame) -> DataFrame:
    """Add partial tables up."""
    both = tables[0]
    for table in tables[1:]:
        both = both.unionByName(table)
    return both.groupBy("user_id").agg(
        *[F.sum(c).cast("long").alias(c) for c in ("n", "n_amount", "n_vpn", "vpn")],
        *[F.sum(c).cast(_WIDE).alias(c) for c in _SUMS],
        F.min("lowest").alias("lowest"),
        F.max("highest").alias("highest"),
    ).select(*PARTIAL_COLUMNS)


def finish(parts: DataFrame) -> DataFrame:
    """Partial sums to mean, sample deviation (0 for a single row), extremes and VPN share.

    The squares are taken about the whole part of the mean, in the same two parts, before they are put together: no
    number on the way is larger than the sums themselves, and nothing is lost where the amounts lie close together.
    """
    n, limb = F.col("n_amount").cast("decimal(20,0)"), F.lit(LIMB).cast("decimal(13,0)")
    wide = lambda x: x.cast(_WIDE)
    total = wide(F.col("high") * limb + F.col("low"))
    mean = parts.withColumn("total", total).withColumn("n_amount", F.nullif("n_amount", F.lit(0)))
    mean = mean.withColumn("rest", wide(F.col("total") % n)).withColumn("whole", ((F.col("total") - F.col("rest")) / n).cast(_WIDE))
    mean = mean.withColumn("mean_low", F.col("whole") % limb).withColumn("mean_high", ((F.col("whole") - F.col("mean_low")) / limb).cast("decimal(20,0)"))
    mh, ml = F.col("mean_high"), F.col("mean_low").cast("decimal(13,0)")
    hh = wide(wide(F.col("high_high") - wide(2 * mh * F.col("high"))) + wide(n * wide(mh * mh)))
    ll = wide(wide(F.col("low_low") - wide(2 * ml * F.col("low"))) + wide(n * wide(ml * ml)))
    hl = wide(wide(F.col("high_low") - wide(ml * F.col("high"))) - wide(mh * F.col("low"))) + wide(n * wide(mh * ml))
    spread = mean.withColumns({"hh": hh, "hl": wide(hl), "ll": ll})
    scaled = F.try_add(F.try_multiply(wide(F.col("hh")), wide(limb * limb)), F.try_multiply(wide(2 * F.col("hl")), wide(limb)))
    exact = F.try_add(scaled, F.col("ll"))
    # beyond whole numbers the first term is so much larger than the others that doubles lose nothing
    rounded = F.col("hh").cast("double") * float(LIMB) ** 2 + F.col("hl").cast("double") * (2.0 * LIMB) + F.col("ll").cast("double")
    rest = F.col("rest").cast("double")
    squares = F.coalesce(exact.cast("double"), rounded) - rest * rest / F.col("n_amount")
    variance = F.when(F.col("n_amount") > 1, F.greatest(squares, F.lit(0.0)) / (F.col("n_amount") - 1))
    return spread.select(
        "user_id",
        F.col("n").alias("user_transaction_count"),
        mean_of(F.col("total"), F.col("n_amount")).alias("user_avg_amount"),
        F.coalesce(F.sqrt(variance) / UNITS, F.lit(0.0)).alias("user_amount_std"),
        F.col("lowest").alias("user_min_amount"),
        F.col("highest").alias("user_max_amount"),
        F.when(F.col("n_vpn") > 0, F.col("vpn") / F.col("n_vpn")).alias("user_vpn_ratio"),
    )


def user_stats(df: DataFrame) -> DataFrame:
    return finish(partials(df))


def with_user_stats(df: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Statistics joined back to each row; a null user has null statistics."""
    return attach(df, user_stats(df) if stats is None else stats, "user_id")
