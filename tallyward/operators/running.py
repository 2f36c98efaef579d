"""Running totals per user in time order, as a distributed prefix sum.

Rows are dealt out in ranges of the order (user, time, id), so a busy user, or one busy second, spreads over as many
ranges as its rows fill. A range adds up its own rows; a user that goes on over a border starts in the next range from
the totals of the ranges before. Only the first and the last user of a range can do so: what is brought together of
them is a few rows per range, whatever the number of users or rows.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.functions.amounts import mean_of, units
from tallyward.session import new_folder


def ranged(df: DataFrame, ranges: int | None = None) -> DataFrame:
    """The rows in ranges, written once; ``_range`` numbers them in the order (user, time, id)."""
    order = ["user_id", "ts", "transaction_id"]
    spread = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    placed = spread.withColumn("_range", F.spark_partition_id())
    placed.write.parquet(path := new_folder(df.sparkSession, "ranges"))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in placed.schema])
    return df.sparkSession.read.schema(schema).parquet(path)


def running_profile(df: DataFrame, ranges: int | None = None) -> DataFrame:
    """Adds ``running_count`` and ``running_avg`` up to and including each row; as many ranges as Spark shuffles by."""
    rows = ranged(df.withColumn("_units", units(F.col("amount"))), ranges)
    who = F.struct("user_id")  # a struct, so that the null user is one as well
    edges = rows.groupBy("_range").agg(F.min(who).alias("a"), F.max(who).alias("b"))
    edges = edges.select(F.explode(F.array("a.user_id", "b.user_id")).alias("_who")).distinct()
    # at most two users per range, and of each a row per range
    earlier = Window.partitionBy("_who").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    start = (
        rows.join(F.broadcast(edges), F.col("user_id").eqNullSafe(F.col("_who")))
        .groupBy("_who", F.col("_range").alias("_at"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("_units").alias("s"))
        .select(
            "_who", "_at",
            F.sum("n").over(earlier).alias("_start_count"),
            F.sum("s").over(earlier).alias("_start_total"),
        ).filter(F.col("_start_count").isNotNull())
    )
    joined = rows.join(
        F.broadcast(start),
        F.col("user_id").eqNullSafe(F.col("_who")) & (F.col("_range") == F.col("_at")),
        "left",
    )
    within = (
        Window.partitionBy("user_id", "_range").orderBy("ts", "transaction_id")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    count = F.count(F.lit(1)).over(within) + F.coalesce("_start_count", F.lit(0))
    total = F.coalesce(F.sum("_units").over(within), F.lit(0)) + F.coalesce("_start_total", F.lit(0))
    some = F.count("_units").over(within) > 0
    return joined.withColumn("running_count", count).withColumn(
        "running_avg", F.when(some | F.col("_start_total").isNotNull(), mean_of(total, F.col("running_count")))
    ).select(*df.columns, "running_count", "running_avg")
