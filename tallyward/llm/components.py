"""Connected components of a graph given as an edge table, by DataFrame functions only."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.tables import stored


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row.n, row.x


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` for every node that has an edge; the root is the smallest node of its component.

    Large-star and small-star steps in turns (a published map-reduce scheme): every step is a
    grouped minimum, which combines on the map side, and a join back, so a node with any number of
    edges needs no task of its own. The table is written to the shared folder after each turn.
    """
    turn = stored(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "edges"
    )
    before = _state(turn)
    while before[0]:
        both = turn.unionByName(turn.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        turn = stored(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        after = _state(turn)
        if after == before:
            break
        before = after
    roots = turn.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return turn.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
