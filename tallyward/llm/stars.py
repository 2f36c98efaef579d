"""Connected components of a graph given as an edge table, by stars of each partition (numpy); ``components`` does it without Python."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallyward.llm.tables import stored

_EDGE = "u long, v long"


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node of these edges that isn't the smallest of its component, with that smallest node."""
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = place[: len(u)], place[len(u):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        # hook the roots of both ends below the smaller one, then let all point to their roots
        np.minimum.at(root, before[a], low)
        np.minimum.at(root, before[b], low)
        while not np.array_equal(up := root[root], root):
            root = up
        if np.array_equal(before, root):
            break
    other = root != np.arange(len(nodes))
    return nodes[other], nodes[root[other]]


def _forests(batches):
    """The edges of a partition as stars; never more of them at a time than nodes and one batch."""
    u, v = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        u, v = forest(np.append(u, batch.column("u").to_numpy()), np.append(v, batch.column("v").to_numpy()))
    yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` for every node that has an edge to another; the root is the smallest node of its component.

    In turns: the edges of each partition become stars around smallest nodes, first where they are, then brought together by
    their larger end (which after the first step has one edge per partition at most, however many it had); then
    every node is led on to where its star's centre points. A turn halves the ways to the roots at least; the table
    is written to the shared folder after each half turn. Ends when a turn changes nothing.
    """
    turn = edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).filter("u <> v")
    before = None
    while True:
        stars = stored(turn.mapInArrow(_forests, _EDGE).repartition("u").mapInArrow(_forests, _EDGE), "stars")
        on = stars.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("on"))
        state = Observation()
        led = stars.join(on, "v", "left").select("u", F.coalesce("on", "v").alias("v")).observe(
            state, F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"))
        turn = stored(led, "stars")
        after = state.get
        if after == before or not after["n"]:
            break
        before = after
    roots = turn.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return turn.select(F.col("u").alias("node"), F.col("v").alias("root")).distinct().unionByName(roots)
