"""Approximate nearest neighbours by largest inner product, with an adaptive scan of dimensions.

Vectors get one more dimension that makes all of them equally long, so the largest inner product is the smallest
distance. Centres found on a bounded sample deal every vector to a list. A query probes the lists of its nearest
centres; in each, vectors are rotated at random and read in blocks of columns. After each block a hypothesis test on
the distance so far (in a random rotation, d of D dimensions hold about d/D of it) gives up the vectors that are very
unlikely to be among the best, so most are left after a few columns. Scores are worked out on the original vectors.
"""

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.tables import stored

NEAREST = 20
EVERY = 20  # ids divisible by this are queries
SAMPLE = 20_000  # vectors that the centres are found on
MOST_LISTS = 1024
RECALL, TRIED = 0.97, 200  # so much of the sample's own neighbours must lie in the probed lists, over so many queries
COLUMNS = 16  # in a block
EPSILON = 2.1  # of the test; larger gives up less
ROWS, QUERIES = 16_384, 2_048  # of a list that one task compares at once


def usable(vector: Column) -> Column:
    """Not null, not zero, every component a finite number."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def vectors(table: DataFrame) -> DataFrame:
    """``id, vec`` of the rows that take part: an id, a usable vector, and the most common number of dimensions."""
    rows = table.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("vec"))
    rows = rows.filter(F.col("id").isNotNull() & F.coalesce(usable(F.col("vec")), F.lit(False)))
    sizes = rows.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    return rows.filter(F.size("vec") == (sizes.d if sizes else 0))


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(rows, -1) if rows else np.zeros((0, 0))


def centres(sample: np.ndarray, lists: int, turns: int = 10) -> np.ndarray:
    """Centres by Lloyd's method; an empty one moves to the vector farthest from its own."""
    rng = np.random.default_rng(5)
    c = sample[rng.choice(len(sample), min(lists, len(sample)), replace=False)]
    for _ in range(turns):
        far = (c * c).sum(1)[None, :] - 2 * sample @ c.T
        own = far.argmin(1)
        count = np.bincount(own, minlength=len(c))
        for d in range(c.shape[1]):
            c[:, d] = np.where(count > 0, np.bincount(own, sample[:, d], len(c)) / np.maximum(count, 1), c[:, d])
        empty = np.flatnonzero(count == 0)
        if len(empty):
            c[empty] = sample[np.argsort(-far.min(1) - (sample * sample).sum(1), kind="stable")[: len(empty)]]
    return c


def needed_probes(sample: np.ndarray, c: np.ndarray, k: int) -> int:
    """How many lists hold a share of ``RECALL`` of the nearest sample vectors of some sample vectors.

    The table's neighbours are nearer than the sample's, so lists enough for these are enough for those.
    """
    distinct = np.unique(sample, axis=0)
    tried = distinct[np.random.default_rng(2).permutation(len(distinct))[:TRIED]]
    size = (c * c).sum(1)[None, :]
    own = np.concatenate([(size - 2 * sample[a: a + 4096] @ c.T).argmin(1) for a in range(0, len(sample), 4096)])
    rank = np.argsort(np.argsort(size - 2 * tried[:, :-1] @ c[:, :-1].T, axis=1, kind="stable"), axis=1)
    needed = []
    for q, r in zip(tried, rank, strict=True):
        score = sample[:, :-1] @ q[:-1]
        score[(sample == q).all(1)] = -np.inf
        best = np.argpartition(-score, min(k, len(score) - 1))[:k]
        needed.append(r[own[best[np.isfinite(score[best])]]])
    needed = np.sort(np.concatenate(needed))
    return int(needed[min(len(needed) - 1, int(RECALL * len(needed)))]) + 1 if len(needed) else 1


def _rotation(d: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(3).normal(size=(d, d)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def _longer(x: np.ndarray, longest: float) -> np.ndarray:
    """The vectors with the dimension that makes them equally long."""
    return np.concatenate([x, np.sqrt(np.maximum(0, longest - (x * x).sum(1)))[:, None]], axis=1)


def _place(c: np.ndarray, longest: float, batches):
    """The list of each vector."""
    size = (c * c).sum(1)[None, :]
    for batch in batches:
        x = _longer(_matrix(batch.column("vec"), batch.num_rows), longest) if batch.num_rows else np.zeros((0, c.shape[1]))
        own = np.concatenate([(size - 2 * x[a: a + 4096] @ c.T).argmin(1) for a in range(0, len(x), 4096)] or [np.zeros(0, int)])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.int32())], names=["id", "vec", "list"])


def _probe(c: np.ndarray, probes: int, rows: np.ndarray, k: int, batches):
    """The lists that each query looks into: the nearest ones, and on until they hold ``k`` other rows (``rows`` of each list)."""
    size = (c * c).sum(1)[None, :]
    for batch in batches:
        x = _matrix(batch.column("vec"), batch.num_rows) if batch.num_rows else np.zeros((0, c.shape[1] - 1))
        own = batch.column("own").to_numpy()
        lists = []
        for a in range(0, len(x), 4096):
            near = np.argsort(size - 2 * x[a: a + 4096] @ c[:, :-1].T, axis=1, kind="stable")
            enough = (np.cumsum(rows[near], axis=1) < k + own[a: a + 4096, None]).sum(axis=1) + 1
            lists += [row[: max(probes, n)].astype(np.int32) for row, n in zip(near, enough, strict=True)]
        batch = batch.select(["id", "vec"])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, pa.list_(pa.int32()))], names=["id", "vec", "lists"])


def scan(rotated: np.ndarray, query: np.ndarray, k: int) -> np.ndarray:
    """Rows that may be among the ``k`` nearest to the (rotated) query.

    ``rotated`` holds the vectors column by column. The first rows set the bar, then each block of columns thins out
    the rest.
    """
    d, n = rotated.shape
    head = min(n, 4 * k)
    first = ((rotated[:, :head] - query[:, None]) ** 2).sum(0)
    if n <= head:
        return np.arange(n)
    bar = np.partition(first, k - 1)[k - 1]
    alive, partial = np.arange(head, n), np.zeros(n - head, np.float32)
    for a in range(0, d, COLUMNS):
        b = min(a + COLUMNS, d)
        block = rotated[a:b, head:] if len(alive) == n - head else rotated[a:b][:, alive]
        partial = partial + ((block - query[a:b, None]) ** 2).sum(0)
        limit = bar * (1 + 1e-5) if b == d else bar * (b / d) * (1 + EPSILON / np.sqrt(b)) ** 2
        keep = partial <= limit
        alive, partial = alive[keep], partial[keep]
    return np.concatenate([np.arange(head), alive])


def _search(longest: float, k: int):
    """The best of one part of a list for a block of queries."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        side = table.column("side").to_numpy()
        ids = table.column("id").to_numpy()
        x = _matrix(table.column("vec").combine_chunks(), len(ids))
        own, asked = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        found = ([], [], [])
        if len(own) and len(asked):
            own = own[np.argsort(ids[own], kind="stable")]
            turn = _rotation(x.shape[1] + 1)
            rotated = np.ascontiguousarray((_longer(x[own], longest).astype(np.float32) @ turn).T)
            queries = np.concatenate([x[asked], np.zeros((len(asked), 1))], axis=1).astype(np.float32) @ turn
            for q, row in zip(queries, asked, strict=True):
                near = own[scan(rotated, q, k + 1)]  # the query itself may be one of them
                near = near[ids[near] != ids[row]]
                score = (x[near] * x[row]).sum(1)
                best = np.lexsort((ids[near], -score))[:k]
                found[0].append(np.full(len(best), ids[row]))
                found[1].append(ids[near[best]])
                found[2].append(score[best])
        columns = [np.concatenate(f) if f else np.zeros(0) for f in found]
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["query_id", "vec_id", "score"])

    return run


def search(table: DataFrame, k: int = NEAREST, every: int = EVERY, probes: int | None = None, lists: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each row whose id is divisible by ``every``.

    Every usable row is in the index (see ``vectors``); rows with the query's own id are no candidates. Ties go to the
    smaller id. Rows that repeat an id are candidates one by one; as queries they count as one, with the smallest of
    their vectors. Lists are as many as half the root of the number of rows, ``MOST_LISTS`` at most, which bounds what is
    sent to the tasks; long lists and lists that many queries probe are cut into parts. Without ``probes`` their number
    is found on the sample; a query whose lists hold fewer than ``k`` other rows looks into further ones, so that it has
    ``k`` neighbours, or all rows there are. Other columns are ignored.
    """
    spark = table.sparkSession
    rows = stored(vectors(table), "vectors")
    norm = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    n, longest = rows.agg(F.count("*"), F.max(norm)).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    lists = lists or min(MOST_LISTS, max(1, round(n**0.5 / 2)))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vec").toArrow().column("vec").combine_chunks()
    sample = _longer(_matrix(sample, len(sample)), longest)
    c = centres(sample, lists)
    probes = probes or needed_probes(sample, c, k)
    placed = stored(rows.mapInArrow(functools.partial(_place, c, longest), "id long, vec array<double>, list int"), "vector-lists")
    queries = rows.filter(F.col("id") % every == 0).groupBy("id").agg(F.min("vec").alias("vec"), F.count("*").alias("own"))
    held = np.zeros(len(c), np.int64)
    for r in placed.groupBy("list").count().collect():  # a row per list
        held[r["list"]] = r["count"]
    probing = queries.mapInArrow(functools.partial(_probe, c, min(probes, len(c)), held, k), "id long, vec array<double>, lists array<int>")
    probing = stored(probing.select("id", "vec", F.explode("lists").alias("list")), "vector-probes")
    # a row per list
    parts = placed.groupBy("list").agg(F.ceil(F.count("*") / F.lit(ROWS)).cast("int").alias("parts"))
    blocks = probing.groupBy("list").agg(F.ceil(F.count("*") / F.lit(QUERIES)).cast("int").alias("blocks"))
    shape = F.broadcast(parts.join(blocks, "list"))
    part, block = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"), F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    all_ = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = placed.join(shape, "list").select("list", part.alias("part"), all_("blocks").alias("block"), F.lit(0).alias("side"), "id", "vec")
    right = probing.join(shape, "list").select("list", all_("parts").alias("part"), block.alias("block"), F.lit(1).alias("side"), "id", "vec")
    found = left.unionByName(right).groupBy("list", "part", "block").applyInArrow(
        _search(longest, k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
