"""Pearson correlations, each pair over the rows where both values are present.

One pass: a task makes its Arrow batches into a few small matrix products, because
one aggregate expression per pair would be thousands of them, and gives one row of
moments per pair. These rows are kept in the shared folder and merged about their common mean: two sums
that combine on the map side.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.session import local_table, new_folder

_PAIR = ["x", "y", "n", "mean_x", "mean_y", "m_xx", "m_yy", "m_xy"]
_SCHEMA = "x int, y int, " + ", ".join(f"{c} double" for c in _PAIR[2:])
_RESULT = pa.schema([("feature_x", pa.string()), ("feature_y", pa.string()), ("corr", pa.float64())])


def _pair_moments():
    """Moments over the rows of one task for every pair of columns.

    An inner function, so that it travels to the tasks by value and the package need
    not be installed there.
    """
    names = list(_PAIR)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, origin = None, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            values = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
            there = (~np.isnan(values)).astype(float)
            if origin is None:
                origin = np.nan_to_num(values).sum(axis=0) / np.maximum(there.sum(axis=0), 1)
            v = np.nan_to_num(values - origin, nan=0.0)
            sx, sxx = v.T @ there, (v * v).T @ there
            part = np.stack([there.T @ there, sx, sx.T, sxx, sxx.T, v.T @ v])
            total = part if total is None else total + part
        if total is None:
            return
        x, y = np.triu_indices(total.shape[1])
        n, sx, sy, sxx, syy, sxy = (m[x, y] for m in total)
        d = np.maximum(n, 1)
        moments = [n, origin[x] + sx / d, origin[y] + sy / d, sxx - sx * sx / d, syy - sy * sy / d, sxy - sx * sy / d]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int32()), pa.array(y, pa.int32()), *[pa.array(m) for m in moments]], names=names
        )

    return run


def pairwise(df: DataFrame, names: list[str]) -> DataFrame:
    """(feature_x, feature_y, corr) of every ordered pair; null when a side is constant.

    Booleans count as 0 and 1. One number per pair reaches the driver.
    """
    numbers = df.select(*[
        (F.col(n).cast("int") if kind == "boolean" else F.col(n)).cast("double").alias(n)
        for n, kind in df.select(*names).dtypes
    ])
    n = F.col("n")
    path = new_folder(df.sparkSession, "moments")
    numbers.mapInArrow(_pair_moments(), _SCHEMA).filter(n > 0).write.parquet(path)
    moments = df.sparkSession.read.parquet(path)
    share = lambda c: (F.sum(n * F.col(c)) / F.sum(n))
    # a row per pair of columns, whatever the number of rows
    means = moments.groupBy("x", "y").agg(share("mean_x").alias("all_x"), share("mean_y").alias("all_y"))
    merged = (
        moments.join(F.broadcast(means), ["x", "y"])
        .withColumns({"dx": F.col("mean_x") - F.col("all_x"), "dy": F.col("mean_y") - F.col("all_y")})
        .groupBy("x", "y")
        .agg(
            F.sum("n").alias("n"), F.min("all_x").alias("mean_x"), F.min("all_y").alias("mean_y"),
            F.sum(F.col("m_xx") + n * F.col("dx") * F.col("dx")).alias("m_xx"),
            F.sum(F.col("m_yy") + n * F.col("dy") * F.col("dy")).alias("m_yy"),
            F.sum(F.col("m_xy") + n * F.col("dx") * F.col("dy")).alias("m_xy"),
        )
    )
    found = {(r.x, r.y): _pearson(r) for r in merged.collect()}
    out = []
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            out.append((a, b, found.get((min(i, j), max(i, j)))))
    return local_table(df.sparkSession, out, _RESULT)


def _pearson(r) -> float | None:
    # what rounding leaves of a constant column is no spread
    if r.m_xx <= r.n * (1e-12 * r.mean_x) ** 2 or r.m_yy <= r.n * (1e-12 * r.mean_y) ** 2:
        return None
    return r.m_xy / float(np.sqrt(r.m_xx) * np.sqrt(r.m_yy))


def with_label(pairs: DataFrame, label: str = "is_fraud") -> DataFrame:
    """(feature, corr) for every feature and the label itself."""
    return pairs.filter(F.col("feature_y") == label).select(F.col("feature_x").alias("feature"), "corr")


def top(correlations: DataFrame, n: int = 15) -> DataFrame:
    return correlations.orderBy(F.desc_nulls_last("corr"), "feature").limit(n)


def top_matrix(pairs: DataFrame, n: int = 15, label: str = "is_fraud") -> DataFrame:
    """The pairs among the ``n`` features that go with the label most."""
    best = F.broadcast(top(with_label(pairs, label), n).select("feature"))
    return (
        pairs.join(best.withColumnRenamed("feature", "feature_x"), "feature_x", "left_semi")
        .join(best.withColumnRenamed("feature", "feature_y"), "feature_y", "left_semi")
        .select("feature_x", "feature_y", "corr")
    )
