"""Standard scaling with the population deviation: fit on train, apply anywhere."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def fit(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and deviation per column; one row reaches the driver. A constant column keeps scale 1."""
    row = df.agg(*[
        expr for c in columns
        for expr in (F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std"))
    ]).first()
    return {c: (row[f"{c}__mean"] or 0.0, row[f"{c}__std"] or 1.0) for c in columns}


def transform(df: DataFrame, scales: dict[str, tuple[float, float]]) -> DataFrame:
    """Scaled in place; all other columns pass."""
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in scales.items()})
