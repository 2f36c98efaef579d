"""Joins to keys that may hold any share of the rows, and small tables."""

from pyspark.sql import DataFrame, Row

# A user with more rows than this is cut into slices by the running totals.
HEAVY_ROWS = 5_000_000
SMALL_TABLE_ROWS = 100_000


def attach(df: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """Left join of many rows to one side row per key.

    A plain join on purpose: the left side of a left sort-merge join is what adaptive execution splits when a key is
    skewed, the null key too, and it needs no count of the keys beforehand.
    """
    return df.join(side, key, "left")


def small_rows(df: DataFrame, limit: int = SMALL_TABLE_ROWS) -> list[Row] | None:
    """All rows when there are at most ``limit``, else None.

    The check never brings more than ``limit + 1`` rows to the driver.
    """
    rows = df.limit(limit + 1).collect()
    return None if len(rows) > limit else rows
