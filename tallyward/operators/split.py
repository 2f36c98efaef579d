"""Exact splits and samples by seeded hash.

Rows are ordered within their class by ``md5(id:seed)``. An exact quota is then a
single cutoff key per class, and the split is a comparison with literals: rows are
never sorted, shuffled or ranked, however many there are. The cutoff is found by
counting rows per leading hash digits, then per the next digits inside the one
bucket the quota ends in, until that bucket is small. Each count is a pass over two
columns that brings at most 4,096 numbers per class to the driver.

Ids are expected to be unique; rows that share an id fall on the same side.
"""

from collections.abc import Callable
from dataclasses import dataclass, field
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_DIGITS = 3  # hex digits per counting step: 4,096 buckets
_MAX_DIGITS = 30  # ids that agree so far are copies of one id
_SMALL_BUCKET = 100_000
MAX_CLASSES = 100  # a column of more values is no class label: refused before its counts are brought together

Quota = Callable[[dict], dict]


def hash_key(id_column: str, seed: str) -> Column:
    return F.md5(F.concat(F.col(id_column), F.lit(f":{seed}")))


def proportional(share: float) -> Quota:
    """``ceil(share * N)`` rows in all, shared by class size; what rounding down leaves
    over goes to the largest fractions."""

    def quota(sizes: dict) -> dict:
        n = sum(sizes.values())
        take = ceil(n * share)
        floors = {c: take * size // n for c, size in sizes.items()}
        left = take - sum(floors.values())
        order = sorted(sizes, key=lambda c: (-(take * sizes[c] % n), c is None, c))
        return {c: floors[c] + (place < left) for place, c in enumerate(order)}

    return quota


def _cutoffs(keyed: DataFrame, quota: Quota, max_classes: int) -> dict:
    """Per class the last (hash, id) that still belongs to the quota; None takes all rows."""
    prefix, left, small = None, {}, False
    found: dict = {}
    depth = 0
    while not small and depth < _MAX_DIGITS:
        rows = _within(keyed, prefix).groupBy("c", F.substring("h", depth + 1, _DIGITS).alias("d")).count()
        counts: dict = {}
        for r in rows.limit((max_classes + 1) * 16**_DIGITS).collect():
            counts.setdefault(r.c, {})[r.d] = r["count"]
        if prefix is None:
            if len(counts) > max_classes:
                raise ValueError(f"too many classes to split by: {len(counts)}")
            sizes = {c: sum(by_digits.values()) for c, by_digits in counts.items()}
            left = quota(sizes)
            found = {c: None for c in sizes if left[c] >= sizes[c]}
            prefix = {c: "" for c in sizes if 0 < left[c] < sizes[c]}
        depth += _DIGITS
        small = True
        for c in prefix:
            for digits in sorted(counts[c]):
                n = counts[c][digits]
                if n >= left[c]:
                    prefix[c] += digits
                    small = small and n <= _SMALL_BUCKET
                    break
                left[c] -= n
    if not prefix:
        return found
    # Copies of an id count together, so this window is over distinct ids of one small bucket.
    running = Window.partitionBy("c").orderBy("h", "i").rowsBetween(Window.unboundedPreceding, 0)
    quota_left = _by_class({c: F.lit(left[c]) for c in prefix})
    edge = (
        _within(keyed, prefix).groupBy("c", "h", "i").count()
        .withColumn("upto", F.sum("count").over(running))
        .filter(F.col("upto") <= quota_left)
        .groupBy("c").agg(F.max(F.struct("h", "i")).alias("k"))
    )
    last = {r.c: (r.k.h, r.k.i) for r in edge.collect()}
    return {**found, **{c: last.get(c, (p, "")) for c, p in prefix.items()}}


def _by_class(values: dict) -> Column:
    out = F.lit(None)
    for c, value in values.items():
        out = F.when(F.col("c").eqNullSafe(F.lit(c)), value).otherwise(out)
    return out


def _within(keyed: DataFrame, prefix: dict | None) -> DataFrame:
    if prefix is None:
        return keyed
    return keyed.filter(_by_class({c: F.col("h").startswith(p) for c, p in prefix.items()}))


def take_by_hash(
    df: DataFrame, quota: Quota, seed: str, out: str, label: Column | None = None, among: Column | None = None,
    id_column: str = "transaction_id", max_classes: int = MAX_CLASSES,
) -> DataFrame:
    """Adds boolean ``out``: the row is among the first rows of its class by hash.

    More than ``max_classes`` classes are refused.

    ``quota`` maps class sizes to rows to take; only rows ``among`` take part, the
    others get false.
    """
    label = F.lit(0) if label is None else label
    among = F.lit(True) if among is None else among
    h, i = hash_key(id_column, seed), F.col(id_column)
    cutoffs = _cutoffs(df.filter(among).select(label.alias("c"), h.alias("h"), i.alias("i")), quota, max_classes)
    taken = F.lit(False)
    for c, last in cutoffs.items():
        inside = F.lit(True) if last is None else (h < last[0]) | ((h == last[0]) & (i <= last[1]))
        taken = F.when(label.eqNullSafe(F.lit(c)), inside).otherwise(taken)
    return df.withColumn(out, F.coalesce(among & taken, F.lit(False)))


def stratified_split(df: DataFrame, label: str = "is_fraud", test: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``split`` = train / test with exact counts per class."""
    marked = take_by_hash(df, proportional(test), str(seed), "_test", F.col(label))
    return marked.withColumn("split", F.when(F.col("_test"), "test").otherwise("train")).drop("_test")


def plain_split(
    df: DataFrame, share: float = 0.2, seed: int = 42, out: str = "is_validation", among: Column | None = None
) -> DataFrame:
    """Adds boolean ``out`` for exactly ``ceil(share * N)`` rows, classes not regarded."""
    return take_by_hash(df, proportional(share), f"validation:{seed}", out, among=among)


_BITS = 60  # of a hash: its first 15 hex digits
_CELL_BITS = 8  # each pass cuts what is open of both hash orders into 256 parts
_CELLS = 1 << _CELL_BITS


@dataclass
class _Search:
    """What is known of both cutoffs after some passes; all counts are exact."""

    bits: int = _BITS
    low: dict = field(default_factory=dict)  # per class: hashes below are test, the next ``1 << bits`` open, the others train
    left: dict = field(default_factory=dict)  # per class: test rows among its open ones
    train: int = 0  # rows known to be train
    floor: int = 0  # validation ends among the ``1 << floor_bits`` hashes from here on
    floor_bits: int = _BITS
    below: int = 0  # rows known to be train under the floor


def _open_rows(keyed: DataFrame, at: _Search) -> DataFrame:
    """Rows that still matter, with ``a``: their open part of the test order (256: train), and ``b``: their part of the
    validation order (-1 below, 256 above)."""
    v, w = (F.conv(F.substring(c, 1, _BITS // 4), 16, 10).cast("long") for c in ("h", "g"))
    test = v - _by_class({c: F.lit(x) for c, x in at.low.items()}).cast("long") if at.low else v
    part = F.shiftright("_test", max(0, at.bits - _CELL_BITS))
    place = F.shiftright("_validation", max(0, at.floor_bits - _CELL_BITS))
    rows = keyed.withColumns({"_test": test, "_validation": w - F.lit(at.floor)}).filter("_test >= 0").select(
        "c", "h", "g", "i", F.when(F.col("_test") < F.lit(1 << at.bits), part).otherwise(_CELLS).cast("int").alias("a"),
        F.when(F.col("_validation") < 0, -1).otherwise(F.least(place, F.lit(_CELLS))).cast("int").alias("b"),
    )
    return rows.filter((F.col("a") < _CELLS) | F.col("b").between(0, _CELLS - 1))


def _narrowed(cells: pd.DataFrame, at: _Search, share: float) -> tuple[_Search, int]:
    """The search after a pass that counted rows by (c, a, b), and how many rows it leaves."""
    now = _Search(at.bits - _CELL_BITS, dict(at.low), dict(at.left), at.train)
    sure, unknown = np.zeros(_CELLS + 2, "int64"), np.zeros(_CELLS + 2, "int64")  # train and open rows by b, from -1 on
    for c, counts in _classes(cells):
        grid = np.zeros((_CELLS + 1, _CELLS + 2), "int64")
        np.add.at(grid, (counts["a"].to_numpy(), counts["b"].to_numpy() + 1), counts["n"].to_numpy())
        upto = grid[:_CELLS].sum(1).cumsum()
        edge = int(np.searchsorted(upto, at.left[c]))  # the part the quota ends in
        now.left[c] -= int(upto[edge - 1]) if edge else 0
        now.low[c] = at.low.get(c, 0) + (edge << now.bits)
        unknown += grid[edge]
        sure += grid[edge + 1:].sum(0)
        now.train += int(grid[edge + 1:_CELLS].sum())
    open_rows = int(unknown.sum())
    fewest = at.below + sure.cumsum()
    most = fewest + unknown.cumsum()
    # ids that occur twice may leave a test quota short, so the number of train rows is known within bounds only
    quotas = (ceil(n * share) for n in (now.train + open_rows - sum(now.left.values()), now.train + open_rows))
    begin = min(max(int(np.searchsorted(most, next(quotas))), 1), _CELLS)
    end = min(max(int(np.searchsorted(fewest, next(quotas))), begin), _CELLS)
    part = max(0, at.floor_bits - _CELL_BITS)
    wide = (end - begin).bit_length()
    now.floor, now.floor_bits = at.floor + ((begin - 1) << part), part + wide
    now.below = int(fewest[begin - 1])
    return now, open_rows + int(sure[begin:begin + (1 << wide)].sum())


def _classes(rows: pd.DataFrame):
    for c, part in rows.groupby("c", dropna=False):
        yield None if pd.isna(c) else getattr(c, "item", lambda c=c: c)(), part


def _last(rows: pd.DataFrame, order: list[str], quota: int, before: int) -> tuple[tuple, pd.Series]:
    """The last (hash, id) within the quota, and which rows are; ``before`` is the hash they all come after."""
    rows = rows.sort_values(order)
    inside = rows["n"].cumsum() <= quota
    taken = rows[inside]
    last = (f"{before:0{_BITS // 4}x}", "") if taken.empty else tuple(taken[order].iloc[-1])
    return last, inside


def _joint_cutoffs(keyed: DataFrame, quota: Quota, share: float, max_classes: int) -> tuple[dict, tuple | None]:
    """Both cutoffs from joint counts: per class the last (hash, id) of the test rows, and that of the validation rows, a
    ``share`` of the others.

    A pass counts rows by class and by 256 parts of either order (at most 65,536 numbers a class reach the driver). The
    part a test quota ends in leaves few rows open, so the validation quota is known to end in one or two parts as well.
    Later passes look at these rows only, until they are few.
    """
    at, rows = _Search(), None
    while rows is None or (rows > _SMALL_BUCKET and at.bits > _CELL_BITS):
        counted = _open_rows(keyed, at).groupBy("c", "a", "b").agg(F.count(F.lit(1)).alias("n"))
        cells = counted.limit((max_classes + 1) * _CELLS * _CELLS).toPandas()
        if rows is None:
            sizes = {c: int(part["n"].sum()) for c, part in _classes(cells)}
            if len(sizes) > max_classes:
                raise ValueError(f"too many classes to split by: {len(sizes)}")
            at.left = {c: min(n, sizes[c]) for c, n in quota(sizes).items()}
        at, rows = _narrowed(cells, at, share)
    # copies of an id are one row here
    rest = _open_rows(keyed, at).groupBy("c", "h", "g", "i", "a", "b").agg(F.count(F.lit(1)).alias("n")).toPandas()
    test, open_ = {c: (f"{x:0{_BITS // 4}x}", "") for c, x in at.low.items()}, rest["a"] < _CELLS
    is_test = pd.Series(False, rest.index)
    for c, part in _classes(rest[open_]):
        test[c], inside = _last(part, ["h", "i"], at.left[c], at.low[c])
        is_test[inside[inside].index] = True
    others = rest[~is_test]
    n = at.train + int(others.loc[open_, "n"].sum()) if len(others) else at.train
    take = ceil(n * share)
    if take >= n:
        return test, None
    left = take - at.below - int(others.loc[open_ & (others["b"] < 0), "n"].sum())
    near = others[others["b"].between(0, _CELLS - 1)].groupby(["g", "i"], as_index=False)["n"].sum()  # of all classes
    return test, _last(near, ["g", "i"], left, at.floor)[0]


def _upto(h: Column, i: Column, last: tuple) -> Column:
    return (h < last[0]) | ((h == last[0]) & (i <= last[1]))


def three_way_split(
    df: DataFrame, label: str = "is_fraud", seed: int = 42, test: float = 0.2, validation: float = 0.2,
    id_column: str = "transaction_id", max_classes: int = MAX_CLASSES,
) -> DataFrame:
    """64 / 16 / 20: stratified test rows, then plain validation rows out of train.

    The rows of ``stratified_split`` followed by ``plain_split``, found together. Rows without an id are train rows that
    no quota counts.
    """
    c, i = F.col(label), F.col(id_column)
    h, g = hash_key(id_column, str(seed)), hash_key(id_column, f"validation:{seed}")
    keyed = df.filter(i.isNotNull()).select(c.alias("c"), h.alias("h"), g.alias("g"), i.alias("i"))
    test_last, last = _joint_cutoffs(keyed, proportional(test), validation, max_classes)
    is_test = F.lit(False)
    for value, edge in test_last.items():
        is_test = F.when(c.eqNullSafe(F.lit(value)), _upto(h, i, edge)).otherwise(is_test)
    is_validation = i.isNotNull() if last is None else _upto(g, i, last)
    return df.withColumn("split", F.when(is_test, "test").when(is_validation, "validation").otherwise("train"))


def class_ratio_sample(
    df: DataFrame, n: int, ratio: float, label: str = "is_fraud", seed: int = 42
) -> DataFrame:
    """``n`` rows of which ``int(n * ratio)`` have the label, in shuffled order.

    A class with fewer rows than asked for gives all it has.
    """
    frauds = int(n * ratio)

    def quota(sizes: dict) -> dict:
        return {c: min(frauds if c else n - frauds, size) for c, size in sizes.items()}

    picked = take_by_hash(df, quota, f"sample:{seed}", "_in", F.col(label), F.col(label).isNotNull())
    return shuffled(picked.filter("_in").drop("_in"), seed)


def shuffled(df: DataFrame, seed: int = 42, id_column: str = "transaction_id") -> DataFrame:
    """Repeatable shuffle: order by seeded hash."""
    return df.orderBy(hash_key(id_column, f"shuffle:{seed}"), id_column)


def split_summary(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.avg(F.col(label).cast("int")).alias("fraud_ratio")
    )
