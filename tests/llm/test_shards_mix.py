"""Rendezvous shards and source mixing."""

import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyward.llm import mixing, sharding
from tests.llm.conftest import ODD


def test_slots(spark, odd, docs, monkeypatch):
    monkeypatch.setattr(sharding, "CHUNK", 2)
    many = docs([*ODD, *[(i, f"text {i}") for i in range(100, 400)], *[(7, "again")] * 9])
    out = sharding.slots(many.withColumn("shard", F.lit("old")), 8).collect()
    assert len(out) == len(ODD) + 309
    assert {r.law for r in out} == {"key"}
    of_key = defaultdict(set)
    slots = defaultdict(list)
    for r in out:
        of_key[r.doc_id].add((r.shard, r.grown_shard))
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 8)
    assert all(len(v) == 1 for v in of_key.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert any(r.grown_shard == 8 for r in out)
    sizes = Counter((r.doc_id, r.size, r.text_crc32) for r in out)
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in [*ODD, *[(i, f"text {i}") for i in range(100, 400)], *[(7, "again")] * 9])
    assert sizes == want
    assert sorted(map(tuple, out), key=str) == sorted(map(tuple, sharding.slots(many.repartition(7), 8).collect()), key=str)
    assert sharding.slots(docs([]), 8).collect() == []


def test_weights_share_the_keys(spark):
    keys = spark.range(20_000).withColumn("shard", F.lit(0))
    n = Counter(r.shard for r in sharding.assign(keys, "id", [1.0, 2.0, 1.0]).collect())
    assert n[1] == pytest.approx(10_000, rel=0.05)
    before = {r.id: r.shard for r in sharding.assign(keys, "id", [1.0, 2.0, 1.0]).collect()}
    after = {r.id: r.shard for r in sharding.assign(keys, "id", [1.0, 2.0]).collect()}
    assert all(after[i] == s for i, s in before.items() if s != 2)


def test_written_shards(spark, docs, tmp_path):
    sharding.write(docs([(i, "t") for i in range(50)]), "doc_id", [1.0] * 4, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 50 and "text" in back.columns


def levels(sizes, weights):
    """Targets by sharing out again and again."""
    total, target, capped = sum(sizes), [0.0] * len(sizes), set()
    while True:
        open_ = [i for i in range(len(sizes)) if i not in capped]
        left = total - sum(3 * sizes[i] for i in capped)
        for i in open_:
            target[i] = left * weights[i] / sum(weights[j] for j in open_)
        over = [i for i in open_ if target[i] > 3 * sizes[i]]
        if not over:
            return target
        for i in over:
            target[i] = 3.0 * sizes[i]
        capped |= set(over)


def test_mix(spark, docs):
    rows = [(i, "w " * (i % 7), ["b", "a", None, "ü", "z"][i % 5 if i % 3 else 0]) for i in range(900)]
    rows += [(1000, None, "a"), (1001, "", "empty"), (1002, "w " * 5000, "z"), (None, "w w", "b")] + [(5, "w", "a")] * 3
    table = docs(rows).withColumn("rate", F.lit("old")).withColumn("_source", F.lit(1)).withColumn("copies", F.lit(1))
    planned = mixing.taken(table).collect()
    assert len(planned) == len(rows)
    size = Counter()
    for _, t, s in rows:
        size[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    want = dict(zip(order, levels([size[s] for s in order], [1 + i % 3 for i in range(len(order))]), strict=True))
    of = {(size[s], round(want[s], 6)): s for s in order}
    taken = Counter()
    for r in planned:
        source = of[r.source_size, round(r.target, 6)]
        rate = r.target / r.source_size if r.source_size else 0
        assert not r.size or r.taken // r.size in (int(rate), int(rate) + 1) and r.taken <= 3 * r.size
        taken[source] += r.taken
    assert taken["b"] == pytest.approx(want["b"], rel=0.1)
    mixed = mixing.emit(table)
    assert mixed.columns == table.columns
    found = Counter()
    for r in mixed.collect():
        found[r.source] += len((r.text or "").split())
    assert found == Counter({s: n for s, n in taken.items() if n})
    assert sorted(map(str, mixing.taken(table).collect())) == sorted(map(str, mixing.taken(table.repartition(5)).collect()))


def test_rows_without_ids_have_coins_of_their_own(docs, monkeypatch):
    """Of equal size, of equal text, one of them a third of all rows."""
    monkeypatch.setattr(mixing, "CHUNK", 50)
    rows = [(None, f"text {i} here", "a") for i in range(400)] + [(None, "the same text", "b")] * 400 + [(i, "w " * 20, "c") for i in range(300)]
    table = docs(rows)
    got = mixing.taken(table).collect()
    assert len(got) == len(rows)
    for size, target in {(r.source_size, r.target) for r in got}:
        assert sum(r.taken for r in got if r.target == target) == pytest.approx(target, rel=0.1)
    again = mixing.taken(table.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.emit(table).groupBy("source").count().collect() and mixing.emit(table).count() == sum(r.taken // r.size for r in got)


def test_mix_of_nothing(docs):
    assert mixing.taken(docs([])).collect() == []
    assert mixing.emit(docs([(1, None), (2, " ")])).collect() == []
    assert [r.taken for r in mixing.taken(docs([(1, None), (2, " ")])).collect()] == [0, 0]
