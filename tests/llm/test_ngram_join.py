"""The n-gram Jaccard join against all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyward.llm import components as native
from tallyward.llm import ngram_join, stars, words
from tests.llm.conftest import ODD


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i: i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components(rows):
    """Smallest id reachable, by comparing everything."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                root[max(find(a), find(b))] = min(find(a), find(b))
    out = []
    for a, (i, s) in enumerate(sets):
        ids = [sets[b][0] for b in range(len(rows)) if find(b) == find(a) and sets[b][0] is not None]
        out.append((i, len(s), min(ids) if ids else None))
    return sorted(out, key=str)


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def near_copies(seed, groups, copies):
    r = random.Random(seed)
    rows, i = [], 0
    common = " ".join(f"c{k}" for k in range(30))
    for g in range(groups):
        base = [f"w{g}_{k}" for k in range(r.randint(3, 90))]
        for _ in range(copies):
            w = list(base)
            for _ in range(r.randint(0, 4)):
                w[r.randrange(len(w))] = f"v{r.randint(0, 30)}"
            text = " ".join(w)
            rows.append((i, text.upper() if r.random() < 0.2 else text + " " + common if r.random() < 0.2 else text))
            i += 1
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot, block", [(128, 512), (2, 3)])
def test_equals_all_pairs(spark, docs, monkeypatch, hot, block):
    monkeypatch.setattr(ngram_join, "HOT", hot)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "BLOCK_BYTES", 2000)  # 32 kB at the least
    rows = near_copies(hot, 8, 14)
    assert got(ngram_join.link(docs(rows))) == components(rows)


def test_odd_rows(odd, docs):
    clashing = odd.withColumn("node", F.lit(1)).withColumn("tokens", F.lit("x")).withColumn("component_id", F.lit(2))
    assert got(ngram_join.link(clashing)) == components(ODD)
    assert got(ngram_join.link(docs([]))) == []


def test_representatives(docs):
    rows = near_copies(5, 4, 6)
    kept = ngram_join.representatives(docs([*rows, rows[0], (900, None), (901, " "), (None, "lone")]))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    firsts = {c for _, _, c in components(rows)}
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, [*firsts, 900, 901, None]))


def test_link_at_the_threshold(docs):
    a = " ".join(f"w{k}" for k in range(11))  # 7 shingles
    b = " ".join(f"w{k}" for k in range(10))  # 6 of them
    c = " ".join(f"w{k}" for k in range(8))  # 4 of b's 6
    assert [r.component_id for r in ngram_join.link(docs([(3, a), (5, b), (9, c)])).orderBy("doc_id").collect()] == [3, 3, 9]


def test_word_arrays():
    texts = ["Ab  cd\tab", None, "", " x", "x y", "ÉA éa"]
    w = words.Words(pa.array(texts), words.separators("blank"))
    assert w.per_text().tolist() == [3, 0, 0, 1, 2, 2]
    h = w.hash.tolist()
    assert h[0] == h[2] != h[1] and h[3] == h[4] and h[6] != h[7]
    assert len({*h}) == 6
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"])
    assert [s.num_rows for s in words.slices(batch, "t", 3)] == [1, 3, 1, 1]
    assert sum(s.num_rows for s in words.slices(batch, "t", 1000)) == 6
    assert np.array_equal(w.text, [0, 0, 0, 3, 4, 4, 5, 5])


@pytest.mark.parametrize("solve", [stars.components, native.components])
def test_components(spark, solve):
    """Long chains, stars, loops and repeated edges, dealt out over partitions."""
    r = random.Random(7)
    edges = [(k, k + 1) for k in range(1, 60)] + [(100, k) for k in range(101, 300)] + [(k, k) for k in range(400, 405)]
    edges += [(r.randrange(500, 900), r.randrange(500, 900)) for _ in range(250)] + [(1, 2), (2, 1), (-5, 700)]
    r.shuffle(edges)
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {x.node: x.root for x in solve(spark.createDataFrame(edges, "a long, b long").repartition(6), "a", "b").collect()}
    assert got == {x: low for x, low in root.items() if any(x in e and e[0] != e[1] for e in edges)}
    assert solve(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []
