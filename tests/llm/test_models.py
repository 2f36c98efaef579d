"""Trained models: page field, toxicity network; and nearest vectors against brute force."""

import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyward.llm import html_text, nearest, toxicity
from tests.llm.conftest import LONG, ODD

TEXTS = [f"Sentence {i} has some words and then a few more, so it goes on. It ends here." for i in range(30)]


@pytest.fixture(scope="module")
def field():
    return html_text.train(TEXTS)


def test_blocks():
    page = ("<html><head><title>t</title><style>p{}</style></head><body><!-- a <p> --><p>One&nbsp;&amp; <b>t</b>wo<br>three<p>four"
            "<script>var x='</p>';</script><ul><li>a<li><a href='>'>b</a></ul><div class='Ad big'>buy</div> tail &am")
    found = html_text.blocks(page)
    assert [b.text for b in found] == ["One & two three", "four", "a", "b", "buy", "tail &am"]
    assert found[4].cues == {"ad"} and found[3].linked == 1.0 and found[0].linked == 0
    assert html_text.blocks("<p>x" + "<" * 5000 + '<a "' * 3000)[0].text.startswith("x<<<")  # soon done


def test_text_after_self_closed_svg_and_open_head():
    def texts(page):
        return [b.text for b in html_text.blocks(page)]

    assert texts('<p>a <svg class="x"/> b</p><p>c</p><svg><text>no</text></svg><p>d</p>') == ["a b", "c", "d"]
    assert texts("<html><head><title>t <b>u</b> v</title><meta x><script>s</script><p>a<p>b") == ["a", "b"]
    assert texts("<head><title>t</title>a<p>b") == ["a", "b"]
    assert texts("<head><link y><svg/>a<div>b</div>") == ["a", "b"]
    assert texts("<head><title>t</title>\n</head><body>a") == ["a"]


def test_field_on_unseen_layouts(field):
    rng = np.random.default_rng(77)
    right = total = 0
    for _ in range(150):
        found = html_text.blocks(html_text.labelled_page(rng, TEXTS[::-1]))
        want = [int(html_text.MARK in b.text) for b in found]
        for b in found:
            b.text = b.text.replace(html_text.MARK, "") or "-"
        right += sum(a == b for a, b in zip(want, field.labels(found), strict=True))
        total += len(want)
    assert right / total > 0.96


def test_viterbi_is_the_best_path(field):
    page = html_text.blocks(html_text.labelled_page(np.random.default_rng(5), TEXTS))[:9]
    e = [[sum(field.weight.get(f, (0, 0))[y] for f in fs) for y in (0, 1)] for fs in html_text.features(page)]

    def worth(path):
        return sum(e[i][y] for i, y in enumerate(path)) + sum(field.step[a, b] for a, b in zip(path, path[1:], strict=False))

    paths = [[k >> i & 1 for i in range(len(page))] for k in range(1 << len(page))]
    assert worth(field.labels(page)) == pytest.approx(max(map(worth, paths)))


def test_extract(spark, field):
    page = "<body><nav><ul><li><a href='/'>Home</a></li></ul></nav><div class='ad'>Buy this.</div><article><h1>Head</h1><p>Body&copy; text.</p></article><footer>&copy; x</footer>"
    rows = [(1, "u", page), (2, "u", page), (3, None, None), (4, "u", ""), (None, "u", "<p></p>"), (5, "u", f"<article><p>{LONG}</p></article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("old"))
    got = {r.page_id: r for r in html_text.extract(pages, field).collect()}
    assert got[1].text == got[2].text == "Head Body© text." and got[1].n_chars == 16
    assert got[3].text == got[4].text == got[None].text == "" and got[3].url is None
    assert got[5].text == " ".join(LONG.split())
    none = pages.limit(0)
    assert html_text.extract(none, html_text.fit(none)).collect() == []


# --- toxicity -----------------------------------------------------------------


def planted(seed, n):
    """Texts of made-up words; a third hold bad ones with common stems."""
    r = np.random.default_rng(seed)
    texts, y = [], []
    for _ in range(n):
        w = ["".join(r.choice(list("abdeinorst"), 5)) for _ in range(int(r.integers(5, 120)))]
        bad = r.random() < 0.33
        if bad:
            w.insert(int(r.integers(len(w))), "zukk" + str(r.choice(["er", "en", "ung"])))
        texts.append(" ".join(w))
        y.append(int(bad))
    return pa.array(texts), np.array(y)


def test_network_learns():
    net = toxicity.train(*planted(1, 500))
    texts, y = planted(2, 300)
    s = net.scores(texts)
    assert ((s >= 0.5) == y).mean() > 0.95
    # the stem alone, with an ending never seen
    assert net.scores(pa.array(["abden zukkit orsti"]))[0] > 5 * net.scores(pa.array(["abden otkkit orsti"]))[0]
    # a word at the very end of a long text counts, so does every window
    assert net.scores(pa.array(["abden " * 40_000 + "zukker"]))[0] > 0.5 > net.scores(pa.array(["abden " * 40_000]))[0]
    assert all(0 <= x <= 1 for x in net.scores(pa.array([None, "", " ", "." * 5000], pa.string()).fill_null("")))


def test_calibration_settles():
    """Logits far from 0 whose classes are all but apart: the score is 0.5 between them, at the fit's lowest loss."""
    rng = np.random.default_rng(5)
    y = (np.arange(960) % 10 == 0).astype(float)
    x = np.where(y == 1, rng.normal(6.8, 0.3, 960), np.where(rng.random(960) < 0.1, rng.normal(5.7, 0.15, 960), rng.normal(-3, 2, 960)))
    a, b = toxicity._calibrate(x, y)
    high = a * x + b >= 0
    assert 5.9 < -b / a < 6.5 and high[y == 1].mean() > 0.95 and high[y == 0].mean() < 0.01
    # a shift of the logits moves the fit along
    assert np.allclose(np.array(toxicity._calibrate(x - 40, y)), [a, b + 40 * a], rtol=1e-4)
    assert toxicity._calibrate(np.full(4, 6.0), np.array([0.0, 1, 0, 1]))[0] > 0


def test_gradients():
    rng = np.random.default_rng(1)
    net = toxicity._train(*planted(3, 40))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x = rng.normal(size=(50, 2 * toxicity.DIM))
    at = rng.integers(0, 50, (6, toxicity.WINDOW))
    mask = np.arange(toxicity.WINDOW)[None, :] < rng.integers(0, toxicity.WINDOW + 1, 6)[:, None]
    y, weight = rng.integers(0, 2, 6).astype(float), np.ones(6)

    def loss():
        p = toxicity._sigmoid(net.run(x, at, mask))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    g, dx, _ = net.grads(x, at, mask, y, weight)
    for name in ("Wf", "Wb", "Uf", "Ub", "bf", "A", "a", "v", "o", "c"):
        value = net.p[name].reshape(-1)
        k = int(rng.integers(len(value)))
        old = value[k]
        value[k] = old + 1e-4
        up = loss()
        value[k] = old - 1e-4
        slope = (up - loss()) / 2e-4
        value[k] = old
        assert g[name].reshape(-1)[k] == pytest.approx(slope, rel=0.02, abs=1e-5), name
    i = at[mask][0]
    x[i, 1] += 1e-4
    up = loss()
    x[i, 1] -= 2e-4
    assert dx[i, 1] == pytest.approx((up - loss()) / 2e-4, rel=0.02, abs=1e-5)


def test_scores_of_frames(spark, docs, odd):
    texts, y = planted(4, 400)
    table = docs([*ODD, *[(i + 100, t) for i, t in enumerate(texts.to_pylist())]])
    labels = spark.createDataFrame([(i + 100, int(v), 0) for i, v in enumerate(y)] + [(None, 1, 1), (5, None, 1), (10**9, 1, 1)], "doc_id long, toxic int, quality int")
    net = toxicity.fit(table, labels)
    scored = toxicity.score(table.withColumn("score", F.lit("old")).withColumn("_text", F.lit(1)), net)
    rows = scored.collect()
    assert len(rows) == len(ODD) + 400 and scored.columns[:6] == ["doc_id", "text", "lang", "source", "n_chars", "_text"]
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0)
    held = [(r.predicted, y[r.doc_id - 100]) for r in rows if r.doc_id and r.doc_id >= 100 and r.held_out]
    assert np.mean([a == b for a, b in held]) > 0.85
    # labels of held-out rows change nothing
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity.score(table, toxicity.fit(table, turned)).collect()}
    assert all(again[r.doc_id] == r.score for r in rows if r.doc_id and r.doc_id >= 100)


def test_nothing_to_learn(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(docs(ODD), toxicity.fit(docs(ODD), labels)).collect()} == {0.0}
    ones = spark.createDataFrame([(3, 1), (5, 1)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(docs(ODD), toxicity.fit(docs(ODD), ones)).collect()} == {1.0}
    assert toxicity.score(docs([]), toxicity.fit(docs([]), labels)).collect() == []


def test_hostile_pages_take_time_in_proportion():
    """100,000 open tags, unclosed tags, comments and quotes, closing tags without their openings."""
    n = 100_000
    pages = ["<div>x" * n, "<span class=nav><b>x" * n, "<a" * n, "<a " * n + ">", "<!--" * n, "<! " * n, "</i>" * n + "<p>" * n, "<p>" + "<span>" * n + "</u>x" * n,
             "<p><a href='" * n, '<p a="' * n, "<script" * n, "<title>" * n, "<head>" * n + "y" * n, "<p><div>" + "<i><li>z" * n]
    for page in pages:
        began = time.process_time()
        html_text.blocks(page)
        assert time.process_time() - began < 20, page[:20]
    assert len(html_text.blocks(pages[0])) == n and html_text.blocks(pages[0])[-1].last == "div"
    assert [b.text for b in html_text.blocks("<p>a<!-- b <p>c")] == ["a"] and [b.text for b in html_text.blocks("<p>a <!-- b > c")] == ["a"]


# --- nearest vectors ------------------------------------------------------------


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], "vec_id long, embedding array<float>, label int")


def brute(rows, k=20):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v is not None and len(v) == 6 and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    out = {}
    for i, q in ok:
        if i % 20 == 0:
            found = sorted((-float((v * q).sum()), j) for j, v in ok if j != i)
            out[i] = [(j, -s) for s, j in found[:k]]
    return out


ODD_VECTORS = [(1, None), (2, []), (3, [0] * 6), (4, [None, 1, 1, 1, 1, 1]), (5, [float("nan")] * 6), (6, [float("inf")] + [1] * 5), (None, [1] * 6), (7, [1, 2])]


@pytest.mark.parametrize("scale", [False, True])
def test_recall(spark, scale, monkeypatch):
    monkeypatch.setattr(nearest, "ROWS", 100)
    monkeypatch.setattr(nearest, "QUERIES", 10)
    r = np.random.default_rng(8)
    x = r.normal(size=(1500, 6)) * (r.exponential(size=(1500, 1)) if scale else 1)
    x[300:700] = x[300]  # one vector over and over
    rows = [(i + 10, v) for i, v in enumerate(x.tolist())] + ODD_VECTORS
    want = brute(rows)
    got = {}
    for row in nearest.search(vectors(spark, rows).withColumn("list", F.lit(1))).orderBy("query_id", "rank").collect():
        got.setdefault(row.query_id, []).append((row.vec_id, row.score))
        assert row.rank == len(got[row.query_id])
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    recall = np.mean([len({j for j, _ in got[q]} & {j for j, _ in want[q]}) / 20 for q in want])
    assert recall >= 0.9
    everything = {}
    for row in nearest.search(vectors(spark, rows), probes=10**6).orderBy("query_id", "rank").collect():
        everything.setdefault(row.query_id, []).append(row.vec_id)
    same = [everything[q] == [j for j, _ in want[q]] for q in want]
    assert np.mean(same) > 0.9  # the test may give up a vector, ties and order are right otherwise
    by_id = {i: np.array(v, np.float32).astype(float) for i, v in rows if i and i >= 10}
    assert all(s == pytest.approx((by_id[q] * by_id[j]).sum(), abs=1e-12) for q, found in got.items() for j, s in found)


def test_few_vectors(spark):
    rows = [(20, [1, 0, 0, 0, 0, 0]), (1, [1, 1, 0, 0, 0, 0]), (2, [1, 1, 0, 0, 0, 0]), *ODD_VECTORS[2:7]]
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in nearest.search(vectors(spark, rows)).orderBy("rank").collect()]
    assert got == [(20, 1, 1, 1.0), (20, 2, 2, 1.0)]
    assert nearest.search(vectors(spark, [])).collect() == []
    assert nearest.search(vectors(spark, ODD_VECTORS[:6])).collect() == []


def test_lone_vectors_have_neighbours_too(spark):
    """Tight clusters, which need few lists, and lone vectors in lists of their own, one of them under a repeated id."""
    r = np.random.default_rng(4)
    centre = r.normal(size=(30, 6)) * 5
    x = np.concatenate([centre[np.arange(3000) % 30] + r.normal(size=(3000, 6)) * 0.01, r.normal(size=(40, 6)) * 60])
    rows = [(i, v) for i, v in enumerate(x[r.permutation(len(x))].tolist(), 1)] + [(20, [1.0, 2, 3, 4, 5, 6])] * 30
    want = brute([*rows[:3040]])
    got = {}
    for row in nearest.search(vectors(spark, rows)).collect():
        got.setdefault(row.query_id, []).append(row.vec_id)
    assert got.keys() == want.keys() and all(len(v) == 20 and q not in v for q, v in got.items())
    few = [(i, v) for i, v in rows[:12]] + [(40, rows[0][1])]
    assert [r.rank for r in nearest.search(vectors(spark, few)).filter("query_id = 40").orderBy("rank").collect()] == list(range(1, 13))
