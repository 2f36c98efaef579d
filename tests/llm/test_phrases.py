"""Phrase mining against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyward.llm import phrases
from tests.llm.conftest import DOCUMENTS, ODD


def plainly(rows, least, top):
    found, total = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, 5):
                found.setdefault(lang, Counter()).update(tuple(words[i: i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in found.items():
        candidates = [p for p, n in f.items() if len(p) > 1 and n >= least]
        kept = []
        for p in candidates:
            inside = any(len(q) > len(p) and 100 * f[q] >= 80 * f[p] and any(q[i: i + len(p)] == p for i in range(len(q))) for q in candidates)
            if not inside:
                score, k = min((2_000_000 * f[p] // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-score, -f[p], " ".join(p), f[p[:k]], f[p[k:]]))
        kept.sort(key=lambda x: (x[0], x[1], x[2].encode()))
        out += [(lang, i, p, -a, left, right, total[lang], -s) for i, (s, a, p, left, right) in enumerate(kept[:top], 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, text, lang, "s", None) for i, (lang, text) in enumerate(rows)], DOCUMENTS)


@pytest.mark.parametrize("block, range_, top", [(1 << 20, 1 << 20, 2000), (400, 300, 9)])
def test_equals_plain_counting(spark, block, range_, top):
    r = random.Random(block)
    words = ["New", "york", "city", "the", "of", "é", "x\x00", "x", "(a"]
    rows = [(r.choice(["en", "de", None]), "".join(r.choice(words) + r.choice([" ", " ", " ", "\t", "  ", ". ", "\n", "!"]) for _ in range(r.randint(0, 60)))) for _ in range(150)]
    assert got(phrases.mine(frame(spark, rows), 20, top=top, block_bytes=block, range_bytes=range_)) == plainly(rows, 20, top)


def test_colliding_fingerprints_are_told_apart(spark, monkeypatch):
    """All phrases of as many words have one fingerprint here."""
    monkeypatch.setattr(phrases._Block, "fingerprints", lambda self, n, first: np.full(len(first), n << 40, np.uint64))
    rows = [("en", "a b c a b"), ("en", "a b d")] * 3
    table = phrases._Block(frame(spark, rows).select("lang", "text").toArrow(), 4)
    assert len({*table.fingerprints(2, table.runs(2)).tolist()}) == 1
    texts = frame(spark, rows).select("lang", "text").toArrow()
    sent = phrases._send(4, 4)(texts.append_column("block", [[7] * 6]))
    back = phrases._often(5)(sent)
    found = phrases._materialise(4, 4)(texts, back).to_pylist()
    assert {(f["phrase"], f["n"]) for f in found if f["words"] == 2} == {("a b", 9), ("b c", 3), ("c a", 3), ("b d", 3)}


def test_odd_rows(spark, odd):
    more = odd.withColumn("phrase", F.lit(1)).withColumn("block", F.lit("x")).withColumn("a", F.lit(0))
    assert got(phrases.mine(more, 2)) == plainly([("en", t) for _, t in ODD], 2, 2000)
    assert got(phrases.mine(odd.limit(0))) == []
    assert got(phrases.mine(frame(spark, [(None, None), ("en", ""), ("en", " \t.")]))) == []
