"""Fingerprints against generalised Jaccard similarity worked out from the words."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tallyward.llm import fingerprints
from tests.llm.conftest import ODD


def words(text):
    return Counter(re.split(r"[\x20\x09-\x0D]+", text.strip(" \t\n\x0b\f\r").lower()))


def jaccard(a, b):
    keys = {*a, *b}
    return sum(min(a[k], b[k]) for k in keys) / sum(max(a[k], b[k]) for k in keys)


def edits(rows):
    """Rows in order, each with its edited text and the next one's text."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    out = []
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        cut = len(t) // 4
        out.append((i, t, t[: len(t) - cut] + following[:cut], following))
    return out


def test_estimates(docs):
    r = random.Random(6)
    rows = []
    for i in range(150):
        vocabulary = [f"w{r.randint(0, 60) + 40 * (i % 4)}" for _ in range(30)]
        rows.append((i * 37 % 1000, " ".join(r.choice(vocabulary) for _ in range(r.randint(1, 80)))))
    got = {x.doc_id: x for x in fingerprints.fingerprints(docs(rows)).collect()}
    off = []
    for i, text, edited, following in edits(rows):
        row = got[i]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        off += [row.near_edited - jaccard(words(text), words(edited)), row.near_next - jaccard(words(text), words(following))]
    off = np.array(off)
    assert abs(off.mean()) < 0.02 and off.std() < 0.1


def test_weights_count(docs):
    rows = [(1, "a " * 30 + "b"), (2, "a " * 15 + "b")]
    row = fingerprints.fingerprints(docs(rows), samples=64).filter("doc_id = 1").first()
    assert 0.3 < row.near_next < 0.7  # 16 / 31; as plain sets the texts would be equal


def test_odd_rows(docs, odd):
    got = fingerprints.fingerprints(odd.withColumn("bin", F.lit(1)).withColumn("fingerprint", F.lit("x")), samples=8).collect()
    assert len(got) == len(ODD)
    want = sorted((str(i), len(t), hashlib.sha256(e.encode()).hexdigest()) for i, t, e, _ in edits(ODD))
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == want
    alike = {r.doc_id: r for r in got if r.doc_id is not None}
    assert alike[0].fingerprint == alike[1].fingerprint == alike[2].fingerprint  # no words
    assert alike[3].fingerprint == alike[6].fingerprint != alike[5].fingerprint
    assert alike[0].near_next == 1.0 and alike[2].near_next == 0.0
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def test_few_rows(docs):
    assert fingerprints.fingerprints(docs([]), samples=4).collect() == []
    row = fingerprints.fingerprints(docs([(5, "abcd efgh")]), samples=4).first()
    assert row.edited_sha256 == hashlib.sha256(b"abcd efab").hexdigest() and row.near_next == 1.0
