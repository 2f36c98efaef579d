"""Byte-level BPE and token counts against the libraries."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
from tests.conftest import rows_of
from pyspark.sql import functions as F

from tallyward.llm import byte_bpe, token_counts
from tests.llm.conftest import LONG, ODD

BPE = P.path("byte_bpe_50k.tiktoken")
PIECES = P.path("piece_bpe_32k.model")
PARTS = ["a", "b", "'", "s", "'re", " ", "  ", "\n", "1", "99", "é", "漢", "!", "...", "the ", "\xa0", "😀", "'ll", "\x00", "▁", "<s>", "</s>", "ing"]


@pytest.fixture(scope="module")
def texts():
    r = random.Random(3)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, 50))) for _ in range(3000)] + [LONG, "ab" * 5000, "9" * 5000, " " * 5000]


def test_tree_equals_library(texts):
    c = byte_bpe.codec(BPE, P.PATTERN)
    for text in texts:
        want = c.bpe.encode_ordinary(text)
        for leaf in (1, 3, 16) if len(text) < 1000 else (64, 4096):
            assert c.encode(text, leaf) == want
            assert c.decode(want, leaf) == text.encode()


def test_ordinary_texts_are_joined(monkeypatch):
    """A page of prose goes through halves and joins, and joins look at a small part of it."""
    c = byte_bpe.codec(BPE, P.PATTERN)
    text = "Some ordinary words, 12 or so, that follow each other. " * 60
    joins, seen = [], []
    join, encode = c._join, c.bpe.encode_ordinary
    monkeypatch.setattr(c, "_join", lambda *a: joins.append(1) or join(*a))
    monkeypatch.setattr(c, "bpe", type("Spy", (), {"encode_ordinary": lambda self, t: seen.append(len(t)) or encode(t), "_encode_single_piece": c.bpe._encode_single_piece})())
    assert c.encode(text) == encode(text)
    assert len(joins) >= 8 and max(seen) <= byte_bpe.LEAF and sum(seen) < 1.2 * len(text)


def test_other_patterns_are_refused():
    with pytest.raises(ValueError, match="seams"):
        byte_bpe.Codec(BPE, r"\S+|\s+")


def test_encode_frames(spark, odd, docs):
    c = byte_bpe.codec(BPE, P.PATTERN)
    named = odd.withColumn("_text", F.lit(7)).withColumn("n_tokens", F.lit("old")).withColumn("ids", F.lit(1))
    out = byte_bpe.encode(named, BPE, P.PATTERN, ids=True)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "_text", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    got = sorted(((r.doc_id, r.text, r.n_tokens, r.ids_sha256, r.decoded_sha256, list(r.ids)) for r in out.collect()), key=str)
    want = []
    for i, text in ODD:
        ids = c.bpe.encode_ordinary(text or "")
        want.append((i, text, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest(), ids))
    assert got == sorted(want, key=str)
    assert byte_bpe.digests(docs([]), BPE, P.PATTERN).collect() == []


def test_counts_equal_library(texts):
    c = token_counts.Counter(PIECES)
    assert c.count(texts) == [len(c.model.encode(t)) for t in texts]
    assert all(c.model.encode(w) and len(c.model.encode(w)) == 1 for w in list(c.whole)[:500])


def test_forgetful_counter(monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 0)
    c = token_counts.Counter(PIECES)
    for t in ("zqxj kk ", "zqxj", "a  b "):
        assert c.count([t]) == [len(c.model.encode(t))]


def test_count_frames(spark, odd, docs):
    c = token_counts.Counter(PIECES)
    out = token_counts.count_tokens(odd.withColumn("n_tokens", F.lit("old")), PIECES, limit=4)
    want = [(i, len((t or "").encode()), n := len(c.model.encode(t or "")), n > 4) for i, t in ODD]
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted(want, key=str)
    assert rows_of(token_counts.count_tokens(docs([]), PIECES)) == []
