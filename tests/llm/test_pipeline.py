"""The stages of the pipeline, each against what it was given; and that the SQL of the folder's queries holds."""

import re

import duckdb
import public_tokenizers as P
import pytest

from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tallyward.llm import byte_bpe, mixing, queries, sanitise, toxicity
from tallyward.llm.tables import read, stored
from tests.llm.conftest import ODD
from tests.llm.test_ngram_join import components
from tests.llm.test_sanitise import base


@pytest.fixture(scope="module")
def stages(spark, data):
    docs = read(spark, data, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], data), f"test-{name}"))
    return out


def test_stages(spark, data, stages):
    for docs in stages[:-1]:
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    given, polite, single, private, mixed, tokens = ([r.asDict() for r in s.collect()] for s in stages)
    scored = toxicity.score(stages[0], toxicity.fit(stages[0], read(spark, data, "labels")))
    assert {r["doc_id"] for r in polite} == {r.doc_id for r in scored.collect() if r.score < 0.5}
    text = {r["doc_id"]: r["text"] for r in given}
    assert all(r["text"] == text[r["doc_id"]] for r in polite)
    groups = components([(r["doc_id"], r["text"]) for r in polite])
    assert {r["doc_id"] for r in single} == {i for i, n, c in groups if c == i}
    before = {r["doc_id"]: r["text"] for r in single}
    assert {r["doc_id"] for r in private} == set(before)
    for r in private:
        assert r["n_chars"] == len(r["text"])
        held = base(before[r["doc_id"]])
        if not held:
            assert r["text"] == before[r["doc_id"]]
        else:
            assert all(before[r["doc_id"]][a:b] not in r["text"] for a, _, b, _ in held)
    planned = {r.doc_id: r.taken // r.size if r.size else 0 for r in mixing.taken(stages[3]).collect()}
    for i, copies in planned.items():
        assert sum(r["doc_id"] == i for r in mixed) == copies
    c = byte_bpe.codec(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    clean = {r["doc_id"]: r["text"] for r in mixed}
    assert len(tokens) == len(mixed)
    assert all(list(r["ids"]) == c.bpe.encode_ordinary(clean[r["doc_id"]]) and r["n_tokens"] == len(r["ids"]) for r in tokens)


def test_registered():
    names = entry.queries()
    assert [n for n in names if re.match(r"op\d+_", n)] == [*queries.queries()] and len(queries.queries()) == 13
    assert "pipeline" in names
    assert sanitise.KINDS[:4] == ("email", "ip", "card", "phone")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, data, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{data}/{table}.parquet'")
    want = con.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, data)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    theirs = sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=str)
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=str) == theirs


@pytest.mark.parametrize("name", ["op2_byte_bpe", "op3_html_main_text", "op4_toxicity", "op5_token_counts", "op6_rendezvous_shards", "op9_disclosure_sanitising"])
def test_query_has_every_row(spark, data, name):
    table = "pages" if name.startswith("op3") else "documents"
    assert queries.queries()[name](spark, data).count() == read(spark, data, table).count()


def test_stages_take_odd_tables(spark, data, docs):
    """Nulls, empty and long texts, ties and repeated rows, columns of clashing names, and an empty table."""
    given = read(spark, data, "documents").limit(40)
    clash = {"_row": F.lit(1), "_key": F.lit("k"), "size": F.lit(2.5), "copies": F.lit(0), "token": F.lit("t"), "n_tokens": F.lit(True), "score": F.lit(0)}
    odd = given.unionByName(docs(ODD)).withColumns(clash)
    nulls = docs([(None, None)] * 3).withColumns({c: F.lit(None).cast(t) for c, t in docs([]).dtypes}).withColumns(clash)
    for table in (odd.unionByName(nulls), odd.limit(0)):
        out = stored(table, "odd")
        for name, stage in corpus_pipeline.STAGES:
            before, out = out, stored(stage(spark, out, data), f"odd-{name}")
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == before.columns
            rows, kept = before.count(), out.count()
            assert kept <= rows if name in ("toxicity", "near-duplicates") else kept == rows if name != "mix" else kept <= 3 * rows
        assert {"doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"} <= set(out.columns)
        if table.count():
            assert out.filter("doc_id = 4").count() >= 0 and out.filter("doc_id IS NOT NULL").count() > 20
        else:
            assert out.count() == 0
