"""Every registered query against its SQL on the same tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tallyward.plans import oracles

TABLES = ["events"]
WANTED = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


def _key(row):
    return tuple((v is None, repr(v)) for v in row)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, data, duck, name):
    df = entry.queries()[name](spark, data)
    names = sorted(df.columns)
    relation = duck.sql(ORACLES[name])
    assert names == sorted(relation.columns)
    kinds = dict(zip(relation.columns, map(str, relation.types), strict=True))
    assert {c: WANTED[t] for c, t in df.dtypes} == kinds
    at = [relation.columns.index(c) for c in names]
    theirs = sorted((tuple(r[i] for i in at) for r in relation.fetchall()), key=_key)
    ours = sorted((tuple(r[c] for c in names) for r in df.collect()), key=_key)
    assert len(ours) == len(theirs)
    for a, b in zip(ours, theirs, strict=True):
        for x, y in zip(a, b, strict=True):
            assert x == y or (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, abs_tol=1e-10))


def test_every_query_has_sql():
    assert set(entry.own_queries()) == set(ORACLES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 1000
    assert "amount_zscore" in df.columns
