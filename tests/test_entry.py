"""The driver contract: entry, queries and oracle SQL (checked with DuckDB at the smallest scale)."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as E

from .conftest import SF_SMALL

SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "timestamp": "TIMESTAMP", "boolean": "BOOLEAN"}

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["country_code", "generation_date"]
    assert df.count() > 0


def test_every_reference_query_has_an_oracle():
    from gridmix.plans.catalog import QUERIES

    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return (0, "")
    return (1, repr(v) if isinstance(v, float) else str(v))


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = df.columns
    srows = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    ocols, otypes = rel.columns, [str(t) for t in rel.types]
    orows = rel.fetchall()
    assert sorted(cols) == sorted(ocols)
    spark_types = {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes}
    assert spark_types == dict(zip(ocols, otypes))
    order = sorted(cols)
    s = sorted(tuple(_norm(r[cols.index(c)]) for c in order) for r in srows)
    o = sorted(tuple(_norm(r[ocols.index(c)]) for c in order) for r in orows)
    assert len(s) == len(o)
    assert s == o
