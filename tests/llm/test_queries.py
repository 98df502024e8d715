"""The registered queries against their SQL and against each other, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_mod
from postlytics.llm.catalog import ORACLE, QUERIES
from tools.oracle_check import TABLES, digest

from ..conftest import MEDIUM, SMALL


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{MEDIUM}/{t}.parquet')")
    return c


def test_entry_module_registers_all():
    names = set(entry_mod.queries())
    assert set(QUERIES) <= names and "pipeline" in names
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, MEDIUM)
    rel = con.sql(ORACLE[name])
    got, expect = [tuple(r) for r in df.collect()], rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest(df.columns, got)[0] == digest(rel.columns, expect)[0]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_returns_a_row_for_every_document(spark, name):
    ids = {r.doc_id for r in QUERIES[name](spark, SMALL).select("doc_id").collect()}
    assert ids == {r.doc_id for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id").collect()}
