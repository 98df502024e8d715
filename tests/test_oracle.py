"""Every catalogued query against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_mod
from postlytics.catalog import QUERIES as CATALOGUED
from tools.oracle_check import TABLES, digest

from .conftest import SMALL

# what the entry module adds from the training-data subpackage is tested in tests/llm
QUERIES = {name: entry_mod.queries()[name] for name in CATALOGUED}
ORACLE = {name: sql for name, sql in entry_mod.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["country", "category", "category_count"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    got = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert len(got) > 0
        return
    rel = con.sql(ORACLE[name])
    expect = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(got) == len(expect)
    assert digest(df.columns, got)[0] == digest(rel.columns, expect)[0]


ORDERED = {"top_category_by_country": ["country"], "top_category_by_year": ["post_year"], "top_user_by_country": ["country"],
           "top_category_by_age_group": ["age_group"], "median_followers_by_age_group": ["age_group"],
           "users_joined_by_year": ["year_joined"], "median_followers_by_year_joined": ["year_joined"],
           "median_followers_by_year_and_age": ["year_joined", "age_group"], "distinct_profile": ["value"],
           "sql_sample_per_group": ["shape", "count_text"]}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_answers_come_in_order(spark, name):
    """The digest above sorts rows, so their order is checked here."""
    keys = [tuple(r[c] for c in ORDERED[name]) for r in QUERIES[name](spark, SMALL).collect()]
    assert keys == sorted(keys, key=lambda k: tuple((v is None, v if v is not None else 0) for v in k))
