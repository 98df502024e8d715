"""Pair counts without a look ahead: no job before the action, one scan a side, sketches from a pass that runs anyway."""

from collections import Counter

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from postlytics.catalog import QUERIES
from postlytics.operators import hot_keys_of, key_sketch, merged_sketch, pair_counts
from postlytics.session import fresh_dir

from .conftest import MEDIUM, rows

QUESTIONS = {"top_category_by_country": {"orders": 2, "customer": 2, "nation": 1},
             "top_category_by_year": {"orders": 2, "customer": 2, "nation": 1},
             "top_category_by_age_group": {"orders": 1, "customer": 2, "supplier": 1},
             "category_counts_repeated_keys": {"orders": 2, "customer": 2, "nation": 1}}


def skewed(spark, n=30_000):
    """A third of the rows hold key 0, a tenth hold key 1, some none; other keys are unique."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 10 == 1, F.lit(1)).when(F.col("id") % 50 == 2, None).otherwise(F.col("id"))
    return spark.range(n).select(key.cast("bigint").alias("ind"), (F.col("id") % 4).alias("g"), (F.col("id") % 7).alias("h"))


@pytest.mark.parametrize("name", sorted(QUESTIONS))
def test_no_job_before_the_action_and_one_scan_a_source(spark, name):
    sc = spark.sparkContext
    sc.setJobGroup(f"building-{name}", "")
    try:
        df = QUERIES[name](spark, MEDIUM)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        sc.setJobGroup("", "")
    assert list(sc.statusTracker().getJobIdsForGroup(f"building-{name}")) == []
    # posts and locations are views of orders and customers: each side reads its own columns once
    for table, scans in QUESTIONS[name].items():
        assert plan.count(f"{table}.parquet") == scans, (table, plan)


def test_hot_keys_are_combined_before_the_first_exchange(spark):
    df = skewed(spark)
    counts = pair_counts(df.select("ind", "g"), df.select("ind", "h"), "ind", ["g"], ["h"], "n")
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(ind") == 2 and "Join" not in plan
    below = plan[plan.rindex("Exchange hashpartitioning(ind"):]
    assert "partial_count" in below  # the rows of a key leave a task as one row a group
    assert {(r.g, r.h): r.n for r in counts.collect()} == expected(df)


def expected(df):
    data = [tuple(r) for r in df.collect()]
    left, right = Counter((k, g) for k, g, _ in data if k is not None), Counter((k, h) for k, _, h in data if k is not None)
    by_key = {}
    for (k, h), n in right.items():
        by_key.setdefault(k, []).append((h, n))
    out = Counter()
    for (k, g), m in left.items():
        for h, n in by_key.get(k, ()):
            out[g, h] += m * n
    return dict(out)


def test_null_groups_and_several_group_columns(spark):
    left = spark.createDataFrame([(1, None, "x"), (1, None, None), (2, "a", "x"), (None, "a", "x")], "k int, g string, f string")
    right = spark.createDataFrame([(1, None), (1, 5), (2, 5), (3, 5), (None, 5)], "k int, h int")
    got = sorted(rows(pair_counts(left, right, "k", ["g", "f"], ["h"])), key=str)
    assert got == sorted([(None, "x", None, 1), (None, "x", 5, 1), (None, None, None, 1), (None, None, 5, 1), ("a", "x", 5, 1)], key=str)


def test_sketches_are_taken_in_a_pass_stored_and_merged(spark):
    base, parts = fresh_dir(spark, "test-sketch"), skewed(spark).randomSplit([0.3, 0.7], seed=1)
    n = 0
    for i, part in enumerate(parts):
        seen = Observation()
        (part.observe(seen, F.count(F.lit(1)).alias("rows"), key_sketch("ind").alias("s"))
         .write.mode("append").parquet(f"{base}/rows"))
        n += seen.get["rows"]
        part.agg(key_sketch("ind").alias("s")).write.mode("append").parquet(f"{base}/sketches")
    stored = spark.read.parquet(f"{base}/sketches")
    assert stored.count() == 2 and n == 30_000
    assert hot_keys_of(stored, "s", n) == [0, 1]
    assert hot_keys_of(stored, "s", n, share=5) == [0]
    merged = stored.agg(merged_sketch("s").alias("s"))
    assert hot_keys_of(merged, "s", n) == [0, 1]
    df = spark.read.parquet(f"{base}/rows")
    left, right = df.select("ind", "g"), df.select("ind", "h")
    for hot in (None, [], hot_keys_of(stored, "s", n)):
        assert {(r.g, r.h): r.n for r in pair_counts(left, right, "ind", ["g"], ["h"], "n", hot).collect()} == expected(df)
    empty = spark.createDataFrame([], "ind bigint").agg(key_sketch("ind").alias("s"))
    assert hot_keys_of(empty, "s", 0) == []
