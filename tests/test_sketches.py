"""Quantile and distinct sketches: rank error, two-level merge, stored parts equal the whole."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType

from postlytics.operators import (brackets_from, common_from, distinct_from, distinct_sketches, merge_distinct_sketches,
                                  merge_quantile_sketches, quantile_sketches, quantiles_from)
from postlytics.operators.aggregate import exact_lower_median
from postlytics.session import fresh_dir

from .conftest import rows


def values(spark, n=60_000):
    """Two groups (one holds 80 % of the rows), a NULL group, NULL values and a group of NULLs only."""
    g = F.when(F.col("id") % 10 < 8, "hot").when(F.col("id") % 10 == 8, "cold").when(F.col("id") % 100 == 9, "none")
    v = F.when(F.col("id") % 100 == 9, None).when(F.col("id") % 17 == 0, None).otherwise((F.col("id") * 7919) % 10007)
    return spark.range(n).select("id", g.alias("g"), v.alias("v"))


@pytest.mark.parametrize("kind", ["bigint", "double", "int"])
def test_rank_error_of_merged_halves(spark, kind):
    df = values(spark).withColumn("v", F.col("v").cast(kind))
    path = fresh_dir(spark, "test-kll")
    for day in (0, 1):
        quantile_sketches(df.where(F.expr("id div 100 % 2") == day).repartition(9), ["g"], "v").write.mode("append").parquet(path)
    stored, kind = spark.read.parquet(path), df.schema["v"].dataType
    assert stored.count() == 8  # two days of four groups
    merged = merge_quantile_sketches(stored, ["g"], kind)
    found = {r.g: r for r in quantiles_from(merged, ["g"], kind, (0.1, 0.5, 0.9), ("a", "b", "c")).collect()}
    data = {}
    for _, g, v in rows(df):
        data.setdefault(g, []).append(v)
    assert set(found) == set(data) == {"hot", "cold", "none", None}
    assert found["none"].n == 0 and found["none"].b is None
    for g in ("hot", "cold", None):
        have = sorted(v for v in data[g] if v is not None)
        assert found[g].n == len(have)
        for q, got in ((0.1, found[g].a), (0.5, found[g].b), (0.9, found[g].c)):
            below, up_to = sum(v < got for v in have) / len(have), sum(v <= got for v in have) / len(have)
            assert below - 0.005 <= q <= up_to + 0.005
    # brackets from stored sketches give the exact median in one pass over the rows
    brackets = brackets_from(merged, ["g"], kind)
    got = dict(rows(exact_lower_median(df, ["g"], "v", bracket=brackets)))
    for g in ("hot", "cold", None):
        have = sorted(v for v in data[g] if v is not None)
        assert got[g] == have[(len(have) + 1) // 2 - 1]
    assert got["none"] is None


def test_a_bracket_that_misses_the_median_raises(spark):
    df = values(spark, 2000)
    wrong = df.groupBy("g").agg(F.max("v").alias("__lo"), F.max("v").alias("__hi")).where("g = 'hot'")
    with pytest.raises(Exception, match="outside its bracket"):
        exact_lower_median(df.where("g = 'hot'"), ["g"], "v", bracket=wrong).collect()
    with pytest.raises(Exception, match="outside its bracket"):  # a group without a bracket
        exact_lower_median(df.where("g = 'cold'"), ["g"], "v", bracket=wrong).collect()


def test_no_task_merges_all_partials_of_a_group(spark):
    """First per (group, part): a group's partial sketches are dealt to as many tasks as there are parts."""
    df = values(spark).repartition(40)
    for sketch in (quantile_sketches(df, ["g"], "v", parts=8), distinct_sketches(df, ["g"], "v", parts=8)):
        plan = sketch._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(g") == 2 and plan.count("__part") > 0
        parts = sketch._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(g#" in parts and "__part#" in parts[parts.rindex("Exchange hashpartitioning(g#"):][:200]


def test_sketch_types(spark):
    with pytest.raises(ValueError):
        quantile_sketches(spark.createDataFrame([("a", dt.date(2020, 1, 1))], "g string, v date"), ["g"], "v")
    empty = spark.createDataFrame([], "g string, v bigint")
    assert quantiles_from(quantile_sketches(empty, ["g"], "v"), ["g"], LongType()).count() == 0
    assert distinct_from(distinct_sketches(empty, ["g"], "v"), ["g"]).count() == 0
    one = quantile_sketches(spark.createDataFrame([(1.5,)], "v double"), [], "v")
    assert rows(quantiles_from(one, [], DoubleType())) == [(1, 1.5)]


def test_union_of_distinct_halves_equals_the_whole(spark):
    df = values(spark)
    halves = distinct_sketches(df.where("id % 2 = 0"), ["g"], "v").unionByName(distinct_sketches(df.where("id % 2 = 1"), ["g"], "v"))
    merged = dict(rows(distinct_from(merge_distinct_sketches(halves, ["g"]), ["g"])))
    whole = dict(rows(distinct_from(distinct_sketches(df, ["g"], "v"), ["g"])))
    exact = dict(rows(df.groupBy("g").agg(F.count_distinct("v"))))
    assert merged == whole == exact  # below 2^14 values the sketch is exact
    rough = dict(rows(distinct_from(merge_distinct_sketches(
        distinct_sketches(df.where("id % 2 = 0"), ["g"], "v", lg=8).unionByName(distinct_sketches(df.where("id % 2 = 1"), ["g"], "v", lg=8)),
        ["g"], lg=8), ["g"])))
    for g, n in exact.items():
        assert abs(rough[g] - n) <= 0.3 * n
    both = dict(rows(common_from(distinct_sketches(df.where("v < 6000"), ["g"], "v"), distinct_sketches(df.where("v >= 4000"), ["g"], "v"), ["g"])))
    assert both["hot"] == df.where("g = 'hot' and v >= 4000 and v < 6000").select("v").distinct().count()
