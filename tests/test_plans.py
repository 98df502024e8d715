"""Plan shape: per-group limits ahead of the shuffle, one plan for Q4, pruned scans."""

from postlytics.catalog import QUERIES

from .conftest import MEDIUM


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rankings_use_partial_group_limit(spark):
    for name in ["top_category_by_country", "top_category_by_year", "top_user_by_country",
                 "top_country_by_followers", "top_category_by_age_group"]:
        plan = _plan(QUERIES[name](spark, MEDIUM))
        assert "WindowGroupLimit" in plan and "Partial" in plan, name


def test_q4_runs_its_joins_once(spark):
    plan = _plan(QUERIES["top_country_by_followers"](spark, MEDIUM))
    assert "Subquery" not in plan and plan.count("o_totalprice") and plan.count("FileScan") == 5
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scans_are_pruned(spark):
    plan = _plan(QUERIES["top_category_by_country"](spark, MEDIUM))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderpriority:string>" in plan
    assert "o_comment" not in plan and "o_totalprice" not in plan


def test_repeated_key_join_is_preaggregated(spark):
    plan = _plan(QUERIES["category_counts_repeated_keys"](spark, MEDIUM))
    assert plan.count("HashAggregate(keys=[ind") >= 2


def test_exact_median_drops_rows_outside_its_bracket_before_the_shuffle(spark):
    plan = _plan(QUERIES["median_exact_by_flag"](spark, MEDIUM))
    assert "rangepartitioning" not in plan and "spark_partition_id" not in plan.lower()
    assert "partial_percentile_approx" in plan and "partial_count" in plan


def test_pair_counts_shuffles_each_side_once(spark):
    from postlytics.operators import pair_counts
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(1000).selectExpr("id AS ind", "id % 3 AS g")
        right = spark.range(1000).selectExpr("id AS ind", "id % 5 AS h")
        plan = _plan(pair_counts(left, right, "ind", ["g"], ["h"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(ind") == 2
    assert plan.count("Exchange") == 3  # and one for the counts by group


def test_large_top_n_is_limited_before_the_last_shuffle(spark):
    from pyspark.sql import functions as F
    from postlytics.operators import top_n_per_group
    df = spark.range(100_000).selectExpr("id % 2 AS g", "id AS v")
    top = top_n_per_group(df, "g", [F.col("v").desc()], n=5000)
    assert _plan(top).count("Window [") == 2
    assert {(r.g, r.lo, r.n) for r in top.groupBy("g").agg(F.min("v").alias("lo"), F.count("*").alias("n")).collect()} == {
        (0, 90_000, 5000), (1, 90_001, 5000)}


def test_offset_reads_only_its_slice(spark):
    from postlytics.operators import rows_at_offset
    df = spark.range(50_000).selectExpr("id * 7 % 50000 AS k")
    got = rows_at_offset(df, "k", 31_234, 3)
    assert [r.k for r in got.collect()] == [31_234, 31_235, 31_236]
    plan = _plan(got)
    assert "__slice" in plan and "offset=31234" not in plan
    assert rows_at_offset(df, "k", 2 ** 40, 3).count() == 0
    assert [r.k for r in rows_at_offset(df, "k", 49_999, 3).collect()] == [49_999]


def test_no_python_in_question_plans(spark):
    for name in ["top_category_by_country", "top_user_by_country", "median_followers_by_age_group",
                 "users_joined_by_year", "clean_posts"]:
        plan = _plan(QUERIES[name](spark, MEDIUM))
        assert "EvalPython" not in plan and "MapInPandas" not in plan and "FlatMapGroupsInPandas" not in plan, name


def test_large_top_n_follows_the_size_of_its_groups(spark):
    """Groups of very different sizes, NULL groups, map columns: parts come from the counted size."""
    from pyspark.sql import functions as F
    from postlytics.operators import top_n_per_group
    df = spark.range(60_000).selectExpr("case when id % 10 < 7 then 'hot' when id % 10 = 7 then 'cold' end AS g", "id AS v",
                                        "map('k', id) AS m")
    top = top_n_per_group(df, "g", [F.col("v").desc()], n=1500, rank_col="place")
    assert top.columns == ["g", "v", "m", "place"]
    rows = top.groupBy("g").agg(F.count("*").alias("n"), F.max("v").alias("hi"), F.max("place").alias("p"), F.sum("v").alias("s")).collect()
    for r in rows:
        best = sorted((i for i in range(60_000) if (("hot" if i % 10 < 7 else "cold" if i % 10 == 7 else None) == r.g)), reverse=True)[:1500]
        assert (r.n, r.hi, r.p, r.s) == (1500, best[0], 1500, sum(best))
    assert len(rows) == 3
    by_column = top_n_per_group(df, F.upper("g"), [F.col("v").desc()], n=1500)
    assert by_column.count() == 4500 and by_column.columns == ["g", "v", "m"]


def test_distinct_profile_evaluates_its_input_once(spark):
    df = QUERIES["distinct_profile"](spark, MEDIUM)
    df.collect()
    assert "ReusedExchange [value" in _plan(df)  # the total counts the distinct values that the rows come from
