"""Question semantics on hand-written rows (FIXTURES B3)."""

import datetime as dt

from pyspark.sql import functions as F

from postlytics import plans
from postlytics.operators import median_by_group, pair_counts, top_n_per_group
from postlytics.schemas import CLEAN_SCHEMAS

from .conftest import rows

T = dt.datetime


def _pins(spark, data):
    # (ind, follower_count, poster_name, category)
    full = [(i, f"u{i}", None, None, fc, name, None, None, None, None, cat) for i, fc, name, cat in data]
    return spark.createDataFrame(full, CLEAN_SCHEMAS["pin"])


def _geo(spark, data):
    return spark.createDataFrame([(i, c, [0.0, 0.0], ts) for i, c, ts in data], CLEAN_SCHEMAS["geo"])


def _users(spark, data):
    return spark.createDataFrame([(i, f"n{i}", age, joined) for i, age, joined in data],
                                 CLEAN_SCHEMAS["user"])


def test_tied_categories_smaller_name_wins(spark):
    pins = _pins(spark, [(1, 5, "a", "travel"), (2, 5, "b", "art")])
    geo = _geo(spark, [(1, "Peru", T(2020, 1, 1)), (2, "Peru", T(2020, 1, 2))])
    assert rows(plans.top_category_by_country(pins, geo)) == [("Peru", "art", 1)]


def test_repeated_keys_multiply(spark):
    pins = _pins(spark, [(1, 5, "a", "art"), (1, 5, "a", "art")])
    geo = _geo(spark, [(1, "Peru", T(2020, 1, 1)), (1, "Peru", T(2020, 1, 1))])
    assert rows(plans.category_counts(pins, geo)) == [("Peru", "art", 4)]
    direct = geo.join(pins, "ind").groupBy("country", "category").count()
    assert rows(direct) == [("Peru", "art", 4)]
    dedup = plans.category_counts(pins.dropDuplicates(), geo.dropDuplicates())
    assert rows(dedup) == [("Peru", "art", 1)]


def test_pair_counts_equals_join_count(spark):
    left = spark.createDataFrame([(k % 3, f"g{k % 2}") for k in range(30)], "ind long, g string")
    right = spark.createDataFrame([(k % 4, f"h{k % 3}") for k in range(40)], "ind long, h string")
    expect = sorted(rows(left.join(right, "ind").groupBy("g", "h").count()))
    assert sorted(rows(pair_counts(left, right, "ind", ["g"], ["h"]))) == expect
    assert sorted(rows(pair_counts(left, right, "ind", ["g"], ["h"], hot_keys=[0, 2]))) == expect
    assert sorted(rows(pair_counts(left, right, "ind", ["g"], ["h"], hot_keys=[]))) == expect


def test_latest_post_and_top_user(spark):
    pins = _pins(spark, [(1, 10, "ann", "art"), (1, 30, "ann", "art"), (2, 30, "bob", "art"),
                         (3, None, "cid", "art")])
    geo = _geo(spark, [(1, "Peru", T(2020, 1, 1)), (1, "Chile", T(2021, 1, 1)),
                       (2, "Peru", T(2020, 5, 1)), (3, "Chile", T(2019, 1, 1))])
    latest = sorted(rows(plans.latest_post_per_user(pins, geo).select("ind", "country", "follower_count")))
    assert latest == [(1, "Chile", 30), (2, "Peru", 30), (3, "Chile", None)]
    assert rows(plans.top_user_by_country(pins, geo)) == [("Chile", "ann", 30), ("Peru", "bob", 30)]
    # both countries share the global max: both kept
    assert sorted(rows(plans.top_country_by_followers(pins, geo))) == [("Chile", 30), ("Peru", 30)]


def test_all_null_counts_keep_row_and_skip_q4(spark):
    pins = _pins(spark, [(1, None, "ann", "art"), (2, 7, "bob", "art")])
    geo = _geo(spark, [(1, "Chile", T(2020, 1, 1)), (2, "Peru", T(2020, 1, 1))])
    assert rows(plans.top_user_by_country(pins, geo)) == [("Chile", "ann", None), ("Peru", "bob", 7)]
    assert rows(plans.top_country_by_followers(pins, geo)) == [("Peru", 7)]


def test_users_without_posts_and_year_bounds(spark):
    pins = _pins(spark, [(1, 10, "a", "art"), (2, 20, "b", "art"), (3, 30, "c", "art"), (4, 40, "d", "art")])
    geo = _geo(spark, [(i, "Peru", T(2020, 1, 1)) for i in (1, 2, 3, 4)])
    users = _users(spark, [(1, 20, T(2015, 1, 1)), (2, 21, T(2020, 12, 31)), (3, 22, T(2016, 1, 1)),
                           (4, 23, T(2016, 1, 1)), (5, 24, T(2016, 2, 2)), (6, 60, T(2021, 1, 1))])
    assert rows(plans.users_joined_by_year(users, 2015, 2020)) == [(2015, 1), (2016, 3), (2020, 1)]
    med = rows(plans.median_followers_by_age_group(pins, geo, users, method="exact"))
    # 18-24 holds 10, 20, 30, 40 and a user without posts: lower median of four values
    assert med == [("+50", None), ("18-24", 20)]
    sketch = rows(plans.median_followers_by_age_group(pins, geo, users, method="approx"))
    assert sketch == med
    by_year = rows(plans.median_followers_by_year_joined(pins, geo, users, 2015, 2020, method="exact"))
    assert by_year == [(2015, 10), (2016, 30), (2020, 20)]


def test_top_category_by_age_group_counts_every_post(spark):
    pins = _pins(spark, [(1, 1, "a", "art"), (1, 1, "a", "art"), (2, 1, "b", "diy")])
    users = _users(spark, [(1, 30, None), (2, 31, None), (3, None, None)])
    assert rows(plans.top_category_by_age_group(pins, users)) == [("25-35", "art", 2)]


def test_top_n_and_median_exact(spark):
    df = spark.createDataFrame([("a", v) for v in (5, 1, 4, 2)] + [("b", None)], "g string, v long")
    assert rows(top_n_per_group(df, "g", [F.col("v").desc_nulls_last()], n=2).orderBy("g", "v")) == [
        ("a", 4), ("a", 5), ("b", None)]
    assert sorted(rows(median_by_group(df, ["g"], "v", method="exact")), key=str) == [("a", 2), ("b", None)]


def test_exact_median_hot_group(spark):
    from postlytics.operators.aggregate import exact_lower_median
    df = spark.range(20000).select(
        F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(F.lit("cold")).alias("g"),
        ((F.col("id") * 7919) % 10007).alias("v"))
    data = [(r.g, r.v) for r in df.collect()]
    for accuracy in (100, 1000):
        got = dict(rows(exact_lower_median(df.repartition(7), ["g"], "v", "m", accuracy=accuracy)))
        for g in ("hot", "cold"):
            vals = sorted(v for k, v in data if k == g)
            assert got[g] == vals[(len(vals) + 1) // 2 - 1]


def test_sample_per_group_does_not_depend_on_partitions(spark):
    from postlytics.operators import sample_per_group
    df = spark.range(1000).selectExpr("id", "id % 3 AS g")
    one = sorted(rows(sample_per_group(df.coalesce(1), "g", n=5, seed=4, key="id")))
    four = sorted(rows(sample_per_group(df.repartition(4), "g", n=5, seed=4, key="id")))
    assert one == four and len(one) == 15
    assert one != sorted(rows(sample_per_group(df, "g", n=5, seed=5, key="id")))


def test_users_without_a_key_keep_their_row(spark):
    users = _users(spark, [(None, 30, T(2016, 1, 1))] * 3 + [(1, 30, T(2016, 1, 1))])
    pins, geo = _pins(spark, [(1, 9, "a", "art")]), _geo(spark, [(1, "Peru", T(2020, 1, 1))])
    got = rows(plans.users_with_latest_post(pins, geo, users).select("ind", "follower_count"))
    assert sorted(got, key=str) == [(1, 9), (None, None), (None, None), (None, None)]


def test_hot_key_without_pairs(spark):
    """One key holds a third of each side: 10 000 x 10 000 = 1e8 joined rows if
    the pairs were built. pair_counts and the latest-post join must not build them."""
    import time
    n = 30000
    left = spark.range(n).select(
        F.when(F.col("id") < n // 3, F.lit(0)).otherwise(F.col("id")).alias("ind"),
        F.when(F.col("id") % 2 == 0, F.lit("Peru")).otherwise(F.lit("Chile")).alias("country"),
        F.timestamp_seconds(F.col("id")).alias("timestamp"))
    right = spark.range(n).select(
        F.when(F.col("id") < n // 3, F.lit(0)).otherwise(F.col("id")).alias("ind"),
        F.when(F.col("id") % 3 == 0, F.lit("art")).otherwise(F.lit("diy")).alias("category"),
        F.col("id").alias("follower_count"), F.concat(F.lit("u"), F.col("id").cast("string")).alias("poster_name"))
    t0 = time.perf_counter()
    got = {(r.country, r.category): r.n for r in pair_counts(left, right, "ind", ["country"], ["category"], "n").collect()}
    # hot key 0: 5000 Peru + 5000 Chile rows on the left, 3334 art + 6666 diy on the right
    hot_left = {"Peru": 5000, "Chile": 5000}
    hot_right = {"art": 3334, "diy": 6666}
    expect = {(c, k): hot_left[c] * hot_right[k] for c in hot_left for k in hot_right}
    for i in range(n // 3, n):  # the other keys are unique and meet themselves once
        key = ("Peru" if i % 2 == 0 else "Chile", "art" if i % 3 == 0 else "diy")
        expect[key] += 1
    assert got == expect
    latest = plans.latest_post_per_user(right, left).filter("ind = 0").collect()
    assert [(r.country, r.follower_count) for r in latest] == [("Chile", 9999)]  # newest row: id 9999
    assert time.perf_counter() - t0 < 60
