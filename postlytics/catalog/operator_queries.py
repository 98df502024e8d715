"""Registered queries that exercise single operators on whole driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from ..functions import age_band, count_multiplier, digit_pattern, join_names, parse_count, to_ts
from ..operators.aggregate import DEFAULT_ACCURACY, distinct_count_by_group, exact_lower_median, median_by_group
from ..operators.clean import (cast_columns, clean_posts, clean_users, null_placeholders,
                               pack_coordinates, parse_timestamp, strip_prefix)
from ..operators.profile import (crosstab_counts, distinct_profile, load_profile, pattern_profile,
                                 reject_counts, sample_per_group, schema_profile)
from ..operators.offsets import build_offset_index
from ..operators.rank import dedupe_records, latest_per_key, rows_at_offset, top_n_per_group
from ..operators.sketches import (brackets_from, distinct_from, distinct_sketches, merge_distinct_sketches, merge_quantile_sketches,
                                  quantile_sketches, quantiles_from)
from ..schemas import USER_CLEAN
from ..session import fresh_dir
from ..sources.bindings import raw_entities, raw_locations, raw_posts, raw_users, read_table
from ..sources.messages import assign_shard, decode_messages, encode_messages
from ..sources.sampling import sample_aligned, sample_keys
from ..sources.views import sql_over
from .. import plans
from .queries import JOIN_YEARS, entities


def parse_count_digits(spark, root):
    posts = raw_posts(spark, root)
    return posts.select("unique_id", F.col("follower_count").alias("follower_count_text"),
                        parse_count("follower_count", mode="digits").alias("follower_count"))


def parse_count_decimal(spark, root):
    posts = raw_posts(spark, root)
    return posts.select("unique_id", F.col("follower_count").alias("follower_count_text"),
                        parse_count("follower_count", mode="decimal").alias("follower_count"))


def null_placeholders_posts(spark, root):
    return null_placeholders(raw_posts(spark, root), values=("", "User Info Error"))


def pattern_profile_runs(spark, root):
    return pattern_profile(raw_posts(spark, root), "follower_count", collapse_runs=True)


def pattern_profile_digits(spark, root):
    return pattern_profile(raw_locations(spark, root), "timestamp", collapse_runs=False)


def pattern_profile_urls(spark, root):
    return pattern_profile(read_table(spark, root, "pages"), "url", collapse_runs=True)


def crosstab_pattern_multiplier(spark, root):
    posts = raw_posts(spark, root)
    return crosstab_counts(posts, [digit_pattern("follower_count").alias("follower_count_pattern"),
                                   count_multiplier("follower_count").alias("follower_count_multiplier")])


def sample_per_pattern(spark, root):
    posts = raw_posts(spark, root).withColumn(
        "follower_count_pattern", digit_pattern("follower_count"))
    posts = posts.withColumn("parsed", parse_count("follower_count"))
    return sample_per_group(posts, "follower_count_pattern", n=5, seed=17, key="unique_id", hash="md5",
                            cols=["follower_count_pattern", "follower_count", "parsed"], order_by=["parsed"])


def strip_prefix_posts(spark, root):
    posts = raw_posts(spark, root).select("unique_id", "save_location")
    return strip_prefix(posts, "save_location")


def pack_coordinates_locations(spark, root):
    geo = raw_locations(spark, root).select("ind", "latitude", "longitude")
    return pack_coordinates(geo)


def parse_timestamp_locations(spark, root):
    geo = raw_locations(spark, root).select("ind", F.col("timestamp").alias("timestamp_text"))
    return parse_timestamp(geo, "timestamp_text", out="timestamp")


def combine_names_users(spark, root):
    users = raw_users(spark, root)
    return users.select("ind", join_names("first_name", "last_name").alias("user_name"))


def age_groups_users(spark, root):
    users = raw_users(spark, root).select("ind", F.col("age").try_cast("int").alias("age"))
    return users.withColumn("age_group", age_band("age"))


def distinct_save_locations(spark, root):
    pins, _, _ = entities(spark, root, "order")
    return distinct_profile(pins, "save_location")


def distinct_brands(spark, root):
    return distinct_profile(read_table(spark, root, "part"), "p_brand")


def load_profile_raw(spark, root):
    return load_profile(raw_entities(spark, root, "order"))


def schema_profile_clean(spark, root):
    """Columns of the three cleaned entities, with the rows that hold a value."""
    pins, geo, users = entities(spark, root, "customer")
    return schema_profile({"pin": pins, "geo": geo, "user": users})


def sketch_within_error(df, by, col):
    """Per group, whether the sketch's median has a rank within n / accuracy, and one row, of the middle."""
    sketch = median_by_group(df, by, col, method="approx", out="__m")
    shares = df.join(sketch, by).groupBy(*by).agg(
        F.try_divide(F.count_if(F.col(col) < F.col("__m")), F.count(col)).alias("below"),
        F.try_divide(F.count_if(F.col(col) <= F.col("__m")), F.count(col)).alias("up_to"),
        (1 / DEFAULT_ACCURACY + F.try_divide(F.lit(1), F.count(col))).alias("bound"))
    near = (F.col("below") <= 0.5 + F.col("bound")) & (F.col("up_to") >= 0.5 - F.col("bound"))
    return shares.select(*by, F.coalesce(near, F.lit(True)).alias("within_error"))


def median_sketch_by_flag(spark, root):
    items = read_table(spark, root, "lineitem").select("l_returnflag", "l_extendedprice")
    return sketch_within_error(items, ["l_returnflag"], "l_extendedprice")


def median_exact_by_flag(spark, root):
    items = read_table(spark, root, "lineitem").select("l_returnflag", "l_extendedprice")
    return median_by_group(items, ["l_returnflag"], "l_extendedprice", method="exact",
                           out="median_price")


def latest_event_per_user(spark, root):
    events = read_table(spark, root, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return latest_per_key(events, "user_id", "ts", [F.col("event_id").desc()])


def top_events_per_user(spark, root):
    events = read_table(spark, root, "events").select("user_id", "event_id", "value")
    return top_n_per_group(events, "user_id", [F.col("value").desc_nulls_last(), F.col("event_id").asc()],
                           n=3, rank_col="event_rank")


def rows_at_offset_events(spark, root):
    events = read_table(spark, root, "events").select("event_id", "user_id", "event_type")
    return rows_at_offset(events, "event_id", offset=100, n=5)


def rows_at_many_offsets_events(spark, root):
    """A hundred offsets of one index, some beyond a small table's end, two rows each."""
    events = read_table(spark, root, "events").select("event_id", "user_id", "event_type")
    return build_offset_index(events, "event_id").rows([i * 97 for i in range(100)], n=2)


def _halves(df, key):
    """Two days' worth of rows, for sketches that are stored apart and merged."""
    return [df.where(F.pmod(F.col(key), F.lit(2)) == day) for day in (0, 1)]


def _stored_price_sketches(spark, root):
    path = fresh_dir(spark, "price-sketches")
    for items in _halves(read_table(spark, root, "lineitem").select("l_orderkey", "l_returnflag", "l_extendedprice"), "l_orderkey"):
        quantile_sketches(items, ["l_returnflag"], "l_extendedprice").write.mode("append").parquet(path)
    return merge_quantile_sketches(spark.read.parquet(path), ["l_returnflag"], DoubleType())


def median_merged_sketch_by_flag(spark, root):
    """Merged sketches of two halves: the rows they hold, and whether their median is within 0.5 % of the middle."""
    items = read_table(spark, root, "lineitem").select("l_returnflag", "l_extendedprice")
    rough = quantiles_from(_stored_price_sketches(spark, root), ["l_returnflag"], DoubleType())
    value, n = F.col("l_extendedprice"), F.col("n")
    ranks = items.join(rough, "l_returnflag").groupBy("l_returnflag", "n").agg(
        F.count_if(value < F.col("median")).alias("below"), F.count_if(value <= F.col("median")).alias("up_to"))
    near = (F.col("below") <= 0.505 * n) & (F.col("up_to") >= 0.495 * n)
    return ranks.select("l_returnflag", "n", near.alias("within_error"))


def median_exact_from_sketches(spark, root):
    """Exact medians in one pass over the rows: stored sketches give the brackets."""
    items = read_table(spark, root, "lineitem").select("l_returnflag", "l_extendedprice")
    brackets = brackets_from(_stored_price_sketches(spark, root), ["l_returnflag"], DoubleType())
    return exact_lower_median(items, ["l_returnflag"], "l_extendedprice", "median_price", bracket=brackets)


def _within(exact, rough, by, name, share):
    near = F.abs(F.col("estimate") - F.col(name)) <= share * F.col(name)
    return exact.join(rough, by).select(by, name, near.alias("within_error"))


def distinct_posters_merged_sketch(spark, root):
    """Posters per category from merged sketches of two halves, beside the exact number."""
    posts = raw_posts(spark, root, "customer").select(F.col("index").cast("bigint").alias("ind"), "category", "poster_name")
    path = fresh_dir(spark, "poster-sketches")
    for half in _halves(posts, "ind"):
        distinct_sketches(half, ["category"], "poster_name").write.mode("append").parquet(path)
    rough = distinct_from(merge_distinct_sketches(spark.read.parquet(path), ["category"]), ["category"])
    return _within(distinct_count_by_group(posts, ["category"], "poster_name", out="posters"), rough, "category", "posters", 0.04)


def users_joined_by_year_sketch(spark, root):
    """Q7 from merged sketches of two halves of the users, beside the exact number."""
    _, _, users = entities(spark, root, "customer")
    years = users.select("ind", F.year("date_joined").alias("year_joined")).where(F.col("year_joined").between(*JOIN_YEARS))
    path = fresh_dir(spark, "user-sketches")
    for half in _halves(years, "ind"):
        distinct_sketches(half, ["year_joined"], "ind").write.mode("append").parquet(path)
    rough = distinct_from(merge_distinct_sketches(spark.read.parquet(path), ["year_joined"]), ["year_joined"])
    return _within(plans.users_joined_by_year(users, *JOIN_YEARS), rough, "year_joined", "number_users_joined", 0.04)


def aligned_keys(spark, root):
    """Exactly 300 users, the same among posts and accounts, with their number of rows in both."""
    raw = raw_entities(spark, root, "customer")
    kept = sample_keys({"pin": raw["pin"], "user": raw["user"]}, {"pin": "index", "user": "ind"}, k=300, seed=7, hash="md5")
    posts = kept["pin"].groupBy(F.col("index").alias("ind")).agg(F.count(F.lit(1)).alias("posts"))
    users = kept["user"].groupBy("ind").agg(F.count(F.lit(1)).alias("users"))
    return posts.join(users, "ind", "full")


def decode_event_props(spark, root):
    events = read_table(spark, root, "events").select("event_id", "props")
    props = StructType([StructField("k", IntegerType(), True)])
    return decode_messages(events, props, payload="props", keep=["event_id"])


def encode_decode_roundtrip(spark, root):
    _, _, users = entities(spark, root, "order")
    messages = encode_messages(users, topic="user", key="ind")
    return decode_messages(messages, USER_CLEAN, payload="value")


def shard_counts(spark, root):
    posts = assign_shard(raw_posts(spark, root), "index", 4, hash="md5")
    return posts.groupBy("shard").agg(F.count(F.lit(1)).alias("messages"))


def assigned_shards(spark, root):
    return assign_shard(raw_posts(spark, root).select("index", "unique_id"), "index", 4, hash="md5")


def top_posts_by_category(spark, root):
    """More rows per group than Spark's partial group limit takes: ranked in two stages."""
    pins, _, _ = entities(spark, root, "order")
    order = [F.col("follower_count").desc_nulls_last(), F.col("ind").asc()]
    return top_n_per_group(pins.select("category", "ind", "follower_count"), "category", order, n=1500, rank_col="place")


def distinct_customers_by_category(spark, root):
    posts = raw_posts(spark, root, "customer").select("category", "poster_name")
    return distinct_count_by_group(posts, ["category"], "poster_name", out="posters")


def approx_customers_by_category(spark, root):
    """The HyperLogLog++ option of the distinct count, within three standard errors (5 %)."""
    posts = raw_posts(spark, root, "customer").select("category", "poster_name")
    exact = distinct_count_by_group(posts, ["category"], "poster_name", out="posters")
    rough = distinct_count_by_group(posts, ["category"], "poster_name", out="estimate", approx=True)
    near = F.abs(F.col("estimate") - F.col("posters")) <= 0.15 * F.col("posters")
    return exact.join(rough, "category").select("category", near.alias("within_error"))


def aligned_sample(spark, root):
    raw = raw_entities(spark, root, "customer")
    kept = sample_aligned({"pin": raw["pin"], "user": raw["user"]}, {"pin": "index", "user": "ind"},
                          fraction=0.25, seed=7, hash="md5")
    return plans.top_category_by_age_group(clean_posts(kept["pin"]), clean_users(kept["user"]))


def sql_top_category_by_country(spark, root):
    pins, geo, _ = entities(spark, root, "order")
    return sql_over(spark, {"pin": pins, "geo": geo}, """
        WITH g AS (SELECT ind, country, count(*) AS n FROM {geo} GROUP BY ind, country),
             p AS (SELECT ind, category, count(*) AS n FROM {pin} GROUP BY ind, category),
             counts AS (SELECT g.country, p.category, sum(g.n * p.n) AS category_count
                        FROM g JOIN p ON g.ind = p.ind GROUP BY g.country, p.category)
        SELECT country, category, category_count FROM (
          SELECT *, row_number() OVER (PARTITION BY country
                                       ORDER BY category_count DESC, category ASC NULLS LAST) AS rn
          FROM counts)
        WHERE rn = 1
        ORDER BY country""")


def sql_sample_per_pattern(spark, root):
    shapes = raw_posts(spark, root).select(
        "unique_id", F.col("follower_count").alias("count_text"), digit_pattern("follower_count").alias("shape"))
    return sql_over(spark, {"shapes": shapes}, """
        WITH drawn AS (
          SELECT shape, count_text,
                 row_number() OVER (PARTITION BY shape ORDER BY md5(concat(unique_id, ':5')), unique_id) AS place
          FROM {shapes})
        SELECT DISTINCT shape, count_text FROM drawn WHERE place <= 5 ORDER BY shape, count_text""")


def cast_post_columns(spark, root):
    posts = raw_posts(spark, root).select("unique_id", "index", "downloaded")
    return cast_columns(posts, {"index": "bigint", "downloaded": "int"})


def join_date_rejects(spark, root):
    users = raw_users(spark, root)
    return reject_counts(users, {
        "date_joined_rejects": F.col("date_joined").isNotNull() & to_ts("date_joined").isNull(),
        "age_rejects": F.col("age").isNotNull() & F.col("age").try_cast("int").isNull(),
    })


def category_counts_latest_only(spark, root):
    """D4 with de-duplication: each user's latest location and highest-count
    post only, then the country x category counts."""
    pins, geo, _ = entities(spark, root, "customer")
    latest_geo = dedupe_records(geo, "latest", key="ind", ts="timestamp",
                                tie=[F.col("country").asc_nulls_last()])
    best_pin = top_n_per_group(pins, "ind", [F.col("follower_count").desc_nulls_last(),
                                             F.col("unique_id").asc_nulls_last()])
    return plans.category_counts(best_pin, latest_geo)


def distinct_posts(spark, root):
    """Exact de-duplication of post records (the same order posted twice counts once)."""
    posts = raw_posts(spark, root, "customer").select("index", "category", "poster_name")
    return dedupe_records(posts, "exact")


OPERATOR_QUERIES = {
    "category_counts_latest_only": category_counts_latest_only,
    "distinct_posts": distinct_posts,
    "sql_top_category_by_country": sql_top_category_by_country,
    "sql_sample_per_group": sql_sample_per_pattern,
    "cast_columns": cast_post_columns,
    "reject_counts": join_date_rejects,
    "parse_count_digits": parse_count_digits,
    "parse_count_decimal": parse_count_decimal,
    "null_placeholders": null_placeholders_posts,
    "pattern_profile_runs": pattern_profile_runs,
    "pattern_profile_digits": pattern_profile_digits,
    "pattern_profile_urls": pattern_profile_urls,
    "crosstab_counts": crosstab_pattern_multiplier,
    "sample_per_group": sample_per_pattern,
    "strip_prefix": strip_prefix_posts,
    "pack_coordinates": pack_coordinates_locations,
    "parse_timestamp": parse_timestamp_locations,
    "combine_names": combine_names_users,
    "age_groups": age_groups_users,
    "distinct_profile": distinct_save_locations,
    "distinct_profile_brands": distinct_brands,
    "load_profile": load_profile_raw,
    "schema_profile": schema_profile_clean,
    "median_sketch_by_flag": median_sketch_by_flag,
    "median_exact_by_flag": median_exact_by_flag,
    "latest_event_per_user": latest_event_per_user,
    "top_events_per_user": top_events_per_user,
    "rows_at_offset": rows_at_offset_events,
    "rows_at_many_offsets": rows_at_many_offsets_events,
    "median_merged_sketch_by_flag": median_merged_sketch_by_flag,
    "median_exact_from_sketches": median_exact_from_sketches,
    "distinct_posters_merged_sketch": distinct_posters_merged_sketch,
    "users_joined_by_year_sketch": users_joined_by_year_sketch,
    "aligned_keys": aligned_keys,
    "decode_event_props": decode_event_props,
    "encode_decode_roundtrip": encode_decode_roundtrip,
    "shard_counts": shard_counts,
    "assigned_shards": assigned_shards,
    "top_posts_by_category": top_posts_by_category,
    "distinct_posters_by_category": distinct_customers_by_category,
    "approx_posters_by_category": approx_customers_by_category,
    "aligned_sample": aligned_sample,
}
