"""DuckDB SQL that recomputes every catalogued query from the driver's tables.

The SQL restates the bindings (``sources.bindings``) and the cleaning rules
with DuckDB functions, and answers each question the plain way (join the rows,
then rank with ``row_number``), so it checks the Spark plans independently.
"""

from __future__ import annotations

_FOLLOWERS = """CASE o_orderkey % 5
      WHEN 0 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR)
      WHEN 1 THEN CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR) || '.'
                  || CAST(CAST(floor(o_totalprice / 100) AS BIGINT) % 10 AS VARCHAR) || 'k'
      WHEN 2 THEN CAST(o_orderkey % 9973 AS VARCHAR) || 'M'
      WHEN 3 THEN 'User Info Error'
      ELSE '' END"""


def _key(family: str) -> str:
    return "o_orderkey" if family == "order" else "o_custkey"


def raw_posts_sql(family: str) -> str:
    key = _key(family)
    return f"""SELECT o_orderpriority AS category,
    o_orderpriority || ' order for ' || c_name AS description,
    CAST(o_orderkey % 2 AS VARCHAR) AS downloaded,
    {_FOLLOWERS} AS follower_count,
    'img/' || CAST(o_orderkey AS VARCHAR) || '.jpg' AS image_src,
    CAST({key} AS VARCHAR) AS "index",
    CASE WHEN o_orderkey % 3 = 0 THEN 'video' ELSE 'image' END AS is_image_or_video,
    c_name AS poster_name,
    'Local save in /data/' || o_orderpriority AS save_location,
    o_orderstatus || ',' || o_orderpriority AS tag_list,
    CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE 'Order ' || CAST(o_orderkey AS VARCHAR) END AS title,
    'pin-' || CAST(o_orderkey AS VARCHAR) AS unique_id
  FROM orders JOIN customer ON o_custkey = c_custkey"""


def raw_locations_sql(family: str) -> str:
    key = _key(family)
    return f"""SELECT n_name AS country,
    CAST({key} AS VARCHAR) AS ind,
    CAST(o_custkey % 180 - 90 AS DOUBLE) AS latitude,
    CAST(o_custkey % 360 - 180 AS DOUBLE) AS longitude,
    strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%Y-%m-%d %H:%M:%S') AS "timestamp"
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""


RAW_USERS = """SELECT
    CASE WHEN n % 17 = 0 THEN NULL ELSE CAST(15 + n % 50 AS VARCHAR) END AS age,
    CASE WHEN n % 101 = 0 THEN 'n/a'
         ELSE printf('%04d-%02d-%02d %02d:%02d:%02d', 2014 + n % 8, 1 + n % 12,
                     1 + n % 28, n % 24, n % 60, (n * 7) % 60) END
      AS date_joined,
    CASE WHEN n % 13 = 0 THEN NULL ELSE ' ' || split_part(name, '#', 1) || '  ' END AS first_name,
    CAST(k AS VARCHAR) AS ind,
    'No.   ' || split_part(name, '#', 2) AS last_name
  FROM (SELECT c_custkey AS k, c_custkey AS n, c_name AS name FROM customer
        UNION ALL SELECT -1 - s_suppkey, s_suppkey, s_name FROM supplier)"""


def count_sql(col: str, mode: str = "digits") -> str:
    """Follower-count parsing (C2) for a text expression ``col``."""
    mult = f"CASE WHEN {col} LIKE '%k' THEN 1000 WHEN {col} LIKE '%M' THEN 1000000 ELSE 1 END"
    if mode == "digits":
        value = f"TRY_CAST(regexp_replace({col}, '[^0-9]+', '', 'g') AS BIGINT) * {mult}"
    else:
        value = (f"TRY_CAST(trunc(TRY_CAST(regexp_replace({col}, '[^0-9.]+', '', 'g') AS DECIMAL(38,6))"
                 f" * {mult}) AS BIGINT)")
    return f"CASE WHEN {col} = 'User Info Error' THEN NULL ELSE {value} END"


CLEAN_POSTS = f"""SELECT TRY_CAST(NULLIF("index", '') AS BIGINT) AS ind,
    NULLIF(unique_id, '') AS unique_id, NULLIF(title, '') AS title,
    NULLIF(description, '') AS description,
    {count_sql("NULLIF(follower_count, '')")} AS follower_count,
    NULLIF(poster_name, '') AS poster_name, NULLIF(tag_list, '') AS tag_list,
    NULLIF(is_image_or_video, '') AS is_image_or_video, NULLIF(image_src, '') AS image_src,
    regexp_replace(NULLIF(save_location, ''), '^Local save in ', '') AS save_location,
    NULLIF(category, '') AS category"""

CLEAN_LOCATIONS = """SELECT TRY_CAST(ind AS BIGINT) AS ind, country,
    [latitude, longitude] AS coordinates,
    try_strptime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp\""""

CLEAN_USERS = r"""SELECT TRY_CAST(ind AS BIGINT) AS ind,
    regexp_replace(trim(concat_ws(' ', first_name, last_name)), '\s+', ' ', 'g') AS user_name,
    TRY_CAST(age AS INTEGER) AS age,
    try_strptime(date_joined, '%Y-%m-%d %H:%M:%S') AS date_joined"""

AGE_GROUP = """CASE WHEN age BETWEEN 18 AND 24 THEN '18-24' WHEN age BETWEEN 25 AND 35 THEN '25-35'
    WHEN age BETWEEN 36 AND 50 THEN '36-50' WHEN age >= 51 THEN '+50' ELSE 'Unknown' END"""


def entities_sql(family: str) -> str:
    """CTE list defining ``pin``, ``geo`` and ``usr`` (cleaned) for a family."""
    return f"""raw_pin AS ({raw_posts_sql(family)}),
raw_geo AS ({raw_locations_sql(family)}),
raw_usr AS ({RAW_USERS}),
pin AS ({CLEAN_POSTS} FROM raw_pin),
geo AS ({CLEAN_LOCATIONS} FROM raw_geo),
usr AS ({CLEAN_USERS} FROM raw_usr)"""


def _top_category(family: str, group_expr: str, group: str, source: str, where: str = "") -> str:
    return f"""WITH {entities_sql(family)},
counts AS (
  SELECT {group_expr} AS {group}, category, count(*) AS category_count
  FROM {source} {where} GROUP BY 1, 2),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {group}
    ORDER BY category_count DESC, category ASC NULLS LAST) AS rn FROM counts)
SELECT {group}, category, category_count FROM ranked WHERE rn = 1"""


_LATEST = """latest AS (
  SELECT ind, country, poster_name, follower_count FROM (
    SELECT g.ind, g.country, p.poster_name, p.follower_count,
      row_number() OVER (PARTITION BY g.ind ORDER BY g."timestamp" DESC NULLS LAST,
        g.country ASC NULLS LAST, p.follower_count DESC NULLS LAST, p.poster_name ASC NULLS LAST) AS rn
    FROM geo g JOIN pin p ON g.ind = p.ind) WHERE rn = 1),
top_user AS (
  SELECT country, poster_name, follower_count FROM (
    SELECT *, row_number() OVER (PARTITION BY country
      ORDER BY follower_count DESC NULLS LAST, poster_name ASC NULLS LAST) AS rn FROM latest)
  WHERE rn = 1),
people AS (
  SELECT u.ind, """ + AGE_GROUP + """ AS age_group,
    CAST(year(u.date_joined) AS INTEGER) AS year_joined, l.follower_count
  FROM usr u LEFT JOIN latest l ON u.ind = l.ind)"""


def _with_latest(body: str) -> str:
    return f"WITH {entities_sql('customer')},\n{_LATEST}\n{body}"


ORACLE: dict[str, str] = {
    "top_category_by_country": _top_category(
        "order", "country", "country", "geo JOIN pin ON geo.ind = pin.ind"),
    "top_category_by_year": _top_category(
        "order", 'CAST(year(geo."timestamp") AS INTEGER)', "post_year",
        "geo JOIN pin ON geo.ind = pin.ind", 'WHERE year(geo."timestamp") BETWEEN 1996 AND 2000'),
    "category_counts_repeated_keys": f"""WITH {entities_sql('customer')}
SELECT country, category, count(*) AS category_count
FROM geo JOIN pin ON geo.ind = pin.ind GROUP BY 1, 2""",
    "top_user_by_country": _with_latest("SELECT country, poster_name, follower_count FROM top_user"),
    "top_country_by_followers": _with_latest(
        "SELECT country, follower_count FROM top_user "
        "WHERE follower_count = (SELECT max(follower_count) FROM top_user)"),
    "top_category_by_age_group": _top_category(
        "customer", AGE_GROUP, "age_group", "usr JOIN pin ON usr.ind = pin.ind"),
    "median_followers_by_age_group": _with_latest(
        "SELECT age_group, quantile_disc(follower_count, 0.5) AS median_follower_count "
        "FROM people GROUP BY 1"),
    "users_joined_by_year": _with_latest(
        "SELECT year_joined, count(DISTINCT ind) AS number_users_joined FROM people "
        "WHERE year_joined BETWEEN 2015 AND 2020 GROUP BY 1"),
    "median_followers_by_year_joined": _with_latest(
        "SELECT year_joined, quantile_disc(follower_count, 0.5) AS median_follower_count "
        "FROM people WHERE year_joined BETWEEN 2015 AND 2020 GROUP BY 1"),
    "median_followers_by_year_and_age": _with_latest(
        "SELECT year_joined, age_group, quantile_disc(follower_count, 0.5) AS median_follower_count "
        "FROM people WHERE year_joined BETWEEN 2015 AND 2020 GROUP BY 1, 2"),
    "clean_posts": f"WITH {entities_sql('order')} SELECT * FROM pin",
    "clean_locations": f"WITH {entities_sql('order')} SELECT * FROM geo",
    "clean_users": f"WITH {entities_sql('order')} SELECT * FROM usr",
}


_RAW_POST_COLS = ["category", "description", "downloaded", "follower_count", "image_src", "index",
                  "is_image_or_video", "poster_name", "save_location", "tag_list", "title", "unique_id"]


def _raw(body: str, family: str = "order") -> str:
    return f"""WITH raw_pin AS ({raw_posts_sql(family)}),
raw_geo AS ({raw_locations_sql(family)}),
raw_usr AS ({RAW_USERS})
{body}"""


def _distinct(source: str, col: str) -> str:
    return f"""WITH {source},
v AS (SELECT DISTINCT {col} AS value FROM src)
SELECT value, (SELECT count(*) FROM v) AS n_distinct FROM v
ORDER BY value ASC NULLS LAST"""


ORACLE.update({
    "parse_count_digits": _raw(
        f"SELECT unique_id, follower_count AS follower_count_text, "
        f"{count_sql('follower_count', 'digits')} AS follower_count FROM raw_pin"),
    "parse_count_decimal": _raw(
        f"SELECT unique_id, follower_count AS follower_count_text, "
        f"{count_sql('follower_count', 'decimal')} AS follower_count FROM raw_pin"),
    "null_placeholders": _raw("SELECT " + ", ".join(
        f"""CASE WHEN "{c}" IN ('', 'User Info Error') THEN NULL ELSE "{c}" END AS "{c}\""""
        for c in _RAW_POST_COLS) + " FROM raw_pin"),
    "pattern_profile_runs": _raw(
        "SELECT regexp_replace(follower_count, '[0-9]+', '9', 'g') AS follower_count_pattern, "
        "count(*) AS \"count\" FROM raw_pin GROUP BY 1"),
    "pattern_profile_digits": _raw(
        "SELECT regexp_replace(\"timestamp\", '[0-9]', '9', 'g') AS timestamp_pattern, "
        "count(*) AS \"count\" FROM raw_geo GROUP BY 1"),
    "pattern_profile_urls":
        "SELECT regexp_replace(url, '[0-9]+', '9', 'g') AS url_pattern, count(*) AS \"count\" "
        "FROM pages GROUP BY 1",
    "crosstab_counts": _raw(
        "SELECT regexp_replace(follower_count, '[0-9]+', '9', 'g') AS follower_count_pattern, "
        "CAST(CASE WHEN follower_count LIKE '%k' THEN 1000 WHEN follower_count LIKE '%M' THEN 1000000 "
        "ELSE 1 END AS BIGINT) AS follower_count_multiplier, count(*) AS \"count\" "
        "FROM raw_pin GROUP BY 1, 2"),
    "sample_per_group": _raw(
        "SELECT DISTINCT follower_count_pattern, follower_count, parsed FROM (SELECT follower_count, "
        f"{count_sql('follower_count')} AS parsed, regexp_replace(follower_count, '[0-9]+', '9', 'g') AS "
        "follower_count_pattern, row_number() OVER (PARTITION BY regexp_replace(follower_count, '[0-9]+', '9', 'g') "
        "ORDER BY CAST('0x' || substr(md5(unique_id || ':17'), 1, 8) AS BIGINT), unique_id) AS place FROM raw_pin) "
        "WHERE place <= 5"),
    "strip_prefix": _raw(
        "SELECT unique_id, regexp_replace(save_location, '^Local save in ', '') AS save_location "
        "FROM raw_pin"),
    "pack_coordinates": _raw("SELECT ind, [latitude, longitude] AS coordinates FROM raw_geo"),
    "parse_timestamp": _raw(
        "SELECT ind, \"timestamp\" AS timestamp_text, "
        "try_strptime(\"timestamp\", '%Y-%m-%d %H:%M:%S') AS \"timestamp\" FROM raw_geo"),
    "combine_names": _raw(
        r"SELECT ind, regexp_replace(trim(concat_ws(' ', first_name, last_name)), '\s+', ' ', 'g') "
        "AS user_name FROM raw_usr"),
    "age_groups": _raw(
        f"SELECT ind, age, {AGE_GROUP} AS age_group FROM "
        "(SELECT ind, TRY_CAST(age AS INTEGER) AS age FROM raw_usr)"),
    "distinct_profile": _distinct(
        f"{entities_sql('order')},\nsrc AS (SELECT save_location FROM pin)", "save_location"),
    "distinct_profile_brands": _distinct("src AS (SELECT p_brand FROM part)", "p_brand"),
    "load_profile": _raw(
        "SELECT 'pin' AS entity, count(*) AS \"rows\", 12 AS \"columns\" FROM raw_pin UNION ALL "
        "SELECT 'geo', count(*), 5 FROM raw_geo UNION ALL SELECT 'user', count(*), 5 FROM raw_usr"),
    "median_sketch_by_flag":
        "SELECT DISTINCT l_returnflag, true AS within_error FROM lineitem",
    "median_exact_by_flag":
        "SELECT l_returnflag, quantile_disc(l_extendedprice, 0.5) AS median_price "
        "FROM lineitem GROUP BY 1",
    "latest_event_per_user":
        "SELECT user_id, event_id, ts, event_type, value FROM (SELECT *, row_number() OVER "
        "(PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn FROM events) "
        "WHERE rn = 1",
    "top_events_per_user":
        "SELECT user_id, event_id, value, CAST(rn AS INTEGER) AS event_rank FROM (SELECT *, "
        "row_number() OVER (PARTITION BY user_id ORDER BY value DESC NULLS LAST, event_id ASC) "
        "AS rn FROM events) WHERE rn <= 3",
    "rows_at_offset":
        "SELECT event_id, user_id, event_type FROM events ORDER BY event_id LIMIT 5 OFFSET 100",
    "decode_event_props":
        "SELECT event_id, TRY_CAST(props->>'$.k' AS INTEGER) AS k FROM events",
    "encode_decode_roundtrip": f"WITH {entities_sql('order')} SELECT * FROM usr",
})

ORACLE.update({
    "stream_clean_posts": ORACLE["clean_posts"],
    "stream_clean_locations": ORACLE["clean_locations"],
    "stream_clean_users": ORACLE["clean_users"],
    "read_topic_posts": ORACLE["clean_posts"],
    "stream_to_catalog_table": ORACLE["clean_users"],
    "stream_processing_time": ORACLE["clean_users"],
    "read_delimited_roundtrip": _raw(
        "SELECT age, date_joined, first_name, ind, CASE CAST(ind AS BIGINT) % 7 WHEN 0 THEN '' "
        "WHEN 1 THEN 'two' || chr(10) || 'lines ' || ind WHEN 2 THEN 'say \"hi\" | ' || last_name || '  ' "
        "ELSE last_name END AS last_name FROM raw_usr"),
})

# Sketch answers depend on the group's size: what must hold is the rank error.
for _name in ("median_followers_by_age_group", "median_followers_by_year_joined",
              "median_followers_by_year_and_age"):
    ORACLE[_name + "_sketch"] = f"SELECT * EXCLUDE (median_follower_count), true AS within_error FROM ({ORACLE[_name]})"

ORACLE.update({
    "sql_top_category_by_country": ORACLE["top_category_by_country"],
    "sql_sample_per_group": _raw(
        "SELECT DISTINCT shape, count_text FROM (SELECT follower_count AS count_text, "
        "regexp_replace(follower_count, '[0-9]+', '9', 'g') AS shape, row_number() OVER (PARTITION BY "
        "regexp_replace(follower_count, '[0-9]+', '9', 'g') ORDER BY md5(unique_id || ':5'), unique_id) AS place "
        "FROM raw_pin) WHERE place <= 5"),
    "cast_columns": _raw(
        'SELECT unique_id, TRY_CAST("index" AS BIGINT) AS "index", '
        "TRY_CAST(downloaded AS INTEGER) AS downloaded FROM raw_pin"),
    "reject_counts": _raw(
        "SELECT count(*) FILTER (WHERE date_joined IS NOT NULL AND "
        "try_strptime(date_joined, '%Y-%m-%d %H:%M:%S') IS NULL) AS date_joined_rejects, "
        "count(*) FILTER (WHERE age IS NOT NULL AND TRY_CAST(age AS INTEGER) IS NULL) AS age_rejects "
        "FROM raw_usr"),
})

_REPORTED = ["top_category_by_country", "top_category_by_year", "top_user_by_country",
             "top_country_by_followers", "top_category_by_age_group", "median_followers_by_age_group",
             "users_joined_by_year", "median_followers_by_year_joined", "median_followers_by_year_and_age"]
_COLUMNS = {
    "top_category_by_country": ["country", "category", "category_count"],
    "top_category_by_year": ["post_year", "category", "category_count"],
    "top_user_by_country": ["country", "poster_name", "follower_count"],
    "top_country_by_followers": ["country", "follower_count"],
    "top_category_by_age_group": ["age_group", "category", "category_count"],
    "median_followers_by_age_group": ["age_group", "median_follower_count"],
    "users_joined_by_year": ["year_joined", "number_users_joined"],
    "median_followers_by_year_joined": ["year_joined", "median_follower_count"],
    "median_followers_by_year_and_age": ["year_joined", "age_group", "median_follower_count"],
}


def _answer_rows(names, sql) -> str:
    """All answers as (question, c1, c2, c3) text rows."""
    parts = []
    for name in names:
        cells = [f"CAST({c} AS VARCHAR)" for c in _COLUMNS[name]] + ["CAST(NULL AS VARCHAR)"] * (3 - len(_COLUMNS[name]))
        parts.append(f"SELECT '{name}' AS question, " + ", ".join(f"{c} AS c{i + 1}" for i, c in enumerate(cells))
                     + f" FROM ({sql[name]})")
    return " UNION ALL ".join(parts)


ORACLE["batch_report"] = _answer_rows(_REPORTED, ORACLE)
# the daily run answers every question from the customer family
_DAILY = {**ORACLE,
          "top_category_by_country": _top_category("customer", "country", "country", "geo JOIN pin ON geo.ind = pin.ind"),
          "top_category_by_year": _top_category(
              "customer", 'CAST(year(geo."timestamp") AS INTEGER)', "post_year",
              "geo JOIN pin ON geo.ind = pin.ind", 'WHERE year(geo."timestamp") BETWEEN 1996 AND 2000')}


def _md5_hash(key: str, seed: int) -> str:
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{seed}'), 1, 8) AS BIGINT)"


_KEPT = f"{_md5_hash('ind', 7)} % 1000000 < 250000"
ORACLE.update({
    "shard_counts": _raw(
        f'SELECT CAST({_md5_hash(chr(34) + "index" + chr(34), 0)} % 4 AS INTEGER) AS shard, '
        "count(*) AS messages FROM raw_pin GROUP BY 1"),
    "aligned_sample": f"""WITH {entities_sql('customer')},
kept_pin AS (SELECT * FROM pin WHERE {_KEPT}),
kept_usr AS (SELECT * FROM usr WHERE {_KEPT}),
counts AS (
  SELECT {AGE_GROUP} AS age_group, category, count(*) AS category_count
  FROM kept_usr u JOIN kept_pin p ON u.ind = p.ind GROUP BY 1, 2),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY age_group
    ORDER BY category_count DESC, category ASC NULLS LAST) AS rn FROM counts)
SELECT age_group, category, category_count FROM ranked WHERE rn = 1""",
})

ORACLE["aligned_keys"] = _raw(f"""
, posted AS (SELECT "index" AS ind, count(*) AS posts FROM raw_pin GROUP BY 1),
joined AS (SELECT ind, count(*) AS users FROM raw_usr GROUP BY 1)
SELECT ind, posts, users FROM posted JOIN joined USING (ind) ORDER BY {_md5_hash('ind', 7)}, ind LIMIT 300""", family="customer")
ORACLE["rows_at_many_offsets"] = """
WITH placed AS (SELECT event_id, user_id, event_type, row_number() OVER (ORDER BY event_id) - 1 AS "offset" FROM events)
SELECT * FROM placed WHERE "offset" % 97 < 2 AND "offset" < 9700"""
ORACLE["median_merged_sketch_by_flag"] = "SELECT l_returnflag, count(*) AS n, true AS within_error FROM lineitem GROUP BY 1"
ORACLE["median_exact_from_sketches"] = ORACLE["median_exact_by_flag"]
ORACLE["distinct_posters_merged_sketch"] = _raw(
    "SELECT category, count(DISTINCT poster_name) AS posters, true AS within_error FROM raw_pin GROUP BY 1", family="customer")
ORACLE["users_joined_by_year_sketch"] = f"SELECT *, true AS within_error FROM ({ORACLE['users_joined_by_year']})"
_TYPES = {"ind": "bigint", "follower_count": "bigint", "age": "int", "coordinates": "array<double>",
          "timestamp": "timestamp", "date_joined": "timestamp"}
_CLEAN = {"pin": ["ind", "unique_id", "title", "description", "follower_count", "poster_name", "tag_list", "is_image_or_video",
                  "image_src", "save_location", "category"],
          "geo": ["ind", "country", "coordinates", "timestamp"], "user": ["ind", "user_name", "age", "date_joined"]}
ORACLE["schema_profile"] = f"WITH {entities_sql('customer')}\n" + " UNION ALL ".join(
    f"SELECT '{e}' AS entity, {i + 1} AS position, '{c}' AS \"column\", '{_TYPES.get(c, 'string')}' AS type, "
    f"count(\"{c}\") AS filled FROM {'usr' if e == 'user' else e}" for e, columns in _CLEAN.items() for i, c in enumerate(columns))
ORACLE["landed_topics"] = _raw(" UNION ALL ".join(
    f"SELECT '{topic}' AS topic, \"{key}\" AS key, CAST({_md5_hash(chr(34) + key + chr(34), 0)} % 4 AS INTEGER) AS partition "
    f"FROM {source}" for topic, key, source in (("pin", "index", "raw_pin"), ("geo", "ind", "raw_geo"), ("user", "ind", "raw_usr"))))
ORACLE["stream_landed_topics"] = ORACLE["landed_topics"]
ORACLE["stream_landed_posts"] = ORACLE["clean_posts"]
ORACLE["assigned_shards"] = _raw(
    f'SELECT "index", unique_id, CAST({_md5_hash(chr(34) + "index" + chr(34), 0)} % 4 AS INTEGER) AS shard FROM raw_pin')
ORACLE["top_posts_by_category"] = f"""WITH {entities_sql('order')}
SELECT category, ind, follower_count, CAST(place AS INTEGER) AS place FROM (
  SELECT category, ind, follower_count, row_number() OVER (PARTITION BY category
    ORDER BY follower_count DESC NULLS LAST, ind) AS place FROM pin) WHERE place <= 1500"""
ORACLE["distinct_posters_by_category"] = _raw(
    "SELECT category, count(DISTINCT poster_name) AS posters FROM raw_pin GROUP BY 1", family="customer")
ORACLE["approx_posters_by_category"] = _raw(
    "SELECT DISTINCT category, true AS within_error FROM raw_pin", family="customer")
_FAULTY = f"""WITH raw_geo AS ({raw_locations_sql('order')}),
faulty AS (SELECT *, CAST(ind AS BIGINT) % 97 = 0 AS unreadable,
  CAST(ind AS BIGINT) % 97 <> 0 AND CAST(ind AS BIGINT) % 89 = 0 AS wrong_type FROM raw_geo)"""
ORACLE["faulty_lines_batch"] = ORACLE["faulty_lines_stream"] = f"""{_FAULTY},
kept AS (SELECT country, ind, CASE WHEN wrong_type THEN NULL ELSE latitude END AS latitude, longitude, "timestamp"
  FROM faulty WHERE NOT unreadable)
{CLEAN_LOCATIONS} FROM kept"""
ORACLE["faulty_rejects_batch"] = ORACLE["faulty_rejects_stream"] = _FAULTY + """
SELECT 'geo' AS entity, CASE WHEN unreadable THEN 'unreadable' ELSE 'wrong type' END AS reason,
  CASE WHEN unreadable THEN 'broken ' || ind ELSE '{"country":"' || country || '","ind":"' || ind
    || '","latitude":"north","longitude":' || CAST(longitude AS VARCHAR) || ',"timestamp":"' || "timestamp" || '"}' END AS payload
FROM faulty WHERE unreadable OR wrong_type"""
ORACLE["streamed_top_user_by_country"] = _answer_rows(["top_user_by_country", "median_followers_by_age_group"], ORACLE)
ORACLE["streamed_latest_posts"] = ORACLE["streamed_top_user_by_country"]
ORACLE["stream_distinct_posts"] = ORACLE["clean_posts"]
ORACLE["compacted_topic_posts"] = ORACLE["clean_posts"]

ORACLE["category_counts_latest_only"] = f"""WITH {entities_sql('customer')},
g AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ind
        ORDER BY "timestamp" DESC NULLS LAST, country ASC NULLS LAST) AS rn FROM geo) WHERE rn = 1),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ind
        ORDER BY follower_count DESC NULLS LAST, unique_id ASC NULLS LAST) AS rn FROM pin) WHERE rn = 1)
SELECT country, category, count(*) AS category_count FROM g JOIN p ON g.ind = p.ind GROUP BY 1, 2"""
ORACLE["distinct_posts"] = _raw(
    'SELECT DISTINCT "index", category, poster_name FROM raw_pin', family="customer")
ORACLE["batch_from_topics"] = _answer_rows(_REPORTED, _DAILY)
ORACLE["incremental_from_topics"] = ORACLE["batch_from_topics"]
ORACLE["stream_binary_envelope"] = ORACLE["clean_users"]
