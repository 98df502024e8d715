"""Raw post, location and user records derived from the driver's tables.

The driver's tables hold orders, customers and nations, not social posts, so
these views restate them in the three raw message shapes (all text, the
stream typing). Every value comes from integer arithmetic on keys and from
the tables' own columns, so a SQL engine can rebuild the same rows exactly.

Two families:

* ``key='order'``: one post and one location per order (``ind`` = order key),
  a one-to-one join, used by the country and year rankings.
* ``key='customer'``: ``ind`` = customer key, posts are the customer's
  orders, so users post repeatedly. Users are the customers and, under negative
  keys, the suppliers, who never post (left join of users, Q6-Q9).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the binding (shared with the oracle SQL).
COUNT_STYLES = 5          # follower_count text style by o_orderkey % 5
MILLIONS_MOD = 9973       # <n>M counts use o_orderkey % 9973
SECONDS_PER_DAY = 86400   # post time = order date + o_orderkey % 86400 seconds


# Column types of the driver tables we read. With a schema given
# up front the reader skips the footer-inference job it would otherwise run.
TABLE_SCHEMAS: dict[str, str] = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
              "props string",
    "pages": "page_id bigint, url string, html string",
}


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One driver table: ``<root>/<name>.parquet`` (declared schema when known)."""
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{root.rstrip('/')}/{name}.parquet")


def _orders(spark: SparkSession, root: str, key: str) -> DataFrame:
    if key not in ("order", "customer"):
        raise ValueError("key must be 'order' or 'customer'")
    return read_table(spark, root, "orders")


def _ind(key: str) -> str:
    return f"CAST({'o_orderkey' if key == 'order' else 'o_custkey'} AS STRING)"


# Expressions are SQL text: one parse per column instead of one driver call
# per expression node.
_POST_TIME = ("date_format(timestampadd(SECOND, o_orderkey % {sec}, o_orderdate), "
              "'yyyy-MM-dd HH:mm:ss')").format(sec=SECONDS_PER_DAY)

_FOLLOWERS = f"""CASE o_orderkey % {COUNT_STYLES}
    WHEN 0 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING)
    WHEN 1 THEN concat(CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS STRING), '.',
                       CAST(CAST(floor(o_totalprice / 100) AS BIGINT) % 10 AS STRING), 'k')
    WHEN 2 THEN concat(CAST(o_orderkey % {MILLIONS_MOD} AS STRING), 'M')
    WHEN 3 THEN 'User Info Error'
    ELSE '' END"""


def raw_posts(spark: SparkSession, root: str, key: str = "order") -> DataFrame:
    """Post records: one per order, keyed by the order or by its customer."""
    orders = _orders(spark, root, key).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    customers = read_table(spark, root, "customer").select("c_custkey", "c_name")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.selectExpr(
        "o_orderpriority AS category",
        "concat(o_orderpriority, ' order for ', c_name) AS description",
        "CAST(o_orderkey % 2 AS STRING) AS downloaded",
        f"{_FOLLOWERS} AS follower_count",
        "concat('img/', CAST(o_orderkey AS STRING), '.jpg') AS image_src",
        f"{_ind(key)} AS index",
        "CASE WHEN o_orderkey % 3 = 0 THEN 'video' ELSE 'image' END AS is_image_or_video",
        "c_name AS poster_name",
        "concat('Local save in /data/', o_orderpriority) AS save_location",
        "concat(o_orderstatus, ',', o_orderpriority) AS tag_list",
        "CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE concat('Order ', CAST(o_orderkey AS STRING)) END AS title",
        "concat('pin-', CAST(o_orderkey AS STRING)) AS unique_id",
    )


def raw_locations(spark: SparkSession, root: str, key: str = "order") -> DataFrame:
    """Location records: country of the ordering customer, time of the order."""
    orders = _orders(spark, root, key).select("o_orderkey", "o_custkey", "o_orderdate")
    customers = read_table(spark, root, "customer").select("c_custkey", "c_nationkey")
    nations = read_table(spark, root, "nation").select("n_nationkey", "n_name")
    joined = (orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
              .join(nations, F.col("c_nationkey") == F.col("n_nationkey")))
    return joined.selectExpr(
        "n_name AS country",
        f"{_ind(key)} AS ind",
        "CAST(o_custkey % 180 - 90 AS DOUBLE) AS latitude",
        "CAST(o_custkey % 360 - 180 AS DOUBLE) AS longitude",
        f"{_POST_TIME} AS timestamp",
    )


def raw_users(spark: SparkSession, root: str) -> DataFrame:
    """User records, one per customer (``ind`` = key) and per supplier (``ind`` = -1 - key,
    without posts): split names with extra blanks, some missing first names and ages,
    a few malformed join dates."""
    people = read_table(spark, root, "customer").selectExpr("c_custkey AS ind", "c_custkey AS n", "c_name AS name")
    people = people.unionAll(read_table(spark, root, "supplier").selectExpr(
        "-1 - s_suppkey AS ind", "s_suppkey AS n", "s_name AS name"))
    return people.selectExpr(
        "CASE WHEN n % 17 = 0 THEN NULL ELSE CAST(15 + n % 50 AS STRING) END AS age",
        "CASE WHEN n % 101 = 0 THEN 'n/a' ELSE format_string('%04d-%02d-%02d %02d:%02d:%02d', "
        "2014 + n % 8, 1 + n % 12, 1 + n % 28, n % 24, n % 60, (n * 7) % 60) END AS date_joined",
        "CASE WHEN n % 13 = 0 THEN NULL ELSE concat(' ', split_part(name, '#', 1), '  ') END AS first_name",
        "CAST(ind AS STRING) AS ind",
        "concat('No.   ', split_part(name, '#', 2)) AS last_name",
    )


def raw_entities(spark: SparkSession, root: str, key: str = "order") -> dict[str, DataFrame]:
    """The three raw entities of one family, keyed like :data:`postlytics.schemas.SCHEMAS`."""
    return {"pin": raw_posts(spark, root, key), "geo": raw_locations(spark, root, key),
            "user": raw_users(spark, root)}
