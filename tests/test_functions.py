"""Golden cases for the column functions and cleaning operators (FIXTURES B1, B2)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from postlytics.functions import age_band, digit_pattern, join_names, parse_count, without_prefix
from postlytics.operators import (clean_locations, clean_posts, clean_users, null_placeholders,
                                  pack_coordinates, parse_timestamp)
from postlytics.schemas import CLEAN_SCHEMAS, LOCATION_RAW, POST_RAW, USER_RAW

COUNTS = [  # text, digits mode, decimal mode
    ("117", 117, 117),
    ("12k", 12000, 12000),
    ("3M", 3000000, 3000000),
    ("1.5k", 15000, 1500),
    ("12K", 12, 12),
    ("99999M", 99999000000, 99999000000),
    ("User Info Error", None, None),
    ("", None, None),
    (None, None, None),
    ("k", None, None),
]


def test_parse_count_modes(spark):
    df = spark.createDataFrame([(t,) for t, _, _ in COUNTS], "t string")
    got = df.select(parse_count("t", mode="digits").alias("d"),
                    parse_count("t", mode="decimal").alias("m")).collect()
    assert [(r.d, r.m) for r in got] == [(d, m) for _, d, m in COUNTS]


def test_parse_count_overflow_is_null(spark):
    df = spark.createDataFrame([("9999999999999999M",), ("99999999999999999999",)], "t string")
    assert [r[0] for r in df.select(parse_count("t")).collect()] == [None, None]


def test_parse_count_bad_mode(spark):
    with pytest.raises(ValueError):
        parse_count("t", mode="roman")


def test_null_placeholders(spark):
    df = spark.createDataFrame([("", float("nan"), "NaN"), ("a", 1.0, "x")], "s string, d double, t string")
    assert [tuple(r) for r in null_placeholders(df).collect()] == [(None, None, "NaN"), ("a", 1.0, "x")]
    given = null_placeholders(df, values=("", "NaN"))
    assert given.collect()[0].t is None


def test_prefix_patterns_names_ages(spark):
    df = spark.createDataFrame(
        [("Local save in /data/art", "12k", "2019-03"), ("/data/art", "117", "x"),
         ("x Local save in y", "3M", None)], "p string, c string, ts string")
    out = df.select(without_prefix("p", "Local save in ").alias("p"),
                    digit_pattern("c").alias("c"), digit_pattern("ts", False).alias("ts")).collect()
    assert [r.p for r in out] == ["/data/art", "/data/art", "x Local save in y"]
    assert [r.c for r in out] == ["9k", "9", "9M"]
    assert out[0].ts == "9999-99"

    names = spark.createDataFrame([(" Ana ", "Maria  Ruiz"), (None, "Ruiz"), (None, None)], "f string, l string")
    assert [r[0] for r in names.select(join_names("f", "l")).collect()] == ["Ana Maria Ruiz", "Ruiz", ""]

    ages = [17, 18, 24, 25, 35, 36, 50, 51, None]
    got = spark.createDataFrame([(a,) for a in ages], "a int").select(age_band("a")).collect()
    assert [r[0] for r in got] == ["Unknown", "18-24", "18-24", "25-35", "25-35", "36-50", "36-50",
                                   "+50", "Unknown"]


def test_coordinates_and_timestamps(spark):
    df = spark.createDataFrame([(1.5, -2.0, "2019-03-04 05:06:07"), (None, -2.0, "xx")],
                               "latitude double, longitude double, timestamp string")
    out = parse_timestamp(pack_coordinates(df), "timestamp").collect()
    assert list(out[0].coordinates) == [1.5, -2.0]
    assert list(out[1].coordinates) == [None, -2.0]
    assert out[0].timestamp == dt.datetime(2019, 3, 4, 5, 6, 7)
    assert out[1].timestamp is None


def _same_types(df, schema):
    return [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in schema.fields]


def test_clean_chains_contract(spark):
    pin = spark.createDataFrame([
        ("art", "d", "1", "12k", "src", "7", "image", "Ana", "Local save in /a", "t1,t2", "", "u1"),
    ], POST_RAW)
    geo = spark.createDataFrame([("Peru", "7", 1.0, float("nan"), "2020-01-02 03:04:05")], LOCATION_RAW)
    user = spark.createDataFrame([("33", "2016-05-06 07:08:09", " Ana", "7", " Ruiz ")], USER_RAW)
    p, g, u = clean_posts(pin), clean_locations(geo), clean_users(user)
    assert _same_types(p, CLEAN_SCHEMAS["pin"])
    assert _same_types(g, CLEAN_SCHEMAS["geo"])
    assert _same_types(u, CLEAN_SCHEMAS["user"])
    prow, grow, urow = p.first(), g.first(), u.first()
    assert (prow.ind, prow.follower_count, prow.save_location, prow.title) == (7, 12000, "/a", None)
    assert grow.coordinates[0] == 1.0 and math.isnan(grow.coordinates[1])
    assert (urow.user_name, urow.age, urow.date_joined) == ("Ana Ruiz", 33, dt.datetime(2016, 5, 6, 7, 8, 9))


def test_clean_chains_bad_text_does_not_fail(spark):
    user = spark.createDataFrame([("abc", "n/a", None, "x1", None)], USER_RAW)
    row = clean_users(user).first()
    assert (row.ind, row.age, row.date_joined, row.user_name) == (None, None, None, "")


def test_null_placeholders_quotes_and_backslashes(spark):
    odd = ["it's", "a\\b", "we`ird"]
    df = spark.createDataFrame([(v, v) for v in odd] + [("keep", "keep")], "`we``ird col` string, s string")
    out = null_placeholders(df, values=odd).collect()
    assert [tuple(r) for r in out] == [(None, None)] * 3 + [("keep", "keep")]


def test_timestamp_parsing_default_and_strict(spark):
    from postlytics.functions import to_ts
    texts = ["2019-03-04 05:06:07", "2019-03-04", "n/a", "12:34", "T01:02", "2019-03-04 05:06:07+05:00",
             "2019-02-30 05:06:07", "2019-03-04T05:06:07", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = df.select("i", to_ts("s").alias("strict"), to_ts("s", None).alias("cast"),
                    to_ts("s", "yyyy-MM-dd").alias("day")).orderBy("i").collect()
    assert [r.strict for r in got] == [dt.datetime(2019, 3, 4, 5, 6, 7)] + [None] * 8
    assert got[1].cast == got[1].day == dt.datetime(2019, 3, 4)
