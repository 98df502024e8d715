"""Message encoding/decoding, shards, landing and aligned samples."""

import datetime as dt

from pyspark.sql import functions as F

from postlytics.schemas import LOCATION_RAW, USER_CLEAN
from postlytics.session import fresh_dir
from postlytics.sources import (BAD_COL, assign_shard, decode_messages, encode_messages, land_topics, reject_messages,
                                read_landed, read_topic, sample_aligned, select_topics)

from .conftest import rows


def test_encode_decode_identity(spark):
    df = spark.createDataFrame([(1, "Ana Ruiz", 30, dt.datetime(2016, 5, 6, 7, 8, 9)),
                                (2, "Bo", None, None)], USER_CLEAN)
    msgs = encode_messages(df, topic="user", key="ind")
    first = msgs.first()
    assert first.topic == "user" and first.key == "1"
    assert '"date_joined":"2016-05-06 07:08:09"' in first.value
    assert '"age":null' in msgs.collect()[1].value
    assert rows(decode_messages(msgs, USER_CLEAN)) == rows(df)


def test_bad_payloads(spark):
    data = [('{"country":"Peru","ind":"1","latitude":1.5,"longitude":2.0,"timestamp":"t"}',),
            ("{bad",), (None,), ('{"country":"Chile","ind":"2","latitude":"x"}',)]
    df = spark.createDataFrame(data, "data string").select(F.col("data").cast("binary").alias("data"))
    assert [r.country for r in decode_messages(df, LOCATION_RAW, payload="data", on_bad="drop").collect()] == ["Peru"]
    flagged = decode_messages(df, LOCATION_RAW, payload="data", on_bad="flag").collect()
    assert [r[BAD_COL] for r in flagged] == [None, "unreadable", "unreadable", "wrong type"]
    kept = decode_messages(df, LOCATION_RAW, payload="data").collect()  # nothing is lost by default
    assert len(kept) == 4 and kept[3].country == "Chile" and kept[3].latitude is None
    readable = decode_messages(df, LOCATION_RAW, payload="data", on_bad="readable").collect()
    assert [(r.country, r.latitude) for r in readable] == [("Peru", 1.5), ("Chile", None)]


def test_one_wrong_field_does_not_lose_the_record(spark):
    df = spark.createDataFrame([('{"latitude":"1.5"}',), ("[1]",), ("7",), ('{"latitude":',)], "value string")
    assert rows(decode_messages(df, LOCATION_RAW, on_bad="readable")) == [(None,) * 5]
    rejects = reject_messages(df, LOCATION_RAW, entity="geo").collect()
    assert sorted((r.reason, r.payload) for r in rejects) == [
        ("unreadable", "7"), ("unreadable", "[1]"), ("unreadable", '{"latitude":'), ("wrong type", '{"latitude":"1.5"}')]


def test_landed_folder_is_the_assigned_shard(spark):
    base = fresh_dir(spark, "test-shards")
    keys = spark.range(1000).select(F.col("id").cast("string").alias("ind"))
    land_topics(encode_messages(keys, topic="t", key="ind"), base, partitions=4)
    landed = {r.k: r.partition for r in read_landed(spark, base).select(
        F.get_json_object("value", "$.ind").alias("k"), "partition").collect()}
    assert landed == {r.ind: r.shard for r in assign_shard(keys, "ind", 4).collect()}


def test_delimited_round_trip_keeps_raw_rows(spark):
    from postlytics.sources import read_delimited, write_delimited
    path = fresh_dir(spark, "test-delimited")
    data = [(1, "a\nb", "y"), (2, "  Ana  ", ""), (3, "", None), (4, 'say "hi"', "x|y"), (5, None, " ")]
    df = spark.createDataFrame(data, "n int, s string, t string")
    write_delimited(df, path, sep="|")
    assert sorted(rows(read_delimited(spark, path, sep="|", schema=df.schema))) == data


def test_shards_are_deterministic(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = assign_shard(df, "k", 4).collect()
    b = assign_shard(df, "k", 4).collect()
    assert a == b and {r.shard for r in a} == {0, 1, 2, 3}


def test_land_and_read_topics(spark):
    base = fresh_dir(spark, "test-landing")
    geo = spark.createDataFrame([("Peru", str(i), 1.0, 2.0, "2020-01-01 00:00:00") for i in range(20)],
                                LOCATION_RAW)
    land_topics(encode_messages(geo, topic="app.geo", key="ind"), base, partitions=3)
    land_topics(encode_messages(geo.limit(5), topic="other.geo", key="ind"), base)
    back = read_topic(spark, base, "app.geo", LOCATION_RAW)
    assert sorted(rows(back)) == sorted(rows(geo))
    counts = select_topics(read_landed(spark, base), r"^app\.").groupBy("topic").count()
    assert rows(counts) == [("app.geo", 20)]


def test_sample_aligned_keeps_same_keys(spark):
    a = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    b = spark.range(0, 2000, 2).select(F.col("id").alias("key"))
    out = sample_aligned({"a": a, "b": b}, {"a": "k", "b": "key"}, 0.3, seed=3)
    ka = {int(r.k) for r in out["a"].collect()}
    kb = {r.key for r in out["b"].collect()}
    assert 450 < len(ka) < 750
    assert kb == {k for k in ka if k % 2 == 0}


def test_connector_layout_and_compaction(spark):
    import json
    import os
    from postlytics.sources import compact_topic
    base = fresh_dir(spark, "test-connector")
    # the reference's sink layout: topics/<topic>/partition=<p>/<one record>.json
    if base.startswith("file:"):
        base = base[5:]
    for p in range(2):
        folder = f"{base}/topics/app.geo/partition={p}"
        os.makedirs(folder, exist_ok=True)
        for i in range(3):
            rec = {"country": "Peru", "ind": str(p * 10 + i), "latitude": 1.0, "longitude": 2.0,
                   "timestamp": "2020-01-01 00:00:00"}
            with open(f"{folder}/{i}.json", "w") as fh:
                fh.write(json.dumps(rec))
    back = read_topic(spark, base, "app.geo", LOCATION_RAW, layout="connector")
    assert sorted(int(r.ind) for r in back.collect()) == [0, 1, 2, 10, 11, 12]
    out = compact_topic(spark, base, "app.geo", f"{base}/compacted", layout="connector")
    again = read_topic(spark, f"{base}/compacted", "app.geo", LOCATION_RAW)
    assert sorted(rows(again)) == sorted(rows(back))
    assert out.endswith("topics/topic=app.geo")


def test_inferred_schema_topics_clean_to_contract(spark):
    """S1 without a schema (the reference's batch read): JSON numbers come in as
    bigint, yet the cleaning chains give the same typed contract."""
    import json
    from postlytics.operators import clean_posts, clean_users
    from postlytics.schemas import CLEAN_SCHEMAS
    base = fresh_dir(spark, "test-inferred")
    pins = [{"index": 7, "unique_id": "u", "title": "", "description": "d", "follower_count": "12k",
             "poster_name": "Ana", "tag_list": "t", "is_image_or_video": "image", "image_src": "s",
             "save_location": "Local save in /x", "category": "art", "downloaded": 1}]
    users = [{"ind": 7, "first_name": "Ana", "last_name": "Ruiz", "age": 33,
              "date_joined": "2016-05-06 07:08:09"}]
    for topic, recs in (("pin", pins), ("user", users)):
        msgs = spark.createDataFrame([(topic, None, json.dumps(r)) for r in recs], "topic string, key string, value string")
        land_topics(msgs, base)
    p = clean_posts(read_topic(spark, base, "pin"))
    u = clean_users(read_topic(spark, base, "user"))
    assert [(f.name, f.dataType) for f in p.schema.fields] == [(f.name, f.dataType) for f in CLEAN_SCHEMAS["pin"].fields]
    assert [(f.name, f.dataType) for f in u.schema.fields] == [(f.name, f.dataType) for f in CLEAN_SCHEMAS["user"].fields]
    assert (p.first().ind, p.first().follower_count, p.first().title) == (7, 12000, None)
    assert (u.first().ind, u.first().age, u.first().user_name) == (7, 33, "Ana Ruiz")


def test_readme_quick_start_calls(spark):
    """The README's batch quick start, run on topics landed in the connector layout."""
    from postlytics import plans
    from postlytics.operators import clean_locations, clean_posts, clean_users
    from postlytics.schemas import SCHEMAS
    from postlytics.sources import raw_entities
    from .conftest import SMALL
    base = fresh_dir(spark, "test-quickstart")
    keys = {"pin": "index", "geo": "ind", "user": "ind"}
    # the reference's layout: topics/<topic>/partition=<n>/ with JSON records
    for e, df in raw_entities(spark, SMALL, "customer").items():
        (encode_messages(df, topic=f"app.{e}", key=keys[e])
         .select("value", (F.pmod(F.xxhash64("key"), F.lit(2))).alias("partition"))
         .write.partitionBy("partition").text(f"{base}/conn/topics/app.{e}"))
    raw = {e: read_topic(spark, f"{base}/conn", f"app.{e}", SCHEMAS[e], layout="connector") for e in keys}
    pins, geo, users = clean_posts(raw["pin"]), clean_locations(raw["geo"]), clean_users(raw["user"])
    assert plans.top_category_by_country(pins, geo).count() == 25
    assert plans.top_country_by_followers(pins, geo).count() >= 1
    assert plans.median_followers_by_age_group(pins, geo, users, method="approx").count() == 5
