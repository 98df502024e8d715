"""Streaming: the batch and stream chains agree; restarts neither lose nor repeat rows."""

import pytest

from postlytics.operators import clean_posts
from postlytics.schemas import POST_RAW
from postlytics.session import fresh_dir
from postlytics.sources import encode_messages, land_topics, raw_posts, read_topic, topic_path
from postlytics.streaming import append_stream, clean_stream, read_messages_stream

from .conftest import SMALL, rows

NOW = {"availableNow": True}


def _run(spark, base, table, checkpoint):
    stream = read_messages_stream(spark, "text", topic_path(base, "pin"))
    q = append_stream(clean_stream(stream, "pin"), path=table, checkpoint=checkpoint, trigger=NOW)
    q.awaitTermination()
    return spark.read.parquet(table)


def test_batch_equals_stream_and_restart(spark):
    base = fresh_dir(spark, "test-stream")
    raw = raw_posts(spark, SMALL)
    first, second = raw.filter("title is null or length(title) % 2 = 0"), raw.filter("length(title) % 2 = 1")
    land_topics(encode_messages(first, topic="pin", key="index"), base, partitions=2)
    table, ckpt = f"{base}/table", f"{base}/ckpt"
    got = _run(spark, base, table, ckpt)
    assert sorted(rows(got), key=str) == sorted(rows(clean_posts(first)), key=str)
    # same checkpoint again: nothing new, nothing repeated
    assert _run(spark, base, table, ckpt).count() == got.count()
    # new input with the same checkpoint: only the new rows are added
    land_topics(encode_messages(second, topic="pin", key="index"), base, partitions=2)
    again = _run(spark, base, table, ckpt)
    assert sorted(rows(again), key=str) == sorted(rows(clean_posts(raw)), key=str)
    # batch read of the landed topic gives the same cleaned rows
    batch = clean_posts(read_topic(spark, base, "pin", POST_RAW))
    assert sorted(rows(batch), key=str) == sorted(rows(again), key=str)
    # a fresh checkpoint on a table that already has output is refused
    with pytest.raises(ValueError):
        _run(spark, base, table, f"{base}/other-ckpt")


def test_append_stream_requires_checkpoint(spark):
    stream = read_messages_stream(spark, "rate")
    with pytest.raises(ValueError):
        append_stream(clean_stream(stream, "pin"), path="/tmp/x", checkpoint=None)


def test_rejects_are_routed(spark):
    from postlytics.streaming import run_entity_streams
    base = fresh_dir(spark, "test-rejects")
    inbox = f"{base}/in"
    lines = ['{"country":"Peru","ind":"1","latitude":1.5,"longitude":2.0,"timestamp":"2020-01-01 00:00:00"}',
             "{bad", '{"country":"Chile","ind":"2","latitude":"x"}']
    spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.text(inbox)
    stream = read_messages_stream(spark, "text", inbox)
    queries = run_entity_streams(spark, {"geo": stream}, f"{base}/tables", trigger=NOW)
    for q in queries.values():
        q.awaitTermination()
    good = spark.read.parquet(f"{base}/tables/geo").collect()
    bad = spark.read.parquet(f"{base}/tables/_rejects/geo").collect()
    assert sorted((r.country, r.coordinates) for r in good) == [("Chile", [None, None]), ("Peru", [1.5, 2.0])]
    assert sorted((r.reason, r.payload) for r in bad) == [("unreadable", "{bad"), ("wrong type", lines[2])]


def test_report_matches_single_questions(spark):
    from postlytics import plans
    from postlytics.catalog import QUERIES, entities
    from postlytics.catalog.queries import JOIN_YEARS, POST_YEARS
    pins, geo, users = entities(spark, SMALL, "customer")
    answers = plans.answer_questions(pins, geo, users, POST_YEARS, JOIN_YEARS, method="exact")
    for name in ["top_user_by_country", "top_country_by_followers", "top_category_by_age_group",
                 "median_followers_by_age_group", "users_joined_by_year",
                 "median_followers_by_year_joined", "median_followers_by_year_and_age"]:
        assert sorted(rows(answers[name]), key=str) == sorted(rows(QUERIES[name](spark, SMALL)), key=str), name


def test_continuous_trigger(spark):
    """T5: a processing-time trigger keeps running; new files are picked up until stopped."""
    base = fresh_dir(spark, "test-continuous")
    raw = raw_posts(spark, SMALL)
    land_topics(encode_messages(raw.limit(10), topic="pin", key="index"), base)
    stream = read_messages_stream(spark, "text", topic_path(base, "pin"))
    q = append_stream(clean_stream(stream, "pin"), path=f"{base}/table", checkpoint=f"{base}/ckpt",
                      trigger={"processingTime": "1 second"})
    try:
        q.processAllAvailable()
        land_topics(encode_messages(raw.limit(10).withColumn("index", raw["index"] + 100000),
                                    topic="pin", key="index"), base)
        q.processAllAvailable()
        assert q.isActive
    finally:
        q.stop()
    assert spark.read.parquet(f"{base}/table").count() == 20


def test_run_batch_load_profile(spark):
    from postlytics import plans
    from postlytics.sources import raw_entities
    base = fresh_dir(spark, "test-daily")
    for entity, raw in raw_entities(spark, SMALL, "customer").items():
        land_topics(encode_messages(raw, topic=entity, key="ind" if entity != "pin" else "index"), base)
    paths = plans.run_batch(spark, base, f"{base}/answers", layout="hive", method="exact")
    profile = {r.entity: (r.rows, r.rows_without_key) for r in spark.read.parquet(paths["_load_profile"]).collect()}
    expect = {e: (df.count(), 0) for e, df in raw_entities(spark, SMALL, "customer").items()}
    assert profile == expect
    assert set(paths) >= {"top_category_by_country", "median_followers_by_year_and_age"}


def test_append_to_catalog_table(spark):
    """The stream appends to a catalog table (toTable)."""
    import uuid
    base = fresh_dir(spark, "test-table")
    raw = raw_posts(spark, SMALL)
    land_topics(encode_messages(raw, topic="pin", key="index"), base)
    name = f"pins_{uuid.uuid4().hex[:10]}"
    stream = read_messages_stream(spark, "text", topic_path(base, "pin"))
    q = append_stream(clean_stream(stream, "pin"), table=name, checkpoint=f"{base}/ckpt", trigger=NOW)
    q.awaitTermination()
    assert sorted(rows(spark.table(name)), key=str) == sorted(rows(clean_posts(raw)), key=str)


def test_batch_command_line(spark, capsys):
    from postlytics.plans.report import main
    from postlytics.sources import raw_entities
    base = fresh_dir(spark, "test-cli")
    keys = {"pin": "index", "geo": "ind", "user": "ind"}
    for entity, raw in raw_entities(spark, SMALL, "customer").items():
        land_topics(encode_messages(raw, topic=f"app.{entity}", key=keys[entity]), base)
    main(["--topics", base, "--out", f"{base}/answers", "--layout", "hive",
          "--pin-topic", "app.pin", "--geo-topic", "app.geo", "--user-topic", "app.user",
          "--post-years", "1996-2000", "--median", "exact"])
    printed = dict(line.split("\t") for line in capsys.readouterr().out.strip().splitlines())
    assert len(printed) == 13  # nine answers, the load profile and three reject tables
    assert spark.read.parquet(printed["top_category_by_year"]).count() == 5
    assert spark.read.parquet(printed["users_joined_by_year"]).count() == 6
