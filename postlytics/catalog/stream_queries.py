"""Registered queries for landing, file reads and streaming appends.

Each call works in a new folder under the session's shared checkpoint folder
(``spark.checkpoint.dir``), lands the raw entities there as JSON messages,
runs the flow and reads the result back as a DataFrame.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.clean import clean_locations, clean_posts, clean_users
from ..schemas import LOCATION_RAW, POST_RAW, USER_RAW
from ..session import fresh_dir
from ..sources.bindings import raw_entities, raw_posts, raw_users
from ..sources.messages import encode_messages, land_topics
from ..sources.topics import (compact_topic, read_delimited, read_landed, read_topic, select_topics, topic_path,
                              topic_rejects, write_delimited)
from ..streaming.landing import land_stream
from ..streaming.sinks import append_stream, clean_stream, read_messages_stream
from ..streaming.state import BEST_POST, LATEST_LOCATION, distinct_messages, read_best_per_key, run_best_per_key
from ..streaming.tables import read_entity_table, run_entity_tables

KEYS = {"pin": "index", "geo": "ind", "user": "ind"}
SHARDS = 4


WAIT_SECONDS = 1800


def _land(raw, base, entity):
    land_topics(encode_messages(raw, topic=entity, key=KEYS[entity]), base, partitions=SHARDS, hash="md5")


def _finish(queries):
    """Wait for catch-up queries, but not forever."""
    for name, query in queries.items():
        if not query.awaitTermination(WAIT_SECONDS):
            query.stop()
            raise TimeoutError(f"stream {name} did not finish in {WAIT_SECONDS} s")


def _answer_rows(answers):
    """All answers as (question, c1, c2, c3) text rows."""
    parts = None
    for name, df in answers.items():
        cells = [F.col(c).cast("string") for c in df.columns] + [F.lit(None).cast("string")] * (3 - len(df.columns))
        part = df.select(F.lit(name).alias("question"), *[c.alias(f"c{i + 1}") for i, c in enumerate(cells)])
        parts = part if parts is None else parts.unionByName(part)
    return parts


def _stream_clean(entity):
    def run(spark, root):
        base = fresh_dir(spark, f"stream-{entity}")
        _land(raw_entities(spark, root, "order")[entity], base, entity)
        messages = read_messages_stream(spark, "text", topic_path(base, entity),
                                        options={"maxFilesPerTrigger": "16"})
        _finish(run_entity_tables(spark, {entity: messages}, f"{base}/tables", trigger={"availableNow": True}))
        return read_entity_table(spark, f"{base}/tables", entity)
    return run


def streamed_top_user_by_country(spark, root):
    """The three entity streams run concurrently (K2) into tables; Q3 is then
    answered over the streamed tables."""
    from .. import plans
    base = fresh_dir(spark, "streamed-questions")
    raw = raw_entities(spark, root, "customer")
    for entity in raw:
        _land(raw[entity], base, entity)
    sources = {entity: read_messages_stream(spark, "text", topic_path(base, entity)) for entity in raw}
    _finish(run_entity_tables(spark, sources, f"{base}/tables", trigger={"availableNow": True}))
    tables = {entity: read_entity_table(spark, f"{base}/tables", entity) for entity in raw}
    return _answer_rows({"top_user_by_country": plans.top_user_by_country(tables["pin"], tables["geo"]),
                         "median_followers_by_age_group": plans.median_followers_by_age_group(
                             tables["pin"], tables["geo"], tables["user"])})


def stream_to_catalog_table(spark, root):
    """The user stream appended to a table of the catalog."""
    base = fresh_dir(spark, "stream-table")
    _land(raw_users(spark, root), base, "user")
    name = f"streamed_users_{base[-12:]}"
    messages = read_messages_stream(spark, "text", topic_path(base, "user"))
    _finish({name: append_stream(clean_stream(messages, "user"), table=name, checkpoint=f"{base}/checkpoint",
                                 trigger={"availableNow": True})})
    return spark.table(name)


def stream_processing_time(spark, root):
    """T5: a continuously triggered stream, stopped once it has read what is there."""
    base = fresh_dir(spark, "stream-continuous")
    _land(raw_users(spark, root), base, "user")
    messages = read_messages_stream(spark, "text", topic_path(base, "user"))
    query = append_stream(clean_stream(messages, "user"), path=f"{base}/table", checkpoint=f"{base}/checkpoint",
                          trigger={"processingTime": "1 second"})
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return spark.read.parquet(f"{base}/table")


def _faulty_locations(spark, root):
    """Location messages of which some are no JSON and some have text for a latitude."""
    messages = encode_messages(raw_entities(spark, root, "order")["geo"], topic="geo", key="ind")
    key = F.col("key").cast("bigint")
    return messages.withColumn("value", F.when(key % 97 == 0, F.concat(F.lit("broken "), F.col("key")))
                               .when(key % 89 == 0, F.regexp_replace("value", '"latitude":[^,]*', '"latitude":"north"'))
                               .otherwise(F.col("value")))


def _faulty(streamed, rejects):
    def run(spark, root):
        base = fresh_dir(spark, "faulty")
        land_topics(_faulty_locations(spark, root), base, partitions=SHARDS)
        if not streamed:
            if rejects:
                return topic_rejects(spark, base, "geo", LOCATION_RAW)
            return clean_locations(read_topic(spark, base, "geo", LOCATION_RAW))
        source = read_messages_stream(spark, "text", topic_path(base, "geo"))
        _finish(run_entity_tables(spark, {"geo": source}, f"{base}/tables", trigger={"availableNow": True}))
        return read_entity_table(spark, f"{base}/tables", "geo", "rejects" if rejects else "clean")
    return run


def stream_binary_envelope(spark, root):
    """Messages in the stream envelope (a binary ``data`` field holding JSON,
    plus stream name and partition key) read as a stream, decoded and cleaned."""
    base = fresh_dir(spark, "envelope")
    messages = encode_messages(raw_users(spark, root), topic="user", key="ind")
    (messages.select(F.col("topic").alias("stream_name"), F.col("key").alias("partition_key"),
                     F.col("value").cast("binary").alias("data"))
     .write.parquet(f"{base}/in"))
    envelopes = read_messages_stream(spark, "parquet", f"{base}/in",
                                     schema=spark.read.parquet(f"{base}/in").schema)
    _finish(run_entity_tables(spark, {"user": envelopes}, f"{base}/tables", trigger={"availableNow": True}, payload="data"))
    return read_entity_table(spark, f"{base}/tables", "user")


def _landed_keys(spark, base):
    messages = select_topics(read_landed(spark, base), r"^(pin|geo|user)$")
    key = F.coalesce(F.get_json_object("value", "$.ind"), F.get_json_object("value", "$.index"))
    return messages.select("topic", key.alias("key"), F.col("partition").cast("int").alias("partition"))


def landed_topics(spark, root):
    base = fresh_dir(spark, "landed")
    for entity, raw in raw_entities(spark, root, "order").items():
        _land(raw, base, entity)
    return _landed_keys(spark, base)


def _land_as_stream(spark, root, base):
    """The three entities as one message stream that lands them; the stream is restarted after each entity."""
    for entity, raw in raw_entities(spark, root, "order").items():
        messages = encode_messages(raw, topic=entity, key=KEYS[entity])
        messages.write.mode("append").parquet(f"{base}/in")
        stream = read_messages_stream(spark, "parquet", f"{base}/in", schema=messages.schema)
        _finish({entity: land_stream(stream, f"{base}/landed", f"{base}/checkpoint", partitions=SHARDS, hash="md5",
                                     trigger={"availableNow": True})})
    return f"{base}/landed"


def stream_landed_topics(spark, root):
    """K3 on streams: every message's topic, key and shard folder, read through the stream's commit log."""
    return _landed_keys(spark, _land_as_stream(spark, root, fresh_dir(spark, "stream-landed")))


def stream_landed_posts(spark, root):
    """The posts of a topic that a stream landed, read as a batch topic and cleaned."""
    return clean_posts(read_topic(spark, _land_as_stream(spark, root, fresh_dir(spark, "stream-landed")), "pin", POST_RAW))


def compacted_topic_posts(spark, root):
    """Posts landed as many small files, compacted, then read and cleaned."""
    base = fresh_dir(spark, "compaction")
    messages = encode_messages(raw_posts(spark, root), topic="pin", key="index")
    land_topics(messages.repartition(64), base, partitions=SHARDS)
    compact_topic(spark, base, "pin", f"{base}/compacted")
    return clean_posts(read_topic(spark, f"{base}/compacted", "pin", POST_RAW))


def read_topic_posts(spark, root):
    base = fresh_dir(spark, "topic-read")
    _land(raw_posts(spark, root), base, "pin")
    return clean_posts(read_topic(spark, base, "pin", POST_RAW))


def read_delimited_roundtrip(spark, root):
    """Raw rows with blanks, quotes, separators, line breaks, empty and missing values."""
    path = fresh_dir(spark, "delimited")
    n = F.col("ind").cast("bigint")
    users = raw_users(spark, root).withColumn("last_name", F.when(n % 7 == 0, F.lit("")).when(
        n % 7 == 1, F.concat(F.lit("two\nlines "), F.col("ind"))).when(
        n % 7 == 2, F.concat(F.lit('say "hi" | '), F.col("last_name"), F.lit("  "))).otherwise(F.col("last_name")))
    write_delimited(users, path, sep="|")
    return read_delimited(spark, path, sep="|", schema=USER_RAW)


def batch_report(spark, root):
    """Every question answered by the one-job report and written as tables; returns
    all answers."""
    from .. import plans
    from .queries import JOIN_YEARS, POST_YEARS, entities
    out = fresh_dir(spark, "report")
    pins_o, geo_o, _ = entities(spark, root, "order")
    pins_c, geo_c, users = entities(spark, root, "customer")
    answers = plans.answer_questions(pins_c, geo_c, users, POST_YEARS, JOIN_YEARS, method="exact")
    # the country and year rankings use the one-post-per-order family
    answers["top_category_by_country"] = plans.top_category_by_country(pins_o, geo_o)
    answers["top_category_by_year"] = plans.top_category_by_year(pins_o, geo_o, *POST_YEARS)
    paths = plans.write_answers(answers, out)
    return _answer_rows({name: spark.read.parquet(path) for name, path in paths.items()})


def batch_from_topics(spark, root):
    """The daily run end to end: the customer family landed as topics, then
    read, cleaned, answered and written by ``run_batch``; returns all answers."""
    from .. import plans
    from .queries import JOIN_YEARS, POST_YEARS
    base = fresh_dir(spark, "daily")
    for entity, raw in raw_entities(spark, root, "customer").items():
        _land(raw, base, entity)
    paths = plans.run_batch(spark, base, f"{base}/answers", layout="hive", post_years=POST_YEARS,
                            join_years=JOIN_YEARS, method="exact")
    return _answer_rows({name: spark.read.parquet(path) for name, path in paths.items() if name[0] != "_"})


def incremental_from_topics(spark, root):
    """The daily run three times: over a part of the users' posts, locations and accounts, over the
    rest, and with nothing new; returns all answers of the last run."""
    from .. import plans
    from .queries import JOIN_YEARS, POST_YEARS
    base = fresh_dir(spark, "incremental")
    raw = raw_entities(spark, root, "customer")
    for early in (True, False, None):
        if early is not None:
            for entity, df in raw.items():
                key = F.col(KEYS[entity]).cast("bigint")
                # repeated keys get old and new rows on both sides of the joins
                text = F.col("title") if entity == "pin" else F.col("timestamp") if entity == "geo" else F.col("ind")
                part = F.pmod(F.crc32(F.coalesce(text, F.lit("")).cast("binary")) + key, F.lit(3)) == 0
                _land(df.where(part if early else ~part), base, entity)
        paths = plans.run_incremental(spark, base, f"{base}/daily", layout="hive", post_years=POST_YEARS, join_years=JOIN_YEARS)
    return _answer_rows({name: spark.read.parquet(path) for name, path in paths.items()})


def streamed_latest_posts(spark, root):
    """Q3 and Q6 over tables of each user's newest location and best post that two streams keep up
    to date; late rows come in a second run, with every seventh row once more."""
    from .. import plans
    base = fresh_dir(spark, "stream-latest")
    raw = raw_entities(spark, root, "customer")
    cleaners, orders = {"pin": clean_posts, "geo": clean_locations}, {"pin": BEST_POST, "geo": LATEST_LOCATION}
    best = {}
    for late in (False, True):
        for entity, clean in cleaners.items():
            mark = F.crc32(F.col("unique_id" if entity == "pin" else "timestamp").cast("binary"))
            _land(raw[entity].where((mark % 2 == 0) | (mark % 7 == 0) if late else mark % 2 == 1), base, entity)
            stream = clean_stream(read_messages_stream(spark, "text", topic_path(base, entity)), entity)
            _finish({entity: run_best_per_key(stream, "ind", orders[entity], f"{base}/best/{entity}",
                                              f"{base}/checkpoints/{entity}", {"availableNow": True})})
            best[entity] = read_best_per_key(spark, f"{base}/best/{entity}", "ind", orders[entity], clean(raw[entity]).schema)
    users = clean_users(raw["user"])
    return _answer_rows({"top_user_by_country": plans.top_user_by_country(best["pin"], best["geo"]),
                         "median_followers_by_age_group": plans.median_followers_by_age_group(best["pin"], best["geo"], users)})


def stream_distinct_posts(spark, root):
    """D4 on a stream: the posts' messages land twice, and the stream restarts in between; each is
    appended once."""
    base = fresh_dir(spark, "stream-distinct")
    for _ in range(2):
        _land(raw_posts(spark, root), base, "pin")
        messages = distinct_messages(read_messages_stream(spark, "text", topic_path(base, "pin")))
        _finish({"pin": append_stream(clean_stream(messages, "pin"), path=f"{base}/posts", checkpoint=f"{base}/checkpoint",
                                      trigger={"availableNow": True})})
    return spark.read.parquet(f"{base}/posts")


STREAM_QUERIES = {
    "stream_to_catalog_table": stream_to_catalog_table,
    "stream_processing_time": stream_processing_time,
    "faulty_lines_batch": _faulty(False, False),
    "faulty_lines_stream": _faulty(True, False),
    "faulty_rejects_batch": _faulty(False, True),
    "faulty_rejects_stream": _faulty(True, True),
    "stream_binary_envelope": stream_binary_envelope,
    "batch_from_topics": batch_from_topics,
    "streamed_latest_posts": streamed_latest_posts,
    "stream_distinct_posts": stream_distinct_posts,
    "incremental_from_topics": incremental_from_topics,
    "streamed_top_user_by_country": streamed_top_user_by_country,
    "batch_report": batch_report,
    "stream_clean_posts": _stream_clean("pin"),
    "stream_clean_locations": _stream_clean("geo"),
    "stream_clean_users": _stream_clean("user"),
    "landed_topics": landed_topics,
    "stream_landed_topics": stream_landed_topics,
    "stream_landed_posts": stream_landed_posts,
    "read_topic_posts": read_topic_posts,
    "compacted_topic_posts": compacted_topic_posts,
    "read_delimited_roundtrip": read_delimited_roundtrip,
}
