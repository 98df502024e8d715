"""Stream landing (K3) and entity tables from one parse (K1, K2, S6): restarts, killed and repeated batches."""

import pytest
from pyspark.sql import functions as F

from postlytics.operators import clean_locations, clean_posts
from postlytics.schemas import LOCATION_RAW, POST_RAW
from postlytics.session import fresh_dir, hadoop_path, path_exists
from postlytics.sources import (encode_messages, land_topics, raw_entities, raw_posts, read_landed, read_topic, topic_path,
                                topic_rejects)
from postlytics.streaming import (append_stream, clean_stream, land_stream, read_entity_table, read_landed_stream,
                                  read_messages_stream, run_entity_tables, tables)

from .conftest import SMALL, rows

NOW = {"availableNow": True}


def messages_of(spark):
    raw = raw_entities(spark, SMALL, "order")
    parts = [encode_messages(raw[e], topic=f"app.{e}", key="index" if e == "pin" else "ind") for e in raw]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def inbox(spark, base, messages):
    messages.write.mode("append").parquet(f"{base}/in")
    return read_messages_stream(spark, "parquet", f"{base}/in", {"maxFilesPerTrigger": "1"}, messages.schema)


def ordered(df):
    return sorted(rows(df), key=str)


def land(spark, base, messages):
    query = land_stream(inbox(spark, base, messages), f"{base}/landed", f"{base}/ckpt", partitions=3, trigger=NOW)
    query.awaitTermination()


def test_stream_landing_equals_batch_landing_after_a_restart(spark):
    base = fresh_dir(spark, "test-land-stream")
    everything = messages_of(spark)
    land_topics(everything, f"{base}/batch", partitions=3)
    early = F.pmod(F.xxhash64("value"), F.lit(2)) == 0
    land(spark, base, everything.where(early).repartition(2))
    land(spark, base, everything.where(~early).repartition(2))  # the same checkpoint goes on
    # same columns, folders and rows
    columns = ["topic", "partition", "value"]
    landed = read_landed(spark, f"{base}/landed").select(columns)
    assert ordered(landed) == ordered(read_landed(spark, f"{base}/batch").select(columns))
    assert path_exists(spark, f"{base}/landed/topics/topic=app.geo/partition=0")
    back = clean_posts(read_topic(spark, f"{base}/landed", "app.pin", POST_RAW))
    assert ordered(back) == ordered(clean_posts(raw_posts(spark, SMALL)))
    assert topic_rejects(spark, f"{base}/landed", "app.geo", LOCATION_RAW).count() == 0


def test_files_of_a_killed_landing_batch_are_not_read(spark):
    base = fresh_dir(spark, "test-land-killed")
    land(spark, base, messages_of(spark).limit(50).coalesce(1))
    # a task of a killed batch left a file that the commit log doesn't name
    spark.createDataFrame([('{"country":"Nowhere"}',)], "value string").coalesce(1).write.mode("append").text(
        f"{base}/landed/topics/topic=app.geo/partition=0")
    assert read_topic(spark, f"{base}/landed", "app.geo", LOCATION_RAW).where("country = 'Nowhere'").count() == 0
    assert read_landed(spark, f"{base}/landed").count() == 50
    # a stream over the landing follows the log too
    stream = read_landed_stream(spark, f"{base}/landed", r"^app\.geo$")
    append_stream(clean_stream(stream, "geo"), path=f"{base}/geo", checkpoint=f"{base}/ckpt2", trigger=NOW).awaitTermination()
    expect = clean_locations(read_topic(spark, f"{base}/landed", "app.geo", LOCATION_RAW))
    assert ordered(spark.read.parquet(f"{base}/geo")) == ordered(expect)


def test_landings_of_batches_and_streams_are_kept_apart(spark):
    base = fresh_dir(spark, "test-land-mixed")
    few = messages_of(spark).limit(20).coalesce(1)
    land(spark, base, few)
    with pytest.raises(ValueError):
        land_topics(few, f"{base}/landed")
    with pytest.raises(ValueError):
        read_topic(spark, f"{base}/landed", "app.pin")  # no schema
    land_topics(few, f"{base}/batch")
    with pytest.raises(ValueError):
        land_stream(inbox(spark, base, few), f"{base}/batch", f"{base}/ckpt3")
    with pytest.raises(ValueError):
        land_stream(inbox(spark, base, few), f"{base}/landed", f"{base}/ckpt4")  # a new checkpoint


GEO = ['{"country":"Peru","ind":"1","latitude":1.5,"longitude":2.0,"timestamp":"2020-01-01 00:00:00"}',
       "{bad", '{"country":"Chile","ind":"2","latitude":"x"}', "[1]",
       '{"country":"","ind":"z","latitude":null,"longitude":2.0,"timestamp":"later"}']


def put(spark, base, lines):
    spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.mode("append").text(f"{base}/in")


def run(spark, base):
    source = read_messages_stream(spark, "text", f"{base}/in", {"maxFilesPerTrigger": "1"})
    queries = run_entity_tables(spark, {"geo": source}, f"{base}/tables", trigger=NOW)
    assert list(queries) == ["geo"]  # one query, both outputs
    queries["geo"].awaitTermination()


def test_entity_table_equals_batch_chain(spark):
    base = fresh_dir(spark, "test-once")
    land_topics(spark.createDataFrame([("geo", None, v) for v in GEO], "topic string, key string, value string"), base)
    put(spark, base, GEO)
    run(spark, base)
    expect = clean_locations(read_topic(spark, base, "geo", LOCATION_RAW))
    got = read_entity_table(spark, f"{base}/tables", "geo")
    assert ordered(got) == ordered(expect) and got.columns == expect.columns and got.count() == 3
    rejects = read_entity_table(spark, f"{base}/tables", "geo", "rejects")
    assert ordered(rejects) == ordered(topic_rejects(spark, base, "geo", LOCATION_RAW))
    assert read_entity_table(spark, f"{base}/none", "geo").count() == 0


def test_messages_are_parsed_once(spark):
    df = spark.createDataFrame([(v,) for v in GEO], "value string")
    plan = tables.parsed_once(df, "geo")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_a_killed_batch_and_a_repeated_batch_add_no_row_twice(spark, monkeypatch):
    base = fresh_dir(spark, "test-killed")
    put(spark, base, GEO[:2])
    commit = tables.commit

    def killed(*args):
        raise RuntimeError("killed between write and commit")
    monkeypatch.setattr(tables, "commit", killed)
    with pytest.raises(Exception, match="killed between"):
        run(spark, base)
    assert read_entity_table(spark, f"{base}/tables", "geo").count() == 0  # the attempt doesn't count
    monkeypatch.setattr(tables, "commit", commit)
    run(spark, base)  # Spark repeats the batch with its id
    assert [r.country for r in read_entity_table(spark, f"{base}/tables", "geo").collect()] == ["Peru"]
    put(spark, base, GEO[2:])
    run(spark, base)
    expect = [("Chile",), (None,), ("Peru",)]
    assert ordered(read_entity_table(spark, f"{base}/tables", "geo").select(F.expr("nullif(country, '')"))) == sorted(expect, key=str)
    # the checkpoint forgot a finished batch: it runs again and finds its commit
    fs, path = hadoop_path(spark, f"{base}/tables/_checkpoints/geo/commits")
    last = max(int(s.getPath().getName()) for s in fs.listStatus(path) if s.getPath().getName().isdigit())
    for name in (str(last), f".{last}.crc"):
        fs.delete(hadoop_path(spark, f"{base}/tables/_checkpoints/geo/commits/{name}")[1], False)
    run(spark, base)
    assert read_entity_table(spark, f"{base}/tables", "geo").count() == 3
    assert read_entity_table(spark, f"{base}/tables", "geo", "rejects").count() == 3
    assert read_entity_table(spark, f"{base}/tables", "geo", since=0).count() == 2


def test_write_batch_is_idempotent_and_guarded(spark):
    base = fresh_dir(spark, "test-idempotent")
    parsed = tables.parsed_once(spark.createDataFrame([(v,) for v in GEO], "value string"), "geo")
    assert tables.write_batch(parsed, 7, f"{base}/geo") and not tables.write_batch(parsed, 7, f"{base}/geo")
    assert read_entity_table(spark, base, "geo").count() == 3
    put(spark, base, GEO)
    source = read_messages_stream(spark, "text", f"{base}/in")
    with pytest.raises(ValueError):  # commits without their checkpoint
        run_entity_tables(spark, {"geo": source}, base, trigger=NOW)
    tables.commit(spark, f"{base}/geo", 7, "other")
    with pytest.raises(ValueError):
        read_entity_table(spark, base, "geo")


def test_new_checkpoint_on_a_filled_table_is_refused(spark):
    import uuid
    base, name = fresh_dir(spark, "test-filled"), f"geo_{uuid.uuid4().hex[:10]}"
    put(spark, base, GEO)
    source = read_messages_stream(spark, "text", f"{base}/in")
    append_stream(clean_stream(source, "geo"), table=name, checkpoint=f"{base}/ckpt", trigger=NOW).awaitTermination()
    with pytest.raises(ValueError):
        append_stream(clean_stream(source, "geo"), table=name, checkpoint=f"{base}/other", trigger=NOW)
    append_stream(clean_stream(source, "geo"), table=name, checkpoint=f"{base}/ckpt", trigger=NOW).awaitTermination()
    assert spark.table(name).count() == 3
