"""The incremental daily run: part loads equal one full load, nothing is read twice, killed runs count once."""

import pytest
from pyspark.sql import functions as F

from postlytics import plans
from postlytics.operators import clean_locations, clean_posts, clean_users
from postlytics.plans import incremental
from postlytics.session import fresh_dir
from postlytics.sources import encode_messages, land_topics, raw_entities
from postlytics.sources.commits import committed
from postlytics.streaming import land_stream, read_messages_stream

from .conftest import SMALL, rows

KEYS = {"pin": "index", "geo": "ind", "user": "ind"}
YEARS = {"post_years": (1996, 2000), "join_years": (2015, 2020)}


def raw_parts(spark):
    """Raw rows of each entity with a part number 0-2; keys have rows in several parts, some have none."""
    out = {}
    for entity, df in raw_entities(spark, SMALL, "customer").items():
        mark = {"pin": "title", "geo": "timestamp", "user": "ind"}[entity]
        df = df.withColumn("part", F.pmod(F.crc32(F.coalesce(F.col(mark), F.lit("")).cast("binary")), F.lit(3)))
        lost = df.where("part = 1").limit(4).withColumn(KEYS[entity], F.lit(None).cast("string"))
        out[entity] = df.unionByName(lost)
    return out


def land(spark, base, frames):
    for entity, df in frames.items():
        land_topics(encode_messages(df, topic=entity, key=KEYS[entity]), base, partitions=2)


def full(parts, keep):
    kept = {e: df.where(keep).drop("part") for e, df in parts.items()}
    answers = plans.answer_questions(clean_posts(kept["pin"]), clean_locations(kept["geo"]), clean_users(kept["user"]),
                                     YEARS["post_years"], YEARS["join_years"])
    return {name: sorted(rows(df), key=str) for name, df in answers.items()}


def run(spark, base):
    paths = plans.run_incremental(spark, base, f"{base}/daily", layout="hive", **YEARS)
    return paths, {name: sorted(rows(spark.read.parquet(p)), key=str) for name, p in paths.items()}


def batches(spark, base):
    return {e: len(committed(spark, f"{base}/daily/tables/{e}")) for e in KEYS}


def test_part_loads_equal_one_full_load(spark):
    base, parts = fresh_dir(spark, "test-incremental"), raw_parts(spark)
    # users come late: the first load has posts and locations only
    land(spark, base, {e: parts[e].where("part = 0").drop("part") for e in ("pin", "geo")})
    spark.createDataFrame([], "value string").write.text(f"{base}/topics/topic=user/partition=0")
    run(spark, base)
    land(spark, base, {e: parts[e].where("part = 1").drop("part") for e in KEYS})
    _, got = run(spark, base)
    late = {"pin": "part < 2", "geo": "part < 2", "user": "part = 1"}
    assert got == full({e: df.where(late[e]) for e, df in parts.items()}, "true")
    land(spark, base, {"pin": parts["pin"].where("part = 2").drop("part"), "geo": parts["geo"].where("part = 2").drop("part"),
                       "user": parts["user"].where("part <> 1").drop("part")})
    paths, got = run(spark, base)
    assert got == full(parts, "true")
    # nothing new: no file is read, no batch, run or answer is added
    before, runs = batches(spark, base), committed(spark, f"{base}/daily/state")
    again, same = run(spark, base)
    assert (again, same) == (paths, got)
    assert batches(spark, base) == before and committed(spark, f"{base}/daily/state") == runs and len(runs) == 3
    # pair counts of the state are those of one load, from counts per key
    pairs = incremental.read_state(spark, f"{base}/daily/state", "user_pin").groupBy("age_group").agg(F.sum("n").alias("n"))
    users = clean_users(parts["user"].drop("part"))
    joined = clean_posts(parts["pin"].drop("part")).join(users, "ind")
    assert pairs.agg(F.sum("n")).first()[0] == joined.count()


def test_a_killed_run_counts_nothing_twice(spark, monkeypatch):
    base, parts = fresh_dir(spark, "test-incremental-killed"), raw_parts(spark)
    land(spark, base, {e: df.where("part = 0").drop("part") for e, df in parts.items()})
    run(spark, base)
    land(spark, base, {e: df.where("part <> 0").drop("part") for e, df in parts.items()})
    commit = incremental.commit

    def killed(spark_, table, batch, attempt):
        if table.endswith(where):
            raise RuntimeError("killed")
        commit(spark_, table, batch, attempt)
    monkeypatch.setattr(incremental, "commit", killed)
    for where in ("/state", "/answers"):  # before the state counts, and between the state and its answers
        with pytest.raises(RuntimeError):
            run(spark, base)
    monkeypatch.setattr(incremental, "commit", commit)
    _, got = run(spark, base)
    assert got == full(parts, "true")
    assert len(committed(spark, f"{base}/daily/state")) == 2


def test_reads_topics_that_a_stream_lands(spark):
    base, parts = fresh_dir(spark, "test-incremental-landed"), raw_parts(spark)
    for part in (0, 1):
        for entity, df in parts.items():
            some = df.where(F.col("part") == part).drop("part")
            messages = encode_messages(some, topic=entity, key=KEYS[entity])
            messages.coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = read_messages_stream(spark, "parquet", f"{base}/in", schema=messages.schema)
        land_stream(stream, base, f"{base}/ckpt", trigger={"availableNow": True}).awaitTermination()
        _, got = run(spark, base)
    assert got == full(parts, "part < 2")


def test_compacted_state_goes_on(spark):
    """Three runs with compactions between them equal one full load; a compaction that was killed is not read."""
    base, parts = fresh_dir(spark, "test-incremental-compacted"), raw_parts(spark)
    state = f"{base}/daily/state"
    for part in (0, 1, 2):
        land(spark, base, {e: df.where(F.col("part") == part).drop("part") for e, df in parts.items()})
        _, got = run(spark, base)
        before = {name: sorted(rows(df), key=str) for name, df in plans.answers_from_state(spark, state, **YEARS).items()}
        assert plans.compact_state(spark, state) == (part > 0)
        after = {name: sorted(rows(df), key=str) for name, df in plans.answers_from_state(spark, state, **YEARS).items()}
        assert got == before == after
    assert got == full(parts, "true")
    assert not plans.compact_state(spark, state)  # one batch stands for all
    stored = incremental.read_state(spark, state, "pin_counts")
    assert stored.count() == stored.select("ind", "category").distinct().count()
    for name in ("pin_best", "geo_best"):
        best = incremental.read_state(spark, state, name)
        assert best.count() == best.select("ind").distinct().count()
    left = incremental.compaction_path(state, 99, "killed")
    spark.createDataFrame([("nobody", 1)], "entity string, upto bigint").write.parquet(f"{left}/taken")
    assert incremental.read_state(spark, state, "taken").where("entity = 'nobody'").count() == 0
