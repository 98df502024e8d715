"""Offset index, fixed-size aligned samples, streams with state."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from postlytics.operators import build_offset_index, open_offset_index
from postlytics.operators.rank import top_n_per_group
from postlytics.session import fresh_dir
from postlytics.sources import sample_keys
from postlytics.streaming import (BEST_POST, LATEST_LOCATION, append_stream, best_per_key, distinct_messages, read_best_per_key,
                                  read_messages_stream, run_best_per_key)

from .conftest import rows

NOW = {"availableNow": True}


def test_a_hundred_offsets_from_one_build(spark):
    df = spark.range(20_000).selectExpr("id * 7919 % 20000 AS k", "id % 3 AS g")
    index = build_offset_index(df, "k", slices=16)
    sc = spark.sparkContext
    sc.setJobGroup("offsets", "")
    try:
        wanted = [(i * 1237) % 20_000 for i in range(100)]
        got = {r.offset: r.k for r in index.rows(wanted).collect()}
    finally:
        sc.setJobGroup("", "")
    assert got == {o: o for o in wanted} and index.total == 20_000 and len(index.starts) == 16
    # nothing was written or sorted again: the jobs are reads of the slices
    plan = index.rows([3, 4]).sort("offset")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__slice" in plan and plan.count("FileScan") == 1
    assert [r.k for r in index.rows([19_990, 5], n=20).orderBy("offset").collect()] == [*range(5, 25), *range(19_990, 20_000)]


def test_offset_index_is_reopened_and_ordered(spark):
    path = fresh_dir(spark, "test-index")
    data = [("b", 1), ("a", 2), (None, 3), ("a", 1), ("c", 0)]
    build_offset_index(spark.createDataFrame(data, "s string, n int"), [F.col("s").desc_nulls_last(), "n"], path, slices=3)
    index = open_offset_index(spark, path)
    got = [(r.s, r.n, r.at) for r in index.rows([0], n=9, offset_col="at").orderBy("at").collect()]
    assert got == [("c", 0, 0), ("b", 1, 1), ("a", 1, 2), ("a", 2, 3), (None, 3, 4)]
    assert rows(index.rows([2, 2])) == [("a", 1, 2)] * 2 and index.rows([7, 10 ** 12]).count() == 0 == index.rows([], 3).count()
    assert sorted(rows(index.random_rows(8, seed=3)), key=str) == sorted(rows(index.random_rows(8, seed=3)), key=str) and index.random_rows(8, 3).count() == 8
    with pytest.raises(ValueError):
        index.rows([-1])
    empty = build_offset_index(spark.createDataFrame([], "s string, n int"), "n")
    assert empty.total == 0 and empty.rows([0]).count() == 0 and empty.random_rows(3, 1).count() == 0


def test_exactly_k_keys_the_same_in_all_tables(spark):
    a = spark.range(3000).select((F.col("id") % 900).cast("string").alias("k")).unionByName(spark.createDataFrame([(None,)] * 9, "k string"))
    b = spark.range(200, 4000).select(F.col("id").alias("key"))  # a holds 0-899, b 200-3999: 700 keys in both
    for k in (0, 1, 50, 700, 5000):
        out = sample_keys({"a": a, "b": b}, {"a": "k", "b": "key"}, k, seed=3, hash="md5")
        ka, kb = {int(r.k) for r in out["a"].collect()}, {r.key for r in out["b"].collect()}
        order = sorted(range(200, 900), key=lambda i: (hashlib.md5(f"{i}:3".encode()).hexdigest()[:8], str(i)))
        assert ka == kb == set(order[:k])
        assert out["a"].count() == sum(3000 // 900 + (i < 3000 % 900) for i in ka)  # all rows of a kept key
    hot = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("key"))
    assert sample_keys({"x": hot}, "key", 10)["x"].select("key").distinct().count() == 10
    with pytest.raises(ValueError):
        sample_keys({"x": hot}, "key", -1)


T = dt.datetime
LOCATIONS = "ind bigint, country string, timestamp timestamp"


def test_best_per_key_equals_ranking(spark):
    data = [(1, "Peru", T(2020, 1, 1)), (1, "Chile", T(2020, 1, 1)), (1, None, T(2020, 1, 1)), (1, "Bolivia", T(2019, 1, 1)),
            (2, "Peru", None), (2, "Chile", T(1960, 5, 5)), (3, None, None), (3, "Peru", None), (None, "Peru", T(2022, 1, 1)), (1, "Chile", T(2020, 1, 1))]
    df = spark.createDataFrame(data, LOCATIONS)
    expect = top_n_per_group(df.where("ind is not null"), "ind", [F.col("timestamp").desc_nulls_last(), F.col("country").asc_nulls_last()])
    best = best_per_key(df, "ind", LATEST_LOCATION)
    assert sorted(rows(best.select("ind", "country", "timestamp"))) == sorted(rows(expect))
    posts = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, None, "0"), (2, -2 ** 63, "x"), (2, None, "a"), (3, 2 ** 63 - 1, None), (3, 2 ** 63 - 1, "z")],
                                  "ind bigint, follower_count bigint, poster_name string")
    assert sorted(rows(best_per_key(posts, "ind", BEST_POST))) == [(1, 5, "a"), (2, -2 ** 63, "x"), (3, 2 ** 63 - 1, "z")]
    with pytest.raises(ValueError):
        best_per_key(df, "ind", [("country", True)])


def test_streamed_latest_rows_survive_late_and_repeated_rows(spark):
    base = fresh_dir(spark, "test-latest")
    loads = [[(1, "Peru", T(2020, 1, 1)), (2, "Peru", T(2021, 1, 1))],
             [(1, "Chile", T(2022, 1, 1)), (1, "Chile", T(2022, 1, 1)), (3, "Peru", T(2020, 1, 1))],
             [(1, "Cuba", T(2019, 1, 1)), (2, "Peru", T(2021, 1, 1)), (2, "Haiti", T(2021, 1, 1)), (None, "Fiji", T(2023, 1, 1))]]
    schema = spark.createDataFrame([], LOCATIONS).schema

    def run():
        stream = read_messages_stream(spark, "parquet", f"{base}/in", {"maxFilesPerTrigger": "1"}, schema)
        run_best_per_key(stream, "ind", LATEST_LOCATION, f"{base}/table", f"{base}/ckpt", NOW).awaitTermination()
        return read_best_per_key(spark, f"{base}/table", "ind", LATEST_LOCATION, schema)

    for i, load in enumerate(loads):
        spark.createDataFrame(load, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
        got = run()  # a restart each time
        everything = spark.createDataFrame([r for part in loads[:i + 1] for r in part], schema)
        assert sorted(rows(got.select("ind", "country", "timestamp"))) == sorted(
            rows(best_per_key(everything, "ind", LATEST_LOCATION).select("ind", "country", "timestamp")))
    assert {r.ind: r.country for r in got.collect()} == {1: "Chile", 2: "Haiti", 3: "Peru"}
    with pytest.raises(ValueError):
        run_best_per_key(read_messages_stream(spark, "parquet", f"{base}/in", schema=schema), "ind", LATEST_LOCATION, f"{base}/table", f"{base}/new")


def test_repeated_messages_give_one_row_across_batches_and_restarts(spark):
    base, kind = fresh_dir(spark, "test-distinct"), "value string, at timestamp"

    def load(data):
        spark.createDataFrame(data, kind).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = read_messages_stream(spark, "parquet", f"{base}/in", {"maxFilesPerTrigger": "1"}, spark.createDataFrame([], kind).schema)
        once = distinct_messages(stream, event_time="at", delay="1 hour").select("value", "at")
        append_stream(once, path=f"{base}/out", checkpoint=f"{base}/ckpt", trigger=NOW).awaitTermination()
        return sorted(rows(spark.read.parquet(f"{base}/out")), key=str)

    noon = T(2024, 1, 1, 12)
    assert load([("a", noon), ("a", noon), ("b", noon)]) == [("a", noon), ("b", noon)]
    minutes = lambda n: noon + dt.timedelta(minutes=n)
    got = load([("a", minutes(20)), ("c", minutes(25)), (None, minutes(25))])  # a restart; the repeat comes in the next batch
    assert sorted((v for v, _ in got), key=str) == [None, "a", "b", "c"]
    load([("later", minutes(300))])  # the watermark passes a's hour
    load([("later still", minutes(301))])
    assert [v for v, _ in load([("a", minutes(302))])].count("a") == 2  # forgotten after its delay: state is bounded
