"""Property tests: parse_count against a small Python model."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from postlytics.functions import parse_count

SUFFIX = {"k": 1000, "M": 1000000}


def model(text, mode):
    if text is None or text == "User Info Error":
        return None
    mult = SUFFIX.get(text[-1:], 1)
    if mode == "digits":
        digits = re.sub(r"[^0-9]+", "", text)
        return int(digits) * mult if digits else None
    num = re.sub(r"[^0-9.]+", "", text)
    if not re.fullmatch(r"[0-9]*\.?[0-9]*", num) or num in ("", "."):
        return None
    whole, _, frac = num.partition(".")
    frac = (frac + "000000")[:6]  # six decimals, like decimal(38,6)
    return (int(whole or "0") * 1000000 + int(frac)) * mult // 1000000


texts = st.builds(
    lambda blank, digits, dot, more, suffix: f"{blank}{digits}{dot}{more}{suffix}",
    st.sampled_from(["", " "]), st.text("0123456789", min_size=0, max_size=6),
    st.sampled_from(["", "."]), st.text("0123456789", max_size=2), st.sampled_from(["", "k", "M", "K", "x"]))


@settings(max_examples=1, deadline=None)
@given(st.lists(texts, min_size=50, max_size=80))
def test_parse_count_matches_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    got = df.select(parse_count("t", mode="digits").alias("d"), parse_count("t", mode="decimal").alias("m")).collect()
    for v, r in zip(values, got):
        assert r.d == model(v, "digits"), v
        assert r.m == model(v, "decimal"), v


rows_st = st.lists(st.tuples(st.integers(0, 5), st.one_of(st.none(), st.integers(-50, 50))),
                   min_size=1, max_size=60)


@settings(max_examples=3, deadline=None)
@given(rows_st)
def test_top1_is_group_max(spark, data):
    from pyspark.sql import functions as F
    from postlytics.operators import top_n_per_group
    df = spark.createDataFrame(data, "g int, v int")
    got = top_n_per_group(df, "g", [F.col("v").desc_nulls_last()]).collect()
    groups = {g for g, _ in data}
    assert sorted(r.g for r in got) == sorted(groups)
    for r in got:
        vals = [v for g, v in data if g == r.g and v is not None]
        assert r.v == (max(vals) if vals else None)


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.sampled_from("ab")), min_size=1, max_size=40),
       st.lists(st.tuples(st.integers(0, 4), st.sampled_from("xyz")), min_size=1, max_size=40))
def test_pair_counts_matches_brute_force(spark, left, right):
    from collections import Counter
    from postlytics.operators import pair_counts
    ldf = spark.createDataFrame(left, "ind int, a string")
    rdf = spark.createDataFrame(right, "ind int, b string")
    expect = Counter((a, b) for k1, a in left for k2, b in right if k1 == k2)
    got = {(r.a, r.b): r["count"] for r in pair_counts(ldf, rdf, "ind", ["a"], ["b"]).collect()}
    assert got == dict(expect)


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.text(max_size=8)),
                          st.one_of(st.none(), st.integers(-2**40, 2**40)),
                          st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False, width=32))),
                min_size=1, max_size=30))
def test_encode_decode_identity(spark, data):
    from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType
    from postlytics.sources import decode_messages, encode_messages
    schema = StructType([StructField("s", StringType()), StructField("n", LongType()),
                         StructField("x", DoubleType())])
    df = spark.createDataFrame(data, schema)
    back = decode_messages(encode_messages(df, topic="t"), schema)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)


@settings(max_examples=2, deadline=None)
@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=3000), st.sampled_from([50, 200, 10000]))
def test_sketch_median_rank_error(spark, values, accuracy):
    from postlytics.operators import median_by_group
    df = spark.createDataFrame([("g", v) for v in values], "g string, v long")
    got = median_by_group(df, ["g"], "v", method="approx", accuracy=accuracy).first()["median"]
    ordered = sorted(values)
    assert got in set(values)
    target = (len(ordered) + 1) // 2 - 1
    lo = sum(1 for v in ordered if v < got)
    hi = sum(1 for v in ordered if v <= got) - 1
    allowed = len(ordered) / accuracy + 1
    assert lo - allowed <= target <= hi + allowed


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 3)), st.sampled_from("ab")),
                min_size=1, max_size=25),
       st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 3)), st.sampled_from("xyz")),
                min_size=1, max_size=25))
def test_top_joined_per_key_equals_brute_force(spark, left, right):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from postlytics.operators import top_joined_per_key
    ldf = spark.createDataFrame(left, "ind int, ts int, c string")
    rdf = spark.createDataFrame(right, "ind int, f int, n string")
    lo = [F.col("ts").desc_nulls_last(), F.col("c").asc_nulls_last()]
    ro = [F.col("f").desc_nulls_last(), F.col("n").asc_nulls_last()]
    got = sorted(map(tuple, top_joined_per_key(ldf, rdf, "ind", lo, ro).select("ind", "ts", "c", "f", "n").collect()),
                 key=repr)
    w = Window.partitionBy("ind").orderBy(*lo, *ro)
    brute = (ldf.join(rdf, "ind").withColumn("rn", F.row_number().over(w)).filter("rn = 1")
             .select("ind", "ts", "c", "f", "n"))
    assert got == sorted(map(tuple, brute.collect()), key=repr)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from("abc")),
                          st.one_of(st.none(), st.integers(-20, 20))), min_size=1, max_size=80),
       st.sampled_from([10, 50, 1000]))
def test_exact_median_matches_model(spark, data, accuracy):
    from postlytics.operators.aggregate import exact_lower_median
    df = spark.createDataFrame(data, "g string, v int")
    got = {r.g: r.m for r in exact_lower_median(df, ["g"], "v", "m", accuracy=accuracy).collect()}
    expect = {}
    for g in {g for g, _ in data}:
        vals = sorted(v for k, v in data if k == g and v is not None)
        expect[g] = vals[(len(vals) + 1) // 2 - 1] if vals else None
    assert got == expect
