"""Brute-force versions of exact dedup, resampling and hard-negative mining, with every awkward row."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from postlytics.llm import exact_dedup, hard_negatives, target_resampling
from postlytics.llm.common import LEAST, MOST, exact_products

from .data import SCHEMA, documents, odd_texts
from .test_vector_operators import SCHEMA as VECTOR_SCHEMA
from .test_vector_operators import fine, odd_vectors, single


def texts():
    return odd_texts() + [(50, " "), (51, "  "), (52, "\n"), (53, " "), (None, ""), (None, ""), (None, " "),
                          (300, "x " * 30), (300, "x " * 30), (301, "Same Start " * 9 + "a"), (302, "Same Start " * 9 + "b")]


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, texts()).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def listed(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def equal_texts(rows):
    plain = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    ids = defaultdict(list)
    for (i, _), t in zip(rows, plain):
        ids[t].append(i)
    out, stays = [], set()
    for (i, _), t in zip(rows, plain):
        keep = min((j for j in ids[t] if j is not None), default=None)
        kept = i == keep and t not in stays
        if kept:
            stays.add(t)
        out.append((i, keep, len(ids[t]), kept, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("options", [{}, {"bits": 15, "prefix_chars": 3, "hot_share": 4}, {"bits": 15, "prefix_chars": 1, "hot_share": 10 ** 6}])
def test_exact_copies(docs, empty, options):
    assert listed(exact_dedup.exact_copies(docs, **options)) == equal_texts(texts())
    assert exact_dedup.exact_copies(empty, **options).count() == 0


def test_only_surviving_texts_are_hashed(spark):
    rows = [(1, "same length A"), (2, "same length B"), (3, "short"), (4, "copy"), (5, "copy")]
    facts = exact_dedup.copies(documents(spark, rows).selectExpr("doc_id AS rid", "doc_id AS id", "text")).collect()
    assert {r.id for r in facts if r.digest} == {4, 5}
    # with a shared prefix the full texts decide
    facts = exact_dedup.copies(documents(spark, rows).selectExpr("doc_id AS rid", "doc_id AS id", "text"), prefix_chars=4).collect()
    assert {r.id for r in facts if r.digest} == {1, 2, 4, 5} and {r.id for r in facts if not r.kept} == {5}


def test_bitmap_holds_exactly_its_keys(spark):
    keys, rows = spark.range(0, 3000, 3), spark.range(3000)
    marked = exact_dedup.with_mark(rows, exact_dedup.bitmap_of(keys, 40, "id"), 40, "id").collect()
    assert all(r.marked == (r.id % 3 == 0) for r in marked) and len(marked) == 3000


def test_keep_first_returns_whole_rows(docs, empty):
    stay = exact_dedup.keep_first(docs)
    assert stay.columns == docs.columns
    assert sorted(str(r.doc_id) for r in stay.collect()) == sorted(str(r[0]) for r in equal_texts(texts()) if r[3])
    assert exact_dedup.keep_first(empty).count() == 0


def features(text, low, high, buckets=10_000):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [zlib.crc32(" ".join(words[i:i + n]).encode()) % buckets for n in range(low, high + 1)
                        for i in range(len(words) - n + 1)]


TARGET = [(1, "w1 w2 w3 hot"), (2, None), (3, "line here 中文"), (4, "")]


def resampled(rows, target, low, high, percent, least=20):
    source, aim = Counter(), Counter()
    for counts, texts_ in ((source, rows), (aim, target)):
        for _, t in texts_:
            counts.update(features(t, low, high)[1])
    s_all, t_all = sum(source.values()) + 10_000, sum(aim.values()) + 10_000
    out = []
    for i, t in rows:
        words, found = features(t, low, high)
        gains = [math.floor(1000 * math.log((aim[b] + 1.0) * s_all / ((source[b] + 1.0) * t_all))) for b in found]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    may = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(may[:len(may) * percent // 100]):
        r[4] = place + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


@pytest.mark.parametrize("low, high, percent, pivots", [(1, 1, 10, 15), (1, 2, 50, 1), (2, 3, 100, 3), (1, 1, 0, 15)])
def test_resampling(spark, docs, empty, low, high, percent, pivots):
    target = spark.createDataFrame(TARGET, "item_id bigint, text string")
    options = {"low": low, "high": high, "percent": percent, "pivots": pivots}
    assert listed(target_resampling.resample(docs, target, **options)) == resampled(texts(), TARGET, low, high, percent)
    assert target_resampling.resample(empty, target, **options).count() == 0
    none = target_resampling.resample(docs, target.limit(0), **options)
    assert listed(none) == resampled(texts(), [], low, high, percent)


def test_drawn_rows_are_whole(spark, docs):
    target = spark.createDataFrame(TARGET, "item_id bigint, text string")
    got = target_resampling.drawn_rows(docs, target, percent=40)
    assert got.columns == docs.columns
    expect = sorted(str(r[0]) for r in resampled(texts(), TARGET, 1, 1, 40) if r[4])
    assert sorted(str(r.doc_id) for r in got.collect()) == expect


def test_long_texts_are_cut_between_words():
    found = target_resampling.Features(1, 3, 10_000)
    text = " ".join(f"word{i}" for i in range(2000)).encode() + b" " + b"x" * 500
    whole = [b for _, part in found.of(text) for b in part]
    cut = [b for _, part in found.of(text, 64) for b in part]
    assert sorted(whole) == sorted(cut) and sum(n for n, _ in found.of(text, 64)) == 2001


def test_quickselect_finds_every_place(spark):
    """Scores with many ties, ids with nulls: the k-th key for every k, and ranks over many partitions."""
    rows = [(i % 4, None if i % 5 == 0 else i % 7, i) for i in range(60)]
    df = spark.createDataFrame(rows, "score bigint, doc_id bigint, row bigint").withColumn("key", target_resampling.sort_key())
    order = sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0, r[2]))
    for k in (1, 2, 17, 30, 59, 60):
        for pivots in (1, 4):
            assert target_resampling.kth_key(df, k, pivots).row == order[k - 1][2]
    got = target_resampling.ranked(df).select("row", "rank").collect()
    assert {r.row: r["rank"] for r in got} == {r[2]: i + 1 for i, r in enumerate(order)}


def vectors():
    rng = np.random.default_rng(3)
    large = [(800, [3e9] * 8, 1), (801, [2e9] * 8, 1), (802, [-2e9, 3e9] * 4, 2), (900, [1e12] * 8, 1), (901, [1e12] * 8, 1),
             (902, [0.9e12] * 8, 2), (903, [1e30] * 8, 1), (910, [0.0] * 8, 1), (911, [-1.0] * 8, 1)]
    plain = [(1000 + i, rng.normal(size=8).tolist(), i % 3) for i in range(100)]
    repeated = [(1100, rng.normal(size=8).tolist(), 1), (1100, rng.normal(size=8).tolist(), 2), (1101, [0.5] * 8, 1), (1101, [0.5] * 8, 1)]
    return odd_vectors() + [(i, e, y, "x", 1, "y", 2) for i, e, y in large + plain + repeated]


def mined(rows, every):
    taking = []
    for i, e, y, *_ in rows:
        if i is not None and y is not None and fine(single(e)):
            taking.append((i, [int(math.floor(256 * x)) for x in single(e)], (y + 1) % 10 if i % 7 == 0 else y))
    most, out = 2 ** 63 - 1, []
    for a in sorted({i for i, _, _ in taking if i % every == 0}):
        _, packed, label = min((len(v), np.array(v, np.float64).tobytes(), y) for i, v, y in taking if i == a)
        own = [int(x) for x in np.frombuffer(packed, np.float64)]
        scored = [(-max(-most, min(most, sum(p * q for p, q in zip(own, v)))), i, y) for i, v, y in taking
                  if i != a and len(v) == len(own)]
        for score, positive in sorted((s, i) for s, i, y in scored if y == label)[:5]:
            fits = [(-s, i) for s, i in sorted((s, i) for s, i, y in scored if y != label) if -80 * score <= -100 * s <= -100 * score]
            out += [(a, positive, rank + 1, i, -score, s) for rank, (s, i) in enumerate(fits[:5])]
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"bucket_rows": 9, "anchor_rows": 1}])
def test_hard_negatives(spark, options):
    df = spark.createDataFrame(vectors(), VECTOR_SCHEMA).repartition(4)
    got = sorted(tuple(r) for r in hard_negatives.hard_negatives(df, anchor_every=10, **options).collect())
    assert got == mined(vectors(), 10) and len(got) > 400
    assert hard_negatives.hard_negatives(spark.createDataFrame([], VECTOR_SCHEMA), **options).count() == 0


def test_products_are_exact_at_every_size():
    rng = np.random.default_rng(1)
    for scale in (1e2, 1e9, 1e17, 1e25):
        q, c = (np.floor(rng.normal(size=(5, 6)) * scale) for _ in range(2))
        c[2] = np.floor(rng.normal(size=6) * 10)
        got = exact_products(q, np.sqrt((q * q).sum(1)), c, np.sqrt((c * c).sum(1)))
        for i in range(5):
            for j in range(5):
                exact = sum(int(x) * int(y) for x, y in zip(q[i], c[j]))
                assert got[i, j] == max(LEAST, min(MOST, exact))


def test_packed_keys_sort_like_their_parts():
    parts = [(a, s, kind, i) for a in (-5, 0, 7) for s in (-2 ** 63 + 1, -1, 0, 2 ** 63 - 1) for kind in (0, 1) for i in (-9, 3)]
    keys = [hard_negatives.pack(*p) for p in parts]
    assert [hard_negatives.unpack(k) for k in keys] == parts
    assert [hard_negatives.unpack(k) for k in sorted(keys)] == sorted(parts, key=lambda p: (p[0], -p[1], p[2], p[3]))
