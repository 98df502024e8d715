"""Importance resampling towards a target distribution (hashed n-gram features).

1. Words of a text are runs of letters a-z, digits and characters beyond ASCII, A-Z lower-cased.
   Features are all runs of ``low`` to ``high`` consecutive words joined by one space; a feature's
   bucket is its CRC-32 modulo ``buckets``.
2. Every task counts buckets in one array and emits its sums, so the shuffle holds at most
   ``buckets`` rows a task and the driver ``buckets`` numbers, whatever the input.
3. A bucket's gain is floor(1000 ln(target share / source share)), add-one smoothed. A document's
   weight is the floored mean of its features' gains, looked up in that array; its score adds
   Gumbel noise drawn from a hash of (seed, doc_id), so the highest scores are a sample without
   replacement and reruns agree.
4. The k-th score is found by a distributed quickselect over composite keys (score descending,
   doc_id, row number): each round draws pivot keys by a hash, one aggregate counts the rows below
   and at every pivot, and only the part between two pivots that holds the k-th key is written for
   the next round. Only pivots and counts reach the driver.
5. The winners alone, range-partitioned and sorted by key, are numbered: a row's place in its
   partition plus the partition sizes before it.

Defined results: a null or empty text has no features and weight 0; a text below ``least_words``
words gets a score, but takes no part in the draw. A null doc_id draws like the empty text and
comes after all ids in ties; rows with equal scores and ids come in the order of the scan. Without target
texts all gains compare with an even spread. An empty table gives no rows. Texts are worked
through in pieces of 4 MB. Other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WordCache, only_caches, slices, staged, text_bytes

# a-z, digits and bytes beyond ASCII stay, A-Z are lowered, all else parts words
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def pieces(text: bytes, most: int) -> Iterator[bytes]:
    """``text`` cut at blanks into pieces of about ``most`` bytes; no word is cut."""
    start = 0
    while len(text) - start > most:
        cut = text.find(b" ", start + most)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:] if start else text


class Features:
    """Bucket numbers of a text's features."""

    def __init__(self, low: int, high: int, buckets: int):
        if not 1 <= low <= high:
            raise ValueError("need 1 <= low <= high")
        self.low, self.high, self.buckets = low, high, buckets
        self.cache = WordCache(lambda word: zlib.crc32(word) % buckets)

    def of(self, text: bytes, most: int = 4 << 20) -> Iterator[tuple[int, np.ndarray]]:
        """(words, buckets) of each piece of ``text``; a feature belongs to the piece its last word is in."""
        before: list[bytes] = []
        for piece in pieces(text.translate(FOLD), most):
            words = piece.split()
            found = []
            for n in range(self.low, self.high + 1):
                if n == 1:
                    found.append(np.fromiter(map(self.cache.__getitem__, words), np.int32, len(words)))
                else:
                    run = before[len(before) - min(len(before), n - 1):] + words
                    found.append(np.fromiter((zlib.crc32(b" ".join(run[i:i + n])) % self.buckets for i in range(len(run) - n + 1)),
                                             np.int32))
            self.cache.trim()
            yield len(words), found[0] if len(found) == 1 else np.concatenate(found)
            if self.high > 1:
                before = (before + words)[1 - self.high:]


def bucket_counts(texts: DataFrame, low: int, high: int, buckets: int) -> np.ndarray:
    """Features of all texts by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(low, high, buckets)
        only_caches(features.cache)
        total = np.zeros(buckets, np.int64)
        for part in slices(batches, 0):
            for text in part.column(0):
                for _, found in features.of(text.as_py()):
                    total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["bucket", "n"])

    summed = (texts.select(text_bytes().alias("text")).mapInArrow(run, "bucket int, n bigint")
              .groupBy("bucket").agg(F.sum("n").alias("n")))
    out = np.zeros(buckets, np.int64)
    for r in summed.collect():  # at most one row a bucket
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(((t + 1) / (T + buckets)) / ((s + 1) / (S + buckets)))) of each bucket, one quotient of doubles."""
    s_all, t_all = float(source.sum() + len(source)), float(target.sum() + len(target))
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weights(rows: DataFrame, gain: np.ndarray, low: int, high: int) -> DataFrame:
    """row, doc_id, n_words, n_features, weight of ``rows`` (row, doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(low, high, len(gain))
        only_caches(features.cache)
        for part in slices(batches, 2):
            words, counts, means = [], [], []
            for text in part.column(2):
                n, k, total = 0, 0, 0
                for more, found in features.of(text.as_py()):
                    n, k, total = n + more, k + len(found), total + int(gain[found].sum())
                words.append(n)
                counts.append(k)
                means.append(total // k if k else 0)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *[pa.array(x, pa.int64()) for x in (words, counts, means)]],
                                             ["row", "doc_id", "n_words", "n_features", "weight"])

    return rows.select("row", F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("text")).mapInArrow(
        run, "row bigint, doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def gumbel(seed: int) -> Column:
    """floor(-1000 ln(-ln u)) with u from the first 32 bits of sha256('seed:doc_id')."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    u = (F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(u)))


def sort_key() -> Column:
    """Smaller keys come first: the highest score, then the smallest doc_id, null last, then the scan's order."""
    return F.struct((-F.col("score")).alias("down"), F.col("doc_id").isNull().alias("none"),
                    F.coalesce("doc_id", F.lit(0).cast("bigint")).alias("id"), F.col("row").alias("row"))


def _as_column(key: Row) -> Column:
    return F.struct(F.lit(key.down).cast("bigint").alias("down"), F.lit(key.none).alias("none"),
                    F.lit(key.id).cast("bigint").alias("id"), F.lit(key.row).cast("bigint").alias("row"))


def kth_key(rows: DataFrame, k: int, pivots: int = 15, seed: int = 0) -> Row:
    """The k-th smallest (from 1) ``key`` of ``rows``: three-way quickselect with several pivots a round."""
    rest, need, turn = rows.select("key"), k, 0
    while True:
        # pivots are drawn from what is left by a hash, so a repeated task draws the same
        drawn = rest.orderBy(F.xxhash64("key.row", F.lit(seed), F.lit(turn)), "key.row").limit(pivots).collect()
        keys = sorted((r.key for r in drawn), key=tuple)
        counts = rest.agg(*[F.count_if(F.col("key") < _as_column(p)).alias(f"below{i}") for i, p in enumerate(keys)],
                          *[F.count_if(F.col("key") == _as_column(p)).alias(f"at{i}") for i, p in enumerate(keys)]).first()
        low = high = None
        passed = 0
        for i, p in enumerate(keys):
            below, at = counts[f"below{i}"], counts[f"at{i}"]
            if below < need <= below + at:
                return p
            if need <= below:
                high = p
                break
            low, passed = p, below + at
        part = F.lit(True)
        if low is not None:
            part = part & (F.col("key") > _as_column(low))
        if high is not None:
            part = part & (F.col("key") < _as_column(high))
        rest, need, turn = staged(rest.where(part), "quickselect"), need - passed, turn + 1


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``key``) plus ``rank`` from 1 by key, without gathering them in one task."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(np.arange(at, at + batch.num_rows))],
                [*batch.schema.names, "part", "place"])
            at += batch.num_rows

    order = ["key.down", "key.none", "key.id", "key.row"]
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("key")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema.fields)
    numbered = staged(dealt.mapInArrow(number, f"{fields}, part int, place bigint"), "ranked")
    sizes = numbered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # one row a partition
    before = F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("part", before.alias("before"))
    return (numbered.join(F.broadcast(starts), "part")
            .withColumn("rank", F.col("before") + F.col("place") + 1).drop("part", "place", "before"))


def draw(rows: DataFrame, target: DataFrame, low: int = 1, high: int = 1, buckets: int = 10_000, percent: int = 10,
         least_words: int = 20, seed: int = 2024, pivots: int = 15) -> DataFrame:
    """row, doc_id, n_features, weight, score, rank (null if not drawn) of ``rows`` (row, doc_id, text)."""
    gain = gains(bucket_counts(rows, low, high, buckets), bucket_counts(target, low, high, buckets))
    scored = staged(weights(rows, gain, low, high).withColumn("score", F.col("weight") + gumbel(seed)), "scored")
    may = F.col("n_words") >= least_words
    keyed = scored.withColumn("key", F.when(may, sort_key()))
    columns = ["row", "doc_id", "n_features", "weight", "score"]
    undrawn = F.lit(None).cast("bigint").alias("rank")
    k = scored.where(may).count() * percent // 100
    if not k:
        return scored.select(*columns, undrawn)
    won = F.col("key") <= _as_column(kth_key(keyed.where(may), k, pivots))
    winners = ranked(keyed.where(won).select(*columns, "key"))
    rest = keyed.where(~F.coalesce(won, F.lit(False))).select(*columns, undrawn)
    return winners.select(*columns, "rank").unionByName(rest)


def resample(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """Per document of ``docs``: doc_id, n_features, weight, score, rank; options as in :func:`draw`."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    return draw(rows, target, **options).drop("row")


def drawn_rows(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The sample itself: the rows of ``docs`` that were drawn, with all their columns."""
    whole = staged(docs.select(F.struct("*").alias("whole"), F.monotonically_increasing_id().alias("row")), "rows")
    rows = whole.select("row", F.col("whole.doc_id").alias("doc_id"), F.col("whole.text").alias("text"))
    won = draw(rows, target, **options).where("rank IS NOT NULL").select("row")
    return whole.join(won, "row", "left_semi").select("whole.*")
