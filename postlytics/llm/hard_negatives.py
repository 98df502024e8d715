"""Hard-negative mining by a secondary-sort shuffle.

Vectors become integers floor(scale * x). Rows are range-partitioned by length into buckets and
anchors are dealt into blocks; a task scores one block of anchors against one bucket.

1. Positives: an anchor block meets only the rows of its own label in each bucket; every task
   returns an anchor's best few, so the merge sees a few rows a bucket.
2. Negatives: with its positives known, an anchor asks for the rows of other labels whose score
   lies in one of the windows low * p <= 100 * score <= high * p. A bucket whose longest vector
   can't reach the lowest window of any anchor of a block isn't paired with it, and a task returns the
   first few rows of each window, never all pairs.
3. The pairs left are packed into byte keys (anchor, descending score, positive before negative,
   id), whose byte order is the order wanted, and ``repartitionAndSortWithinPartitions`` deals them
   by anchor. One iterator then reads each partition: a positive opens its window, a negative goes
   to every open window that it fits and that isn't full, and rows leave as they come. It holds an
   anchor's few open windows and no list of its pairs.

Products are exact: in float64 where the lengths bound them below 2^53, else in 64-bit
integers, else in Python's own; a score beyond 64 bits counts as the nearest 64-bit integer.

Defined results: rows with a null vec_id or label, or a vector that is null or empty or holds null
or non-finite components (also after scaling), take no part. Vectors of another length than the
anchor's are neither positives nor negatives of it. Rows whose vec_id is the anchor's are never its
positives or negatives; of several anchor rows with one vec_id, the one with the smallest
(length, vector, label) stands for all; other rows with equal vec_ids are candidates each. An anchor
without positives, and a positive without negatives, give no row. Other columns are not read.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import LEAST, MOST, exact_products, staged
from .topk import best

KEY = struct.Struct(">QQBQ")  # anchor, descending score, kind, id
POSITIVE, NEGATIVE = 0, 1


def integer_rows(vectors: DataFrame, scale: int, relabel_every: int, labels: int) -> DataFrame:
    """vec_id, label, dim, norm, vec (integers as float64 bytes), row (a number) of the rows that take part."""
    x = F.transform(F.col("embedding").cast("array<double>"), lambda e: F.lit(float(scale)) * e)
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    rows = (vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0)).where(finite)
            .select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), x.alias("x")))
    moved = F.when(F.col("vec_id") % relabel_every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            whole = [np.floor(np.asarray(x, np.float64)) for x in batch["x"]]
            yield pd.DataFrame({"vec_id": batch["vec_id"], "label": batch["label"], "dim": [len(v) for v in whole],
                                "norm": [_norm(v) for v in whole], "vec": [v.tobytes() for v in whole]})

    taking = rows.withColumn("label", moved).mapInPandas(run, "vec_id bigint, label bigint, dim int, norm double, vec binary")
    return taking.withColumn("row", F.monotonically_increasing_id())


def _norm(v: np.ndarray) -> float:
    top = float(np.abs(v).max())
    return top * math.sqrt(float(((v / top) ** 2).sum())) if top else 0.0


def _matrix(packed: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.float64).reshape(len(packed), -1)


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """Least and largest score s with low * score <= 100 * s <= high * score."""
    return max(LEAST, -(-low * score // 100)), min(MOST, high * score // 100)


def pack(anchor: int, score: int, kind: int, other: int) -> bytes:
    return KEY.pack(anchor + (1 << 63), MOST - score, kind, other + (1 << 63))


def unpack(key: bytes) -> tuple[int, int, int, int]:
    anchor, down, kind, other = KEY.unpack(key)
    return anchor - (1 << 63), MOST - down, kind, other - (1 << 63)


def emit(keys: Iterator[bytes], positives: int, negatives: int, low: int, high: int) -> Iterator[tuple]:
    """(anchor, positive, rank, negative, positive score, negative score) from sorted keys."""
    anchor, opened = None, []
    for key in keys:
        a, score, kind, other = unpack(key)
        if a != anchor:
            anchor, opened, seen = a, [], 0
        if kind == POSITIVE:
            if seen < positives:
                seen += 1
                opened.append([other, score, *window(score, low, high), 0])
            continue
        for w in opened:
            if w[2] <= score <= w[3] and w[4] < negatives:
                w[4] += 1
                yield anchor, w[0], w[4], other, w[1], score
        # scores only fall from here on: a window whose least score has passed, or that is full, closes
        opened = [w for w in opened if w[4] < negatives and score >= w[2]]


def blocks_of(rows: pd.DataFrame, size: int = 256) -> Iterator[pd.DataFrame]:
    for start in range(0, len(rows), size):
        yield rows.iloc[start:start + size]


def hard_negatives(vectors: DataFrame, anchor_every: int = 100, positives: int = 5, negatives: int = 5, low: int = 80,
                   high: int = 100, scale: int = 256, relabel_every: int = 7, labels: int = 10, bucket_rows: int = 8192,
                   anchor_rows: int = 4096) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = vectors.sparkSession
    rows = staged(integer_rows(vectors, scale, relabel_every, labels), "vectors")
    n = rows.count()
    buckets, blocks = max(1, math.ceil(n / bucket_rows)), max(1, math.ceil(n / anchor_every / anchor_rows))
    dealt = staged(rows.repartitionByRange(buckets, "dim", F.desc("norm"), "vec_id", "row")
                   .withColumn("bucket", F.spark_partition_id()), "buckets")
    anchors = staged(rows.where(F.col("vec_id") % anchor_every == 0).groupBy("vec_id")
                     .agg(F.min(F.struct("dim", "vec", "label", "norm")).alias("a")).select("vec_id", "a.*")
                     .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")), "anchors")
    spans = staged(dealt.groupBy("dim", "bucket", "label").agg(F.max("norm").alias("longest")), "spans")

    def nearest(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            ids, c, c_norm = right["vec_id"].to_numpy(), _matrix(right["vec"]), right["norm"].to_numpy()
            for part in blocks_of(left):
                scores = exact_products(_matrix(part["vec"]), part["norm"].to_numpy(), c, c_norm)
                for a, row in zip(part["vec_id"], scores):
                    ok = np.flatnonzero(ids != a)
                    pick = ok[best(row[ok], ids[ok], positives)]
                    out += [(a, ids[j], row[j]) for j in pick]
        return pd.DataFrame(out, columns=["anchor", "other", "score"], dtype="int64")

    # an anchor block, the rows of its label in a bucket
    own = anchors.join(spans.select("dim", "label", "bucket"), ["dim", "label"])
    pairs = own.select("dim", "label", "bucket", "block").distinct()
    left = own.select("dim", "label", "bucket", "block", "vec_id", "norm", "vec").groupBy("dim", "label", "bucket", "block")
    right = dealt.join(pairs, ["dim", "label", "bucket"]).select(
        F.col("dim").alias("d"), F.col("label").alias("l"), F.col("bucket").alias("c"), F.col("block").alias("b"),
        "vec_id", "norm", "vec").groupBy("d", "l", "c", "b")
    found = left.cogroup(right).applyInPandas(nearest, "anchor bigint, other bigint, score bigint")
    place = F.row_number().over(W.partitionBy("anchor").orderBy(F.desc("score"), "other"))
    near = staged(found.withColumn("place", place).where(F.col("place") <= positives).drop("place"), "positives")

    wanted = near.groupBy("anchor").agg(F.collect_list("score").alias("scores"), F.min("score").alias("lowest"))
    asking = staged(anchors.join(wanted, F.col("vec_id") == F.col("anchor")).drop("anchor"), "asking")
    longest = spans.groupBy("dim", "bucket").agg(F.max("longest").alias("longest"))
    # no score of a bucket is above |anchor| * longest; the lowest window of an anchor begins at low * lowest
    reach = (F.lit(float(low)) * F.col("lowest") <= 100 * F.col("norm") * F.col("longest") * (1 + 1e-9) + 1)
    meets = asking.join(longest, "dim").where(reach | (F.col("lowest") <= 0))
    pairs = meets.select("dim", "bucket", "block").distinct()

    def hardest(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            ids, own, c, c_norm = (right["vec_id"].to_numpy(), right["label"].to_numpy(), _matrix(right["vec"]),
                                   right["norm"].to_numpy())
            for part in blocks_of(left):
                scores = exact_products(_matrix(part["vec"]), part["norm"].to_numpy(), c, c_norm)
                for a, label, asked, row in zip(part["vec_id"], part["label"], part["scores"], scores):
                    other = np.flatnonzero((own != label) & (ids != a))
                    picked = set()
                    for p in {int(s) for s in asked}:
                        least, most = window(p, low, high)
                        ok = other[(row[other] >= least) & (row[other] <= most)]
                        picked.update(ok[best(row[ok], ids[ok], negatives)].tolist())
                    out += [pack(int(a), int(row[j]), NEGATIVE, int(ids[j])) for j in sorted(picked)]
        return pd.DataFrame({"key": pd.Series(out, dtype=object)})

    left = meets.select("dim", "bucket", "block", "vec_id", "label", "norm", "vec", "scores").groupBy("dim", "bucket", "block")
    right = dealt.join(pairs, ["dim", "bucket"]).select(
        F.col("dim").alias("d"), F.col("bucket").alias("c"), F.col("block").alias("b"), "vec_id", "label", "norm", "vec").groupBy("d", "c", "b")
    found = staged(left.cogroup(right).applyInPandas(hardest, "key binary"), "pairs")

    keys = found.rdd.map(lambda r: (bytes(r[0]), None)).union(
        near.rdd.map(lambda r: (pack(r.anchor, r.score, POSITIVE, r.other), None)))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_keys = keys.repartitionAndSortWithinPartitions(parts, lambda key: zlib.crc32(key[:8]))
    mined = sorted_keys.mapPartitions(lambda pairs: emit((key for key, _ in pairs), positives, negatives, low, high))
    return spark.createDataFrame(mined, "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
                                        "positive_score bigint, negative_score bigint", verifySchema=False)
