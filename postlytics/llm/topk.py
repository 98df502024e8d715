"""Exact top-k inner-product search by norm-bucketed retrieval.

1. Vectors become integers floor(scale * x). Candidates are dealt into buckets of
   similar length (range partitioning by norm), so a bucket knows a tight bound
   on its longest vector.
2. Each query gets a first threshold: the k-th best score over the longest
   ``seed_rows`` candidates (a bounded number). A bucket whose largest possible
   product |q| * longest is below the threshold is never paired with the query.
3. A bucket meets the queries that are left in blocks. There the local cosine
   threshold theta / (|q| * longest) chooses how to prune: by length (only
   candidates long enough to reach theta, a prefix of the bucket in descending
   length) when it is low, or by coordinates when it is high: the query's
   largest coordinates and the remainder's length bound each product from above.
   What passes is verified with the full product.
4. The blocks' k best are merged per query.

Scores are exact integers; ties go to the smaller vec_id. Defined results: vectors
that are null or empty, or hold null or non-finite components, take no part, nor
do rows without a vec_id; vectors of another length than the query's are no candidates; a
query's own row is the row of its vec_id. Rows with one and the same vec_id are
each a candidate; as a query, the one with the smallest vector stands for them. A query with fewer than k candidates returns all; without any, no row.
Where lengths allow products of over 2^53, a bucket's products are taken in 64-bit or Python's
integers, unpruned; scores beyond 64 bits count as the nearest 64-bit integer. Vectors whose scaled
components aren't finite take no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import exact_products, staged


def integer_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, dim, norm, vec (integers as float64 bytes) of the rows that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims, norms, packed = [], [], [], []
            for vec_id, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                v = np.floor(scale * np.array(x, np.float64))
                ids.append(vec_id)
                dims.append(len(v))
                norms.append(float(np.sqrt(v @ v)))
                packed.append(v.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()),
                                              pa.array(norms, pa.float64()), pa.array(packed, pa.binary())],
                                             ["vec_id", "dim", "norm", "vec"])

    x = F.col("embedding")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double") * scale) < F.lit(float("inf"))))
    rows = vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0)).where(finite)
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), x.cast("array<double>").alias("x")).mapInArrow(
        run, "vec_id bigint, dim int, norm double, vec binary")


def _matrix(packed: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.float64).reshape(len(packed), -1)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best by (score descending, id ascending)."""
    if len(scores) > 4 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        among = np.flatnonzero(scores >= cut)
    else:
        among = np.arange(len(scores))
    return among[np.lexsort((ids[among], -scores[among]))[:k]]


def search_block(q_ids, q, q_norm, theta, c_ids, c, c_norm, k: int, high: float = 0.5, coordinates: int = 8):
    """k best of one bucket for one block of queries, pruned by length or by coordinates.

    ``c`` in descending length; ``theta`` holds scores that k other candidates are known
    to reach, so anything below it is never asked for. Yields (query row, candidate rows, scores).
    """
    if float(np.max(q_norm, initial=0)) * float(np.max(c_norm, initial=0)) >= 2.0 ** 53:
        raise ValueError("inner products exceed the exact range of 2^53")
    longest = float(c_norm[0])
    with np.errstate(divide="ignore", invalid="ignore"):
        local = np.where(q_norm * longest > 0, theta / (q_norm * longest), np.where(theta > 0, np.inf, -np.inf))
    by_length = np.flatnonzero(local <= high)
    if len(by_length):
        # theta / |q| is the shortest length that can reach theta; the block's least one fits all
        with np.errstate(divide="ignore", invalid="ignore"):
            need = np.where(theta[by_length] > 0, theta[by_length] / q_norm[by_length], 0.0) * (1 - 1e-12)
        n = int(np.searchsorted(-c_norm, -need.min(), side="right"))
        for part in np.split(by_length, range(128, len(by_length), 128)):
            for row, scores in zip(part, q[part] @ c[:n].T):
                ok = np.flatnonzero((scores >= theta[row]) & (c_ids[:n] != q_ids[row]))
                pick = ok[best(scores[ok], c_ids[ok], k)]
                yield row, pick, scores[pick]
    squares = c * c
    for row in np.flatnonzero((local > high) & (local <= 1 + 1e-12)):
        focus = np.argsort(-np.abs(q[row]), kind="stable")[:coordinates]
        rest_q = math.sqrt(max(0.0, q_norm[row] ** 2 - float(q[row, focus] @ q[row, focus])))
        rest_c = np.sqrt(np.maximum(0.0, c_norm ** 2 - squares[:, focus].sum(1)))
        bound = c[:, focus] @ q[row, focus] + rest_q * rest_c
        ok = np.flatnonzero((bound * (1 + 1e-12) + 1e-6 >= theta[row]) & (c_ids != q_ids[row]))
        scores = c[ok] @ q[row]
        good = scores >= theta[row]
        ok, scores = ok[good], scores[good]
        pick = best(scores, c_ids[ok], k)
        yield row, ok[pick], scores[pick]


def search_large(q_ids, q, q_norm, c_ids, c, c_norm, k: int):
    """As :func:`search_block` for vectors whose products may exceed 2^53: exact integers, no pruning."""
    for start in range(0, len(q_ids), 128):
        part = slice(start, start + 128)
        for row, scores in enumerate(exact_products(q[part], q_norm[part], c, c_norm), start):
            ok = np.flatnonzero(c_ids != q_ids[row])
            pick = ok[best(scores[ok], c_ids[ok], k)]
            yield row, pick, scores[pick]


def top_k(vectors: DataFrame, k: int = 5, query_every: int = 50, scale: int = 256, bucket_rows: int = 16384,
          query_rows: int = 2048, seed_rows: int = 1000) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best."""
    rows = staged(integer_vectors(vectors, scale), "vectors")
    n = rows.count()
    buckets = max(1, math.ceil(n / bucket_rows))
    # length order within a dimension; bucket numbers come from a sampled range partitioning
    dealt = staged(rows.repartitionByRange(buckets, "dim", F.desc("norm"), "vec_id")
                   .withColumn("bucket", F.spark_partition_id()), "buckets")
    # the longest vectors of each dimension, a bounded number, seed the thresholds
    seeds = (dealt.withColumn("r", F.row_number().over(W.partitionBy("dim").orderBy(F.desc("norm"), "vec_id")))
             .where(F.col("r") <= seed_rows).select("dim", "vec_id", "norm", "vec"))
    queries = (rows.where(F.col("vec_id") % query_every == 0).groupBy("vec_id")
               .agg(F.min(F.struct("dim", "norm", "vec")).alias("q")).select("vec_id", "q.*"))
    blocks = max(1, math.ceil(n / query_every / query_rows))
    blocked = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))

    def first_thresholds(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left["theta"] = -np.inf
        if len(left) and len(right):
            right = right.sort_values(["norm", "vec_id"], ascending=[False, True])
            q, c, ids = _matrix(left["vec"]), _matrix(right["vec"]), right["vec_id"].to_numpy()
            # floats of exact integers: at most one step above them, and a threshold may only be too low
            products = np.nextafter(exact_products(q, left["norm"].to_numpy(), c, right["norm"].to_numpy()).astype(np.float64), -np.inf)
            products[left["vec_id"].to_numpy()[:, None] == ids[None, :]] = -np.inf
            if products.shape[1] >= k:
                left["theta"] = np.partition(products, products.shape[1] - k, axis=1)[:, products.shape[1] - k]
        return left[["vec_id", "dim", "norm", "vec", "block", "theta"]]

    repeated = seeds.select(F.col("dim").alias("d"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"),
                            "vec_id", "norm", "vec")
    seeded = (blocked.groupBy("dim", "block").cogroup(repeated.groupBy("d", "b"))
              .applyInPandas(first_thresholds, "vec_id bigint, dim int, norm double, vec binary, block int, theta double"))
    seeded = staged(seeded, "queries")
    spans = dealt.groupBy("dim", "bucket").agg(F.max("norm").alias("longest"))
    # (query block, bucket) pairs in which some query can still reach its threshold
    wanted = (seeded.join(spans, "dim")
              .where((F.col("theta") <= F.col("norm") * F.col("longest") * (1 + 1e-12))))
    pairs = wanted.select(F.col("dim").alias("d"), F.col("bucket").alias("c"), F.col("block").alias("b")).distinct()

    def search(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            right = right.sort_values(["norm", "vec_id"], ascending=[False, True])
            q_ids, c_ids = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
            q, c, q_norm, c_norm = _matrix(left["vec"]), _matrix(right["vec"]), left["norm"].to_numpy(), right["norm"].to_numpy()
            if float(q_norm.max()) * float(c_norm.max()) < 2.0 ** 52:
                found = search_block(q_ids, q, q_norm, left["theta"].to_numpy(), c_ids, c, c_norm, k)
            else:
                found = search_large(q_ids, q, q_norm, c_ids, c, c_norm, k)
            for row, pick, scores in found:
                out += [(q_ids[row], c_ids[j], int(s)) for j, s in zip(pick, scores)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"], dtype="int64")

    left = wanted.select("dim", "bucket", "block", "vec_id", "norm", "vec", "theta")
    right = dealt.select(F.col("dim").alias("d"), F.col("bucket").alias("c"), F.col("vec_id").alias("vec_id"),
                         F.col("norm").alias("norm"), F.col("vec").alias("vec")).join(pairs, ["d", "c"])
    found = (left.groupBy("dim", "bucket", "block").cogroup(right.groupBy("d", "c", "b"))
             .applyInPandas(search, "query_id bigint, vec_id bigint, score bigint"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
