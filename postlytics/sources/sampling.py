"""Key-aligned sampling (S7): the same keys are kept in every table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import fresh_dir

BUCKETS = 1_000_000
BROADCAST_KEYS = 100_000


def key_hash(key: Column | str, seed: int = 0, hash: str = "xxhash64") -> Column:
    """Non-negative 64-bit hash of a key's text and a seed.

    ``xxhash64`` is the fast default; ``md5`` (first 32 bits of the digest of
    ``<key>:<seed>``) is slower but portable, so another engine can repeat it.
    """
    k = (F.col(key) if isinstance(key, str) else key).cast("string")
    if hash == "xxhash64":
        return F.xxhash64(k, F.lit(seed))
    if hash == "md5":
        digest = F.md5(F.concat(k, F.lit(f":{seed}")))
        return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    raise ValueError("hash must be 'xxhash64' or 'md5'")


def key_bucket(key: Column | str, seed: int = 0, hash: str = "xxhash64") -> Column:
    """Stable bucket in ``[0, 1_000_000)`` of a key's text and a seed."""
    return F.pmod(key_hash(key, seed, hash), F.lit(BUCKETS))


def sample_aligned(frames: Mapping[str, DataFrame], keys: Mapping[str, str] | str,
                   fraction: float, seed: int = 0, hash: str = "xxhash64") -> dict[str, DataFrame]:
    """Keep about ``fraction`` of the keys, and for a kept key all its rows,
    in every frame. ``keys`` is one column name or a column per frame.

    A hash of the key decides, so no table is shuffled or joined and the
    frames stay aligned: a key kept in one is kept in all.
    """
    if not 0 <= fraction <= 1:
        raise ValueError("fraction must lie in [0, 1]")
    limit = int(round(fraction * BUCKETS))
    out = {}
    for name, df in frames.items():
        key = keys if isinstance(keys, str) else keys[name]
        out[name] = df.filter(key_bucket(key, seed, hash) < limit)
    return out


def sample_keys(frames: Mapping[str, DataFrame], keys: Mapping[str, str] | str, k: int, seed: int = 0,
                hash: str = "xxhash64") -> dict[str, DataFrame]:
    """Exactly ``k`` keys (all, if fewer) and all their rows in every frame.

    The keys are the ``k`` smallest by hash, then by text, of those that occur in *every* frame, so the
    sample is random, reproducible and aligned. A task sends each key it holds once, with a mark of
    the frames that hold it; of the keys with all marks every task keeps its ``k`` smallest. The chosen
    keys are written to the shared folder when this is called and joined to each frame, broadcast
    up to 100 000 keys. NULL keys are never chosen.
    """
    if k < 0:
        raise ValueError("k must not be negative")
    column = {name: keys if isinstance(keys, str) else keys[name] for name in frames}
    marked = None
    for i, (name, df) in enumerate(frames.items()):
        part = df.select(F.col(column[name]).cast("string").alias("__key"), F.lit(1 << i).cast("bigint").alias("__mark"))
        marked = part if marked is None else marked.unionByName(part)
    spark = marked.sparkSession
    held = (marked.where(F.col("__key").isNotNull()).groupBy("__key").agg(F.bit_or("__mark").alias("__marks"))
            .where(F.col("__marks") == (1 << len(frames)) - 1))
    path = fresh_dir(spark, "sample-keys")
    held.orderBy(key_hash("__key", seed, hash), "__key").limit(k).select("__key").write.parquet(path)
    chosen = spark.read.schema("__key string").parquet(path)
    chosen = F.broadcast(chosen) if k <= BROADCAST_KEYS else chosen
    return {name: df.join(chosen, df[column[name]].cast("string") == F.col("__key"), "left_semi") for name, df in frames.items()}
