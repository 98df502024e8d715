"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import weakref
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlytics.session import fresh_dir

# Words are maximal runs of anything but space, tab, LF, VT, FF and CR; that is
# what bytes.split() yields, and what this pattern counts on the JVM side.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

# Scores beyond 64 bits count as these; -LEAST is a 64-bit integer too.
MOST = (1 << 63) - 1
LEAST = -MOST


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a new folder under ``spark.checkpoint.dir`` and read it back.

    Cuts lineage with files that every executor sees, so a lost executor costs
    a re-read and not a re-computation.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder under ``spark.checkpoint.dir`` as a path workers can open.

    Memory-mapped files need a folder mounted on every node (NFS, Lustre, a
    FUSE mount); a shared folder without a file path is refused.
    """
    url = urlparse(fresh_dir(spark, label))
    if url.scheme not in ("", "file"):
        raise ValueError("memory-mapped model files need spark.checkpoint.dir on a mounted "
                         f"file system, not {url.scheme}://")
    os.makedirs(url.path, exist_ok=True)
    return url.path


def text_bytes(column: str = "text") -> Column:
    """UTF-8 bytes of a text column; null is the empty text."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def doc_remainder(modulus: int, column: str = "doc_id") -> Column:
    """crc32(doc_id as text) mod ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def slices(batches: Iterator[pa.RecordBatch], column: int, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that one slice holds about ``most_bytes`` of the binary
    ``column`` (a longer single value stays whole): bounds a worker's memory."""
    for batch in batches:
        start, held = 0, 0
        for i, n in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
            n = n or 0
            if held and held + n > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


_caches: list[weakref.ref] = []


def held_by_worker(cache) -> None:
    """``cache`` outlives its task; ``only_caches`` calls its ``clear`` when another operator's task starts."""
    _caches.append(weakref.ref(cache))


def only_caches(*mine) -> None:
    """Called when a task starts: empty the tables that other operators have left in this
    worker, and give freed memory back to the system."""
    for cache in [c for c in (ref() for ref in _caches) if c is not None]:
        if not any(cache is m for m in mine):
            cache.clear()
    _caches[:] = [ref for ref in _caches if ref() is not None]
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only the GNU library has it
        ctypes.CDLL(None).malloc_trim(0)


class WordCache(dict):
    """A per-worker table word -> value, filled by ``make`` when first asked for.

    ``trim`` empties it once it holds ``most`` entries; words over ``longest``
    are never kept, so memory stays bounded.
    """

    def __init__(self, make, most: int = 400_000, longest: int = 64):
        super().__init__()
        self.make, self.most, self.longest = make, most, longest
        held_by_worker(self)

    def __missing__(self, word):
        value = self.make(word)
        if len(word) <= self.longest:
            self[word] = value
        return value

    def trim(self) -> None:
        if len(self) > self.most:
            self.clear()


def exact_products(q: np.ndarray, q_norm: np.ndarray, c: np.ndarray, c_norm: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows (as float64) as int64, held between LEAST and MOST."""
    longest = float(q_norm.max())
    small = longest * c_norm < 2.0 ** 52
    if small.all():
        return (q @ c.T).astype(np.int64)
    out = np.empty((len(q), len(c)), np.int64)
    out[:, small] = (q @ c[small].T).astype(np.int64)
    whole = ~small & (longest * c_norm < 2.0 ** 62) & (c_norm < 2.0 ** 62) & (longest < 2.0 ** 62)
    if whole.any():  # 64-bit sums may wrap on the way, but not in the end
        out[:, whole] = q.astype(np.int64) @ c[whole].astype(np.int64).T
    for j in np.flatnonzero(~small & ~whole):
        other = [int(x) for x in c[j]]
        for i, row in enumerate(q):
            out[i, j] = min(MOST, max(LEAST, sum(int(x) * y for x, y in zip(row, other))))
    return out
