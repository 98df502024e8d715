"""Rows at offsets of a total order (O8), from an index that is built once.

``build_offset_index`` range-partitions the rows on the order and stores each slice sorted, with
every row's place in its slice, next to the slice sizes. ``OffsetIndex.rows`` then answers any
number of offsets: prefix sums over the slice sizes (one number a slice) tell the slice and place
of each, and only those slices' row groups around the places are read. An index with a path of its
own outlives the job that built it (``open_offset_index``).
"""

from __future__ import annotations

import json
import random
from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..session import fresh_dir

SLICE, PLACE = "__slice", "__place"
PLACE_BITS = 33  # monotonically_increasing_id: partition number above, row number in these low bits


@dataclass(frozen=True)
class OffsetIndex:
    """Sorted slices of a table under ``path``; ``starts`` holds each slice's first offset."""

    spark: SparkSession
    path: str
    schema: StructType
    slices: tuple[int, ...]
    starts: tuple[int, ...]
    total: int

    def _spans(self, offset: int, n: int) -> list[tuple[int, int, int, int]]:
        """(slice, first place, last place, slice's first offset) that hold ``n`` rows from ``offset``."""
        out, end = [], min(offset + n, self.total)
        at = bisect_right(self.starts, offset) - 1
        while offset < end:
            stop = min(end, self.starts[at + 1] if at + 1 < len(self.starts) else self.total)
            out.append((self.slices[at], offset - self.starts[at], stop - 1 - self.starts[at], self.starts[at]))
            offset, at = stop, at + 1
        return out

    def rows(self, offsets: Sequence[int], n: int = 1, offset_col: str = "offset") -> DataFrame:
        """``n`` rows from each offset, as the table's columns and ``offset_col``, the row's own offset.
        Offsets beyond the end give no row; a row asked for twice comes twice."""
        if n < 0 or any(o < 0 for o in offsets):
            raise ValueError("offsets and n must not be negative")
        spans = [span for o in offsets for span in self._spans(o, n)]
        data = _read_data(self.spark, self.path, self.schema)
        if not spans:
            return data.limit(0).select(*self.schema.names, F.lit(None).cast("bigint").alias(offset_col))
        # the caller's list, a row an offset and slice; its slices and outer places prune the scan
        wanted = self.spark.createDataFrame(spans, "__in int, __from bigint, __to bigint, __start bigint")
        data = data.where(F.col(SLICE).isin(*{s for s, *_ in spans})
                          & F.col(PLACE).between(min(a for _, a, _, _ in spans), max(b for _, _, b, _ in spans)))
        met = (F.col(SLICE) == F.col("__in")) & F.col(PLACE).between(F.col("__from"), F.col("__to"))
        return data.join(F.broadcast(wanted), met).select(*self.schema.names, (F.col("__start") + F.col(PLACE)).alias(offset_col))

    def random_rows(self, n: int, seed: int, offset_col: str = "offset") -> DataFrame:
        """``n`` rows at random offsets, with repeats, the same for the same seed."""
        rng = random.Random(seed)
        return self.rows([rng.randrange(self.total) for _ in range(n)] if self.total else [], 1, offset_col)


def build_offset_index(df: DataFrame, order: Sequence[Column | str] | Column | str, path: str | None = None,
                       slices: int | None = None) -> OffsetIndex:
    """Store ``df`` in the order of ``order`` (total: end it in a tie-break); one distributed sort, when this
    is called. Under a ``path`` it can be opened again; without one it lies in the session's shared folder."""
    spark = df.sparkSession
    keys = [order] if isinstance(order, (str, Column)) else list(order)
    keep, path = path is not None, path or fresh_dir(spark, "offsets")
    parts = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    row = F.monotonically_increasing_id()
    (df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("__row", row)
     .withColumns({SLICE: F.shiftright("__row", PLACE_BITS).cast("int"),
                   PLACE: F.col("__row").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))}).drop("__row")
     .write.partitionBy(SLICE).parquet(f"{path}/data"))
    counted = _read_data(spark, path, df.schema).groupBy(SLICE).agg(F.count(F.lit(1)).alias("rows"))
    sizes = sorted((r[SLICE], r["rows"]) for r in counted.collect())  # one row a slice
    if keep:
        stored = json.dumps({"schema": json.loads(df.schema.json()), "sizes": sizes})
        spark.createDataFrame([(stored,)], "value string").coalesce(1).write.text(f"{path}/index")
    return _index(spark, path, df.schema, sizes)


def _index(spark: SparkSession, path: str, schema: StructType, sizes: Sequence[Sequence[int]]) -> OffsetIndex:
    counts = [n for _, n in sizes]
    return OffsetIndex(spark, path, schema, tuple(s for s, _ in sizes), tuple(accumulate([0, *counts]))[:-1], sum(counts))


def _read_data(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The stored rows; the schema is given, as an empty table has no file to tell it."""
    extra = [StructField(PLACE, LongType(), True), StructField(SLICE, IntegerType(), True)]
    return spark.read.schema(StructType([*schema.fields, *extra])).parquet(f"{path}/data")


def open_offset_index(spark: SparkSession, path: str) -> OffsetIndex:
    """An index that was built before under a path of its own."""
    stored = json.loads(spark.read.text(f"{path}/index").first().value)
    return _index(spark, path, StructType.fromJson(stored["schema"]), stored["sizes"])
