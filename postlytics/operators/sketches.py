"""Mergeable sketches per group: quantiles (A6) and distinct counts (A5, Q7).

A sketch table holds one binary sketch per group. It is built in two levels, first per group and
*part* (a fixed number of parts, dealt by the task that read the rows), then per group, so a group
that every task holds is merged by ``parts`` tasks and not by one. Tables of different days or
runs are unioned and merged the same way, so a stored sketch is never rebuilt from its rows.

Sketch answers are approximate; the exact operators are in ``aggregate``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, DoubleType, FloatType, IntegerType, LongType, ShortType

PARTS = 64
SKETCH = "sketch"
QUANTILE_K = 4096   # normalised rank error of a KLL sketch: about 2.4 / k^0.94, here 0.1 %
DISTINCT_LG = 14    # 2^14 kept hashes: exact below that many values, then about 0.8 % standard error


def _two_levels(rows: DataFrame, by: Sequence[str], first: Column, merge: Callable[[str], Column], parts: int) -> DataFrame:
    """One sketch per group: ``first`` over rows per (group, part), then ``merge`` over the parts."""
    part = F.pmod(F.spark_partition_id(), F.lit(parts)).alias("__part")
    partial = rows.select("*", part).groupBy(*by, "__part").agg(first.alias(SKETCH))
    return partial.groupBy(*by).agg(merge(SKETCH).alias(SKETCH))


def _merged(sketches: DataFrame, by: Sequence[str], merge: Callable[[str], Column], parts: int) -> DataFrame:
    return _two_levels(sketches.select(*by, SKETCH), by, merge(SKETCH), merge, parts)


def _kll(kind: DataType, name: str) -> Callable:
    """A KLL function for the column's type: whole numbers as bigint, others as double."""
    suffix = "double" if isinstance(kind, (DoubleType, FloatType)) else "bigint"
    return getattr(F, f"kll_{name}_{suffix}")


def quantile_sketches(df: DataFrame, by: Sequence[str], col: str, k: int = QUANTILE_K, parts: int = PARTS) -> DataFrame:
    """(by, sketch): a KLL sketch of the non-NULL values of ``col`` per group. Groups without
    values keep an empty sketch."""
    kind = df.schema[col].dataType
    if not isinstance(kind, (ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType)):
        raise ValueError(f"{col} is {kind.simpleString()}; quantile sketches hold whole numbers, float or double")
    value = F.col(col).cast("double" if isinstance(kind, (DoubleType, FloatType)) else "bigint")
    return _two_levels(df.select(*by, value.alias("__v")), by, _kll(kind, "sketch_agg")("__v", F.lit(k)),
                       lambda c: _kll(kind, "merge_agg")(c, F.lit(k)), parts)


def merge_quantile_sketches(sketches: DataFrame, by: Sequence[str], kind: DataType, k: int = QUANTILE_K,
                            parts: int = PARTS) -> DataFrame:
    """One sketch per group from the union of stored sketch tables; ``kind`` is the type of the values."""
    return _merged(sketches, by, lambda c: _kll(kind, "merge_agg")(c, F.lit(k)), parts)


def quantiles_from(sketches: DataFrame, by: Sequence[str], kind: DataType, q: Sequence[float] = (0.5,),
                   names: Sequence[str] = ("median",)) -> DataFrame:
    """(by, n, one column per quantile) of a sketch table; NULL where a group has no values."""
    n = _kll(kind, "sketch_get_n")(SKETCH)
    found = [F.when(n > 0, _kll(kind, "sketch_get_quantile")(SKETCH, F.lit(float(p)))).alias(name) for p, name in zip(q, names)]
    return sketches.select(*by, n.alias("n"), *found)


def brackets_from(sketches: DataFrame, by: Sequence[str], kind: DataType, k: int = QUANTILE_K) -> DataFrame:
    """(by, __lo, __hi): values that enclose every group's median, for ``exact_lower_median(bracket=...)``:
    10 / k of the group to either side, four times the sketch's error."""
    return quantiles_from(sketches, by, kind, (max(0.0, 0.5 - 10 / k), min(1.0, 0.5 + 10 / k)), ("__lo", "__hi")).drop("n")


def distinct_sketches(df: DataFrame, by: Sequence[str], col: str, lg: int = DISTINCT_LG, parts: int = PARTS) -> DataFrame:
    """(by, sketch): a theta sketch of the distinct non-NULL values of ``col`` per group."""
    return _two_levels(df.select(*by, F.col(col).alias("__v")), by, F.theta_sketch_agg("__v", F.lit(lg)),
                       lambda c: F.theta_union_agg(c, F.lit(lg)), parts)


def merge_distinct_sketches(sketches: DataFrame, by: Sequence[str], lg: int = DISTINCT_LG, parts: int = PARTS) -> DataFrame:
    """One sketch per group from the union of stored sketch tables: a value in several of them counts once."""
    return _merged(sketches, by, lambda c: F.theta_union_agg(c, F.lit(lg)), parts)


def distinct_from(sketches: DataFrame, by: Sequence[str], out: str = "estimate") -> DataFrame:
    """(by, estimate) of a sketch table."""
    return sketches.select(*by, F.theta_sketch_estimate(SKETCH).alias(out))


def common_from(left: DataFrame, right: DataFrame, by: Sequence[str], out: str = "estimate") -> DataFrame:
    """(by, estimate) of the values that both sketch tables hold, e.g. users seen on both of two days."""
    other = right.select(*by, F.col(SKETCH).alias("__other"))
    return left.join(other, list(by)).select(*by, F.theta_sketch_estimate(F.theta_intersection(SKETCH, "__other")).alias(out))
