"""Aggregates: medians (A6) and distinct counts (A5) per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_ACCURACY = 10000
BRACKET_ACCURACY = 1000


def median_by_group(df: DataFrame, by: Sequence[str], col: str, method: str = "exact",
                    accuracy: int = DEFAULT_ACCURACY, out: str = "median") -> DataFrame:
    """Lower median of ``col`` per group, NULLs ignored.

    ``exact`` equals ``percentile_disc(0.5)`` (see :func:`exact_lower_median`).
    ``approx`` is the reference's sketch (``percentile_approx``): one pass, bounded
    memory per group, merged map-side, rank error at most n / accuracy, so its answer
    depends on the group's size.
    Groups whose values are all NULL keep a row with a NULL median.
    """
    keys = list(by)
    if method == "approx":
        return df.groupBy(*keys).agg(F.percentile_approx(col, 0.5, accuracy).alias(out))
    if method != "exact":
        raise ValueError(f"unknown method {method!r}; expected 'approx' or 'exact'")
    return exact_lower_median(df, keys, col, out)


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on equal keys where NULL equals NULL; keeps the left side's key columns."""
    renamed = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    cond = [left[k].eqNullSafe(renamed[f"__r_{k}"]) for k in keys]
    joined = left.join(renamed, cond, how) if cond else left.join(renamed, how=how)
    return joined.drop(*[f"__r_{k}" for k in keys])


def exact_lower_median(df: DataFrame, by: Sequence[str], col: str, out: str = "median",
                       accuracy: int = BRACKET_ACCURACY, bracket: DataFrame | None = None) -> DataFrame:
    """Smallest value whose cumulative share in its group reaches one half.

    A function of the data alone, whatever the partitioning:

    1. one sketch per group gives two values that enclose the median (they lie
       3 / accuracy of the group below and above its middle, three times the sketch's error);
       stored sketches give them without this pass (``bracket``: by, __lo, __hi, see
       :func:`postlytics.operators.sketches.brackets_from`);
    2. a pass counts the rows below the bracket, the rows above or NULL and, per value, the rows
       inside, with a map-side combine: a task sends a few rows a group and the values inside;
    3. the few values inside are ranked per group.

    The sketch is used once and the groups come from the counts, so the input is read twice (once
    with ``bracket``). No task sees more of a group than the sketch and about 6 / accuracy of its distinct values.
    """
    keys, value = list(by), F.col(col)
    rows = df.select(*keys, col)
    if bracket is None:
        bracket = rows.groupBy(*keys).agg(
            F.percentile_approx(col, max(0.0, 0.5 - 3 / accuracy), accuracy).alias("__lo"),
            F.percentile_approx(col, min(1.0, 0.5 + 3 / accuracy), accuracy).alias("__hi"))
    lo, hi = F.col("__lo"), F.col("__hi")
    zone = (F.when(value.isNull(), 3).when(value < lo, 0).when(value <= hi, 1).otherwise(2)).alias("__zone")
    # a group that its bracket table lacks has no bounds: its values fall in zone 2 and raise below
    placed = _null_safe_join(rows, bracket, keys, "left").select(
        *keys, zone, F.when(value.between(lo, hi), value).alias("__value"))
    counts = placed.groupBy(*keys, "__zone", "__value").agg(F.count(F.lit(1)).alias("__rows"))
    group = Window.partitionBy(*keys)
    so_far = F.sum("__rows").over(group.orderBy("__zone", "__value").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    total = F.sum(F.when(F.col("__zone") < 3, F.col("__rows"))).over(group)
    ranked = counts.select(*keys, "__zone", "__value", so_far.alias("__cum"), total.alias("__n"))
    # the lower median is the first row that reaches the middle; outside zone 1 the sketch broke its bound
    first = F.min(F.when((F.col("__zone") < 3) & (F.col("__cum") * 2 >= F.col("__n")), F.struct("__zone", "__value")))
    answer = ranked.groupBy(*keys).agg(first.alias("__first"))
    broken = F.col("__first.__zone") != 1
    checked = F.when(broken, F.raise_error(F.lit("the median lies outside its bracket"))).otherwise(F.col("__first.__value"))
    return answer.select(*keys, checked.alias(out))


def distinct_count_by_group(df: DataFrame, by: Sequence[str], col: str, out: str,
                            approx: bool = False) -> DataFrame:
    """Distinct values of ``col`` per group (A5); ``approx`` uses HyperLogLog++."""
    agg = F.approx_count_distinct(col) if approx else F.count_distinct(col)
    return df.groupBy(*by).agg(agg.alias(out))
