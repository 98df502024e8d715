"""Join-based operators that keep the reference's repeated-key semantics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRACKED = 8192   # items a key sketch tracks: estimates are off by at most 0.03 % of all rows
HOT_SHARE = 1000  # a key is hot when it holds over 1 / HOT_SHARE of the rows


def key_sketch(key: Column | str, tracked: int = TRACKED) -> Column:
    """Frequent-items sketch of a key, an aggregate of bounded size.

    It rides along with a pass that reads the rows anyway (``DataFrame.observe`` or another
    aggregate), can be stored, and is merged with others by :func:`merged_sketch`.
    """
    return F.call_function("approx_top_k_accumulate", F.col(key) if isinstance(key, str) else key, F.lit(tracked))


def merged_sketch(sketch: Column | str, tracked: int = TRACKED) -> Column:
    """Aggregate that merges stored sketches into one."""
    return F.call_function("approx_top_k_combine", F.col(sketch) if isinstance(sketch, str) else sketch, F.lit(tracked))


def hot_keys_of(sketches: DataFrame, sketch: str, rows: int, share: int = HOT_SHARE) -> list:
    """Keys that hold over 1 / ``share`` of ``rows`` rows by the merged sketches: fewer than ``share``
    keys, whatever the input. They steer plans and never decide results."""
    # grouped by a constant: a task without sketches then has no state to hand over
    found = (sketches.groupBy(F.lit(1).alias("__all")).agg(merged_sketch(sketch).alias("s"))
             .select(F.explode(F.call_function("approx_top_k_estimate", F.col("s"), F.lit(share))).alias("i")).select("i.*"))
    return sorted(r.item for r in found.where(F.col("item").isNotNull() & (F.col("count") * share > rows)).collect())


def _counted_by_key(left: DataFrame, right: DataFrame, on: str, lb: list[str], rb: list[str]) -> DataFrame:
    """(lb, rb, __pairs) from one pass over either side, for keys of any frequency.

    Both sides go through one exchange as (key, side, group, rows) with a map-side combine, so a
    key that holds a third of the rows costs a few rows a task. A second exchange, by
    the key alone, brings a key's groups together, and their counts are multiplied group by group.
    """
    l_type = left.select(F.struct(*lb).alias("g")).schema["g"].dataType
    r_type = right.select(F.struct(*rb).alias("g")).schema["g"].dataType
    rows = left.select(on, F.lit(True).alias("__is_left"), F.struct(*lb).alias("__l"), F.lit(None).cast(r_type).alias("__r"))
    rows = rows.unionByName(right.select(on, F.lit(False).alias("__is_left"), F.lit(None).cast(l_type).alias("__l"),
                                         F.struct(*rb).alias("__r")))
    counts = (rows.where(F.col(on).isNotNull()).groupBy(on, "__is_left", "__l", "__r").agg(F.count(F.lit(1)).alias("__n")))
    by_key = counts.groupBy(on).agg(
        F.collect_list(F.when(F.col("__is_left"), F.struct(F.col("__l").alias("g"), F.col("__n").alias("n")))).alias("__ls"),
        F.collect_list(F.when(~F.col("__is_left"), F.struct(F.col("__r").alias("g"), F.col("__n").alias("n")))).alias("__rs"))
    met = by_key.where((F.size("__ls") > 0) & (F.size("__rs") > 0))
    pairs = met.select(F.explode("__ls").alias("__a"), "__rs").select("__a", F.explode("__rs").alias("__b"))
    return pairs.select(*[F.col(f"__a.g.`{c}`").alias(c) for c in lb], *[F.col(f"__b.g.`{c}`").alias(c) for c in rb],
                        (F.col("__a.n") * F.col("__b.n")).alias("__pairs"))


def pair_counts(left: DataFrame, right: DataFrame, on: str,
                left_by: Sequence[str], right_by: Sequence[str],
                out: str = "count", hot_keys: Sequence | None = None) -> DataFrame:
    """Row counts of ``left ⋈ right`` (inner, on ``on``) grouped by columns of both sides.

    Equal to ``left.join(right, on).groupBy(*left_by, *right_by).count()``,
    including the m x n rows a key repeated m and n times contributes, but
    each side is first reduced to ``(key, group, rows)``, so no pairs are ever
    materialised. The plan is lazy and reads each side once.

    Without ``hot_keys`` nothing is known of the keys, and rows are combined map-side before
    either of two exchanges (:func:`_counted_by_key`). With them (an empty list: no key repeats often;
    else as :func:`hot_keys_of` finds them in sketches of an earlier pass) either side is shuffled once, by
    ``on``, and the counts per (key, group) and the join are finished inside that
    partitioning; rows of hot keys take a path of their own with a map-side combine.
    """
    lb, rb = list(left_by), list(right_by)
    if hot_keys is None:
        pairs = _counted_by_key(left, right, on, lb, rb)
        return pairs.groupBy(*lb, *rb).agg(F.sum("__pairs").alias(out))

    def counted(df: DataFrame, by: list[str], n: str, hot: Column | None) -> DataFrame:
        rows = df.select(on, *by)
        if hot is not None:
            rows = rows.where(hot)
        else:
            rows = (rows.where(~F.col(on).isin(*hot_keys)) if hot_keys else rows.where(F.col(on).isNotNull())).repartition(on)
        return rows.groupBy(on, *by).agg(F.count(F.lit(1)).alias(n))

    def joined(hot: Column | None) -> DataFrame:
        both = counted(left, lb, "__nl", hot).join(counted(right, rb, "__nr", hot), on)
        return both.select(*lb, *rb, (F.col("__nl") * F.col("__nr")).alias("__pairs"))

    pairs = joined(None)
    if hot_keys:
        pairs = pairs.unionByName(joined(F.col(on).isin(*hot_keys)))
    return pairs.groupBy(*lb, *rb).agg(F.sum("__pairs").alias(out))
