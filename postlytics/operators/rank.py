"""Ranking operators: top rows per group, latest row per key, rows at an offset.

``top_n_per_group`` uses ``row_number`` plus a filter, the form Catalyst turns
into a partial ``WindowGroupLimit`` ahead of the shuffle: each map task sends at
most ``n`` rows per group, so one huge group does not reach a single task whole.
Spark plans that limit for up to 1000 rows; larger ``n`` are ranked in two stages, first in parts
whose number follows the counted size of each group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .offsets import build_offset_index

GROUP_LIMIT = 1000  # spark.sql.window.group.limit.threshold: no partial limit beyond it


def _cols(items: Sequence[Column | str] | str) -> list[Column]:
    if isinstance(items, (str, Column)):
        items = [items]
    return [F.col(c) if isinstance(c, str) else c for c in items]


def top_n_per_group(df: DataFrame, by: Sequence[Column | str] | str,
                    order: Sequence[Column | str] | Column | str, n: int = 1,
                    rank_col: str | None = None) -> DataFrame:
    """The first ``n`` rows of every group under ``order``.

    ``order`` must end in a tie-break that makes it total, otherwise the kept
    rows are arbitrary (D5). With ``rank_col`` the 1-based rank is kept.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    rc = rank_col or "__rank"
    if n > GROUP_LIMIT:
        # first the best n of each part of a group, then of what is left of it
        keyed = df.withColumns({f"__by{i}": c for i, c in enumerate(_cols(by))})
        keys = [f"__by{i}" for i in range(len(_cols(by)))]
        sizes = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("__size"))
        sized = keyed.join(sizes.select(*[F.col(k).alias(f"{k}_of") for k in keys], "__size"),
                           on=[F.col(k).eqNullSafe(F.col(f"{k}_of")) for k in keys])
        # a group of g rows in sqrt(g / n) parts: a part holds as many rows as come from all parts together
        parts = F.ceil(F.sqrt(F.col("__size") / n)).cast("int")
        part = F.pmod(F.hash(F.monotonically_increasing_id()), parts)
        w = Window.partitionBy(*keys, "__part").orderBy(*_cols(order))
        df = sized.withColumn("__part", part).withColumn(rc, F.row_number().over(w)).filter(F.col(rc) <= n).select(*df.columns)
    w = Window.partitionBy(*_cols(by)).orderBy(*_cols(order))
    out = df.withColumn(rc, F.row_number().over(w)).filter(F.col(rc) <= n)
    return out if rank_col else out.drop(rc)


def latest_per_key(df: DataFrame, key: Sequence[str] | str, ts: str,
                   tie: Sequence[Column | str] = ()) -> DataFrame:
    """The newest row of every key (W3); NULL times lose, ``tie`` settles equal times."""
    return top_n_per_group(df, key, [F.col(ts).desc_nulls_last(), *_cols(tie)], 1)


def top_joined_per_key(left: DataFrame, right: DataFrame, key: str,
                       left_order: Sequence[Column | str],
                       right_order: Sequence[Column | str]) -> DataFrame:
    """Top row per key of ``left ⋈ right`` ordered by left's keys, then right's.

    Under such an order the best joined row is the best left row paired with
    the best right row, so each side is reduced to one row per key before the
    join and the m x n rows of a repeated key (D4) are never produced.
    """
    best_left = top_n_per_group(left, key, left_order, 1)
    best_right = top_n_per_group(right, key, right_order, 1)
    return best_left.join(best_right, key)


def rows_at_offset(df: DataFrame, order: Sequence[Column | str] | Column | str,
                   offset: int, n: int = 1) -> DataFrame:
    """``n`` rows after skipping ``offset`` rows of a total order.

    Builds an index for this one question when called (:mod:`postlytics.operators.offsets`); to ask for
    many offsets, build it once. No task holds ``offset`` rows, and offsets may exceed 32 bits.
    """
    if offset < 0 or n < 0:
        raise ValueError("offset and n must not be negative")
    rows = build_offset_index(df, order).rows([offset], n, "__offset")
    return rows.orderBy("__offset").select(*df.columns)


def dedupe_records(df: DataFrame, mode: str = "exact", key: str | None = None,
                   ts: str | None = None, tie: Sequence[Column | str] = ()) -> DataFrame:
    """Remove repeated records ahead of a join (the option of D4).

    ``exact`` drops rows identical in every column (an aggregate with a
    map-side combine, so a record repeated a million times costs one row per
    task); ``latest`` keeps the newest row per ``key`` by ``ts`` (ties by
    ``tie``) with the same per-task limit as :func:`top_n_per_group`.
    """
    if mode == "exact":
        return df.dropDuplicates()
    if mode == "latest":
        if key is None or ts is None:
            raise ValueError("mode='latest' needs key and ts")
        return latest_per_key(df, key, ts, tie)
    raise ValueError("mode must be 'exact' or 'latest'")
