"""Data profiles used ahead of a cast.

Profiles are ordinary aggregate queries returning DataFrames; nothing is
printed or collected, so a caller runs them only when it wants them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import digit_pattern
from ..sources.sampling import key_hash
from .rank import top_n_per_group


def pattern_profile(df: DataFrame, col: str, collapse_runs: bool = True,
                    out: str | None = None) -> DataFrame:
    """Rows per value shape: runs of digits (or single digits) become ``9``."""
    name = out or f"{col}_pattern"
    return df.groupBy(digit_pattern(col, collapse_runs).alias(name)) \
        .agg(F.count(F.lit(1)).alias("count"))


def crosstab_counts(df: DataFrame, cols: Sequence[Column | str]) -> DataFrame:
    """Rows per combination of columns or expressions."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("count"))


def random_order(df: DataFrame, key: Sequence[str] | str | None = None, seed: int = 0,
                 hash: str = "xxhash64") -> list[Column]:
    """A reproducible random order (W6, F10): by a hash of the row's unique key and a seed, so
    neither partitioning nor a repeated task changes it. Without a key the whole row counts."""
    cols = df.columns if key is None else [key] if isinstance(key, str) else list(key)
    text = F.col(cols[0]).cast("string") if len(cols) == 1 else F.to_json(F.struct(*cols))
    return [key_hash(text, seed, hash).asc_nulls_last(), text.asc_nulls_last()]


def sample_per_group(df: DataFrame, by: Sequence[str] | str, n: int = 5, seed: int = 0,
                     key: Sequence[str] | str | None = None, cols: Sequence[str] | None = None,
                     distinct: bool = True, rank_col: str | None = None, order_by: Sequence[Column | str] = (),
                     hash: str = "xxhash64") -> DataFrame:
    """Up to ``n`` random rows of every group (C6), optionally de-duplicated and ordered.

    The order within a group is :func:`random_order` of ``key`` and ``seed``; the
    per-group limit runs map-side, so a huge group costs ``n`` rows per task.
    """
    rc = rank_col or "__pick"
    picked = top_n_per_group(df, by, random_order(df, key, seed, hash), n, rank_col=rc)
    if cols is not None:
        picked = picked.select(*cols, *([rc] if rank_col else []))
    elif not rank_col:
        picked = picked.drop(rc)
    picked = picked.distinct() if distinct else picked
    return picked.orderBy(*order_by) if order_by else picked


def distinct_profile(df: DataFrame, col: str) -> DataFrame:
    """Every distinct value of ``col``, in value order, with their total count.

    Columns: ``value``, ``n_distinct``. The total is a scalar subquery, so
    no number travels through the driver.
    """
    values = df.select(F.col(col).alias("value")).distinct()
    total = values.agg(F.count(F.lit(1))).scalar()
    return values.select("value", total.alias("n_distinct")).orderBy(F.col("value").asc_nulls_last())


def load_profile(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and column count per entity (S2), one aggregate job per entity, unioned."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows"))
          .select(F.lit(name).alias("entity"), "rows", F.lit(len(df.columns)).alias("columns"))
        for name, df in frames.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def schema_profile(frames: Mapping[str, DataFrame]) -> DataFrame:
    """The schema of every entity with its load (S2): a row per column with its position, type, and
    the rows that hold a value. One aggregate job per entity, all columns in one pass."""
    parts = None
    for name, df in frames.items():
        counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(df.schema.fields)])
        listed = F.array(*[F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column"),
                                    F.lit(f.dataType.simpleString()).alias("type"), F.col(f"c{i}").alias("filled"))
                           for i, f in enumerate(df.schema.fields)])
        part = counts.select(F.lit(name).alias("entity"), F.explode(listed).alias("c")).select("entity", "c.*")
        parts = part if parts is None else parts.unionByName(part)
    return parts


def reject_counts(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Rows matching each named condition, in one pass (D3 reject counts).

    For rejects, pass conditions on the raw rows such as
    ``F.col('timestamp').isNotNull() & to_ts('timestamp').isNull()``.
    """
    aggs = [F.count_if(cond).alias(name) for name, cond in checks.items()]
    return df.agg(*aggs)
