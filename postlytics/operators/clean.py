"""Cleaning operators (C1, C2, C7, C8, C10-C17) and the three entity chains.

Each chain is a single ``select`` of built-in expressions, so batch and
streaming DataFrames go through the same function objects and Catalyst can
prune any column the caller does not use.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType, TimestampType

from ..functions import (DEFAULT_AGE_BANDS, MESSAGE_TS_FORMAT, DEFAULT_ERROR_VALUES, DEFAULT_SUFFIXES, age_band,
                         join_names, parse_count, to_ts, without_prefix)

# Fixed value: the text in front of every save location.
SAVE_LOCATION_PREFIX = "Local save in "


def sql_ident(name: str) -> str:
    """A column name quoted for Spark SQL text."""
    return "`" + name.replace("`", "``") + "`"


def sql_text(value: str) -> str:
    """A string literal for Spark SQL text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def null_placeholders(df: DataFrame, values: Iterable[str] = ("",), nan: bool = True,
                      cols: Sequence[str] | None = None) -> DataFrame:
    """Turn placeholder text (default: empty text) and NaN into NULL.

    Only text columns are compared with ``values`` and only floating columns
    with NaN, like ``DataFrame.replace``; the text ``'NaN'`` stays unless it
    is listed in ``values``. One projection, written as SQL text.
    """
    targets = set(df.columns if cols is None else cols)
    texts = ", ".join(sql_text(v) for v in values)
    exprs = []
    for field in df.schema.fields:
        c = sql_ident(field.name)
        expr = c
        if field.name in targets:
            if texts and isinstance(field.dataType, StringType):
                expr = f"CASE WHEN {c} IN ({texts}) THEN NULL ELSE {c} END"
            elif nan and isinstance(field.dataType, (DoubleType, FloatType)):
                expr = f"CASE WHEN isnan({c}) THEN NULL ELSE {c} END"
        exprs.append(f"{expr} AS {c}")
    return df.selectExpr(*exprs)


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Safe casts: values that do not convert become NULL."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def strip_prefix(df: DataFrame, col: str, prefix: str = SAVE_LOCATION_PREFIX) -> DataFrame:
    """Remove a literal prefix at the start of ``col``."""
    return df.withColumn(col, without_prefix(col, prefix))


def pack_coordinates(df: DataFrame, lat: str = "latitude", lon: str = "longitude",
                     out: str = "coordinates", drop: bool = True) -> DataFrame:
    """``[lat, lon]`` as one array column (C10); NULL parts stay NULL inside the array."""
    df = df.withColumn(out, F.array(F.col(lat).cast("double"), F.col(lon).cast("double")))
    return df.drop(lat, lon) if drop else df


def _as_timestamp(df: DataFrame, col: str, fmt: str | None):
    if isinstance(df.schema[col].dataType, TimestampType):
        return F.col(col)
    return to_ts(col, fmt)


def parse_timestamp(df: DataFrame, col: str, fmt: str | None = MESSAGE_TS_FORMAT,
                    out: str | None = None) -> DataFrame:
    """Text to timestamp; text of another pattern becomes NULL (C11, D3). ``fmt`` as in
    :func:`postlytics.functions.to_ts`."""
    return df.withColumn(out or col, _as_timestamp(df, col, fmt))


def combine_names(df: DataFrame, first: str = "first_name", last: str = "last_name",
                  out: str = "user_name", drop: bool = True) -> DataFrame:
    """Join two name columns with whitespace normalised."""
    df = df.withColumn(out, join_names(first, last))
    return df.drop(first, last) if drop else df


def with_age_group(df: DataFrame, age: str = "age", out: str = "age_group",
                   bands=DEFAULT_AGE_BANDS) -> DataFrame:
    """Age band label column."""
    return df.withColumn(out, age_band(age, bands))


def with_year(df: DataFrame, ts: str, out: str) -> DataFrame:
    """Calendar year of a timestamp in the session time zone."""
    return df.withColumn(out, F.year(ts))


def clean_posts(df: DataFrame, count_mode: str = "digits", placeholders: Iterable[str] = ("",),
                suffixes: Mapping[str, int] = DEFAULT_SUFFIXES,
                error_values: Iterable[str] = DEFAULT_ERROR_VALUES,
                prefix: str = SAVE_LOCATION_PREFIX, keep: Sequence[str] = ()) -> DataFrame:
    """Raw post records to the post contract (C13); ``keep`` lists input columns carried along as they are.

    Placeholders to NULL, follower counts parsed, ``index`` cast and renamed
    ``ind``, save-location prefix removed, fixed column order. ``downloaded``
    is not part of the contract and is never read.
    """
    df = null_placeholders(df, placeholders, cols=[c for c in df.columns if c not in keep])
    return df.select(
        F.col("index").try_cast("bigint").alias("ind"),
        "unique_id", "title", "description",
        parse_count("follower_count", suffixes, error_values, count_mode).alias("follower_count"),
        "poster_name", "tag_list", "is_image_or_video", "image_src",
        without_prefix("save_location", prefix).alias("save_location"),
        "category", *keep,
    )


def clean_locations(df: DataFrame, ts_format: str | None = MESSAGE_TS_FORMAT, keep: Sequence[str] = ()) -> DataFrame:
    """Raw location records to the location contract (C14); ``ts_format`` as in
    :func:`postlytics.functions.to_ts` (default: the message format only), ``keep`` as in :func:`clean_posts`."""
    return df.select(
        F.col("ind").try_cast("bigint").alias("ind"),
        "country",
        F.array(F.col("latitude").cast("double"), F.col("longitude").cast("double")).alias("coordinates"),
        _as_timestamp(df, "timestamp", ts_format).alias("timestamp"), *keep,
    )


def clean_users(df: DataFrame, ts_format: str | None = MESSAGE_TS_FORMAT, keep: Sequence[str] = ()) -> DataFrame:
    """Raw user records to the user contract (C15); ``ts_format`` as in
    :func:`postlytics.functions.to_ts` (default: the message format only), ``keep`` as in :func:`clean_posts`."""
    return df.select(
        F.col("ind").try_cast("bigint").alias("ind"),
        join_names("first_name", "last_name").alias("user_name"),
        F.col("age").try_cast("int").alias("age"),
        _as_timestamp(df, "date_joined", ts_format).alias("date_joined"), *keep,
    )


CLEANERS = {"pin": clean_posts, "geo": clean_locations, "user": clean_users}
