"""SQL over DataFrames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def sql_over(spark: SparkSession, frames: Mapping[str, DataFrame], text: str) -> DataFrame:
    """Run SQL whose ``{name}`` placeholders refer to the given frames (write a literal
    brace twice). The views Spark makes for them are gone when this returns."""
    return spark.sql(text, **frames)
