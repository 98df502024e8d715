"""Raw message schemas (S3) and the cleaned contracts.

Raw schemas use the stream typing: every field is text except the two
coordinates. Batch reads use the same schemas, so both flows see one typing and
the cleaning operators turn it into the contract with safe casts.
"""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType,
                               TimestampType)


def _text(*names: str) -> list[StructField]:
    return [StructField(n, StringType(), True) for n in names]


# Field names and types of the three message types.
POST_RAW = StructType(_text(
    "category", "description", "downloaded", "follower_count", "image_src",
    "index", "is_image_or_video", "poster_name", "save_location", "tag_list",
    "title", "unique_id"))

LOCATION_RAW = StructType(
    _text("country", "ind")
    + [StructField("latitude", DoubleType(), True),
       StructField("longitude", DoubleType(), True)]
    + _text("timestamp"))

USER_RAW = StructType(_text("age", "date_joined", "first_name", "ind", "last_name"))

SCHEMAS: dict[str, StructType] = {"pin": POST_RAW, "geo": LOCATION_RAW, "user": USER_RAW}

# Cleaned column order per entity.
POST_COLUMNS = ["ind", "unique_id", "title", "description", "follower_count",
                "poster_name", "tag_list", "is_image_or_video", "image_src",
                "save_location", "category"]
LOCATION_COLUMNS = ["ind", "country", "coordinates", "timestamp"]
USER_COLUMNS = ["ind", "user_name", "age", "date_joined"]

POST_CLEAN = StructType(
    [StructField("ind", LongType(), True)]
    + _text("unique_id", "title", "description")
    + [StructField("follower_count", LongType(), True)]
    + _text("poster_name", "tag_list", "is_image_or_video", "image_src",
            "save_location", "category"))

LOCATION_CLEAN = StructType([
    StructField("ind", LongType(), True),
    StructField("country", StringType(), True),
    StructField("coordinates", ArrayType(DoubleType(), True), False),
    StructField("timestamp", TimestampType(), True),
])

USER_CLEAN = StructType([
    StructField("ind", LongType(), True),
    StructField("user_name", StringType(), False),
    StructField("age", IntegerType(), True),
    StructField("date_joined", TimestampType(), True),
])

CLEAN_SCHEMAS: dict[str, StructType] = {
    "pin": POST_CLEAN, "geo": LOCATION_CLEAN, "user": USER_CLEAN}
