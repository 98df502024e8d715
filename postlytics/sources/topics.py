"""Readers for landed topics and delimited files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .messages import decode_messages, reject_messages, stream_landed


def topic_path(root: str, topic: str, layout: str = "hive") -> str:
    """Folder of one topic: ``topics/topic=<t>`` (ours) or ``topics/<t>`` (connector layout)."""
    base = f"{root.rstrip('/')}/topics"
    if layout == "hive":
        return f"{base}/topic={topic}"
    if layout == "connector":
        return f"{base}/{topic}"
    raise ValueError("layout must be 'hive' or 'connector'")


def topic_lines(spark: SparkSession, root: str, topic: str, layout: str = "hive") -> DataFrame:
    """Lines of one topic as ``value`` with the ``partition`` folder where there is one.

    A root that a stream lands in is read through the stream's commit log, which leaves out files of
    a batch that was killed; its folder filter prunes the other topics.
    """
    if layout == "hive" and stream_landed(spark, root):
        return select_topics(read_landed(spark, root), "^" + re.escape(topic) + "$").drop("topic")
    return spark.read.text(topic_path(root, topic, layout))


def read_topic(spark: SparkSession, root: str, topic: str, schema: StructType | None = None,
               layout: str = "hive") -> DataFrame:
    """All JSON records of one topic, every partition folder included.

    With ``schema`` a line is decoded as a stream decodes a message: no inference pass,
    fields of a wrong type are NULL, and unreadable lines give no row (both are in
    :func:`topic_rejects`). Without, Spark infers the schema from all lines.
    """
    if schema is not None:
        return decode_messages(topic_lines(spark, root, topic, layout), schema, on_bad="readable")
    if layout == "hive" and stream_landed(spark, root):
        raise ValueError("a topic landed by a stream is read with a schema")
    df = spark.read.json(topic_path(root, topic, layout))
    return df.select(*[c for c in df.columns if c != "partition"])


def topic_rejects(spark: SparkSession, root: str, topic: str, schema: StructType, layout: str = "hive") -> DataFrame:
    """Lines of one topic with a fault, as ``(entity, reason, payload)``."""
    return reject_messages(topic_lines(spark, root, topic, layout), schema, entity=topic)


def read_landed(spark: SparkSession, root: str) -> DataFrame:
    """Every landed message as ``(value, topic, partition)`` text rows (K3 read back)."""
    return spark.read.text(f"{root.rstrip('/')}/topics")


def select_topics(df: DataFrame, pattern: str, col: str = "topic") -> DataFrame:
    """Messages whose topic matches a regular expression (S9). On landed
    files ``topic`` is a folder column, so the filter prunes folders."""
    return df.filter(F.col(col).rlike(pattern))


# Blanks, quotes, line breaks and empty text survive a write and a read: quotes are doubled,
# empty text is written as "", and a missing value as its own mark.
_DELIMITED = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
              "nullValue": "\\N"}


def read_delimited(spark: SparkSession, path: str, sep: str = ",", header: bool = True,
                   schema: StructType | str | None = None, multi_line: bool = True, **options: str) -> DataFrame:
    """Delimited text with a header row and a separator (S4); give ``schema``
    to skip the inference pass.

    ``multi_line`` allows line breaks inside quotes, at the price that one file is read
    by one task; switch it off for large files without them. ``options`` (``quote``,
    ``escape``, ``nullValue``, ``mode``, ...) go to the reader.
    """
    reader = (spark.read.options(**{**_DELIMITED, "emptyValue": "", **options})
              .option("header", header).option("sep", sep).option("multiLine", multi_line))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def write_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = True,
                    mode: str = "overwrite", **options: str) -> None:
    """Delimited text with a header row (the counterpart of :func:`read_delimited`)."""
    (df.write.mode(mode).options(**{**_DELIMITED, "emptyValue": '""', **options})
     .option("header", header).option("sep", sep).csv(path))


def compact_topic(spark: SparkSession, root: str, topic: str, out_root: str,
                  layout: str = "hive", mode: str = "overwrite") -> str:
    """Rewrite one topic's many small files under ``<out_root>/topics/topic=<t>/`` (the
    landing writes one file per record in the reference). Returns the new topic folder.

    Adaptive execution rebalances the lines by partition folder: small folders share a task,
    large ones are split, so files hold about
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` whatever the topic's size.
    """
    out = topic_path(out_root, topic, "hive")
    (topic_lines(spark, root, topic, layout)
     .hint("rebalance", "partition")
     .write.mode(mode).partitionBy("partition").text(out))
    return out
