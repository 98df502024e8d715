"""Message encoding and decoding (K4-K6, S6) and topic landing (K3).

Messages are rows ``(topic, key, value)`` whose ``value`` holds one JSON
record. The same functions work on batch and streaming DataFrames.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType

from ..functions import MESSAGE_TS_FORMAT

from ..session import path_exists
from .sampling import key_hash

CORRUPT_COL = "_corrupt_record"
BAD_COL = "_bad"
UNREADABLE, WRONG_TYPE = "unreadable", "wrong type"


def encode_messages(df: DataFrame, topic: str | Column | None = None, key: str | Column | None = None,
                    ts_format: str = MESSAGE_TS_FORMAT, keep_nulls: bool = True,
                    cols: Sequence[str] | None = None) -> DataFrame:
    """Rows as JSON messages ``(topic, key, value)`` (K4, K5).

    Timestamps are written as ``ts_format`` text; NULL fields are kept as
    JSON ``null`` unless ``keep_nulls`` is False.
    """
    fields = list(cols) if cols is not None else df.columns
    options = {"timestampFormat": ts_format, "ignoreNullFields": "false" if keep_nulls else "true"}
    value = F.to_json(F.struct(*[F.col(f"`{c}`") for c in fields]), options)

    def as_text(c):
        if c is None:
            return F.lit(None).cast("string")
        if isinstance(c, str):
            return F.col(c).cast("string")
        return c.cast("string")

    topic_col = F.lit(topic) if isinstance(topic, str) else as_text(topic)
    return df.select(topic_col.alias("topic"), as_text(key).alias("key"), value.alias("value"))


def decode_messages(df: DataFrame, schema: StructType, payload: str = "value",
                    on_bad: str = "keep", keep: Sequence[str] = (),
                    options: Mapping[str, str] | None = None) -> DataFrame:
    """Parse the JSON payload into one column per schema field.

    Binary payloads are read as UTF-8 text. A payload is *unreadable* when it is NULL
    or no JSON object; a readable one may hold values of the *wrong type*, which become
    NULL while its other fields stay (D15). ``on_bad``: ``'keep'`` (default) loses
    nothing, unreadable payloads are rows of NULLs; ``'readable'`` keeps every
    readable record; ``'drop'`` keeps only records without any fault; ``'flag'`` keeps all
    and adds ``_bad`` (NULL, ``'unreadable'`` or ``'wrong type'``), see
    :func:`reject_messages`. ``keep`` lists input columns carried along (e.g.
    ``topic``). ``options`` go to the JSON parser (timestamps default to the message format).
    """
    if on_bad not in ("drop", "keep", "readable", "flag"):
        raise ValueError("on_bad must be 'drop', 'keep', 'readable' or 'flag'")
    parse_schema = StructType(list(schema.fields) + [StructField(CORRUPT_COL, StringType(), True)])
    text = F.col(payload).cast("string")
    parse_options = {"timestampFormat": MESSAGE_TS_FORMAT, **(options or {}),
                     "columnNameOfCorruptRecord": CORRUPT_COL}
    rec = F.from_json(text, parse_schema, parse_options)
    parsed = df.select(*keep, rec.alias("__rec"))
    corrupt = F.col(f"__rec.{CORRUPT_COL}")
    fields = [F.col(f"__rec.`{f.name}`").alias(f.name) for f in schema.fields]
    if on_bad == "keep":
        return parsed.select(*keep, *fields)
    faulty = F.col("__rec").isNull() | corrupt.isNotNull()
    if on_bad == "drop":
        return parsed.filter(~faulty).select(*keep, *fields)
    # only faulty payloads are looked at a second time
    is_object = F.coalesce(F.ltrim(F.get_json_object(corrupt, "$")).startswith("{"), F.lit(False))
    if on_bad == "readable":
        return parsed.filter(~faulty | is_object).select(*keep, *fields)
    bad = F.when(faulty, F.when(is_object, F.lit(WRONG_TYPE)).otherwise(F.lit(UNREADABLE)))
    return parsed.select(*keep, *fields, bad.alias(BAD_COL))


def reject_messages(df: DataFrame, schema: StructType, payload: str = "value", entity: str | None = None,
                    keep: Sequence[str] = (), options: Mapping[str, str] | None = None) -> DataFrame:
    """Payloads with a fault, as ``(entity, reason, payload)`` (D15): unreadable ones, which give
    no record, and those with a value of the wrong type, whose record keeps its other fields."""
    text = df.withColumn("__payload", F.col(payload).cast("string"))
    flagged = decode_messages(text, schema, payload="__payload", on_bad="flag", keep=[*keep, "__payload"], options=options)
    return flagged.filter(F.col(BAD_COL).isNotNull()).select(
        *keep, F.lit(entity).cast("string").alias("entity"), F.col(BAD_COL).alias("reason"), F.col("__payload").alias("payload"))


def assign_shard(df: DataFrame, key: str | Column, n: int, out: str = "shard",
                 hash: str = "xxhash64") -> DataFrame:
    """Deterministic shard number in ``[0, n)`` from a key hash (K6): one key, one shard.
    ``hash`` as in :func:`postlytics.sources.sampling.key_hash`."""
    return df.withColumn(out, shard_of(key, n, hash))


def shard_of(key: str | Column, n: int, hash: str = "xxhash64") -> Column:
    """The shard of a key's text in ``[0, n)``; the one rule for messages, files and readers."""
    if n < 1:
        raise ValueError("n must be at least 1")
    return F.pmod(key_hash(key, 0, hash), F.lit(n)).cast("int")


def landing_rows(messages: DataFrame, partitions: int = 1, hash: str = "xxhash64") -> DataFrame:
    """(value, topic, partition) rows of a landing, batch or streaming: ``partition`` is the message key's
    :func:`shard_of` (K6), 0 for messages without a key."""
    shard = F.when(F.col("key").isNull(), F.lit(0)).otherwise(shard_of("key", partitions, hash))
    return messages.select("value", "topic", shard.alias("partition"))


def stream_landed(spark, root: str) -> bool:
    """Whether a stream lands topics under ``root``: its commit log then says which files count."""
    return path_exists(spark, f"{root.rstrip('/')}/topics/_spark_metadata")


def land_topics(messages: DataFrame, root: str, partitions: int = 1, mode: str = "append",
                hash: str = "xxhash64") -> None:
    """Write messages as JSON-lines files under ``<root>/topics/topic=<t>/partition=<p>/`` (K3).

    Folders as in :func:`landing_rows`. One distributed write: every task writes its own rows into the
    folders they belong to, so a topic holding most messages is still spread
    over all tasks. A root that a stream lands in (``streaming.land_stream``) is refused: its
    readers would not see files beside the stream's commit log.
    """
    if stream_landed(messages.sparkSession, root):
        raise ValueError(f"{root} is landed by a stream; land batches under another root")
    (landing_rows(messages, partitions, hash)
     .write.mode(mode).partitionBy("topic", "partition").text(f"{root.rstrip('/')}/topics"))
