"""Streams with state: the latest row per key (W3, J3) and repeated messages.

Windows don't run on streams, so the latest row per key is a streaming aggregate: the state store
holds one row per key, its best so far, and a batch hands over the keys it touched. Rows may come
late or repeatedly, in any order; the best of what has come is the same. The batches are committed by id
(``sources.commits``), and the table's reader takes the best row per key again.

Repeated messages are dropped by Spark's watermark-bounded state: a message is remembered for
``delay`` after its event time and then forgotten, so state doesn't grow with the stream.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.rank import top_n_per_group
from ..session import path_exists
from ..sources.commits import attempt_path, commit, committed, is_committed
from .sinks import has_started

Order = Sequence[tuple[str, bool]]  # (column, descending)

# The orders of the questions (D6): newest location, then the smaller country; most followers, then the smaller name.
LATEST_LOCATION: Order = (("timestamp", True), ("country", False))
BEST_POST: Order = (("follower_count", True), ("poster_name", False))


def _columns(order: Order) -> list[Column]:
    return [F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in order]


def best_per_key(rows: DataFrame, key: str, order: Order) -> DataFrame:
    """The row of each key that comes first under ``order`` (ascending or descending, NULL last): one
    aggregate, so it runs on streams (output mode ``update``) and combines map-side in batches.

    Columns outside ``key`` and ``order`` would be ambiguous on ties and are not kept.
    """
    def part(name: str, down: bool) -> list[Column]:
        c = F.col(name)
        return [c.isNull().alias(f"{name}__none"), (_reversed(rows.schema, name) if down else c).alias(name)]
    fields = [x for name, down in order for x in part(name, down)]
    best = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*fields)).alias("__best"))
    return best.select(key, *[_restored(rows.schema, name, F.col(f"__best.{name}")) if down else F.col(f"__best.{name}").alias(name)
                              for name, down in order])


def _reversed(schema: StructType, name: str) -> Column:
    kind = schema[name].dataType.simpleString()
    if kind == "timestamp":
        return F.bitwise_not(F.unix_micros(name))
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.bitwise_not(F.col(name).cast("bigint"))  # ~x falls as x grows and never overflows
    raise ValueError(f"{name} is {kind}; a descending column must be a whole number or a timestamp")


def _restored(schema: StructType, name: str, value: Column) -> Column:
    back = F.bitwise_not(value)
    back = F.timestamp_micros(back) if schema[name].dataType.simpleString() == "timestamp" else back
    return back.cast(schema[name].dataType).alias(name)


def run_best_per_key(rows: DataFrame, key: str, order: Order, table: str, checkpoint: str,
                     trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """Keep a table of each key's best row up to date from a stream (W3); read it with
    :func:`read_best_per_key`. The state store is the session's (RocksDB for many keys)."""
    spark = rows.sparkSession
    if path_exists(spark, f"{table}/commits") and not has_started(spark, checkpoint):
        raise ValueError(f"{table} already holds a stream's output; its checkpoint {checkpoint} is missing")

    def write(df: DataFrame, batch: int) -> None:
        if not is_committed(df.sparkSession, table, batch):
            attempt = uuid.uuid4().hex
            df.write.parquet(attempt_path(table, batch, attempt))
            commit(df.sparkSession, table, batch, attempt)

    writer = best_per_key(rows, key, order).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def read_best_per_key(spark: SparkSession, table: str, key: str, order: Order, schema: StructType) -> DataFrame:
    """The best row per key of everything committed; ``schema`` is that of the streamed rows."""
    fields = StructType([schema[key], *[schema[c] for c, _ in order]])
    paths = [attempt_path(table, batch, attempt) for batch, attempt in committed(spark, table).items()]
    if not paths:
        return spark.createDataFrame([], fields)
    return top_n_per_group(spark.read.schema(fields).parquet(*paths), key, _columns(order))


def distinct_messages(messages: DataFrame, by: Sequence[str] = ("value",), event_time: Column | str | None = None,
                      delay: str = "1 day") -> DataFrame:
    """Messages without repeats of ``by`` (D4), across batches and restarts, as long as a repeat's event time
    lies within ``delay`` of the first one's.

    ``event_time`` is a broker's message time; without it the batch's clock counts. The query that
    writes the result must keep one checkpoint, which holds the state.
    """
    at = F.current_timestamp() if event_time is None else F.col(event_time) if isinstance(event_time, str) else event_time
    timed = messages.withColumn("__at", at.cast("timestamp")).withWatermark("__at", delay)
    return timed.dropDuplicatesWithinWatermark(list(by)).drop("__at")
