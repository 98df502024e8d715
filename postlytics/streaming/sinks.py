"""Streaming sources and sinks.

The cleaning chains are plain projections, so a streaming DataFrame goes
through exactly the functions a batch one does; these helpers only add the
stream source, the append sink and durable checkpoints.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.clean import CLEANERS
from ..schemas import SCHEMAS
from ..session import path_exists
from ..sources.messages import decode_messages, reject_messages


def read_messages_stream(spark: SparkSession, source_format: str = "text", path: str | None = None,
                         options: Mapping[str, str] | None = None,
                         schema: StructType | None = None) -> DataFrame:
    """An unbounded message table.

    ``source_format`` is any streaming source: ``text`` or ``json`` folders
    (each new file is new input), or a broker connector such as ``kafka``
    when its package is on the class path, with options like
    ``subscribe`` and ``startingOffsets=earliest`` set here on the reader
    (D10). File sources always start from the earliest file.
    """
    reader = spark.readStream.format(source_format)
    if options:
        reader = reader.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def has_started(spark: SparkSession, checkpoint: str) -> bool:
    """Whether a query has planned a batch with this checkpoint, finished or not."""
    return path_exists(spark, f"{checkpoint.rstrip('/')}/offsets")


def append_stream(df: DataFrame, path: str | None = None, checkpoint: str | None = None,
                  table: str | None = None, sink_format: str = "parquet",
                  trigger: Mapping[str, object] | None = None,
                  query_name: str | None = None, partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Append a stream to a folder or a catalog table with a durable checkpoint.

    ``checkpoint`` is required and must live on storage that outlives the
    job (D9). A fresh checkpoint on a folder that already holds a file-sink
    log is refused: the sink would skip batch ids it has committed before and
    silently drop the new rows. So is one on a table that already has rows, to which the stream would
    append its whole input again. ``trigger`` defaults to continuous
    micro-batches; pass ``{'availableNow': True}`` for catch-up runs. ``partition_by`` names folder columns.
    """
    if not checkpoint:
        raise ValueError("a durable checkpoint location is required")
    if (path is None) == (table is None):
        raise ValueError("give exactly one of path or table")
    spark = df.sparkSession
    if not has_started(spark, checkpoint):
        if path is not None and path_exists(spark, f"{path.rstrip('/')}/_spark_metadata"):
            raise ValueError(f"{path} already holds a stream's output; reuse its checkpoint "
                             f"instead of starting a new one")
        if table is not None and spark.catalog.tableExists(table) and not spark.table(table).isEmpty():
            raise ValueError(f"table {table} already has rows; reuse its stream's checkpoint or name a new table")
    writer = (df.writeStream.format(sink_format).outputMode("append")
              .option("checkpointLocation", checkpoint))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if trigger:
        writer = writer.trigger(**trigger)
    if query_name:
        writer = writer.queryName(query_name)
    if table is not None:
        return writer.toTable(table)
    return writer.start(path)


def clean_stream(messages: DataFrame, entity: str, payload: str = "value",
                 on_bad: str = "readable", **clean_options) -> DataFrame:
    """Decode one entity's messages and clean them with the batch chain (T2): every
    readable record, fields of a wrong type as NULL (see :func:`reject_stream`)."""
    records = decode_messages(messages, SCHEMAS[entity], payload=payload, on_bad=on_bad)
    return CLEANERS[entity](records, **clean_options)


def reject_stream(messages: DataFrame, entity: str, payload: str = "value") -> DataFrame:
    """Messages of one entity with a fault (D15): entity, reason, raw payload text."""
    return reject_messages(messages, SCHEMAS[entity], payload, entity)


def run_entity_streams(spark: SparkSession, sources: Mapping[str, DataFrame], target_root: str,
                       sink_format: str = "parquet", trigger: Mapping[str, object] | None = None,
                       payload: str = "value", rejects: bool = True) -> dict[str, StreamingQuery]:
    """Plain file sinks (K2): ``sources`` maps entity -> message stream. See
    :func:`postlytics.streaming.run_entity_tables` for one query per entity and one parse.

    Tables go to ``<target_root>/<entity>``, checkpoints to
    ``<target_root>/_checkpoints/<entity>``. A second query per entity appends
    messages with a fault to ``<target_root>/_rejects/<entity>`` (switch it off with
    ``rejects=False``; the reference appends unreadable ones as empty rows instead). The reject query reads
    and parses the source a second time; in exchange each output is a folder that any
    reader takes with the file sink's own log. Queries run concurrently; the caller waits with
    ``awaitTermination`` or ``spark.streams.awaitAnyTermination``.
    """
    root = target_root.rstrip("/")
    queries = {}
    for entity, stream in sources.items():
        queries[entity] = append_stream(
            clean_stream(stream, entity, payload=payload), path=f"{root}/{entity}",
            checkpoint=f"{root}/_checkpoints/{entity}", sink_format=sink_format, trigger=trigger,
            query_name=f"clean_{entity}")
        if rejects:
            queries[f"{entity}_rejects"] = append_stream(
                reject_stream(stream, entity, payload), path=f"{root}/_rejects/{entity}",
                checkpoint=f"{root}/_checkpoints/{entity}_rejects", sink_format=sink_format,
                trigger=trigger, query_name=f"rejects_{entity}")
    return queries
