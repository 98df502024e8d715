"""Entity tables from one query and one parse each.

A micro-batch is parsed once; its cleaned records and its rejects leave in one write, in folders
``kind=clean`` and ``kind=rejects`` of a new attempt::

    <root>/<entity>/data/batch=<id>/attempt=<a>/kind=clean/...
    <root>/<entity>/commits/<id>-<a>

The batch counts from the moment its commit file exists, which is created after the write.
A batch that was killed leaves an attempt without a commit, which no reader sees; a batch that Spark
repeats after its commit (the checkpoint lagged behind) finds the commit and writes nothing. So
every row is there once, with any store that creates a file in one step (``sources.commits``).
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.clean import CLEANERS
from ..schemas import CLEAN_SCHEMAS, SCHEMAS
from ..session import path_exists
from ..sources.commits import attempt_path, commit, committed, is_committed
from ..sources.messages import BAD_COL, UNREADABLE, decode_messages
from .sinks import has_started

CLEAN, REJECTS = "clean", "rejects"
REJECT_FIELDS = [StructField(n, StringType(), True) for n in ("entity", "reason", "payload")]


def parsed_once(messages: DataFrame, entity: str, payload: str = "value", **clean_options) -> DataFrame:
    """Cleaned columns, reject columns and ``kind`` of a message stream or table, from one parse.

    A readable record gives a ``clean`` row, a fault gives a ``rejects`` row (D15); a record with a
    value of the wrong type gives both. The columns of the other kind are NULL.
    """
    text = messages.select(F.col(payload).cast("string").alias("__payload"))
    flagged = decode_messages(text, SCHEMAS[entity], payload="__payload", on_bad="flag", keep=["__payload"])
    cleaned = CLEANERS[entity](flagged, keep=["__payload", BAD_COL], **clean_options)
    bad = F.col(BAD_COL)
    kinds = (F.when(bad.isNull(), F.array(F.lit(CLEAN))).when(bad == UNREADABLE, F.array(F.lit(REJECTS)))
             .otherwise(F.array(F.lit(CLEAN), F.lit(REJECTS))))
    rows = cleaned.withColumn("kind", F.explode(kinds))
    clean, reject = F.col("kind") == CLEAN, F.col("kind") == REJECTS
    return rows.select(*[F.when(clean, F.col(f.name)).alias(f.name) for f in CLEAN_SCHEMAS[entity].fields],
                       F.when(reject, F.lit(entity)).alias("entity"), F.when(reject, bad).alias("reason"),
                       F.when(reject, F.col("__payload")).alias("payload"), "kind")


def write_batch(rows: DataFrame, batch: int, table: str) -> bool:
    """Write and commit one batch; False if it was committed before. Streams call it, and so may a
    batch job with ids of its own."""
    spark = rows.sparkSession
    if is_committed(spark, table, batch):
        return False
    attempt = uuid.uuid4().hex
    rows.write.partitionBy("kind").parquet(attempt_path(table, batch, attempt))
    commit(spark, table, batch, attempt)
    return True


def run_entity_tables(spark: SparkSession, sources: Mapping[str, DataFrame], target_root: str,
                      trigger: Mapping[str, object] | None = None, payload: str = "value",
                      **clean_options) -> dict[str, StreamingQuery]:
    """One query per entity (K2): ``sources`` maps entity -> message stream; read the tables with
    :func:`read_entity_table`.

    Checkpoints lie in ``<target_root>/_checkpoints/<entity>``. A table with commits and no
    started checkpoint is refused: a new query would count its batches from 0 and find them committed.
    """
    root, queries = target_root.rstrip("/"), {}
    for entity, stream in sources.items():
        table, checkpoint = f"{root}/{entity}", f"{root}/_checkpoints/{entity}"
        if path_exists(spark, f"{table}/commits") and not has_started(spark, checkpoint):
            raise ValueError(f"{table} already holds a stream's output; its checkpoint {checkpoint} is missing")
        rows = parsed_once(stream, entity, payload, **clean_options)
        writer = (rows.writeStream.foreachBatch(lambda df, batch, table=table: write_batch(df, batch, table) and None)
                  .option("checkpointLocation", checkpoint).queryName(f"table_{entity}"))
        queries[entity] = (writer.trigger(**trigger) if trigger else writer).start()
    return queries


def read_entity_table(spark: SparkSession, target_root: str, entity: str, kind: str = CLEAN,
                      since: int = -1, upto: int | None = None) -> DataFrame:
    """Committed rows of one entity: its cleaned records, or with ``kind='rejects'`` its faulty
    messages as (entity, reason, payload). Only batches after ``since`` and up to ``upto`` are read."""
    if kind not in (CLEAN, REJECTS):
        raise ValueError("kind must be 'clean' or 'rejects'")
    table = f"{target_root.rstrip('/')}/{entity}"
    fields = REJECT_FIELDS if kind == REJECTS else CLEAN_SCHEMAS[entity].fields
    paths = [attempt_path(table, batch, attempt) for batch, attempt in committed(spark, table).items()
             if batch > since and (upto is None or batch <= upto)]
    names = [f.name for f in fields]
    if not paths:
        return spark.createDataFrame([], StructType(fields))
    schema = StructType([*CLEAN_SCHEMAS[entity].fields, *REJECT_FIELDS,
                         *[StructField(n, StringType(), True) for n in ("batch", "attempt", "kind")]])
    return (spark.read.schema(schema).option("basePath", f"{table}/data").parquet(*paths)
            .where(F.col("kind") == kind).select(*names))
