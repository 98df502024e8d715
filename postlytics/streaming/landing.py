"""Topic landing on streams (K3): the partitioned file sink and its reader.

``land_stream`` writes a message stream to the same folders as the batch landing
(``topics/topic=<t>/partition=<p>/``), as Spark's file sink with its commit log: files of a batch
that was killed are not in the log, so readers that go through it (``read_topic``,
``topic_rejects``, ``read_landed``, ``read_landed_stream``) see every message once, also after a
restart. Each task writes its own rows into the folders they belong to; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..session import path_exists
from ..sources.messages import landing_rows, stream_landed
from ..sources.topics import select_topics
from .sinks import append_stream, has_started, read_messages_stream


def land_stream(messages: DataFrame, root: str, checkpoint: str, partitions: int = 1, hash: str = "xxhash64",
                trigger: Mapping[str, object] | None = None, query_name: str | None = None) -> StreamingQuery:
    """Append a stream of messages (topic, key, value) to the landing under ``root``.

    A root with files that a batch landed is refused: readers follow the stream's log and
    would not see them.
    """
    spark, topics = messages.sparkSession, f"{root.rstrip('/')}/topics"
    if not stream_landed(spark, root) and not has_started(spark, checkpoint) and path_exists(spark, topics):
        raise ValueError(f"{root} holds topics landed by a batch; land the stream under another root")
    return append_stream(landing_rows(messages, partitions, hash), path=topics, checkpoint=checkpoint, sink_format="text",
                         trigger=trigger, query_name=query_name, partition_by=["topic", "partition"])


def read_landed_stream(spark: SparkSession, root: str, pattern: str,
                       options: Mapping[str, str] | None = None) -> DataFrame:
    """Messages (value, topic, partition) of the topics that match ``pattern`` as a stream (S5, S9): new files
    of the landing, committed ones only where a stream lands them."""
    return select_topics(read_messages_stream(spark, "text", f"{root.rstrip('/')}/topics", options), pattern)
