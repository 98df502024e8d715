"""Sources: driver-table bindings, landed topics, messages, sampling."""

from .bindings import raw_entities, raw_locations, raw_posts, raw_users, read_table
from .messages import (BAD_COL, assign_shard, decode_messages, encode_messages, land_topics, landing_rows, reject_messages,
                       shard_of, stream_landed)
from .sampling import key_bucket, sample_aligned, sample_keys
from .views import sql_over
from .topics import (compact_topic, read_delimited, read_landed, read_topic, select_topics, topic_lines, topic_path,
                     topic_rejects, write_delimited)

__all__ = [
    "BAD_COL", "compact_topic", "assign_shard", "decode_messages", "encode_messages", "key_bucket", "land_topics", "landing_rows",
    "raw_entities", "raw_locations", "raw_posts", "raw_users", "read_delimited", "read_landed",
    "read_table", "read_topic", "reject_messages", "sample_aligned", "sample_keys", "shard_of", "stream_landed",
    "topic_rejects", "select_topics", "sql_over", "topic_lines", "topic_path", "write_delimited",
]
