"""Structured Streaming: message sources, landing, cleaning on streams, append sinks, entity tables."""

from .landing import land_stream, read_landed_stream
from .sinks import (append_stream, clean_stream, read_messages_stream, reject_stream,
                    run_entity_streams)
from .state import (BEST_POST, LATEST_LOCATION, best_per_key, distinct_messages, read_best_per_key,
                    run_best_per_key)
from .tables import parsed_once, read_entity_table, run_entity_tables, write_batch

__all__ = ["BEST_POST", "LATEST_LOCATION", "append_stream", "best_per_key", "clean_stream", "distinct_messages", "land_stream",
           "parsed_once", "read_best_per_key", "read_entity_table", "read_landed_stream", "read_messages_stream", "reject_stream",
           "run_best_per_key", "run_entity_streams", "run_entity_tables", "write_batch"]
