from .parse import parse_events, tag_events, with_stream_metadata
from .windows import tumbling, sliding, funnel, session_windows, dedupe_events
from .sinks import (start_bronze_stream, start_debug_stream, start_mart_stream, start_memory_stream, start_upsert_stream,
                    stream_progress)

__all__ = ["parse_events", "tag_events", "with_stream_metadata", "tumbling", "sliding", "funnel",
           "session_windows", "dedupe_events", "start_bronze_stream", "start_debug_stream",
           "start_mart_stream", "start_memory_stream", "start_upsert_stream", "stream_progress"]
