from maskwright.streaming.streams import (
    distinct_pairs,
    start_routing,
    start_routing_files,
    start_writing,
    stream_files,
    stream_lines,
    stream_records,
)

__all__ = [
    "distinct_pairs",
    "start_routing",
    "start_routing_files",
    "start_writing",
    "stream_files",
    "stream_lines",
    "stream_records",
]
