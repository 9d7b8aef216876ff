from gaugeworks.sources.files import (
    count_lines,
    decode_events,
    flatten_payload,
    read_inventory,
    read_json_lines,
    split_corrupt,
)
from gaugeworks.sources.streams import json_file_stream, kafka_stream
from gaugeworks.sources.tables import scan_table

__all__ = [
    "count_lines",
    "decode_events",
    "flatten_payload",
    "json_file_stream",
    "kafka_stream",
    "read_inventory",
    "read_json_lines",
    "scan_table",
    "split_corrupt",
]
