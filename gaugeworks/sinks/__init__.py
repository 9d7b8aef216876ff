from gaugeworks.sinks.buckets import create_buckets, read_buckets, remove_unused, upsert_buckets
from gaugeworks.sinks.files import (
    export_latest,
    land_snapshot,
    publish_messages,
    read_report,
    write_clean,
    write_json_lines,
    write_report,
)
from gaugeworks.sinks.publish import publish, published_runs, read_published
from gaugeworks.sinks.tables import append_rows

__all__ = [
    "append_rows",
    "create_buckets",
    "export_latest",
    "land_snapshot",
    "publish",
    "publish_messages",
    "published_runs",
    "read_buckets",
    "read_published",
    "read_report",
    "remove_unused",
    "upsert_buckets",
    "write_clean",
    "write_json_lines",
    "write_report",
]
