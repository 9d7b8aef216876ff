from gaugeworks.streaming.commits import committed_batches, read_committed
from gaugeworks.streaming.flows import (
    compact_keys,
    deduplicated,
    enrich_messages,
    enriched_file_stream,
    keep_running,
    load_clean,
    rate,
    rows_processed,
    trigger_options,
)
from gaugeworks.streaming.keyed import load_clean_keyed

__all__ = [
    "committed_batches",
    "compact_keys",
    "deduplicated",
    "enrich_messages",
    "enriched_file_stream",
    "keep_running",
    "load_clean",
    "load_clean_keyed",
    "rate",
    "read_committed",
    "rows_processed",
    "trigger_options",
]
