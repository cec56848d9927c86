"""Column expressions shared by the reports (all built-in, JVM-side)."""

from dumpwise.functions.documents import document_id, grouped_datatype
from dumpwise.functions.epoch import ms_to_seconds, ms_to_timestamp, seconds_to_ms
from dumpwise.functions.lists import joined_field, sorted_pairs
from dumpwise.functions.paths import (
    deterministic_path,
    prefixed_path,
    protocol_prefix,
    scope_directory,
    url_path,
)

__all__ = [
    "deterministic_path", "document_id", "grouped_datatype", "joined_field", "ms_to_seconds",
    "ms_to_timestamp", "prefixed_path", "protocol_prefix", "scope_directory", "seconds_to_ms",
    "sorted_pairs", "url_path",
]
