"""Incremental table sync on Spark: bounded reads, exact types, last row per key, append, replace and merge."""

from tablesync.errors import SyncError
from tablesync.functions.nested import (
    decode_staged, encode_exact, interval_text, parse_nested, project_declared, to_json_text, widen_nested,
)
from tablesync.functions.redact import redact, redact_text
from tablesync.functions.types import classify, describe_dataset, normalize_for_write, target_ddl
from tablesync.operators.dedup import dedup_last, with_sequence
from tablesync.operators.merge import merge_frame, merge_into, merge_preview, missing_columns
from tablesync.session import build_session
from tablesync.sinks.target import clean_versions, drop_target, find_target
from tablesync.sinks.write import StagedWrite, append, compact, ensure_target, merge, replace, write
from tablesync.sources.names import quote, resolve_entity
from tablesync.sources.read import (
    Window, incremental, partition_counts, read_dataset, read_path, read_query, read_staged, read_table, shape_read, split_counts,
)
from tablesync.streaming.stream import stream_append, stream_merge

__all__ = [
    "StagedWrite", "SyncError", "Window", "append", "build_session", "classify", "clean_versions", "compact", "decode_staged",
    "dedup_last", "describe_dataset", "drop_target", "encode_exact", "ensure_target", "find_target", "incremental", "interval_text",
    "merge", "merge_frame", "merge_into", "merge_preview", "missing_columns", "normalize_for_write", "parse_nested",
    "partition_counts", "project_declared", "quote", "read_dataset", "read_path", "read_query", "read_staged",
    "read_table", "redact", "redact_text", "replace", "resolve_entity", "shape_read", "split_counts", "stream_append", "stream_merge",
    "target_ddl", "to_json_text", "widen_nested", "with_sequence", "write",
]
