"""Sources and sinks."""

from matchlake.sources.batches import (
    batch_counts, commit_batch, enforce_required, finish_batches, missing_required, required,
)
from matchlake.sources.files import scan_json_files
from matchlake.sources.landing import list_files, open_files, write_files
from matchlake.sources.sinks import (
    append_parquet, checkpoint_reliably, collect_versions, has_partitions, materialize_table, materialize_view, open_latest, read_latest,
    read_positions, replace_partitions, sort_columns, write_sorted, write_version,
)
from matchlake.sources.tables import (
    Source, SourceRegistry, ensure_table, loaded_keys, path_exists, read_csv, read_seed,
    read_table_or_empty, spread,
)

__all__ = [
    "Source", "SourceRegistry", "append_parquet", "batch_counts", "checkpoint_reliably",
    "collect_versions", "commit_batch", "enforce_required",
    "ensure_table", "finish_batches", "has_partitions", "list_files", "loaded_keys", "materialize_table", "materialize_view", "missing_required",
    "open_files", "open_latest", "path_exists", "read_csv", "read_latest", "read_positions", "read_seed", "read_table_or_empty", "replace_partitions",
    "required", "scan_json_files", "sort_columns", "spread", "write_files", "write_sorted", "write_version",
]
