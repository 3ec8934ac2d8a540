"""Reusable DataFrame operators, parameterised by column names."""

from matchlake.operators.joins import anti_new, broadcast_if_small, join_null_safe, proven_size_bytes
from matchlake.operators.metrics import observed_count
from matchlake.operators.quality import (
    accepted_values_violations, column_check_counts, not_null_violations, relationships_violations,
    unique_violations,
)
from matchlake.operators.ranking import (
    attach_dense_id, dense_id, number_all, pivot_top_n, sequence_within, top_n_per_group,
)
from matchlake.operators.reshape import explode_level, unpivot_sides

__all__ = [
    "accepted_values_violations", "anti_new", "attach_dense_id", "broadcast_if_small",
    "column_check_counts", "dense_id", "explode_level", "join_null_safe",
    "not_null_violations", "number_all", "observed_count", "pivot_top_n", "proven_size_bytes", "relationships_violations",
    "sequence_within", "top_n_per_group", "unique_violations", "unpivot_sides",
]
