"""Column-level helpers (thin compositions of built-in functions, all JVM-side)."""

from matchlake.functions.json_fns import (
    first_key, is_valid_json, json_array, json_value_scalar, parse_document, scalar_text,
)
from matchlake.functions.text import (
    ceil_double, flag_from_predicate, margin_label, regexp_group, split_first,
)
from matchlake.functions.timefmt import hour_iso, parse_dmy_hm

__all__ = [
    "ceil_double", "first_key", "flag_from_predicate", "hour_iso", "is_valid_json", "json_array",
    "json_value_scalar", "margin_label", "parse_dmy_hm", "parse_document", "regexp_group", "scalar_text",
    "split_first",
]
