from .audit import audit_totals, null_token_audit
from .cube import cube_agg, cube_level, grouping_of
from .dims import (
    distinct_dim,
    duplicate_keys,
    family_codes,
    family_dim,
    field_dim,
    label_dim,
    year_dim,
)
from .latest import latest_integer, latest_nonnull, latest_row, latest_value
from .median import grouped_medians, middle_values
from .reshape import differences, layers_agree, peak, pivot_sum, share_matrix, top_bottom
from .switches import category_changes, switches

__all__ = [
    "audit_totals",
    "category_changes",
    "cube_agg",
    "cube_level",
    "differences",
    "distinct_dim",
    "duplicate_keys",
    "family_codes",
    "family_dim",
    "field_dim",
    "grouped_medians",
    "middle_values",
    "grouping_of",
    "label_dim",
    "latest_integer",
    "latest_nonnull",
    "latest_row",
    "latest_value",
    "layers_agree",
    "null_token_audit",
    "peak",
    "pivot_sum",
    "share_matrix",
    "switches",
    "top_bottom",
    "year_dim",
]
