"""Reusable DataFrame operators (compositions of built-in Spark operators)."""

from tallywise.operators.sizing import broadcast_if_small, by_shuffle, estimated_bytes
from tallywise.operators.compare import null_safe_full_outer
from tallywise.operators.grouping import (
    dense_index, first_non_null, first_row_per_group, flag_first_in_group, last_wins, number_within_group,
)
from tallywise.operators.prefix import prefix_equi_join, hyphen_prefixes
from tallywise.operators.semi import exists_other_value
from tallywise.operators.frames import reindex, rename_require, keep_available, duplicate_keys

__all__ = [
    "broadcast_if_small", "by_shuffle", "estimated_bytes", "null_safe_full_outer", "first_non_null", "dense_index",
    "first_row_per_group", "flag_first_in_group", "last_wins", "number_within_group",
    "prefix_equi_join", "hyphen_prefixes", "exists_other_value", "reindex", "rename_require",
    "keep_available", "duplicate_keys", "HEAVY_ROWS", "heavy_keys", "skew_join",
]
from tallywise.operators.skew import HEAVY_ROWS, heavy_keys, skew_join  # noqa: F401
