"""DataFrame operators (DataFrame in, DataFrame out)."""

from .dedup import distinct_rows, keep_first, keep_one
from .filters import drop_ids, keep_ids
from .joins import enrich, fanout_counts, join_on_key, lookup_key
from .keys import dense_key, dense_key_scaled, row_number_scaled, unique_key, with_prefix
from .ordering import preview, sort_by
from .profile import count_tables, describe, merge_profiles, profile, profile_state
from .projection import drop_cols, fill_nulls, move_last, project, rename, stamp
from .registry import read_registry, register, registered_key
from .setops import union_all, union_filters, union_typed
from .sql import in_list_markers, run_sql

__all__ = [
    "distinct_rows", "keep_first", "keep_one", "drop_ids", "keep_ids",
    "enrich", "fanout_counts", "join_on_key", "lookup_key",
    "dense_key", "dense_key_scaled", "row_number_scaled", "unique_key", "with_prefix",
    "preview", "sort_by", "count_tables", "describe", "profile",
    "merge_profiles", "profile_state", "read_registry", "register", "registered_key",
    "drop_cols", "fill_nulls", "move_last", "project", "rename", "stamp",
    "union_all", "union_filters", "union_typed", "in_list_markers", "run_sql",
]
