"""Relational operators over DataFrames; columns are always passed by name."""

from homelake.operators.dedupe import first_in_batch, latest_per_key, latest_stored, new_rows, one_per_key, prefix_until_stale
from homelake.operators.ids import collect_keys, column_key, json_key, not_containing, present_key, with_fallback
from homelake.operators.joins import join_exclude, lookup_join
from homelake.operators.median import exact_median
from homelake.operators.nested import attach_parent, explode_nested, explode_series, quality_items
from homelake.operators.ordering import range_order
from homelake.operators.partials import Measure, merge_states, partial_states
from homelake.operators.pivot import pivot_series, series_keys, with_series_key
from homelake.operators.profile import json_profile, table_profile
from homelake.operators.projection import Out, project_spec
from homelake.operators.summaries import (
    bin_label,
    conditional_counts,
    geo_bins,
    group_std,
    keyword_score,
    left_join_count,
    std_by_key,
    summary_by,
    top_by,
    with_group_std,
)

__all__ = [
    "Measure", "Out", "attach_parent", "bin_label", "collect_keys", "column_key", "conditional_counts", "exact_median", "explode_nested",
    "explode_series", "first_in_batch", "geo_bins", "group_std", "join_exclude", "json_profile", "keyword_score",
    "latest_per_key", "latest_stored", "left_join_count", "lookup_join", "merge_states", "new_rows", "not_containing", "one_per_key",
    "json_key", "partial_states", "pivot_series", "prefix_until_stale", "present_key", "project_spec", "quality_items", "range_order", "series_keys",
    "std_by_key", "summary_by", "table_profile", "top_by", "with_fallback", "with_group_std", "with_series_key",
]
