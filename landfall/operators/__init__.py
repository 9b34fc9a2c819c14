"""Relational operators, each ``DataFrame -> DataFrame``."""

from landfall.operators.counts import (
    count_by,
    distinct_count,
    global_count,
    last_k,
    top_k,
    value_counts,
)
from landfall.operators.dedupe import duplicate_keys, first_per_key
from landfall.operators.frequent import frequent_values
from landfall.operators.labels import (
    accepted,
    flag_withdrawn,
    follow_successors,
    place_parts,
    redirect_codes,
    rejected,
    split_dictionary,
    successor,
)
from landfall.operators.lookup import add_label, conform, keep_valid_codes, require_not_null
from landfall.operators.names import repair_names, with_repairs
from landfall.operators.quality import (
    QualityError,
    check_counts,
    check_no_rejects,
    check_non_empty,
    check_unique,
    enforce,
    match_rate,
    profile,
    reconcile,
    reconcile_filters,
)
from landfall.operators.ranks import attach, dense_rank_by, dense_ranks, share_of_total
from landfall.operators.sets import append_members, project, union_sources
from landfall.operators.sketches import distinct_sketches, merged_counts

__all__ = [
    "QualityError",
    "accepted",
    "add_label",
    "append_members",
    "attach",
    "check_counts",
    "check_no_rejects",
    "check_non_empty",
    "check_unique",
    "conform",
    "count_by",
    "dense_rank_by",
    "dense_ranks",
    "distinct_count",
    "distinct_sketches",
    "duplicate_keys",
    "enforce",
    "first_per_key",
    "flag_withdrawn",
    "follow_successors",
    "frequent_values",
    "global_count",
    "keep_valid_codes",
    "last_k",
    "match_rate",
    "merged_counts",
    "place_parts",
    "profile",
    "project",
    "reconcile",
    "reconcile_filters",
    "redirect_codes",
    "rejected",
    "repair_names",
    "require_not_null",
    "share_of_total",
    "split_dictionary",
    "successor",
    "top_k",
    "union_sources",
    "value_counts",
    "with_repairs",
]
