"""DataFrame operators: validation, aggregation, joins, registry, ranking."""

from chaintally.operators.aggregate import global_mean, limb_sums, means_by, sums_to_totals, totals_by, whole_totals
from chaintally.operators.rank import (
    above_below,
    best_row,
    pivot_series,
    reconcile,
    top_k,
    zero_fill,
)
from chaintally.operators.registry import (
    address_counts,
    counted_members,
    registry_addresses,
    registry_entries,
    registry_report,
)
from chaintally.operators.validate import (
    RULE_SETS,
    Rule,
    keep_valid,
    observe_quality,
    observed_report,
    passes,
    quality_report,
    reason_counts,
    reject_reason,
)

__all__ = [
    "global_mean", "limb_sums", "means_by", "sums_to_totals", "totals_by", "whole_totals",
    "above_below", "best_row", "pivot_series", "reconcile", "top_k", "zero_fill",
    "address_counts", "counted_members", "registry_addresses", "registry_entries",
    "registry_report",
    "RULE_SETS", "Rule", "keep_valid", "observe_quality", "observed_report", "passes",
    "quality_report", "reason_counts", "reject_reason",
]
