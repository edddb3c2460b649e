"""Operators on DataFrames: measuring, membership, remediation, profile, corruption."""

from probity.operators.measure import issues, key_counts, key_presence, measure
from probity.operators.membership import duplicate_rows, orphan_rows
from probity.operators.profile import missing_before_after, null_counts, quick_stats, sample_rows
from probity.operators.remedy import cleaning_summary, keep_first, remediate

__all__ = [
    "cleaning_summary",
    "duplicate_rows",
    "issues",
    "keep_first",
    "key_counts",
    "key_presence",
    "measure",
    "missing_before_after",
    "null_counts",
    "orphan_rows",
    "quick_stats",
    "remediate",
    "sample_rows",
]
