"""Whole plans: scores, the filing rule set, report tables, lineage, the batch job."""
