"""Data quality and governance on Spark DataFrames."""

from probity.model import Check, ForeignKey, RowRule, Severity, UniqueKey
from probity.operators import issues, measure
from probity.plans.filings import (
    check_completeness,
    check_consistency,
    check_referential_integrity,
    check_timeliness,
    check_uniqueness,
    check_validity,
    clean_returns,
    run_all_checks,
    summarise_cleaning,
)
from probity.plans.pipeline import run_pipeline
from probity.plans.scoring import result_document
from probity.sources import Catalogue

__all__ = [
    "Catalogue",
    "Check",
    "ForeignKey",
    "RowRule",
    "Severity",
    "UniqueKey",
    "check_completeness",
    "check_consistency",
    "check_referential_integrity",
    "check_timeliness",
    "check_uniqueness",
    "check_validity",
    "clean_returns",
    "issues",
    "measure",
    "result_document",
    "run_all_checks",
    "run_pipeline",
    "summarise_cleaning",
]
