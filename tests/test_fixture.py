"""The counts the fixture is known to give at the smallest scale."""

from __future__ import annotations

from workload.fixture import AS_OF, COLUMNS, filings, register

from probity.model import DIMENSIONS
from probity.plans.filings import clean_returns, database_metrics, summarise_cleaning
from probity.plans.scoring import result_document

SEQ = ["src_seq"]


def test_anchors(spark, sf_dir):
    metrics = database_metrics(filings(spark, sf_dir), register(spark, sf_dir), AS_OF, COLUMNS)
    got = {(r.dimension, r.field): (r.affected_rows, r.pass_rate, r.severity) for r in metrics.collect() if r.affected_rows}
    assert got == {
        ("Completeness", "tin"): (75, 95.0, "MEDIUM"),
        ("Completeness", "amount_due"): (60, 96.0, "MEDIUM"),
        ("Validity", "amount_due"): (44, 97.07, "HIGH"),
        ("Validity", "currency"): (60, 96.0, "HIGH"),
        ("Consistency", "period_start / period_end"): (30, 98.0, "HIGH"),
        ("Consistency", "filing_date / period_start"): (131, 91.27, "HIGH"),
        ("Consistency", "amount_paid / amount_due"): (44, 97.07, "MEDIUM"),
        ("Uniqueness", "return_id"): (92, 93.87, "HIGH"),
        ("Timeliness", "filing_date"): (69, 95.4, "MEDIUM"),
        ("Timeliness", "filing_date + filing_status"): (270, 82.0, "LOW"),
        ("Referential Integrity", "tin"): (98, 93.47, "HIGH"),
    }
    doc = result_document(metrics).first()
    assert doc.overall_dq_score == 93.92
    assert [doc.dimension_scores[d] for d in DIMENSIONS] == [95.5, 96.54, 95.45, 93.87, 88.7, 93.47]


def test_cleaning_anchors(spark, sf_dir):
    raw = filings(spark, sf_dir)
    assert tuple(summarise_cleaning(raw, AS_OF, COLUMNS).first()) == (1500, 1131, 369, 75.4)
    assert clean_returns(raw, AS_OF, SEQ, COLUMNS).count() == 1131


def test_clean_output_passes_the_rules_cleaning_enforces(spark, sf_dir):
    clean = clean_returns(filings(spark, sf_dir), AS_OF, SEQ, COLUMNS)
    assert clean_returns(clean, AS_OF, SEQ, COLUMNS).count() == clean.count()
    left = {(r.dimension, r.field) for r in database_metrics(clean, register(spark, sf_dir), AS_OF, COLUMNS).collect() if r.affected_rows}
    assert not left & {
        ("Completeness", "tin"),
        ("Completeness", "amount_due"),
        ("Validity", "amount_due"),
        ("Validity", "currency"),
        ("Uniqueness", "return_id"),
        ("Timeliness", "filing_date"),
    }
    # A well-formed key the register lacks is not removed.
    assert ("Referential Integrity", "tin") in left
