"""The scorer on known counts, with the figures published for one run."""

from __future__ import annotations

import json

import pytest

from probity.operators.measure import graded
from probity.plans import report
from probity.plans.scoring import dimension_scores, issue_rows, overall, result_document

COUNTED = (
    "check_seq BIGINT, dataset STRING, dimension STRING, field STRING, description STRING, "
    "affected_rows BIGINT, total_rows BIGINT, above_pct INT, level STRING, otherwise STRING"
)

# Nine (affected, total) pairs and what they must lead to.
PUBLISHED = [
    ("Completeness", "tin", 94, 5, "HIGH", "MEDIUM", 95.3, "MEDIUM"),
    ("Completeness", "amount_due_ugx", 80, 5, "HIGH", "MEDIUM", 96.0, "MEDIUM"),
    ("Validity", "amount_due_ugx", 57, None, "HIGH", None, 97.15, "HIGH"),
    ("Validity", "currency", 80, None, "HIGH", None, 96.0, "HIGH"),
    ("Consistency", "amount_paid_ugx / amount_due_ugx", 57, None, "MEDIUM", None, 97.15, "MEDIUM"),
    ("Uniqueness", "return_id", 118, 2, "HIGH", "MEDIUM", 94.1, "HIGH"),
    ("Timeliness", "filing_date", 60, None, "MEDIUM", None, 97.0, "MEDIUM"),
    ("Timeliness", "filing_date + filing_status", 261, None, "LOW", None, 86.95, "LOW"),
    ("Referential Integrity", "tin", 80, None, "HIGH", None, 96.0, "HIGH"),
]
SCORES = {
    "Completeness": 95.65,
    "Validity": 96.58,
    "Consistency": 97.15,
    "Uniqueness": 94.1,
    "Timeliness": 91.98,
    "Referential Integrity": 96.0,
}


@pytest.fixture
def published(rows):
    data = [
        (i, "tax_returns", dim, field, f"d{i}", bad, 2000, above, level, other)
        for i, (dim, field, bad, above, level, other, _, _) in enumerate(PUBLISHED, 1)
    ]
    passing = (10, "tax_returns", "Completeness", "tax_type", "", 0, 2000, 5, "HIGH", "MEDIUM")
    return graded(rows(COUNTED, [*reversed(data), passing]))


def test_published_run(published):
    doc = result_document(published).first()
    assert doc.overall_dq_score == 95.24
    assert doc.dimension_scores == SCORES
    assert doc.severity_summary == {"HIGH": 4, "MEDIUM": 4, "LOW": 1}
    assert doc.total_issues == 9
    assert [(i.pass_rate, i.severity) for i in doc.issues] == [p[-2:] for p in PUBLISHED]


def test_without_issues_every_score_is_full(rows):
    doc = result_document(graded(rows(COUNTED, [(1, "t", "Validity", "f", "", 0, 9, None, "HIGH", None)]))).first()
    assert doc.overall_dq_score == 100.0
    assert set(doc.dimension_scores.values()) == {100.0}
    assert doc.severity_summary == {"HIGH": 0, "MEDIUM": 0, "LOW": 0}
    assert doc.issues == []


def test_report_tables_without_issues(rows):
    doc = result_document(graded(rows(COUNTED, [(1, "t", "Validity", "f", "", 0, 9, None, "HIGH", None)])))
    assert report.issue_log(doc).count() == 0
    assert [r.issue for r in report.dimension_detail(doc).collect()] == [None] * 6
    assert tuple(report.explorer_count(doc).first()) == (0, 0)
    assert report.overall_verdict(doc).first().verdict == "GOOD"


def test_tables_of_the_published_run(published, rows):
    doc = result_document(published)
    assert {r.dimension: r.score for r in dimension_scores(doc).collect()} == SCORES
    assert tuple(overall(doc).first()) == (95.24, 9, 4, 4, 1)
    assert [r.status for r in report.dimension_bands(doc).orderBy("dimension_seq").collect()] == [
        "PASS", "PASS", "PASS", "MONITOR", "MONITOR", "PASS",
    ]
    log = report.issue_log(doc).orderBy("issue_no").collect()
    assert [r.severity for r in log] == ["HIGH"] * 4 + ["MEDIUM"] * 4 + ["LOW"]
    assert [r.field for r in log[:4]] == ["amount_due_ugx", "currency", "return_id", "tin"]
    assert [r.pass_text for r in log[:2]] == ["97.15%", "96.0%"]
    assert [r.check_seq for r in issue_rows(doc).collect()] == list(range(1, 10))
    cleaning = rows("rows_before BIGINT, rows_after BIGINT, rows_removed BIGINT, retention_pct DOUBLE", [(2000, 1536, 464, 76.8)])
    assert tuple(report.kpi_row(doc, cleaning).first()) == (95.24, 9, 4, 4, 1, 76.8)


def test_explorer_filters(published):
    doc = result_document(published)
    chosen = report.issue_explorer(doc, ["Validity", "Uniqueness"], ["HIGH"]).collect()
    assert {(r.shown, r.of_total) for r in chosen} == {(3, 9)}
    assert report.issue_explorer(doc).count() == 9
    assert report.issue_explorer(doc, [], ["HIGH"]).count() == 0
    assert tuple(report.explorer_count(doc, ["Validity"], ["LOW"]).first()) == (0, 9)
    assert [r.dimension for r in report.explorer_dimensions(doc).collect()] == list(SCORES)


def test_the_document_as_json(published):
    doc = json.loads(result_document(published).toJSON().first())
    assert list(doc) == ["overall_dq_score", "dimension_scores", "severity_summary", "total_issues", "issues"]
    assert list(doc["issues"][0]) == ["dimension", "field", "description", "affected_rows", "total_rows", "pass_rate", "severity"]
    assert doc["dimension_scores"] == SCORES
