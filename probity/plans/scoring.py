"""From metrics to the result document.

The document is one row, and its issue array holds at most one entry per check,
so it stays small however large the checked tables are. Every report table is
derived from it, whether it was just computed or read back from a file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from probity.functions import SEVERITIES, basis_points, listed, mean_basis_points, percent, quoted
from probity.model import DIMENSIONS, ISSUE_COLUMNS

POINTS = basis_points("affected_rows", "total_rows")


def result_document(metrics: DataFrame) -> DataFrame:
    """Overall score, dimension scores, severities and issues as one row.

    A dimension's score is the mean rate of its failing checks, 100 if none
    fails; the overall score is the plain mean of the rounded dimension scores.
    """
    numbered = list(enumerate(DIMENSIONS))
    sums = [
        f"{kind}(CASE WHEN dimension = {quoted(d)} THEN points END) AS {kind}{i}"
        for i, d in numbered
        for kind in ("sum", "count")
    ]
    by_severity = [f"count_if(severity = {quoted(s)}) AS {s}" for s in SEVERITIES]
    issue = f"struct(check_seq, {', '.join(ISSUE_COLUMNS)})"
    found = metrics.filter("affected_rows > 0").selectExpr("*", f"{POINTS} AS points")
    collected = found.selectExpr(
        *sums,
        *by_severity,
        "count(1) AS total_issues",
        f"sort_array(collect_list({issue})) AS found",
    )
    scored = collected.selectExpr(
        *[f"{mean_basis_points(f'sum{i}', f'count{i}')} AS score{i}" for i, _ in numbered],
        *SEVERITIES,
        "total_issues",
        "found",
    )
    total = " + ".join(f"score{i}" for i, _ in numbered)
    scores = ", ".join(percent(f"score{i}") for i, _ in numbered)
    fields = ", ".join(f"{quoted(c)}, i.{c}" for c in ISSUE_COLUMNS)
    return scored.selectExpr(
        f"{percent(mean_basis_points(total, f'{len(DIMENSIONS)}L'))} AS overall_dq_score",
        f"map_from_arrays(array({listed(DIMENSIONS)}), array({scores})) AS dimension_scores",
        f"map_from_arrays(array({listed(SEVERITIES)}), array({', '.join(SEVERITIES)}))"
        " AS severity_summary",
        "total_issues",
        f"transform(found, i -> named_struct({fields})) AS issues",
    )


def issue_rows(result: DataFrame) -> DataFrame:
    """The issues of a result document as rows, with their position ``check_seq``."""
    return result.selectExpr("posexplode(issues) AS (pos, issue)").selectExpr(
        "CAST(pos + 1 AS BIGINT) AS check_seq", "issue.*"
    )


def dimension_scores(result: DataFrame) -> DataFrame:
    """Six rows: dimension and score."""
    rows = ", ".join(
        f"named_struct('dimension_seq', {i}L, 'dimension', {quoted(d)}, "
        f"'score', dimension_scores[{quoted(d)}])"
        for i, d in enumerate(DIMENSIONS, 1)
    )
    return result.selectExpr(f"inline(array({rows}))")


def overall(result: DataFrame) -> DataFrame:
    """One row: overall score, number of issues, and issues by severity."""
    return result.selectExpr(
        "overall_dq_score",
        "total_issues",
        *[f"severity_summary[{quoted(s)}] AS {s.lower()}_issues" for s in SEVERITIES],
    )
