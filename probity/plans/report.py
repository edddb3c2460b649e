"""Report tables. Each is derived from the one-row result document."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame

from probity.functions import (
    SEVERITIES,
    date_literal,
    listed,
    quoted,
    score_band,
    severity_rank,
    thousands,
    verdict,
)
from probity.model import DIMENSIONS
from probity.plans.lineage import flow
from probity.plans.scoring import dimension_scores, issue_rows, overall

# Fixed values.
DIMENSION_TEXTS = {
    "Completeness": "Required fields must not be null or empty.",
    "Validity": "Values must conform to permitted formats and ranges.",
    "Consistency": "Related fields must be logically coherent with each other.",
    "Uniqueness": "No duplicate records on primary key fields.",
    "Timeliness": "Dates must fall within acceptable windows.",
    "Referential Integrity": "Foreign keys must point to existing records.",
}
DATASETS_ASSESSED = "Tax Returns, Taxpayer Register"
CLASSIFICATION = "INTERNAL"


def kpi_row(result: DataFrame, cleaning: DataFrame) -> DataFrame:
    """Scores, issue counts and the share of rows kept as one row.

    The two one-row inputs are stacked and folded together.
    """
    scored = overall(result).selectExpr("*", "CAST(NULL AS DOUBLE) AS retention_pct")
    names = scored.columns
    kept = cleaning.selectExpr(*[f"NULL AS {c}" for c in names[:-1]], "retention_pct")
    return scored.union(kept).selectExpr(*[f"max({c}) AS {c}" for c in names])


def dimension_bands(result: DataFrame) -> DataFrame:
    """Dimension, score and PASS / MONITOR / FAIL."""
    return dimension_scores(result).selectExpr("*", f"{score_band('score')} AS status")


def overall_verdict(result: DataFrame) -> DataFrame:
    return result.selectExpr("overall_dq_score", f"{verdict('overall_dq_score')} AS verdict")


def severity_summary(result: DataFrame) -> DataFrame:
    """Three rows: severity and its number of issues."""
    rows = ", ".join(
        f"named_struct('severity', {quoted(s)}, 'issues', severity_summary[{quoted(s)}])"
        for s in SEVERITIES
    )
    return result.selectExpr(f"inline(array({rows}))")


def issue_log(result: DataFrame) -> DataFrame:
    """Issues numbered from 1, HIGH first, in check order within a severity.

    The array is sorted inside its row, so no shuffle or window is needed.
    """
    entry = f"named_struct('rank', {severity_rank('i.severity')}, 'pos', p, 'issue', i)"
    ranked = f"sort_array(transform(issues, (i, p) -> {entry}))"
    return (
        result.selectExpr(f"posexplode({ranked}) AS (pos, entry)")
        .selectExpr("CAST(pos + 1 AS BIGINT) AS issue_no", "entry.issue.*")
        .selectExpr(
            "*",
            f"{thousands('affected_rows')} AS affected_text",
            "concat(CAST(pass_rate AS STRING), '%') AS pass_text",
        )
    )


def _chosen(dimensions: Sequence[str], severities: Sequence[str], prefix: str = "") -> str:
    """True for an issue of the chosen dimensions and severities; empty choices fit none."""
    tests = [
        f"{prefix}{name} IN ({listed(values)})" if values else "false"
        for name, values in (("dimension", dimensions), ("severity", severities))
    ]
    return " AND ".join(tests)


def issue_explorer(
    result: DataFrame,
    dimensions: Sequence[str] = DIMENSIONS,
    severities: Sequence[str] = SEVERITIES,
) -> DataFrame:
    """Issues of the chosen dimensions and severities, with "k of n" on each row."""
    chosen = f"filter(issues, i -> {_chosen(dimensions, severities, 'i.')})"
    return (
        result.selectExpr("issues", f"{chosen} AS chosen")
        .selectExpr(
            "CAST(size(chosen) AS BIGINT) AS shown",
            "CAST(size(issues) AS BIGINT) AS of_total",
            "explode(chosen) AS issue",
        )
        .selectExpr("shown", "of_total", "issue.*")
    )


def explorer_count(
    result: DataFrame,
    dimensions: Sequence[str] = DIMENSIONS,
    severities: Sequence[str] = SEVERITIES,
) -> DataFrame:
    """"k of n" as one row, there even if no issue is shown."""
    chosen = f"filter(issues, i -> {_chosen(dimensions, severities, 'i.')})"
    return result.selectExpr(
        f"CAST(size({chosen}) AS BIGINT) AS shown", "CAST(size(issues) AS BIGINT) AS of_total"
    )


def explorer_dimensions(result: DataFrame) -> DataFrame:
    """The dimensions that have an issue, in the order of their first one."""
    return result.selectExpr(
        "explode(array_distinct(transform(issues, i -> i.dimension))) AS dimension"
    )


def dimension_detail(result: DataFrame) -> DataFrame:
    """Each dimension with its text, score and issues; one row without issue if none."""
    rows = ", ".join(
        f"named_struct('dimension', {quoted(d)}, 'description', {quoted(DIMENSION_TEXTS[d])}, "
        f"'score', dimension_scores[{quoted(d)}], "
        f"'found', filter(issues, i -> i.dimension = {quoted(d)}))"
        for d in DIMENSIONS
    )
    return (
        result.selectExpr(f"inline(array({rows}))")
        .selectExpr("dimension", "description", "score", "explode_outer(found) AS issue")
        .selectExpr(
            "dimension",
            "description",
            "score",
            f"{score_band('score')} AS status",
            "issue.field AS field",
            "issue.description AS issue",
            "issue.affected_rows AS affected_rows",
        )
    )


def report_metadata(result: DataFrame, pipeline_run: str, report_date: date) -> DataFrame:
    """``pipeline_run`` is an expression for the time of the run."""
    return result.selectExpr(
        f"date_format({date_literal(report_date)}, 'MMMM dd, yyyy') AS report_date",
        f"{pipeline_run} AS pipeline_run",
        f"{quoted(DATASETS_ASSESSED)} AS datasets_assessed",
        "total_issues",
        f"{quoted(CLASSIFICATION)} AS classification",
    )


def report_tables(summary: DataFrame, report_date: date) -> dict[str, DataFrame]:
    """All tables of the report from a saved run summary."""
    result = summary.select("pipeline_run", "dq_results.*")
    cleaning = summary.select("cleaning_summary.*")
    nodes = summary.selectExpr("inline(lineage.nodes)")
    edges = summary.selectExpr("inline(lineage.edges)")
    return {
        "metadata": report_metadata(result, "pipeline_run", report_date),
        "verdict": overall_verdict(result),
        "kpi": kpi_row(result, cleaning),
        "dimensions": dimension_bands(result),
        "dimension_detail": dimension_detail(result),
        "severities": severity_summary(result),
        "issue_log": issue_log(result),
        "issues": issue_rows(result),
        "explorer": issue_explorer(result),
        "explorer_count": explorer_count(result),
        "explorer_dimensions": explorer_dimensions(result),
        "cleaning": cleaning,
        "nodes": nodes,
        "edges": edges,
        "flow": flow(nodes, edges),
    }
