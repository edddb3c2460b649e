"""Table schemas and the declarations a rule set is made of."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import types as T

# Fixed values.
DIMENSIONS = (
    "Completeness",
    "Validity",
    "Consistency",
    "Uniqueness",
    "Timeliness",
    "Referential Integrity",
)

REGISTER_SCHEMA = T.StructType(
    [
        T.StructField("tin", T.StringType()),
        T.StructField("taxpayer_name", T.StringType()),
        T.StructField("sector", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("registration_date", T.DateType()),
        T.StructField("is_active", T.BooleanType()),
    ]
)

RETURNS_SCHEMA = T.StructType(
    [
        T.StructField("return_id", T.StringType()),
        T.StructField("tin", T.StringType()),
        T.StructField("tax_type", T.StringType()),
        T.StructField("period_start", T.DateType()),
        T.StructField("period_end", T.DateType()),
        T.StructField("filing_date", T.DateType()),
        T.StructField("filing_status", T.StringType()),
        T.StructField("amount_due_ugx", T.DoubleType()),
        T.StructField("amount_paid_ugx", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("assessor_id", T.StringType()),
    ]
)

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("return_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
    ]
)

ISSUE_SCHEMA = T.StructType(
    [
        T.StructField("dimension", T.StringType()),
        T.StructField("field", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("affected_rows", T.LongType()),
        T.StructField("total_rows", T.LongType()),
        T.StructField("pass_rate", T.DoubleType()),
        T.StructField("severity", T.StringType()),
    ]
)
ISSUE_COLUMNS = ISSUE_SCHEMA.names

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("overall_dq_score", T.DoubleType()),
        T.StructField("dimension_scores", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("severity_summary", T.MapType(T.StringType(), T.LongType())),
        T.StructField("total_issues", T.LongType()),
        T.StructField("issues", T.ArrayType(ISSUE_SCHEMA)),
    ]
)

CLEANING_SCHEMA = T.StructType(
    [
        T.StructField("rows_before", T.LongType()),
        T.StructField("rows_after", T.LongType()),
        T.StructField("rows_removed", T.LongType()),
        T.StructField("retention_pct", T.DoubleType()),
    ]
)

NODE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("rows", T.LongType()),
    ]
)

EDGE_SCHEMA = T.StructType(
    [
        T.StructField("from", T.StringType()),
        T.StructField("to", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("operation", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)

SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("pipeline_run", T.StringType()),
        T.StructField("dq_results", RESULT_SCHEMA),
        T.StructField("cleaning_summary", CLEANING_SCHEMA),
        T.StructField(
            "lineage",
            T.StructType(
                [
                    T.StructField("nodes", T.ArrayType(NODE_SCHEMA)),
                    T.StructField("edges", T.ArrayType(EDGE_SCHEMA)),
                ]
            ),
        ),
    ]
)

DATASETS_SCHEMA = T.StructType(
    [
        T.StructField("dataset_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("source_type", T.StringType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("col_count", T.LongType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("description", T.StringType()),
        T.StructField("seq", T.LongType()),
    ]
)

TRANSFORMATIONS_SCHEMA = T.StructType(
    [
        T.StructField("transform_id", T.StringType()),
        T.StructField("step_name", T.StringType()),
        T.StructField("input_datasets", T.ArrayType(T.StringType())),
        T.StructField("output_dataset", T.StringType()),
        T.StructField("operation", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("executed_at", T.TimestampNTZType()),
        T.StructField("duration_ms", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("seq", T.LongType()),
    ]
)

#: A try of a step of a run.
STEPS_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("step", T.StringType()),
        T.StructField("attempt", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("started_at", T.TimestampNTZType()),
        T.StructField("duration_ms", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("message", T.StringType()),
    ]
)

DQ_RUNS_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("dataset_id", T.StringType()),
        T.StructField("overall_score", T.DoubleType()),
        T.StructField("total_issues", T.LongType()),
        T.StructField("high_issues", T.LongType()),
        T.StructField("medium_issues", T.LongType()),
        T.StructField("low_issues", T.LongType()),
        T.StructField("run_at", T.TimestampNTZType()),
    ]
)


@dataclass(frozen=True)
class Severity:
    """A fixed level, or ``level`` only while more than ``above_pct`` % of rows fail."""

    level: str
    above_pct: int | None = None
    otherwise: str | None = None


@dataclass(frozen=True, eq=False)
class RowRule:
    """A rule one row can break on its own.

    ``violated`` is SQL text or a Column, and NULL or false for a good row.
    """

    dimension: str
    field: str
    description: str
    violated: str | Column
    needs: tuple[str, ...]
    severity: Severity


@dataclass(frozen=True)
class UniqueKey:
    """Rows sharing their key with another row; a NULL key equals another NULL key.

    ``digest`` groups by the SHA-256 of each key column, so that long texts
    are not sent through the shuffle.
    """

    keys: tuple[str, ...]
    severity: Severity = Severity("HIGH", 2, "MEDIUM")
    digest: bool = False
    dimension: str = "Uniqueness"

    @property
    def field(self) -> str:
        return " + ".join(self.keys)

    @property
    def description(self) -> str:
        return f"Duplicate records found on key fields: {list(self.keys)}"


@dataclass(frozen=True)
class ForeignKey:
    """Rows whose non-NULL key is not among the parent's non-NULL keys."""

    key: str
    parent: str
    parent_key: str
    description: str
    severity: Severity = Severity("HIGH")
    dimension: str = "Referential Integrity"

    @property
    def field(self) -> str:
        return self.key


@dataclass(frozen=True, eq=False)
class Check:
    """A rule bound to a dataset by name."""

    dataset: str
    rule: RowRule | UniqueKey | ForeignKey
