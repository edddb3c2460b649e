"""The catalogue: three append-only tables of datasets, transformations and runs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import desc

from probity.functions import (
    SEVERITIES,
    listed,
    moment_literal,
    quoted,
    surrogate_id,
)
from probity.model import DATASETS_SCHEMA, DQ_RUNS_SCHEMA, TRANSFORMATIONS_SCHEMA
from probity.sources.commits import BatchTable
from probity.sources.ledger import StepLedger, stored_steps

TABLES = {
    "datasets": DATASETS_SCHEMA,
    "transformations": TRANSFORMATIONS_SCHEMA,
    "dq_runs": DQ_RUNS_SCHEMA,
}
#: Folder of the runs' steps.
STEPS = "steps"
#: Rows written per file when a table is compacted.
COMPACT_ROWS = 1_000_000


def _seconds(moment: datetime) -> datetime:
    return moment.replace(microsecond=0)


@dataclass(frozen=True, eq=False)
class Dataset:
    """What the catalogue records of a table.

    Its rows are counted if neither ``row_count`` nor ``counted`` is given, a frame
    of one row and the column row_count that is known without reading the table.
    """

    name: str
    df: DataFrame
    source_type: str
    file_path: str
    description: str = ""
    row_count: int | None = None
    counted: DataFrame | None = None

    def id_at(self, run_ts: datetime) -> str:
        """The id it is registered with: two of one name differ by their paths."""
        return surrogate_id(self.name, run_ts, self.file_path)


def dataset_rows(entries: Sequence[Dataset], run_ts: datetime) -> DataFrame:
    """Catalogue rows for datasets, counted by one job, numbered in the given order."""
    created = moment_literal(_seconds(run_ts))
    if len({(e.name, e.file_path) for e in entries}) < len(entries):
        raise ValueError("two datasets have the same name and path")

    def row(seq: int, entry: Dataset) -> DataFrame:
        if entry.counted is not None:
            counted = entry.counted
        elif entry.row_count is None:
            counted = entry.df.selectExpr("count(1) AS row_count")
        else:
            counted = entry.df.sparkSession.range(1).selectExpr(f"{entry.row_count}L AS row_count")
        return counted.selectExpr(
            f"{quoted(entry.id_at(run_ts))} AS dataset_id",
            f"{quoted(entry.name)} AS name",
            f"{quoted(entry.source_type)} AS source_type",
            f"{quoted(entry.file_path)} AS file_path",
            "row_count",
            f"{len(entry.df.columns)}L AS col_count",
            f"{created} AS created_at",
            f"{quoted(entry.description)} AS description",
            f"{seq}L AS seq",
        )

    return reduce(DataFrame.union, [row(k, entry) for k, entry in enumerate(entries)])


def transformation_row(
    spark: SparkSession,
    step_name: str,
    input_ids: Sequence[str],
    output_id: str,
    operation: str,
    description: str,
    run_ts: datetime,
    duration_ms: int = 0,
    status: str = "success",
    seq: int = 0,
) -> DataFrame:
    """The catalogue row of a step; ``seq`` is its place among the steps of a run."""
    return spark.range(1).selectExpr(
        f"{quoted(surrogate_id(step_name, run_ts, output_id))} AS transform_id",
        f"{quoted(step_name)} AS step_name",
        f"CAST(array({listed(input_ids)}) AS ARRAY<STRING>) AS input_datasets",
        f"{quoted(output_id)} AS output_dataset",
        f"{quoted(operation)} AS operation",
        f"{quoted(description)} AS description",
        f"{moment_literal(_seconds(run_ts))} AS executed_at",
        f"{duration_ms}L AS duration_ms",
        f"{quoted(status)} AS status",
        f"{seq}L AS seq",
    )


def dq_run_row(result: DataFrame, dataset_id: str, run_ts: datetime) -> DataFrame:
    """The run log row of a result document."""
    return result.selectExpr(
        f"{quoted(surrogate_id(dataset_id, run_ts))} AS run_id",
        f"{quoted(dataset_id)} AS dataset_id",
        "overall_dq_score AS overall_score",
        "total_issues",
        *[f"severity_summary[{quoted(s)}] AS {s.lower()}_issues" for s in SEVERITIES],
        f"{moment_literal(_seconds(run_ts))} AS run_at",
    )


class Catalogue:
    """The catalogue's tables under one folder. Rows are only ever appended.

    Every append is a batch that counts from its commit on, so runs at the same time
    don't disturb each other and one that is broken off leaves no rows; see ``commits``.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")

    def table(self, name: str) -> BatchTable:
        return BatchTable(self.spark, f"{self.path}/{name}", TABLES[name])

    def init(self) -> Catalogue:
        """Create the tables that are not there yet, empty."""
        for name in TABLES:
            table = self.table(name)
            if table.version()[0] < 0:
                table.commit(lambda batches: batches)
        return self

    def append(self, name: str, rows: DataFrame, once: bool = False) -> None:
        """Append rows to a table as one file, in the table's types.

        With ``once``, rows whose id is there already are left out: for a step that
        is done again and may have got as far as this.
        """
        if once:
            key = TABLES[name].names[0]
            rows = rows.join(self._scan(name).select(key).distinct(), key, "left_anti")
        typed = rows.selectExpr(
            *[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in TABLES[name]]
        )
        self.table(name).append(typed.coalesce(1))

    def compact(self, name: str) -> None:
        """Rewrite a table's many small batches as one with few files.

        Appends that come meanwhile stay. Readers that have begun go on with the
        old batches, which ``vacuum`` deletes later. Of two compactions at the same
        time one raises ``Conflict``.
        """
        table = self.table(name)
        batches = table.version()[1]
        rows = table.read()
        files = -(-rows.count() // COMPACT_ROWS)
        if len(batches) > 1:
            table.replace(batches, rows.coalesce(max(1, files)))

    def vacuum(self, name: str, older_than_seconds: float = 24 * 3600) -> list[str]:
        """Delete batches that no longer count and are older."""
        return self.table(name).vacuum(older_than_seconds)

    def _scan(self, name: str) -> DataFrame:
        return self.table(name).read()

    def datasets(self) -> DataFrame:
        return self._scan("datasets")

    def transformations(self) -> DataFrame:
        return self._scan("transformations")

    def dq_runs(self) -> DataFrame:
        return self._scan("dq_runs")

    def ledger(self, run_id: str) -> StepLedger:
        """The stored steps of a run, which may be new."""
        return StepLedger(self.spark, f"{self.path}/{STEPS}", run_id)

    def steps(self) -> DataFrame:
        """Every try of a step of every run: when, how long, how it ended."""
        return stored_steps(self.spark, f"{self.path}/{STEPS}")

    def register_dataset(
        self,
        name: str,
        df: DataFrame,
        source_type: str,
        file_path: str,
        run_ts: datetime,
        description: str = "",
        row_count: int | None = None,
        once: bool = False,
    ) -> str:
        """Add a dataset and return its id. ``row_count`` saves counting a table
        whose rows were already counted while it was written."""
        entry = Dataset(name, df, source_type, file_path, description, row_count)
        return self.register_datasets([entry], run_ts, once)[0]

    def register_datasets(
        self, entries: Sequence[Dataset], run_ts: datetime, once: bool = False
    ) -> list[str]:
        """Add datasets in one append and return their ids in the given order.

        Those without a row count are counted in one job.
        """
        self.append("datasets", dataset_rows(entries, run_ts), once)
        return [entry.id_at(run_ts) for entry in entries]

    def register_transformation(
        self,
        step_name: str,
        input_ids: Sequence[str],
        output_id: str,
        operation: str,
        description: str,
        run_ts: datetime,
        duration_ms: int = 0,
        status: str = "success",
        seq: int = 0,
        once: bool = False,
    ) -> str:
        self.append(
            "transformations",
            transformation_row(
                self.spark,
                step_name,
                input_ids,
                output_id,
                operation,
                description,
                run_ts,
                duration_ms,
                status,
                seq,
            ),
            once,
        )
        return surrogate_id(step_name, run_ts, output_id)

    def log_dq_run(
        self, dataset_id: str, result: DataFrame, run_ts: datetime, once: bool = False
    ) -> str:
        self.append("dq_runs", dq_run_row(result, dataset_id, run_ts), once)
        return surrogate_id(dataset_id, run_ts)

    def listing(self) -> DataFrame:
        """All datasets, newest first, those of one time in the order of registration."""
        return self.datasets().orderBy(desc("created_at"), "seq", "dataset_id")
