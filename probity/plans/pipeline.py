"""The batch job: save raw tables, check, clean, record lineage, save the summary."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from probity.functions import quoted
from probity.model import RESULT_SCHEMA
from probity.operators.profile import (
    aligned,
    null_counts,
    null_counts_of_files,
    quick_stats,
    sample_rows,
)
from probity.operators.remedy import cleaning_columns
from probity.plans.filings import (
    DEFAULT,
    HOME_CURRENCY,
    REGISTER,
    RETURNS,
    Columns,
    clean_returns,
    database_metrics,
)
from probity.plans.lineage import graph_document, of_ids
from probity.plans.scoring import result_document
from probity.sources import (
    INPUT_POSITION,
    Catalogue,
    Dataset,
    read_csv,
    read_document,
    read_parquet,
    write_document,
    write_table,
)
from probity.sources.ledger import SUCCESS

CLEAN = f"{RETURNS}_clean"
AUDIT_LOG = "audit_log"
# What the catalogue says. Cleaning does not in fact enforce status,
# consistency, staleness or foreign keys.
RAW_TEXTS = {
    REGISTER: "Master register of all registered taxpayers",
    RETURNS: "Tax return filings with injected quality issues",
}
CLEAN_TEXT = "Cleaned tax returns — passed all quality checks"
STEP = "DQ Remediation"
STEP_OPERATION = "filter + deduplicate"
STEP_TEXT = "Remove rows failing null, validity, currency, date and uniqueness checks"
# Steps of a run beside the saving of each raw table, in this order.
BEGIN, REGISTERED, CHECK, LOG, CLEANED, CLEAN_REGISTERED, SUMMARY, PROFILE = (
    "begin", "register", "check", "log", "clean", "register_clean", "summary", "profile",
)


@dataclass(frozen=True)
class Run:
    """Where a finished run left its outputs, and the ids it registered."""

    run_id: str
    raw: dict[str, str]
    clean: str
    result: str
    summary: str
    profile: dict[str, str]
    dataset_ids: dict[str, str]
    rows: dict[str, int]
    duration_ms: dict[str, int]


def _summary(
    result: DataFrame, graph: DataFrame, before: int, after: int, run_ts: datetime
) -> DataFrame:
    """The summary document. The two one-row parts are stacked and folded."""
    counts = ", ".join(cleaning_columns(f"{before}L", f"{after}L"))
    results = result.selectExpr("struct(*) AS dq_results", "NULL AS lineage")
    lineage = graph.selectExpr("NULL AS dq_results", "struct(*) AS lineage")
    folded = results.union(lineage).selectExpr(
        "any_value(dq_results, true) AS dq_results", "any_value(lineage, true) AS lineage"
    )
    return folded.selectExpr(
        f"{quoted(run_ts.isoformat(timespec='seconds'))} AS pipeline_run",
        "dq_results",
        f"struct({counts}) AS cleaning_summary",
        "lineage",
    )


def run_pipeline(
    spark: SparkSession,
    returns: DataFrame,
    register: DataFrame,
    out_dir: str,
    catalogue: Catalogue,
    as_of: date | datetime,
    audit_log: DataFrame | None = None,
    raw_paths: Mapping[str, str] | None = None,
    order_by: Sequence[str] = (),
    columns: Columns = DEFAULT,
    *,
    run_ts: datetime,
    fmt: str = "parquet",
    clean_fmt: str | None = None,
    run_id: str | None = None,
) -> Run:
    """Run every step and return where its outputs are.

    Check and clean both read the saved raw tables, with the types the given
    frames have. Tables named in ``raw_paths`` are already saved there as
    ``fmt`` and are not written again. Prefer parquet for ``fmt``: the raw tables
    are read once per grouping, and only parquet reads a few columns cheaply.
    The clean table is saved as ``clean_fmt`` if that should differ.

    Without ``order_by`` the first row of a key is the first by input position,
    that of the given frame if it has one, else that in the saved files. The
    audit log is saved but not registered. The profile is the missing values
    before and after, quick counts, and the first rows of either table.

    Every step is stored in the catalogue as it ends, with its status, duration
    and rows. Given the ``run_id`` of a run that was broken off, and the same
    ``run_ts``, steps that ended well are not done again: the run goes on at the
    first that didn't. A new run gets a new id if none is given.
    """
    out = out_dir.rstrip("/")
    catalogue.init()
    steps = catalogue.ledger(run_id or uuid.uuid4().hex)
    again = bool(steps.rows)
    begun = {"run_ts": run_ts.isoformat(), "out": out, "formats": [fmt, clean_fmt or fmt]}
    if steps.run(BEGIN, lambda: begun) != begun:
        raise ValueError(f"run {steps.run_id} began with another run_ts, out_dir or format")

    raw = {REGISTER: register, RETURNS: returns}
    if audit_log is not None:
        raw[AUDIT_LOG] = audit_log
    given = raw_paths or {}
    paths = {name: given.get(name, f"{out}/raw/{name}") for name in raw}

    def save(name: str) -> int:
        return raw[name].count() if name in given else write_table(raw[name], paths[name], fmt)

    def counted(step: str, action: Callable[[], int]) -> int:
        return steps.run(step, action, lambda n: n)

    rows = {name: counted(name, lambda name=name: save(name)) for name in raw}

    def saved(name: str, position: bool = False) -> DataFrame:
        read = read_csv if fmt == "csv" else read_parquet
        return read(spark, paths[name], raw[name].schema, position=position)

    entries = [
        Dataset(name, raw[name].drop(INPUT_POSITION), "raw_file", paths[name], text, rows[name])
        for name, text in RAW_TEXTS.items()
    ]
    found = steps.run(REGISTERED, lambda: catalogue.register_datasets(entries, run_ts, once=again))
    ids = dict(zip(RAW_TEXTS, found, strict=True))

    result_path = f"{out}/dq_results"

    def check() -> None:
        metrics = database_metrics(saved(RETURNS), saved(REGISTER), as_of, columns)
        write_document(result_document(metrics), result_path)

    steps.run(CHECK, check)
    result = read_document(spark, result_path, RESULT_SCHEMA)
    steps.run(LOG, lambda: catalogue.log_dq_run(ids[RETURNS], result, run_ts, once=again))

    placed = bool(order_by) or INPUT_POSITION in returns.columns
    clean_path = f"{out}/processed/{CLEAN}"

    def cleaned() -> DataFrame:
        return clean_returns(
            saved(RETURNS, position=not placed), as_of, list(order_by) or None, columns
        )

    rows[CLEAN] = counted(CLEANED, lambda: write_table(cleaned(), clean_path, clean_fmt or fmt))
    clean = cleaned()

    def register_clean() -> list[str]:
        made = catalogue.register_dataset(
            CLEAN, clean, "transformed", clean_path, run_ts, CLEAN_TEXT, rows[CLEAN], once=again
        )
        took = steps.duration_ms(CLEANED)
        step = catalogue.register_transformation(
            STEP, [ids[RETURNS]], made, STEP_OPERATION, STEP_TEXT, run_ts, took, once=again
        )
        return [made, step]

    ids[CLEAN], step = steps.run(CLEAN_REGISTERED, register_clean)
    summary_path = f"{out}/pipeline_summary"

    def summarise() -> None:
        graph = graph_document(
            of_ids(catalogue.datasets(), list(ids.values())),
            of_ids(catalogue.transformations(), [step]),
        )
        write_document(_summary(result, graph, rows[RETURNS], rows[CLEAN], run_ts), summary_path)

    steps.run(SUMMARY, summarise)

    read = read_csv if (clean_fmt or fmt) == "csv" else read_parquet
    profile = {
        name: f"{out}/profile/{name}"
        for name in ("missing_values", "quick_stats", "raw_sample", "clean_sample")
    }

    def save_profile() -> None:
        first = list(order_by) or ([INPUT_POSITION] if not placed else [columns.return_id])
        before = saved(RETURNS, position=not placed)
        after = read(spark, clean_path, clean.schema)
        bare = before.drop(INPUT_POSITION)
        both = {"raw": bare, "clean": after}

        def nulls_of(df: DataFrame, path: str, saved_as: str) -> DataFrame:
            if saved_as == "parquet" and spark.read.parquet(path).schema.simpleString() == df.schema.simpleString():
                return null_counts_of_files(spark, path, df.schema)
            return null_counts(df)

        tables = {
            "missing_values": aligned(
                nulls_of(bare, paths[RETURNS], fmt), nulls_of(after, clean_path, clean_fmt or fmt)
            ),
            "quick_stats": quick_stats(
                both, columns.tin, columns.amount_due, columns.currency, HOME_CURRENCY
            ),
            "raw_sample": sample_rows(before, first).drop(INPUT_POSITION),
            "clean_sample": sample_rows(after, list(order_by) or [columns.return_id]),
        }
        for name, table in tables.items():
            write_table(table.coalesce(1), profile[name], clean_fmt or fmt)

    steps.run(PROFILE, save_profile)
    durations = {r["step"]: r["duration_ms"] for r in steps.rows if r["status"] == SUCCESS}
    return Run(
        steps.run_id, paths, clean_path, result_path, summary_path, profile, ids, rows, durations
    )
