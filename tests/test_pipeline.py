from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql.types import StructType
from workload.fixture import AS_OF, COLUMNS, RUN_TS, filings, register

from probity import Catalogue, run_pipeline
from probity.operators.corrupt import audit_events
from probity.plans.report import report_tables
from probity.plans.scoring import result_document
from probity.session import scratch_dir
from probity.sources import read_csv, read_parquet, read_summary

def test_report_from_a_saved_summary(spark, rows, tmp_path):
    """A summary of figures made up here, saved indented and over many lines as other tools do."""
    metrics = rows(
        "check_seq BIGINT, dataset STRING, dimension STRING, field STRING, description STRING, "
        "affected_rows BIGINT, total_rows BIGINT, pass_rate DOUBLE, severity STRING",
        [
            (1, "t", "Timeliness", "due", "late", 3, 8000, 99.96, "LOW"),
            (2, "t", "Validity", "code", "wrong", 1600, 8000, 80.0, "HIGH"),
        ],
    )
    result = json.loads(result_document(metrics).toJSON().first())
    nodes = [{"id": "x", "label": "in", "type": "raw_file", "rows": 8000}, {"id": "y", "label": "out", "type": "transformed", "rows": 6000}]
    saved = {
        "pipeline_run": "2030-01-02T03:04:05",
        "dq_results": result,
        "cleaning_summary": {"rows_before": 8000, "rows_after": 6000, "rows_removed": 2000, "retention_pct": 75.0},
        "lineage": {"nodes": nodes, "edges": [{"from": "x", "to": "y", "label": "Step", "operation": "filter", "status": "success"}]},
    }
    path = tmp_path / "summary.json"
    path.write_text(json.dumps(saved, indent=2))
    tables = report_tables(read_summary(spark, str(path)), date(2030, 1, 2))
    got = {name: [tuple(r) for r in df.collect()] for name, df in tables.items()}
    score = result["overall_dq_score"]
    assert got["metadata"] == [("January 02, 2030", "2030-01-02T03:04:05", "Tax Returns, Taxpayer Register", 2, "INTERNAL")]
    assert got["verdict"] == [(score, "GOOD")]
    assert got["kpi"] == [(score, 2, 1, 0, 1, 75.0)]
    assert got["severities"] == [("HIGH", 1), ("MEDIUM", 0), ("LOW", 1)]
    assert got["cleaning"] == [(8000, 6000, 2000, 75.0)]
    assert [(r[0], r[1], r[-2], r[-1]) for r in got["issue_log"]] == [(1, "Validity", "1,600", "80.0%"), (2, "Timeliness", "3", "99.96%")]
    bands = {r[1]: r[3] for r in got["dimensions"]}
    assert (bands["Validity"], bands["Timeliness"], bands["Uniqueness"]) == ("MONITOR", "PASS", "PASS")
    assert len(got["dimension_detail"]) == 6
    assert got["nodes"] == [tuple(n.values()) for n in nodes]
    assert got["edges"] == [("x", "y", "Step", "filter", "success")]
    assert got["flow"] == [("in", 8000, "Step", "filter", "success", "out", 6000)]
    assert got["explorer_count"] == [(2, 2)]
    assert sorted(got["explorer_dimensions"]) == [("Timeliness",), ("Validity",)]
    assert len(got["explorer"]) == 2


def test_csv_and_parquet_give_the_same_run(spark, rows):
    """Blanks around values count, whatever the raw tables are saved as."""
    day = date(2024, 1, 2)
    raw = rows(
        "return_id STRING, tin STRING, currency STRING, amount_due_ugx DOUBLE, filing_date DATE, note STRING",
        [
            ("a", "1234567890", "UGX", 1.0, day, "two\nlines"),
            ("b", "1234567891 ", "UGX", 2.0, day, ' "quoted" '),
            (" a", "1234567892", "UGX ", 3.0, day, None),
        ],
    )
    known = rows("tin STRING", [("1234567890",), ("1234567891 ",), ("1234567892",)])
    seen = []
    for fmt in ("parquet", "csv"):
        out = scratch_dir(spark)
        done = run_pipeline(
            spark, raw, known, out, Catalogue(spark, f"{out}/catalogue"), date(2024, 6, 1),
            order_by=["return_id"], run_ts=RUN_TS, fmt=fmt,
        )
        summary = read_summary(spark, done.summary).drop("lineage").first()
        read = read_csv if fmt == "csv" else read_parquet
        kept = read(spark, done.clean, raw.schema).collect()
        sample = read(spark, done.profile["raw_sample"], raw.schema).collect()
        seen.append((summary, sorted(map(tuple, kept)), sorted(map(str, sample))))
    assert seen[0] == seen[1]
    assert [k[0] for k in seen[0][1]] == ["a"]


def test_values_that_look_missing_are_the_same_in_both_formats(spark, rows):
    """Texts such as NA are values, empty texts are not NULL, and times keep their microseconds."""
    at = datetime(2024, 1, 2, 3, 4, 5, 123456)
    raw = rows(
        "return_id STRING, tin STRING, tax_type STRING, currency STRING, amount_due_ugx DOUBLE, "
        "filing_date TIMESTAMP_NTZ, note STRING",
        [
            ("a", "1234567890", "NA", "UGX", 1.0, at, "None"),
            ("NULL", "1234567891", None, "None", 2.0, at, ""),
            ("nan", "1234567892", "", "UGX", 3.0, at, "\\N"),
        ],
    )
    known = rows("tin STRING", [("1234567890",), ("1234567891",), ("1234567892",)])
    seen = []
    for fmt in ("parquet", "csv"):
        out = scratch_dir(spark)
        done = run_pipeline(
            spark, raw, known, out, Catalogue(spark, f"{out}/catalogue"), at, order_by=["return_id"],
            run_ts=RUN_TS, fmt=fmt,
        )
        read = read_csv if fmt == "csv" else read_parquet
        missing = read(spark, done.profile["missing_values"], StructType()).collect()
        seen.append(
            (
                read_summary(spark, done.summary).drop("lineage").first(),
                sorted(map(str, read(spark, done.clean, raw.schema).collect())),
                sorted(map(str, missing)),
            )
        )
    assert seen[0] == seen[1]
    assert any("microsecond=123456" in r or "123456" in r for r in seen[0][1])


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_whole_run(spark, sf_dir, fmt):
    out = scratch_dir(spark)
    catalogue = Catalogue(spark, f"{out}/catalogue")
    raw, parent = filings(spark, sf_dir).drop("src_seq"), register(spark, sf_dir)
    log = audit_events(filings(spark, sf_dir).selectExpr("src_seq AS return_id"), "return_id")

    def run(moment: datetime):
        return run_pipeline(
            spark, raw, parent, f"{out}/{moment:%d}", catalogue, AS_OF, log,
            columns=COLUMNS, run_ts=moment, fmt=fmt,
        )

    read = read_csv if fmt == "csv" else read_parquet

    first = run(RUN_TS)
    assert first.rows["tax_returns"] == 1500 and first.rows["tax_returns_clean"] == 1131
    assert first.rows["audit_log"] == log.count()
    missing = read(spark, first.profile["missing_values"], StructType()).collect()
    assert {m.column_name: int(m.resolved) for m in missing}["tin"] == 75
    assert [int(m.null_keys) for m in read(spark, first.profile["quick_stats"], StructType()).orderBy("dataset").collect()] == [0, 75]
    assert read(spark, first.profile["raw_sample"], raw.schema).count() == 100
    sample = read(spark, first.profile["clean_sample"], raw.schema)
    assert sample.columns == raw.columns and sample.filter("tin IS NULL").count() == 0
    summary = read_summary(spark, first.summary).first()
    assert summary.pipeline_run == "2001-08-01T02:00:00"
    assert summary.dq_results.overall_dq_score == 93.92
    assert tuple(summary.cleaning_summary) == (1500, 1131, 369, 75.4)
    # The audit log is saved but not in the catalogue.
    assert sorted(n.label for n in summary.lineage.nodes) == ["tax_returns", "tax_returns_clean", "taxpayer_register"]
    (edge,) = summary.lineage.edges
    assert (edge["from"], edge["to"]) == (first.dataset_ids["tax_returns"], first.dataset_ids["tax_returns_clean"])
    assert catalogue.dq_runs().first().overall_score == 93.92

    document = json.loads(spark.read.text(first.summary).first()[0])
    assert list(document) == ["pipeline_run", "dq_results", "cleaning_summary", "lineage"]
    assert document["cleaning_summary"]["retention_pct"] == 75.4

    if fmt == "parquet":
        second = run(datetime(2001, 8, 2, 2))
        assert catalogue.datasets().count() == 6
        assert catalogue.dq_runs().count() == 2
        # The document holds this run's graph, whatever the catalogue holds.
        assert len(read_summary(spark, second.summary).first().lineage.edges) == 1


def test_saved_inputs_are_not_written_again(spark, sf_dir):
    out = scratch_dir(spark)
    paths = {"tax_returns": f"{out}/in/returns", "taxpayer_register": f"{out}/in/register"}
    filings(spark, sf_dir).write.parquet(paths["tax_returns"])
    register(spark, sf_dir).write.parquet(paths["taxpayer_register"])
    done = run_pipeline(
        spark,
        spark.read.parquet(paths["tax_returns"]),
        spark.read.parquet(paths["taxpayer_register"]),
        f"{out}/out",
        Catalogue(spark, f"{out}/catalogue"),
        AS_OF,
        raw_paths=paths,
        columns=COLUMNS,
        run_ts=RUN_TS,
    )
    assert done.raw == paths
    assert done.rows == {"taxpayer_register": 150, "tax_returns": 1500, "tax_returns_clean": 1131}
    assert spark.read.parquet(done.clean).columns == filings(spark, sf_dir).columns


def test_a_broken_off_run_goes_on_at_the_first_unfinished_step(spark, rows, monkeypatch):
    from probity.plans import pipeline

    raw = rows(
        "return_id STRING, tin STRING, currency STRING, amount_due_ugx DOUBLE, filing_date DATE",
        [(k, f"123456789{k}", "UGX", 1.0, date(2024, 1, 2)) for k in "0123"],
    )
    known = rows("tin STRING", [(f"123456789{k}",) for k in "0123"])
    out = scratch_dir(spark)
    catalogue = Catalogue(spark, f"{out}/catalogue")

    def run(**more):
        return run_pipeline(
            spark, raw, known, out, catalogue, date(2024, 6, 1), order_by=["return_id"],
            **{"run_ts": RUN_TS, "run_id": "r1", **more},
        )

    def tries():
        stored = catalogue.steps().filter("run_id = 'r1'").orderBy("seq").collect()
        return [(s.step, s.attempt, s.status) for s in stored]

    calls = []
    whole = pipeline.write_table

    def failing(df, path, fmt="parquet"):
        calls.append(path.rsplit("/", 1)[1])
        if path.endswith("tax_returns_clean") and len(calls) == 3:
            raise OSError("disk full")
        return whole(df, path, fmt)

    monkeypatch.setattr(pipeline, "write_table", failing)
    with pytest.raises(OSError, match="disk full"):
        run()
    first = ["begin", "taxpayer_register", "tax_returns", "register", "check", "log"]
    assert tries() == [*[(s, 1, "success") for s in first], ("clean", 1, "failed")]
    failed = catalogue.steps().filter("status = 'failed'").first()
    assert failed.duration_ms >= 0 and failed.message == "OSError: disk full" and failed.rows is None

    # The same again, but the step after cleaning is lost once its rows are in the catalogue.
    with monkeypatch.context() as patch:
        lost = Catalogue.register_transformation

        def broken(self, *given, **named):
            lost(self, *given, **named)
            raise RuntimeError("the driver is gone")

        patch.setattr(Catalogue, "register_transformation", broken)
        with pytest.raises(RuntimeError, match="gone"):
            run()
    done = run()
    assert calls[:4] == ["taxpayer_register", "tax_returns", "tax_returns_clean", "tax_returns_clean"]
    assert calls[4:] == ["missing_values", "quick_stats", "raw_sample", "clean_sample"]
    assert tries()[6:] == [
        ("clean", 1, "failed"), ("clean", 2, "success"), ("register_clean", 1, "failed"),
        ("register_clean", 2, "success"), ("summary", 1, "success"), ("profile", 1, "success"),
    ]
    assert done.rows == {"taxpayer_register": 4, "tax_returns": 4, "tax_returns_clean": 4}
    # Each row is in the catalogue once, and the stored time of the step is the one of its good try.
    assert (catalogue.datasets().count(), catalogue.dq_runs().count()) == (3, 1)
    (step,) = catalogue.transformations().collect()
    stored = {(s.step, s.status): s.duration_ms for s in catalogue.steps().collect()}
    assert step.duration_ms == stored["clean", "success"] == done.duration_ms["clean"]
    # A finished run does nothing more; another run id is another run, and other inputs are refused.
    before = len(calls)
    assert run() == done and len(calls) == before
    with pytest.raises(ValueError, match="began with another"):
        run(run_ts=datetime(2030, 1, 1))
    assert run(run_id=None, run_ts=datetime(2024, 6, 3)).run_id not in ("r1", None)
    assert catalogue.datasets().count() == 6


@pytest.mark.parametrize("name", ["", "a/b", "*"])
def test_a_run_id_is_the_name_of_a_file(spark, name):
    with pytest.raises(ValueError, match="run id"):
        Catalogue(spark, scratch_dir(spark)).ledger(name)


def test_steps_of_no_run(spark):
    assert Catalogue(spark, scratch_dir(spark)).steps().count() == 0
