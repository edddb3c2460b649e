"""Checks on tables that grow by files."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from probity import Check, ForeignKey, RowRule, Severity, UniqueKey, measure
from probity.operators import rules
from probity.plans import incremental
from probity.plans.incremental import CheckState
from probity.session import scratch_dir
from probity.sources.commits import BatchTable

CHECKS = [
    Check("o", RowRule("Validity", "v", "negative", "v < 0", ("v",), Severity("HIGH"))),
    Check("o", rules.not_null("v")),
    Check("o", UniqueKey(("id",))),
    Check("o", ForeignKey("p", "parent", "k", "orphan")),
    Check("parent", UniqueKey(("k",))),
]
SCHEMA, PARENT = "id LONG, p INT, v DOUBLE", "k LONG"


@pytest.fixture
def made(spark, rows):
    folder = f"{scratch_dir(spark)}/with space %"
    parts = [
        [(1, 1, 1.0), (2, 2, -1.0), (3, None, float("nan"))],
        [(3, 9, 2.0), (4, 1, None)],
        [(1, 9, -0.5), (None, 3, 1.0), (None, 1, 1.0)],
    ]
    frames = [rows(SCHEMA, p) for p in parts]
    parent = rows(PARENT, [(1,), (2,), (2,)])
    state = CheckState(spark, f"{folder}/state", CHECKS, {"o": frames[0].schema, "parent": parent.schema})
    return folder, frames, parent, state


def _write(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def test_deliveries_add_up_to_one_run_over_all(made):
    folder, frames, parent, state = made
    _write(parent, f"{folder}/parent")
    state.deliver("parent", f"{folder}/parent")
    for k, part in enumerate(frames, 1):
        _write(part, f"{folder}/o")
        assert len(state.deliver("o", f"{folder}/o")) == 1
        whole = frames[0]
        for other in frames[1:k]:
            whole = whole.union(other)
        want = sorted(map(tuple, measure(CHECKS, {"o": whole, "parent": parent}).collect()))
        assert sorted(map(tuple, state.metrics().collect())) == want
        state.compact()
        assert sorted(map(tuple, state.metrics().collect())) == want
    assert state.deliver("o", f"{folder}/o") == []
    assert len(state.files("o")) == 3


def test_only_new_files_are_scanned(made, monkeypatch):
    folder, frames, _, state = made
    scanned = []
    whole = CheckState.scan

    def noted(self, name, files):
        df = whole(self, name, files)
        scanned.append(sorted(df.inputFiles()))
        return df

    monkeypatch.setattr(CheckState, "scan", noted)
    for part in frames:
        _write(part, f"{folder}/o")
        assert state.deliver("o", f"{folder}/o") == scanned[-1]
    assert [len(s) for s in scanned] == [1, 1, 1]
    assert len({f for s in scanned for f in s}) == 3


def test_rows_of_a_large_file_are_dealt_to_tasks(made, rows, monkeypatch):
    folder, frames, parent, state = made
    monkeypatch.setattr(incremental, "ROWS", 20)
    many = rows(SCHEMA, [(k % 70, k % 4 or None, float(k % 3 - 1)) for k in range(100)])
    for df in (many, frames[0]):
        _write(df, f"{folder}/o")
        new = state.new_files("o", f"{folder}/o")
        assert len(new) == 1  # of one row group, which one task reads
        task = F.spark_partition_id().alias("task")
        sizes = [r["count"] for r in state.scan("o", new).groupBy(task).count().collect()]
        assert sum(sizes) == df.count() and max(sizes) < 50
        state.deliver("o", f"{folder}/o")
    _write(parent, f"{folder}/parent")
    state.deliver("parent", f"{folder}/parent")
    want = sorted(map(tuple, measure(CHECKS, {"o": many.union(frames[0]), "parent": parent}).collect()))
    assert sorted(map(tuple, state.metrics().collect())) == want
    state.compact()
    assert sorted(map(tuple, state.metrics().collect())) == want


def test_a_delivery_that_is_broken_off_is_read_again(made, monkeypatch):
    folder, frames, _, state = made
    _write(frames[0], f"{folder}/o")

    def gone(self, change):
        raise RuntimeError("the driver is gone")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="gone"):
        state.state.version()
        patch.setattr(BatchTable, "commit", gone)
        state.deliver("o", f"{folder}/o")
    assert state.files("o") == []
    assert len(state.deliver("o", f"{folder}/o")) == 1
    assert {r.total_rows for r in state.metrics().filter("dataset = 'o'").collect()} == {3}


def test_two_deliveries_of_one_file_at_a_time_count_it_once(made, monkeypatch):
    folder, frames, _, state = made
    _write(frames[0], f"{folder}/o")
    whole = BatchTable.write_batch

    def slow(self, given):
        name = whole(self, given)
        with monkeypatch.context() as patch:
            patch.setattr(BatchTable, "write_batch", whole)
            state.deliver("o", f"{folder}/o")
        return name

    with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="same files"):
        patch.setattr(BatchTable, "write_batch", slow)
        state.deliver("o", f"{folder}/o")
    assert {r.total_rows for r in state.metrics().filter("dataset = 'o'").collect()} == {3}


def test_files_without_rows_and_no_files(made, spark):
    folder, frames, _, state = made
    _write(frames[0].limit(0), f"{folder}/o")
    state.deliver("o", f"{folder}/o")
    assert state.deliver("o", f"{folder}/o") == []
    assert {(r.affected_rows, r.total_rows) for r in state.metrics().collect()} == {(0, 0)}


def test_other_checks_are_counted_anew(made, spark):
    folder, frames, parent, state = made
    _write(frames[0], f"{folder}/o")
    state.deliver("o", f"{folder}/o")
    schemas = {"o": frames[0].schema, "parent": parent.schema}
    other = CheckState(spark, f"{folder}/state", CHECKS[:3], {"o": frames[0].schema})
    assert len(other.new_files("o", f"{folder}/o")) == 1
    again = CheckState(spark, f"{folder}/state", CHECKS, schemas)
    assert again.new_files("o", f"{folder}/o") == []
    with pytest.raises(ValueError, match="SQL text"):
        rule = RowRule("Validity", "v", "x", F.col("v") < 0, ("v",), Severity("LOW"))
        CheckState(spark, folder, [Check("o", rule)], schemas)


def test_rows_may_be_prepared(made, spark):
    folder, frames, _, _ = made
    _write(frames[0], f"{folder}/o")
    rule = rules.not_future("day", date(2024, 1, 1), "late")
    state = CheckState(
        spark, f"{folder}/prepared", [Check("o", rule)], {"o": frames[0].schema},
        {"o": lambda df: df.withColumn("day", F.expr("date_add(DATE '2023-12-30', CAST(id AS INT))"))},
    )
    state.deliver("o", f"{folder}/o")
    assert [(r.affected_rows, r.total_rows) for r in state.metrics().collect()] == [(1, 3)]
