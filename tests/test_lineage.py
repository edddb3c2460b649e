from __future__ import annotations

import hashlib
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest

from probity.functions import surrogate_id
from probity.plans import lineage
from probity.plans.scoring import result_document
from probity.session import scratch_dir
from probity.sources import Catalogue, Dataset
from probity.sources.catalogue import dataset_rows
from probity.sources.commits import BatchTable, Conflict

T1, T2 = datetime(2026, 3, 10, 16, 28, 47, 123456), datetime(2026, 3, 11, 9)


@pytest.fixture
def catalogue(spark):
    return Catalogue(spark, f"{scratch_dir(spark)}/catalogue").init()


def test_new_tables_are_empty(catalogue):
    assert catalogue.init().datasets().count() == 0
    assert catalogue.transformations().count() == 0
    assert catalogue.dq_runs().count() == 0


def test_ids(catalogue, rows):
    want = hashlib.md5(b"tax_returns2026-03-10T16:28:47.123456").hexdigest()
    assert surrogate_id("tax_returns", T1) == want[:16]
    assert surrogate_id("tax_returns", T1, length=20) == want[:20]
    df = rows("a INT", [(1,)])
    one, other = Dataset("t", df, "raw_file", "x"), Dataset("t", df, "raw_file", "y")
    ids = catalogue.register_datasets([one, other], T1)
    assert len(set(ids)) == 2
    assert {r.dataset_id: r.file_path for r in catalogue.datasets().collect()} == dict(zip(ids, "xy", strict=True))
    with pytest.raises(ValueError, match="same name and path"):
        catalogue.register_datasets([one, one], T2)


def test_flow_between_two_datasets_of_one_name(catalogue, rows):
    df = rows("a INT", [(1,)])
    ids = catalogue.register_datasets([Dataset("t", df, "raw_file", p) for p in "xy"], T1)
    catalogue.register_transformation("Copy", [ids[0]], ids[1], "copy", "", T1)
    flow = lineage.flow(lineage.nodes(catalogue.datasets()), lineage.edges(catalogue.transformations()))
    assert [tuple(r) for r in flow.collect()] == [("t", 1, "Copy", "copy", "success", "t", 1)]


def _register(catalogue, df, *names):
    for name in names:
        catalogue.register_dataset(name, df, "raw_file", "p", T1)


def _named(catalogue):
    return sorted(r.name for r in catalogue.datasets().collect())


def test_compaction_keeps_every_row_once(catalogue, rows):
    df = rows("a INT", [(1,)])
    _register(catalogue, df, "a", "b", "c", "d", "e")
    before = sorted(map(tuple, catalogue.datasets().collect()))
    begun = catalogue.datasets()
    assert len(catalogue.table("datasets").version()[1]) == 5
    catalogue.compact("datasets")
    assert len(catalogue.table("datasets").version()[1]) == 1
    assert sorted(map(tuple, catalogue.datasets().collect())) == before
    assert begun.count() == 5  # a reader from before goes on
    catalogue.vacuum("datasets", -1)
    assert sorted(map(tuple, catalogue.datasets().collect())) == before
    catalogue.register_dataset("more", df, "raw_file", "p", T2)
    assert catalogue.datasets().count() == 6


@pytest.mark.parametrize("stopped_at", ["write_batch", "commit", "_put"])
def test_a_compaction_broken_off_anywhere_leaves_each_row_once(catalogue, rows, stopped_at, monkeypatch):
    df = rows("a INT", [(1,)])
    _register(catalogue, df, "a", "b")
    whole = getattr(BatchTable, stopped_at)

    def broken(self, *given):
        if stopped_at == "write_batch":
            whole(self, *given)
        raise RuntimeError("the driver is gone")

    with monkeypatch.context() as patch:
        patch.setattr(BatchTable, stopped_at, broken)
        with pytest.raises(RuntimeError, match="gone"):
            catalogue.compact("datasets")
    assert _named(catalogue) == ["a", "b"]
    assert catalogue.listing().count() == 2
    _register(catalogue, df, "c")
    catalogue.compact("datasets")
    assert _named(catalogue) == ["a", "b", "c"]
    assert any(n.startswith("batch=") for n in catalogue.vacuum("datasets", -1))
    assert _named(catalogue) == ["a", "b", "c"]


def test_an_append_beside_a_compaction_stays(catalogue, rows, monkeypatch):
    df = rows("a INT", [(1,)])
    _register(catalogue, df, "a", "b")
    whole = BatchTable.write_batch

    def slow(self, given):
        name = whole(self, given)
        with monkeypatch.context() as patch:
            patch.setattr(BatchTable, "write_batch", whole)
            _register(catalogue, df, "c")
        return name

    with monkeypatch.context() as patch:
        patch.setattr(BatchTable, "write_batch", slow)
        catalogue.compact("datasets")
    assert _named(catalogue) == ["a", "b", "c"]
    assert len(catalogue.table("datasets").version()[1]) == 2


def test_of_two_compactions_one_gives_way(catalogue, rows, monkeypatch):
    _register(catalogue, rows("a INT", [(1,)]), "a", "b")
    whole = BatchTable.write_batch

    def slow(self, given):
        name = whole(self, given)
        with monkeypatch.context() as patch:
            patch.setattr(BatchTable, "write_batch", whole)
            catalogue.compact("datasets")
        return name

    with monkeypatch.context() as patch, pytest.raises(Conflict):
        patch.setattr(BatchTable, "write_batch", slow)
        catalogue.compact("datasets")
    assert _named(catalogue) == ["a", "b"]


def test_appends_at_the_same_time_all_stay(catalogue, rows):
    df = rows("a INT", [(1,)])
    names = [f"d{k}" for k in range(6)]
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda n: _register(catalogue, df, n), names))
    assert _named(catalogue) == names


def test_tables_from_before_there_were_commits(spark, rows):
    catalogue = Catalogue(spark, f"{scratch_dir(spark)}/catalogue")
    df = rows("a INT", [(1,)])
    for name in ("a", "b"):
        dataset_rows([Dataset(name, df, "raw_file", "p")], T1).write.parquet(
            f"{catalogue.path}/datasets/batch={name}"
        )
    assert _named(catalogue) == ["a", "b"]
    _register(catalogue.init(), df, "c")
    assert _named(catalogue) == ["a", "b", "c"]


def _reached(rows, edges):
    pairs = lineage.reach(rows("`from` STRING, `to` STRING", edges)).collect()
    return {(r["from"], r["to"]): r["steps"] for r in pairs}


def test_reach_over_chains_branches_and_cycles(rows):
    chain = [(f"n{k:02}", f"n{k + 1:02}") for k in range(37)]
    got = _reached(rows, [*chain, ("n00", "n30")])
    assert len(got) == 37 * 38 / 2
    assert (got["n00", "n37"], got["n00", "n29"], got["n01", "n37"]) == (8, 29, 36)
    assert _reached(rows, []) == {}
    assert _reached(rows, [(None, "a"), ("a", None), ("a", "a"), ("a", "b"), ("a", "b")]) == {("a", "b"): 1}
    ring = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("e", "a")]
    want = {
        ("a", "b"): 1, ("a", "c"): 2, ("a", "d"): 3, ("b", "c"): 1, ("b", "a"): 2, ("b", "d"): 2, ("c", "a"): 1,
        ("c", "b"): 2, ("c", "d"): 1, ("e", "a"): 1, ("e", "b"): 2, ("e", "c"): 3, ("e", "d"): 4,
    }
    assert _reached(rows, ring) == want
    near = lineage.related(rows("`from` STRING, `to` STRING", ring), "c").collect()
    assert sorted(map(tuple, near)) == [
        ("down", "a", 1), ("down", "b", 2), ("down", "d", 1), ("up", "a", 2), ("up", "b", 1), ("up", "e", 3),
    ]


def test_reach_writes_each_pair_once(rows, spark, monkeypatch):
    folder = scratch_dir(spark)
    monkeypatch.setattr(lineage, "scratch_dir", lambda _: folder)
    ring = [(f"r{k}", f"r{(k + 1) % 9}") for k in range(9)]
    diamond = [("s", "x"), ("s", "y"), ("x", "t"), ("y", "t"), ("t", "r0")]
    chain = [(f"n{k:02}", f"n{k + 1:02}") for k in range(20)]
    edges = [*ring, *diamond, *chain]
    after = {}
    for a, b in edges:
        after.setdefault(a, []).append(b)
    want = {}
    for start in after:
        steps, now = {start: 0}, [start]
        for a in now:  # grows as it goes
            new = [b for b in after.get(a, []) if b not in steps]
            steps |= {b: steps[a] + 1 for b in new}
            now += new
        want |= {(start, c): n for c, n in steps.items() if n}
    assert _reached(rows, edges) == want
    written = spark.read.option("basePath", folder).parquet(f"{folder}/reach-*")
    assert written.count() == written.select("from", "to").distinct().count() == len(want)


def test_texts_are_kept_as_they_are(catalogue, rows, spark):
    odd = "home ${env:HOME} it's \\n \"x\""
    for setting in ("true", "false"):
        spark.conf.set("spark.sql.parser.escapedStringLiterals", setting)
        try:
            moment = T1 if setting == "true" else T2
            catalogue.register_dataset(odd, rows("a INT", []), odd, odd, moment, odd)
        finally:
            spark.conf.unset("spark.sql.parser.escapedStringLiterals")
    stored = catalogue.datasets().select("name", "source_type", "file_path", "description").collect()
    assert [tuple(r) for r in stored] == [(odd,) * 4] * 2


def test_listing_is_newest_first(catalogue, rows):
    df = rows("a INT, b INT", [(1, 2), (3, 4), (5, 6)])
    old = catalogue.register_dataset("old", df, "raw_file", "x.csv", T1, "it's old")
    new = catalogue.register_datasets([Dataset("n1", df, "raw_file", "y"), Dataset("n2", df, "raw_file", "z", row_count=9)], T2)
    got = catalogue.listing().collect()
    assert [r.dataset_id for r in got] == [*new, old]
    assert tuple(got[-1]) == (old, "old", "raw_file", "x.csv", 3, 2, datetime(2026, 3, 10, 16, 28, 47), "it's old", 0)
    assert {r.name: r.row_count for r in got} == {"old": 3, "n1": 3, "n2": 9}


def test_graph_and_flow(catalogue, rows):
    df = rows("a INT", [(1,), (2,)])
    raw = catalogue.register_dataset("raw", df, "raw_file", "r", T1)
    clean = catalogue.register_dataset("clean", df.limit(1), "transformed", "c", T1)
    step = catalogue.register_transformation("Fix", [raw, "gone"], clean, "filter", "", T1, 12)
    catalogue.register_transformation("Nothing in", [], clean, "make", "", T2)
    stored = catalogue.transformations().filter("step_name = 'Fix'").first()
    assert (stored.transform_id, stored.input_datasets, stored.duration_ms, stored.status) == (step, [raw, "gone"], 12, "success")

    nodes = lineage.nodes(catalogue.datasets())
    edges = lineage.edges(catalogue.transformations())
    assert {tuple(r) for r in nodes.collect()} == {(raw, "raw", "raw_file", 2), (clean, "clean", "transformed", 1)}
    want = {(raw, clean, "Fix", "filter", "success"), ("gone", clean, "Fix", "filter", "success")}
    assert {tuple(r) for r in edges.collect()} == want
    as_text = lineage.inputs_as_json(catalogue.transformations())
    assert {tuple(r) for r in lineage.edges(as_text).collect()} == want
    assert {tuple(r) for r in lineage.flow(nodes, edges).collect()} == {
        ("raw", 2, "Fix", "filter", "success", "clean", 1),
        ("gone", None, "Fix", "filter", "success", "clean", 1),
    }
    late = catalogue.register_dataset("late", df, "raw_file", "l", T2)
    doc = lineage.graph_document(catalogue.datasets(), catalogue.transformations()).first()
    assert [n.asDict() for n in doc.nodes][-1] == {"id": late, "label": "late", "type": "raw_file", "rows": 2}
    assert [list(e.asDict()) for e in doc.edges] == [["from", "to", "label", "operation", "status"]] * 2
    assert len(doc.nodes) == 3
    some = lineage.graph_document(
        lineage.of_ids(catalogue.datasets(), [raw]), lineage.of_ids(catalogue.transformations(), [step])
    ).first()
    assert ([n.id for n in some.nodes], len(some.edges)) == ([raw], 2)


def test_run_log(catalogue, rows):
    metrics = rows(
        "check_seq BIGINT, dataset STRING, dimension STRING, field STRING, description STRING, "
        "affected_rows BIGINT, total_rows BIGINT, pass_rate DOUBLE, severity STRING",
        [(1, "t", "Validity", "f", "", 60, 100, 40.0, "HIGH")],
    )
    run = catalogue.log_dq_run("some-id", result_document(metrics), T1)
    assert tuple(catalogue.dq_runs().first()) == (run, "some-id", 90.0, 1, 1, 0, 0, datetime(2026, 3, 10, 16, 28, 47))
