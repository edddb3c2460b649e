from __future__ import annotations

import hashlib
from datetime import date

import pytest

from probity import Check, ForeignKey, RowRule, Severity, UniqueKey
from probity.operators import corrupt, sample
from probity.operators.detect import detection
from probity.operators.sample import FEW, sample_at_most
from probity.plans.filings import REGISTER, RETURNS, database_metrics


def sound(spark):
    start = "DATE '2023-01-01'"
    returns = spark.range(2000).selectExpr(
        "id AS src_seq",
        "format_string('RET-%05d', id) AS return_id",
        "lpad(CAST(id % 500 AS STRING), 10, '0') AS tin",
        "'VAT' AS tax_type",
        f"{start} AS period_start",
        f"date_add({start}, 30) AS period_end",
        f"date_add({start}, 40) AS filing_date",
        "'Filed' AS filing_status",
        "CAST(id + 1 AS DOUBLE) AS amount_due_ugx",
        "CAST(0 AS DOUBLE) AS amount_paid_ugx",
        "'UGX' AS currency",
    )
    register = spark.range(500).selectExpr(
        "lpad(CAST(id AS STRING), 10, '0') AS tin", "'n' AS taxpayer_name", "'s' AS sector", "'r' AS region"
    )
    return returns, register


def test_detected_equals_injected(spark):
    returns, register = sound(spark)
    key = "src_seq"
    defects = [
        corrupt.null_out("tin", corrupt.every(key, 20, 0)),
        corrupt.orphan("tin", corrupt.every(key, 25, 1)),
        corrupt.negate("amount_due_ugx", corrupt.every(key, 40, 2)),
        corrupt.pick("currency", corrupt.every(key, 25, 3), ["USD", "EUR"], key),
        corrupt.fixed("filing_date", corrupt.every(key, 40, 4), date(2027, 1, 1)),
        corrupt.null_out("amount_due_ugx", corrupt.every(key, 25, 5)),
        corrupt.copied_key("return_id", corrupt.every(key, 40, 6), "format_string('RET-%05d', src_seq + 1)"),
    ]
    bad = corrupt.inject(returns, defects)
    metrics = database_metrics(bad, register, date(2024, 1, 1)).collect()
    got = {(r.dataset, r.dimension, r.field): r.affected_rows for r in metrics if r.affected_rows}
    assert got == {
        (RETURNS, "Completeness", "tin"): 100,
        (RETURNS, "Completeness", "amount_due_ugx"): 80,
        (RETURNS, "Validity", "amount_due_ugx"): 50,
        (RETURNS, "Validity", "currency"): 80,
        (RETURNS, "Consistency", "amount_paid_ugx / amount_due_ugx"): 50,
        (RETURNS, "Uniqueness", "return_id"): 100,
        (RETURNS, "Timeliness", "filing_date"): 50,
        (RETURNS, "Referential Integrity", "tin"): 80,
    }
    assert database_metrics(returns, register, date(2024, 1, 1)).filter("affected_rows > 0").count() == 0
    assert {r.dataset for r in metrics} == {RETURNS, REGISTER}


def test_later_defects_win(spark):
    df = spark.range(4).selectExpr("id", "'a' AS c")
    got = corrupt.inject(df, [corrupt.fixed("c", "id < 3", "b"), corrupt.null_out("c", "id < 2"), corrupt.orphan("c", "id > 1")])
    assert [r.c for r in got.orderBy("id").collect()] == [None, None, "bX", "aX"]


def test_selection_does_not_depend_on_partitions(spark):
    df = spark.range(5000).selectExpr("id", "'a' AS c")
    defect = [corrupt.null_out("c", corrupt.share("id", 5, seed=42))]
    one = {r.id for r in corrupt.inject(df.coalesce(1), defect).filter("c IS NULL").collect()}
    many = {r.id for r in corrupt.inject(df.repartition(9), defect).filter("c IS NULL").collect()}
    assert one == many and 150 < len(one) < 350


def test_sample_and_events(spark):
    df = spark.range(1000).selectExpr("format_string('RET-%05d', id) AS return_id")
    sample = sample_at_most(df, "return_id", 50)
    assert sample.count() == 50
    assert {r[0] for r in sample.collect()} == {r[0] for r in sample_at_most(df.repartition(7), "return_id", 50).collect()}
    assert sample_at_most(df, "return_id", 5000).count() == 1000

    events = corrupt.audit_events(df, "return_id").collect()
    per_return = {}
    for e in events:
        per_return[e.return_id] = per_return.get(e.return_id, 0) + 1
        assert len(e.event_id) == 12 and e.timestamp.year == 2024
        assert e.event_type in corrupt.AUDIT_EVENTS and e.user_id in {f"USR-{i:03d}" for i in range(10, 25)}
    assert set(per_return.values()) == {1, 2, 3} and len(per_return) == 1000
    assert len({e.event_id for e in events}) == len(events)

    twice = df.union(df).selectExpr("return_id", "monotonically_increasing_id() AS line").collect()
    lines = spark.createDataFrame(twice, "return_id STRING, line LONG")
    events = corrupt.audit_events(lines, "return_id", identity="line", id_length=20).collect()
    assert {len(e.event_id) for e in events} == {20}
    assert len({e.event_id for e in events}) == len(events)
    assert len({e.return_id for e in events}) == 1000


def test_share_is_not_cut(spark):
    assert corrupt.share("id", 0.29, 1).endswith("< 2900")


def _in_order(data, key=0):
    """Rows by the digest of their key, NULL first."""
    return sorted(data, key=lambda r: hashlib.md5(str(r[key]).encode()).hexdigest() if r[key] is not None else "")


@pytest.mark.parametrize("few", [FEW, 20])
def test_samples_of_every_size_are_exact(rows, monkeypatch, few):
    monkeypatch.setattr(sample, "FEW", few)
    data = [(k, k % 7) for k in range(3000)] + [(None, 1)]
    df = rows("id LONG, v INT", data)
    want = _in_order(data)
    for n in (0, 1, 2, 19, 333, 1000, 2999, 3000, 3001, 5000):
        assert set(map(tuple, sample_at_most(df, "id", n).collect())) == set(want[:n])
    text = sample_at_most(df, "id", 1000)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in text and "Exchange" not in text and "Sort" not in text


def test_samples_cut_through_rows_of_one_key_and_through_equal_rows(rows, monkeypatch):
    monkeypatch.setattr(sample, "FEW", 5)
    data = [("hot", k) for k in range(200)] + [("hot", None)] * 50 + [(f"k{k}", 0) for k in range(100)]
    df = rows("id STRING, v INT", data)
    before = sum(hashlib.md5(f"k{k}".encode()).digest() < hashlib.md5(b"hot").digest() for k in range(100))
    for n in (before, before + 1, before + 120, before + 249, before + 250, 349):
        got = sample_at_most(df, "id", n).collect()
        assert len(got) == n
        assert sum(r.id == "hot" for r in got) == min(n - before, 250)
        assert len({r.v for r in got if r.id == "hot" and r.v is not None}) == sum(r.id == "hot" and r.v is not None for r in got)
    same = rows("id INT", [(1,)] * 500)
    assert sample_at_most(same, "id", 123).count() == 123
    assert sample_at_most(same.limit(0), "id", 5).count() == 0


def test_mask_has_every_defect_that_hit_a_row(spark):
    df = spark.range(12).selectExpr("id", "id AS v")
    defects = [corrupt.null_out("v", "id % 2 = 0"), corrupt.Defect("v", "id % 3 = 0", "-1L"), corrupt.Defect("v", "v < 0", "9L")]
    got = {r.id: (r.v, r.m) for r in corrupt.inject(df, defects, mask="m").collect()}
    assert got[0] == (9, 0b111) and got[1] == (1, 0) and got[2] == (None, 0b001) and got[3] == (9, 0b110)
    assert corrupt.inject(df, defects).columns == ["id", "v"]
    with pytest.raises(ValueError, match="63"):
        corrupt.inject(df, defects * 22, mask="m")


def test_detection_says_which_check_catches_which_defect(rows):
    # id, key, v, mask: bit 0 a doubled id, bit 1 a negative value, bit 2 an unknown key
    data = [(1, "a", 1, 0), (1, "a", 2, 1), (2, "b", -1, 2), (3, "x", -2, 6), (4, None, 3, 4), (5, "b", 3, None), (1, "z", -4, 7)]
    child = rows("id INT, key STRING, v INT, mask LONG", data)
    parent = rows("k STRING", [("a",), ("b",), ("b",)])
    checks = [
        Check("c", UniqueKey(("id",))),
        Check("c", RowRule("Validity", "v", "negative", "v < 0", ("v",), Severity("HIGH"))),
        Check("c", ForeignKey("key", "p", "k", "orphan")),
        Check("c", RowRule("Validity", "w", "not there", "w < 0", ("w",), Severity("HIGH"))),
        Check("p", UniqueKey(("k",))),
    ]
    got = detection({"c": child, "p": parent}, checks, "c", "mask", ["double", "negative", "unknown", "never"])
    assert got._jdf.queryExecution().executedPlan().toString().count("Scan") == 2
    assert {(r.defect, r.check_seq): (r.injected, r.caught, r.missed) for r in got.collect()} == {
        ("double", 1): (2, 2, 0), ("double", 2): (2, 1, 1), ("double", 3): (2, 1, 1),
        ("negative", 1): (3, 1, 2), ("negative", 2): (3, 3, 0), ("negative", 3): (3, 2, 1),
        ("unknown", 1): (3, 1, 2), ("unknown", 2): (3, 2, 1), ("unknown", 3): (3, 2, 1),
        ("never", 1): (0, 0, 0), ("never", 2): (0, 0, 0), ("never", 3): (0, 0, 0),
    }
    assert detection({"c": child.limit(0), "p": parent}, checks, "c", "mask", ["a"]).collect()[0].injected == 0
