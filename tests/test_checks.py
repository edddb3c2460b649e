"""Boundary rows of every check."""

from __future__ import annotations

import sys
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from probity import (
    Check,
    ForeignKey,
    RowRule,
    Severity,
    UniqueKey,
    check_completeness,
    check_consistency,
    check_referential_integrity,
    check_timeliness,
    check_uniqueness,
    check_validity,
    measure,
)
from probity.plans.filings import REGISTER, RETURNS

AS_OF = date(2024, 6, 30)
NAN = float("nan")


def found(df) -> dict[str, tuple]:
    return {r.field: (r.affected_rows, r.total_rows, r.pass_rate, r.severity) for r in df.collect()}


def days(n: int) -> date:
    return AS_OF + timedelta(days=n)


@pytest.mark.parametrize(("nulls", "severity"), [(5, "MEDIUM"), (6, "HIGH")])
def test_completeness_threshold_is_strict(rows, nulls, severity):
    df = rows("tin STRING", [(None if i < nulls else "x",) for i in range(100)])
    assert found(check_completeness(df, ["tin"])) == {"tin": (nulls, 100, 100.0 - nulls, severity)}


def test_completeness_skips_a_missing_column(rows):
    assert found(check_completeness(rows("a STRING", [("x",)]), ["a", "nowhere"])) == {}


def test_nan_is_missing(rows):
    df = rows("amount_due_ugx DOUBLE", [(NAN,), (None,), (1.0,)])
    assert found(check_completeness(df, ["amount_due_ugx"]))["amount_due_ugx"][0] == 2


def test_validity_of_returns(rows):
    df = rows(
        "amount_due_ugx DOUBLE, currency STRING, filing_status STRING",
        [
            (-1.0, "UGX", "Filed"),
            (0.0, None, None),
            (NAN, "USD", "Closed"),
            (None, "ugx", "Amended"),
        ],
    )
    assert found(check_validity(df, RETURNS)) == {
        "amount_due_ugx": (1, 4, 75.0, "HIGH"),
        "currency": (2, 4, 50.0, "HIGH"),
        "filing_status": (1, 4, 75.0, "MEDIUM"),
    }


def test_key_pattern(rows):
    bad = ["123456789X", "123456789", "12345678901", "", " 123456789", "1234567890 "]
    df = rows("tin STRING", [(t,) for t in [*bad, "1234567890", None]])
    assert found(check_validity(df, REGISTER))["tin"][:2] == (len(bad), 8)


def test_key_pattern_of_a_number(rows):
    df = rows("tin BIGINT", [(1234567890,), (123,)])
    assert found(check_validity(df, REGISTER))["tin"][0] == 1


def test_unknown_dataset_has_no_issue(rows):
    df = rows("tin STRING, filing_date DATE", [("x", days(9))])
    for check in (check_validity, check_consistency):
        assert check(df, "something_else").collect() == []
    assert check_timeliness(df, "something_else", days(0)).collect() == []


def test_consistency(rows):
    d = date(2024, 1, 1)
    df = rows(
        "period_start DATE, period_end DATE, filing_date DATE, "
        "amount_due_ugx DOUBLE, amount_paid_ugx DOUBLE",
        [
            (d, d, d, 100.0, 150.0),
            (d, days(0), d - timedelta(days=1), 100.0, 150.01),
            (d, None, None, 0.0, 0.0),
            (None, d, d, -5.0, 1.0),
            (d, days(0), d, 1.0, NAN),
            (d, days(0), d, NAN, 1.0),
            (d, days(0), d, None, 1.0),
        ],
    )
    assert {k: v[0] for k, v in found(check_consistency(df, RETURNS)).items()} == {
        "period_start / period_end": 1,
        "filing_date / period_start": 1,
        "amount_paid_ugx / amount_due_ugx": 2,
    }


def test_dates_as_text_are_compared_as_dates(rows):
    df = rows("period_start STRING, period_end STRING", [("2024-01-09", "2024-1-10")])
    assert found(check_consistency(df, RETURNS)) == {}


def test_text_that_is_no_date_fails(rows):
    df = rows("period_start STRING, period_end STRING", [("2024-01-09", "soon")])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        check_consistency(df, RETURNS).collect()


def test_timeliness(rows):
    df = rows(
        "filing_date DATE, filing_status STRING",
        [
            (days(0), "Pending"),
            (days(1), "Filed"),
            (days(-1095), "Pending"),
            (days(-1096), "Pending"),
            (days(-1096), "Filed"),
            (days(-5000), None),
            (None, "Pending"),
        ],
    )
    want = {
        "filing_date": (1, 7, 85.71, "MEDIUM"),
        "filing_date + filing_status": (1, 7, 85.71, "LOW"),
    }
    assert found(check_timeliness(df, RETURNS, AS_OF)) == want
    assert found(check_timeliness(df, RETURNS, datetime(2024, 6, 30, 23, 59))) == want


@pytest.mark.parametrize(("pairs", "severity"), [(1, "MEDIUM"), (2, "HIGH")])
def test_uniqueness_counts_all_members(rows, pairs, severity):
    keys = [f"k{i}" for i in range(100)]
    for i in range(pairs):
        keys[2 * i + 1] = keys[2 * i]
    got = found(check_uniqueness(rows("id STRING", [(k,) for k in keys]), ["id"]))
    assert got == {"id": (2 * pairs, 100, 100.0 - 2 * pairs, severity)}


@pytest.mark.parametrize("digest", [False, True])
def test_null_keys_equal_each_other(rows, digest):
    df = rows("a STRING, b DOUBLE", [("x", None), ("x", NAN), ("x", 1.0), (None, None), (None, None), ("", None)])
    got = found(check_uniqueness(df, ["a", "b"], digest))
    assert got["a + b"][0] == 4


def test_digest_keeps_the_columns_apart(rows):
    df = rows("a STRING, b STRING", [("x", "yz"), ("xy", "z"), ("x", "yz")])
    assert found(check_uniqueness(df, ["a", "b"], digest=True))["a + b"][0] == 2


def test_referential_integrity(rows):
    child = rows("tin STRING", [("1",), ("2",), ("2",), ("3",), (None,)])
    parent = rows("tin STRING", [("1",), ("1",), (None,)])
    assert found(check_referential_integrity(child, parent)) == {"tin": (3, 5, 40.0, "HIGH")}


def test_keys_of_different_types_compare_as_text(rows):
    child = rows("tin STRING", [("1",), ("2X",)])
    assert found(check_referential_integrity(child, rows("tin BIGINT", [(1,)])))["tin"][0] == 1


def test_whole_numbers_of_different_width(rows):
    child, parent = rows("tin INT", [(1,), (2,), (None,)]), rows("tin BIGINT", [(1,), (2**40,)])
    assert found(check_referential_integrity(child, parent))["tin"][:2] == (1, 3)


def test_empty_tables(rows):
    child, parent = rows("tin STRING", []), rows("tin STRING", [])
    bound = [
        Check("c", RowRule("Validity", "tin", "", "tin = 'x'", ("tin",), Severity("LOW"))),
        Check("c", UniqueKey(("tin",))),
        Check("c", ForeignKey("tin", "p", "tin", "")),
    ]
    got = measure(bound, {"c": child, "p": parent}).collect()
    assert [(r.affected_rows, r.total_rows, r.pass_rate, r.severity) for r in got] == [(0, 0, 100.0, None)] * 3


def test_a_foreign_key_and_the_unique_key_it_points_to(rows):
    child = rows("fk STRING", [("a",), ("b",), (None,), ("z",)])
    parent = rows("id STRING", [("a",), ("a",), ("b",), (None,), (None,)])
    bound = [
        Check("c", ForeignKey("fk", "p", "id", "")),
        Check("p", UniqueKey(("id",))),
        Check("c", UniqueKey(("fk",))),
    ]
    got = {r.check_seq: (r.affected_rows, r.total_rows) for r in measure(bound, {"c": child, "p": parent}).collect()}
    assert got == {1: (1, 4), 2: (4, 5), 3: (0, 4)}
    alone = measure(bound[1:2], {"p": parent}).first()
    assert (alone.affected_rows, alone.total_rows) == got[2]


def test_a_rule_may_be_a_column(rows):
    rule = RowRule("Validity", "v", "too large", F.col("v") > 2, ("v",), Severity("LOW"))
    got = measure([Check("t", rule)], {"t": rows("v INT", [(1,), (3,), (None,)])}).first()
    assert (got.affected_rows, got.total_rows, got.severity) == (1, 3, "LOW")


def test_texts_with_quotes_survive(rows):
    rule = RowRule("Validity", "it's", 'a "b" \\ c', "v > 2", ("v",), Severity("LOW"))
    got = measure([Check("t", rule)], {"t": rows("v INT", [(3,)])}).first()
    assert (got.field, got.description) == ("it's", 'a "b" \\ c')


def test_metrics_do_not_depend_on_partitions(spark, sf_dir):
    from workload.fixture import AS_OF as fixture_as_of
    from workload.fixture import COLUMNS, filings, register

    from probity.plans.filings import database_metrics

    f, r = filings(spark, sf_dir), register(spark, sf_dir)
    one = database_metrics(f.coalesce(1), r, fixture_as_of, COLUMNS).collect()
    many = database_metrics(f.repartition(13), r.repartition(5), fixture_as_of, COLUMNS).collect()
    assert sorted(one) == sorted(many)
    assert [r.check_seq for r in sorted(one)] == list(range(1, 22))


KEYS = [
    ("STRING", ["a", "b", "a", None, None, "", "1:a,-"]),
    ("BIGINT", [1, 2, 1, None, -1, 0, 0]),
    ("DOUBLE", [0.0, -0.0, NAN, None, 1e300, 0.1, float("inf")]),
    ("FLOAT", [0.0, -0.0, NAN, None, 1.5, 0.1, 0.1]),
    ("DECIMAL(20, 4)", [Decimal("1.5"), Decimal("1.50"), None, None, Decimal(0), Decimal("-0.0001"), Decimal(1)]),
    ("DATE", [days(0), days(0), None, days(1), days(2), None, days(3)]),
    ("TIMESTAMP", [datetime(2024, 1, 1, 1, 1, 1, 1)] * 2 + [datetime(2024, 1, 1, 1, 1, 1, 2), None, None, *[datetime(1, 1, 1)] * 2]),
    ("BINARY", [b"", b"\x00", b"\x00", None, None, b"a", b"A"]),
    ("BOOLEAN", [True, False, True, None, None, True, False]),
]


@pytest.mark.parametrize(("kind", "values"), KEYS, ids=[k for k, _ in KEYS])
def test_one_scan_counts_what_each_grouping_counts(rows, monkeypatch, kind, values):
    """The tally of all checks against a grouping for each, on keys of every type."""
    data = [(v, values[k // 2], k) for k, v in enumerate(values)]
    child = rows(f"a {kind}, b {kind}, n INT", data)
    parent = rows(f"k {kind}, n INT", [(v, 1) for v in values[:3]])
    checks = [
        Check("child", RowRule("Validity", "n", "odd", "n % 2 = 1", ("n",), Severity("HIGH"))),
        Check("child", RowRule("Validity", "x", "not there", "x = 1", ("x",), Severity("HIGH"))),
        Check("child", RowRule("Completeness", "a", "missing", F.col("a").isNull(), ("a",), Severity("LOW"))),
        Check("child", UniqueKey(("a",))),
        Check("child", UniqueKey(("a", "b"))),
        Check("child", UniqueKey(("a",), digest=True)),
        Check("child", ForeignKey("a", "parent", "k", "orphan")),
        Check("parent", UniqueKey(("k",))),
        Check("empty", UniqueKey(("k",))),
    ]
    tables = {"child": child, "parent": parent, "empty": parent.limit(0)}
    together = sorted(map(tuple, measure(checks, tables).collect()))
    monkeypatch.setattr(sys.modules["probity.operators.measure"], "_scans_again", lambda checks: False)
    assert together == sorted(map(tuple, measure(checks, tables).collect()))
    assert [r[0] for r in together] == [1, 3, 4, 5, 6, 7, 8, 9]


def test_keys_of_different_types_meet_in_one_scan(rows, monkeypatch):
    child = rows("a INT, b STRING, c DATE", [(1, "1", days(0)), (2, "x", days(1)), (None, None, None), (1, "2.0", days(0))])
    parent = rows("d DOUBLE, i BIGINT, t TIMESTAMP_NTZ", [(1.0, 1, datetime(2024, 6, 30)), (NAN, 3, None)])
    checks = [
        Check("child", ForeignKey("a", "parent", "d", "number")),
        Check("child", ForeignKey("b", "parent", "i", "text")),
        Check("child", ForeignKey("c", "parent", "t", "day")),
        Check("child", RowRule("Completeness", "a", "missing", "a IS NULL", ("a",), Severity("LOW"))),
    ]
    tables = {"child": child, "parent": parent}
    together = sorted(map(tuple, measure(checks, tables).collect()))
    assert [(r[0], r[5], r[6]) for r in together] == [(1, 1, 4), (2, 2, 4), (3, 1, 4), (4, 1, 4)]
    monkeypatch.setattr(sys.modules["probity.operators.measure"], "_scans_again", lambda checks: False)
    assert together == sorted(map(tuple, measure(checks, tables).collect()))


def test_keys_without_a_text_are_grouped_apart(rows):
    df = rows("a ARRAY<INT>, n INT", [([1], 1), ([1], 2), (None, 3)])
    checks = [Check("t", UniqueKey(("a",))), Check("t", UniqueKey(("n",)))]
    assert sorted((r.check_seq, r.affected_rows, r.total_rows) for r in measure(checks, {"t": df}).collect()) == [(1, 2, 3), (2, 0, 3)]
