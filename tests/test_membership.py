"""Row-level membership against brute force, with one key holding a third of the rows."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest

from probity.model import Check, ForeignKey, UniqueKey
from probity.operators import membership
from probity.operators.measure import is_orphan, key_counts, key_presence, measure
from probity.operators.membership import HOT_ROWS, duplicate_rows, orphan_rows, settle

ALL = pytest.mark.parametrize("hot_rows", [HOT_ROWS, 50], ids=["whole", "sliced"])


def skewed() -> list[tuple]:
    """3000 rows: a third share one key, a tenth have none, the rest come once or twice."""
    data = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else None if i % 10 == 1 else f"k{i // 4}"
        data.append((i, key, float(i % 7)))
    return data


@ALL
def test_duplicate_rows(rows, hot_rows):
    data = skewed()
    seen = Counter(k for _, k, _ in data)
    want = sorted(i for i, k, _ in data if seen[k] > 1)
    got = duplicate_rows(rows("i INT, k STRING, v DOUBLE", data), ["k"], hot_rows=hot_rows)
    assert got.columns == ["i", "k", "v"]
    assert sorted(r.i for r in got.collect()) == want


@ALL
def test_duplicate_rows_on_two_keys_by_digest(rows, hot_rows):
    data = [*skewed(), (9001, "n", float("nan")), (9002, "n", None), (9003, "z", 0.0), (9004, "z", -0.0)]
    seen = Counter((k, None if v is None or v != v else v) for _, k, v in data)
    want = sorted(i for i, k, v in data if seen[(k, None if v is None or v != v else v)] > 1)
    df = rows("i INT, k STRING, v DOUBLE", data)
    for digest in (True, False):
        got = duplicate_rows(df, ["k", "v"], digest=digest, hot_rows=hot_rows)
        assert sorted(r.i for r in got.collect()) == want


@ALL
def test_orphan_rows(rows, hot_rows):
    data = skewed()
    parents = [(f"k{i}",) for i in range(0, 800, 2)] + [(None,)]
    known = {k for (k,) in parents}
    want = sorted(i for i, k, _ in data if k is not None and k not in known)
    child, parent = rows("i INT, k STRING, v DOUBLE", data), rows("p STRING", parents)
    got = orphan_rows(child, parent, "k", "p", hot_rows)
    assert sorted(r.i for r in got.collect()) == want


@pytest.mark.parametrize("digest", [True, False])
@pytest.mark.parametrize(
    ("kind", "values"),
    [
        ("DOUBLE", [0.0, -0.0, 1.5, float("nan"), None, None]),
        ("FLOAT", [0.0, -0.0, 0.1, 0.1]),
        ("BINARY", [b"\xff\xfe", b"\xff\xfe", b"\xff", None]),
        ("STRING", ["a", "a", "", None, None]),
        ("DATE", [date(2024, 1, 1), date(2024, 1, 1), None]),
        ("DECIMAL(10,2)", [Decimal("1.00"), Decimal("1.00"), Decimal("1.01")]),
    ],
)
def test_digests_count_what_values_count(rows, kind, values, digest):
    df = rows(f"i INT, k {kind}", list(enumerate(values)))
    folded = [None if v is None or v != v else v for v in values]
    want = sorted(i for i, v in enumerate(folded) if folded.count(v) > 1)
    checks = [Check("t", UniqueKey(("k",), digest=digest))]
    assert measure(checks, {"t": df}).first().affected_rows == len(want)
    assert sorted(r.i for r in duplicate_rows(df, ["k"], digest=digest).collect()) == want


BIG = 12345678901234567890
ZONE = "America/New_York"
# Twice one o'clock in that zone: the clock is put back at two.
BEFORE, AFTER = datetime.fromtimestamp(1730611800), datetime.fromtimestamp(1730615400)


@pytest.mark.parametrize(
    ("own", "other", "child", "parent", "orphans"),
    [
        ("DECIMAL(20,0)", "DECIMAL(20,0)", [Decimal(BIG), Decimal(BIG + 1)], [Decimal(BIG + 1)], [0]),
        ("DECIMAL(38,0)", "DECIMAL(38,10)", [Decimal(10**27), Decimal(100)], [Decimal(100)], [0]),
        ("FLOAT", "FLOAT", [0.1, 0.2], [0.2], [0]),
        ("DOUBLE", "BIGINT", [1.0, 1.5, -0.0, float("nan")], [1, 0], [1]),
        ("DECIMAL(10,2)", "BIGINT", [Decimal("1.00"), Decimal("1.50")], [1], [1]),
        ("BIGINT", "DECIMAL(10,2)", [1, 2], [Decimal("1.00"), Decimal("2.50")], [1]),
        ("INT", "DOUBLE", [1, 2], [1.0], [1]),
        ("TIMESTAMP_NTZ", "DATE", [datetime(2024, 1, 1), datetime(2024, 1, 1, 1)], [date(2024, 1, 1)], [1]),
        ("DATE", "TIMESTAMP_NTZ", [date(2024, 1, 1), date(2024, 1, 2)], [datetime(2024, 1, 1)], [1]),
        ("TIMESTAMP", "TIMESTAMP", [BEFORE, AFTER], [BEFORE], [1]),
        ("STRING", "BIGINT", ["1", "01", "2"], [1, 2], [1]),
    ],
)
def test_keys_of_two_types_are_counted_and_found_alike(spark, rows, own, other, child, parent, orphans):
    spark.conf.set("spark.sql.session.timeZone", ZONE)
    try:
        c = rows(f"i INT, k {own}", list(enumerate(child)))
        p = rows(f"p {other}", [(v,) for v in parent])
        checks = [Check("c", ForeignKey("k", "p", "p", "lost"))]
        assert measure(checks, {"c": c, "p": p}).first().affected_rows == len(orphans)
        assert sorted(r.i for r in orphan_rows(c, p, "k", "p").collect()) == orphans
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_measurements(rows):
    df = rows("i INT, k STRING, v DOUBLE", skewed())
    keys = settle(key_counts(df, ["k"]), ["k"], "n > 1")
    counted = Counter(k for _, k, _ in skewed())
    repeated = {k: n for k, n in counted.items() if n > 1}
    assert (keys.table_rows, keys.size, keys.largest) == (3000, len(repeated), 1000)
    assert Path(keys.path).exists()
    keys.drop()
    assert not Path(keys.path).exists()


def test_what_is_known_of_hot_keys_does_not_grow_with_the_keys(rows):
    df = rows("k STRING", [(f"{k}" * 10_000,) for k in range(4) for _ in range(60)])
    keys = settle(key_counts(df, ["k"]), ["k"], "n > 1")
    assert sorted(keys.slices(50).values()) == [2, 2, 2, 2]
    assert duplicate_rows(df, ["k"], hot_rows=50).count() == 240
    assert keys.slices(60) == {}


def test_nothing_to_find(rows):
    df = rows("i INT, k STRING", [(1, "a"), (2, "b")])
    assert duplicate_rows(df, ["k"]).count() == 0
    assert duplicate_rows(df.limit(0), ["k"]).count() == 0
    present = key_presence(df, df, "k", "k")
    assert settle(present.withColumnRenamed("key", "k"), ["k"], is_orphan("k")).size == 0


def test_a_hot_key_is_spread_over_slices(rows, monkeypatch):
    monkeypatch.setattr(membership, "SLICES", 100)
    df = rows("i INT, k STRING, v DOUBLE", skewed())
    got = duplicate_rows(df, ["k"], hot_rows=10)
    text = got._jdf.queryExecution().toString()
    assert "__want_slice" in text and "LeftSemi" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert got.count() == duplicate_rows(df, ["k"]).count()
