from __future__ import annotations

from datetime import date, datetime

import pytest

from probity.model import RETURNS_SCHEMA
from probity.operators import membership
from probity.operators.profile import (
    missing_before_after,
    null_counts,
    null_counts_of_files,
    quick_stats,
    sample_rows,
)
from probity.operators.remedy import keep_first, keep_first_late
from probity.plans.filings import clean_returns, summarise_cleaning
from probity.session import scratch_dir
from probity.sources import INPUT_POSITION, read_parquet

SCHEMA = (
    "src_seq INT, return_id STRING, tin STRING, amount_due_ugx DOUBLE, amount_paid_ugx DOUBLE, "
    "currency STRING, filing_date DATE"
)
TIN, DAY = "1234567890", date(2024, 6, 30)
NAN = float("nan")
SEQ = ["src_seq"]


def row(seq, rid="a", tin=TIN, due=1.0, paid=1.0, currency="UGX", filed=DAY):
    return (seq, rid, tin, due, paid, currency, filed)


DATA = [
    row(1, currency="USD"),
    row(2),
    row(3),
    row(4, None),
    row(5, None),
    row(6, "b", tin=None),
    row(7, "c", tin="123456789X"),
    row(8, "d", due=None),
    row(9, "e", due=NAN),
    row(10, "f", due=-0.01),
    row(11, "g", due=0.0, paid=NAN),
    row(12, "h", currency=None),
    row(13, "i", filed=None),
    row(14, "j", filed=date(2024, 7, 1)),
]


@pytest.mark.parametrize("as_of", [DAY, datetime(2024, 6, 30, 12)])
def test_clean(rows, as_of):
    df = rows(SCHEMA, DATA).repartition(5)
    clean = clean_returns(df, as_of, SEQ).orderBy("src_seq").collect()
    # The dirty first copy of "a" does not hide the good one, and one NULL id is kept.
    assert [r.src_seq for r in clean] == [2, 4, 11]
    assert clean[-1].amount_paid_ugx is None
    assert tuple(summarise_cleaning(df, as_of).first()) == (14, 3, 11, 21.4)


def test_time_of_day_counts_for_timestamps(rows):
    schema = SCHEMA.replace("filing_date DATE", "filing_date TIMESTAMP_NTZ")
    df = rows(schema, [row(1, "a", filed=datetime(2024, 6, 30, 9)), row(2, "b", filed=datetime(2024, 6, 30, 15))])
    assert clean_returns(df, datetime(2024, 6, 30, 12), SEQ).count() == 1
    assert clean_returns(df, DAY, SEQ).count() == 2


def test_the_first_row_must_be_defined(rows):
    with pytest.raises(ValueError, match="which row"):
        clean_returns(rows(SCHEMA, DATA), DAY)


def test_empty_table(rows):
    df = rows(SCHEMA, [])
    assert clean_returns(df, DAY, SEQ).count() == 0
    assert tuple(summarise_cleaning(df, DAY).first()) == (0, 0, 0, 100.0)


def test_keep_first_by_several_columns(rows):
    df = rows("k STRING, a INT, b INT", [("x", 2, 1), ("x", 1, 9), ("x", 1, 3), (None, 5, 5), (None, 4, 4)])
    got = keep_first(df.repartition(4), ["k"], ["a", "b"]).collect()
    assert {tuple(r) for r in got} == {("x", 1, 3), (None, 4, 4)}


def test_missing_before_after_with_different_columns(rows):
    raw = rows("a STRING, b DOUBLE, c INT", [(None, NAN, 1), ("x", None, 2)])
    clean = rows("a STRING, b DOUBLE, d INT", [("x", 1.0, None)])
    got = {r.column_name: tuple(r)[1:] for r in missing_before_after(raw, clean).collect()}
    assert got == {"a": (1, 0, 1), "b": (2, 0, 2), "c": (0, None, None), "d": (None, 1, None)}


def test_quick_stats_count_a_null_currency(rows):
    df = rows("k STRING, v DOUBLE, c STRING", [(None, -1.0, None), ("x", NAN, "UGX"), ("y", None, "USD")])
    assert tuple(quick_stats({"raw": df}, "k", "v", "c", "UGX").first()) == ("raw", 1, 1, 2)


def test_sample_is_the_first_rows(spark):
    df = spark.range(1000).repartition(7)
    assert [r.id for r in sample_rows(df, "id").collect()] == list(range(100))


@pytest.mark.parametrize("hot_rows", [100_000, 3])
def test_late_first_rows_are_the_first_rows(rows, spark, monkeypatch, hot_rows):
    """Ties, NULL keys, a hot key, and a table without any repeated key."""
    monkeypatch.setattr(membership, "HOT_ROWS", hot_rows)
    data = [(k, None if k % 11 == 0 else k % 7, k % 3, f"wide {k}") for k in range(200)] + [(300 + k, 99, 0, "hot") for k in range(100)]
    df = rows("id INT, key INT, at INT, wide STRING", data).repartition(6)
    late = keep_first_late(df, ["key"], ["at"], ["id"])
    assert sorted(map(tuple, late.collect()), key=str) == sorted(
        map(tuple, keep_first(df, ["key"], ["at", "id"]).collect()), key=str
    )
    assert late.columns == df.columns
    two = keep_first_late(df, ["key", "at"], ["id"], ["id"])
    assert two.count() == df.select("key", "at").distinct().count()
    alone = df.filter("id < 5 AND key IS NOT NULL")
    assert keep_first_late(alone, ["id"], ["at"], ["id"]) is alone
    assert keep_first_late(df.limit(0), ["key"], ["at"], ["id"]).count() == 0


def test_late_cleaning_goes_by_input_position(spark, rows):
    path = f"{scratch_dir(spark)}/t"
    rows(SCHEMA, DATA).drop("src_seq").coalesce(1).write.parquet(path)
    raw = read_parquet(spark, path, RETURNS_SCHEMA, position=True)
    late = clean_returns(raw, DAY, row_id=[INPUT_POSITION])
    assert sorted(map(str, late.collect())) == sorted(map(str, clean_returns(raw, DAY).collect()))
    assert late.columns == raw.drop(INPUT_POSITION).columns


def test_nulls_by_footers_are_those_of_a_scan(rows, spark):
    schema = "a INT, f DOUBLE, b STRING, `odd name` DATE, g FLOAT, h BOOLEAN, s STRUCT<x: INT, y: INT>, t BINARY, n ARRAY<INT>"
    data = [
        (1, NAN, None, None, None, True, None, b"", None),
        (None, 1.0, "", DAY, NAN, None, (None, 1), None, [None]),
        (2, None, None, None, 1.0, None, (1, None), b"x", []),
    ]
    df = rows(schema, data).repartition(2)
    path = f"{scratch_dir(spark)}/t"
    df.write.parquet(path)
    want = {r.column_name: r.nulls for r in null_counts(df).collect()}
    got = {r.column_name: r.nulls for r in null_counts_of_files(spark, path, df.schema).collect()}
    assert got == want == {"a": 1, "b": 2, "f": 2, "g": 2, "h": 2, "n": 1, "s": 1, "t": 1, "odd name": 2}
    df.limit(0).write.mode("overwrite").parquet(path)
    assert {r.nulls for r in null_counts_of_files(spark, path, df.schema).collect()} == {0}
    assert {r.nulls for r in null_counts_of_files(spark, path, df.select("f").schema).collect()} == {0}
