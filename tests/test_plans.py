"""Plans are what they should be: scans, shuffles, pushed filters."""

from __future__ import annotations

import re
from datetime import date

import pytest
from pyspark.sql import types as T
from workload.queries import QUERIES

from probity.model import RETURNS_SCHEMA
from probity.plans.filings import clean_returns, completeness_rules, validity_rules
from probity.model import Check
from probity.operators.measure import measure
from probity.operators.profile import footer_scan
from probity.session import scratch_dir


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def returns(spark):
    path = f"{scratch_dir(spark)}/returns"
    spark.createDataFrame([], RETURNS_SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


def test_all_row_rules_share_one_scan(spark, returns):
    rules = [*completeness_rules(returns.columns), *validity_rules("tax_returns")]
    text = plan(measure([Check("t", r) for r in rules], {"t": returns}))
    assert text.count("FileScan") == 1
    assert text.count("Exchange") == 1


def test_the_whole_rule_set_scans_each_table_once(spark, sf_dir):
    text = plan(QUERIES["dq_metrics_all"](spark, sf_dir))
    assert len(re.findall(r"FileScan.*?orders\.parquet", text)) == 1
    assert len(re.findall(r"FileScan.*?customer\.parquet", text)) == 1
    # One shuffle of keys, combined before it, one by check, one of the single row.
    assert "partial_sum(n" in text and "SortMergeJoin" not in text
    assert len(re.findall(r"Exchange hashpartitioning\(slot#\d+, key#\d+", text)) == 1


def test_a_key_alone_reads_its_column_only(spark, sf_dir):
    text = plan(QUERIES["dq_uniqueness"](spark, sf_dir))
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint>", text)


def test_groupings_are_combined_before_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["dq_referential"](spark, sf_dir))
    assert "partial_sum(n" in text
    assert "SortMergeJoin" not in text


def test_cleaning_pushes_its_filters_and_limits_before_the_shuffle(returns):
    text = plan(clean_returns(returns, date(2024, 1, 1), ["period_start", "assessor_id"]))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", text).group(1)
    for part in ("IsNotNull(tin)", "EqualTo(currency,UGX)", "GreaterThanOrEqual(amount_due_ugx,0.0)", "LessThanOrEqual(filing_date"):
        assert part in pushed
    below = text[text.index("Exchange hashpartitioning(return_id") :]
    assert "WindowGroupLimit" in below and "Partial" in below
    assert text.count("Exchange ") == 1


def test_the_cleaning_summary_shuffles_keys_and_counts_only(returns):
    from probity.plans.filings import summarise_cleaning

    text = plan(summarise_cleaning(returns, date(2024, 1, 1)))
    assert "Window" not in text and "Sort " not in text
    assert "partial_count" in text


def test_samples_are_taken_without_a_full_sort(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(QUERIES["sample_rows"](spark, sf_dir))


def test_long_texts_are_shuffled_as_digests(spark, sf_dir):
    text = plan(QUERIES["nat_duplicate_text"](spark, sf_dir))
    assert text.index("Exchange hashpartitioning") < text.index("sha2")


def test_a_day_limit_on_timestamps_reaches_the_scan(spark):
    path = f"{scratch_dir(spark)}/returns"
    typed = spark.createDataFrame([], RETURNS_SCHEMA).selectExpr(
        "* EXCEPT (filing_date)", "CAST(filing_date AS TIMESTAMP_NTZ) AS filing_date"
    )
    typed.write.parquet(path)
    text = plan(clean_returns(spark.read.parquet(path), date(2024, 1, 1), ["assessor_id"]))
    assert "LessThan(filing_date,2024-01-02T00:00" in text


@pytest.mark.parametrize("name", ["first_per_key_late", "clean_filings_late"])
def test_late_first_rows_shuffle_no_wide_column(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "Exchange hashpartitioning" not in text and "Window" not in text
    assert "BroadcastHashJoin" in text and "LeftAnti" in text


def test_counts_come_from_footers(spark):
    schema = T.StructType.fromDDL("a INT, b STRING, c DATE, d TIMESTAMP_NTZ, e DECIMAL(10, 2)")
    path = f"{scratch_dir(spark)}/t"
    spark.createDataFrame([(1, None, None, None, None), (None, "x", None, None, None)], schema).write.parquet(path)
    scan = footer_scan(spark, path, schema, schema.names)
    assert "PushedAggregation: [COUNT(*)" in plan(scan)
    assert "COUNT(b)" in plan(scan)
    assert tuple(scan.first()) == (2, 1, 1, 0, 0, 0)
