"""Every registered query against its SQL, and the shape of its plan."""

from __future__ import annotations

import importlib
import sys

import pytest
from compare import connect, oracle_bag, spark_bag

import __spark_entry__ as entry_point
from workload.oracle import ORACLE
from workload.queries import QUERIES

NEVER = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLE) <= set(entry_point.oracle_sql())


def test_queries_are_there_without_the_llm_subpackage(monkeypatch):
    monkeypatch.setitem(sys.modules, "probity.llm", None)
    monkeypatch.delitem(sys.modules, "probity.llm.queries", raising=False)
    alone = importlib.reload(entry_point)
    assert set(alone.queries()) == set(QUERIES)
    monkeypatch.undo()
    importlib.reload(entry_point)


def test_entry(spark, sf_dir):
    assert entry_point.entry(spark).count() == 21


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in NEVER if node in plan]
    columns, got = spark_bag(df)
    want_columns, want = oracle_bag(con, ORACLE[name])
    assert columns == want_columns
    assert got == want
