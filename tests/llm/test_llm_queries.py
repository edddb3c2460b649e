"""The registered queries of the subpackage that have reference SQL."""

from __future__ import annotations

import pytest
from compare import connect, oracle_bag, spark_bag

from probity.llm.oracle import ORACLE
from probity.llm.queries import QUERIES


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_its_sql(spark, sf_dir, name):
    columns, got = spark_bag(QUERIES[name](spark, sf_dir))
    want_columns, want = oracle_bag(connect(sf_dir), ORACLE[name])
    assert columns == want_columns
    assert got == want


def test_every_operator_is_registered():
    names = [n.split("_")[0] for n in QUERIES if n != "pipeline"]
    assert sorted(names) == sorted(f"op{k}" for k in range(1, 14))
    assert "pipeline" in QUERIES
