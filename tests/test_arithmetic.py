from __future__ import annotations

import random
from decimal import ROUND_HALF_EVEN, Decimal

import pytest

from probity.functions import half_even_div, pass_rate, retention_pct, score_band, verdict


def exact(num: int, den: int, places: int) -> float:
    step = Decimal(1).scaleb(-places)
    return float((Decimal(100 * num) / Decimal(den)).quantize(step, ROUND_HALF_EVEN))


def test_half_even_ties(rows):
    df = rows("num BIGINT, den BIGINT, want BIGINT", [(5, 2, 2), (7, 2, 4), (1, 2, 0), (3, 2, 2), (9, 4, 2), (11, 4, 3), (0, 7, 0)])
    got = df.selectExpr(f"{half_even_div('num', 'den')} AS got", "want").collect()
    assert all(r.got == r.want for r in got)


def test_division_by_zero_is_null(rows):
    df = rows("num BIGINT, den BIGINT", [(1, 0)])
    assert df.selectExpr(half_even_div("num", "den")).first()[0] is None


def test_rates_equal_exact_decimals(rows):
    rng = random.Random(7)
    pairs = [(rng.randint(0, n), n) for n in [1, 3, 7, 32, 1500, 2000, 60000, 10**12] for _ in range(60)]
    df = rows("affected BIGINT, total BIGINT", pairs)
    for a, n, rate, kept in df.selectExpr("affected", "total", pass_rate("affected", "total"), retention_pct("total - affected", "total")).collect():
        assert rate == exact(n - a, n, 2)
        assert kept == exact(n - a, n, 1)


@pytest.mark.parametrize("n", [32, 1500, 2000, 15000])
def test_rates_equal_rounding_of_a_double(spark, n):
    df = spark.range(n + 1).selectExpr("id", f"{pass_rate('id', f'{n}L')} AS rate")
    assert all(r.rate == round(100.0 * (n - r.id) / n, 2) for r in df.collect())


def test_empty_table_passes(rows):
    df = rows("affected BIGINT, total BIGINT", [(0, 0)])
    assert tuple(df.selectExpr(pass_rate("affected", "total"), retention_pct("affected", "total")).first()) == (100.0, 100.0)


def test_bands(rows):
    df = rows("score DOUBLE", [(95.0,), (94.99,), (94.5,), (80.0,), (79.99,)])
    got = [tuple(r) for r in df.selectExpr(score_band("score"), verdict("score")).collect()]
    assert got == [("PASS", "GOOD"), ("MONITOR", "MODERATE"), ("MONITOR", "MODERATE"), ("MONITOR", "MODERATE"), ("FAIL", "POOR")]
