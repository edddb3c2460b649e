"""Rates as whole basis points, rounded half to even.

Rounding a double gives different last digits in different engines when the
value is a tie (96.545). Counts are whole numbers, so the rate is divided in
integers and turned into a double only once, at the end.
"""

from __future__ import annotations

FULL = 10_000  # 100.00 % in basis points


def half_even_div(num: str, den: str) -> str:
    """``num / den`` rounded to a whole number, ties to even; NULL if ``den`` is 0.

    Both operands must be non-negative whole numbers.
    """
    den = f"nullif({den}, 0L)"
    quotient = f"(({num}) div {den})"
    twice_rest = f"(({num}) % {den} * 2)"
    return (
        f"({quotient} + CASE WHEN {twice_rest} > {den} "
        f"OR ({twice_rest} = {den} AND {quotient} % 2 = 1) THEN 1 ELSE 0 END)"
    )


def basis_points(affected: str, total: str) -> str:
    """Share of rows that pass, in basis points; an empty table passes in full."""
    return f"coalesce({half_even_div(f'(({total}) - ({affected})) * {FULL}', total)}, {FULL}L)"


def mean_basis_points(total: str, count: str) -> str:
    """Mean of ``count`` basis-point values adding up to ``total``; 100 % if none."""
    return f"coalesce({half_even_div(total, count)}, {FULL}L)"


def percent(points: str) -> str:
    return f"({points} / 100.0D)"


def pass_rate(affected: str, total: str) -> str:
    """Pass rate in percent with two decimals."""
    return percent(basis_points(affected, total))


def retention_pct(after: str, before: str) -> str:
    """Rows kept in percent with one decimal; 100.0 when there was nothing to keep."""
    return f"(coalesce({half_even_div(f'({after}) * 1000', before)}, 1000L) / 10.0D)"
