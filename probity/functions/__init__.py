"""Expressions as SQL text.

The library writes its expressions as text and hands them to ``selectExpr``,
``filter`` and ``expr``. Spark parses a text in one step, while every operation
on a Column object is a call of its own between Python and the JVM.
"""

from probity.functions.arithmetic import (
    basis_points,
    half_even_div,
    mean_basis_points,
    pass_rate,
    percent,
    retention_pct,
)
from probity.functions.bands import SEVERITIES, score_band, severity_rank, verdict
from probity.functions.missing import fold_nan, present
from probity.functions.text import (
    date_literal,
    last_chars,
    listed,
    moment_literal,
    quoted,
    surrogate_id,
    thousands,
    ticked,
)

__all__ = [
    "SEVERITIES",
    "basis_points",
    "date_literal",
    "fold_nan",
    "half_even_div",
    "last_chars",
    "listed",
    "mean_basis_points",
    "moment_literal",
    "pass_rate",
    "percent",
    "present",
    "quoted",
    "retention_pct",
    "score_band",
    "severity_rank",
    "surrogate_id",
    "thousands",
    "ticked",
    "verdict",
]
