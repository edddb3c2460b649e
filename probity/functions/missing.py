"""NULL and NaN as one kind of missing value.

Spark ranks NaN above every number, so an unfolded NaN would count as overpaid
and as non-negative. Only float and double columns can hold one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from probity.functions.text import ticked

FLOATS = (T.DoubleType, T.FloatType)


def folded(df: DataFrame, name: str) -> str:
    """The column with NaN turned into NULL."""
    column = ticked(name)
    if isinstance(df.schema[name].dataType, FLOATS):
        return f"CASE WHEN NOT isnan({column}) THEN {column} END"
    return column


def present(df: DataFrame, name: str) -> str:
    """True where the column has a value."""
    column = ticked(name)
    if isinstance(df.schema[name].dataType, FLOATS):
        return f"({column} IS NOT NULL AND NOT isnan({column}))"
    return f"({column} IS NOT NULL)"


def fold_nan(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every float or double column."""
    if not any(isinstance(f.dataType, FLOATS) for f in df.schema.fields):
        return df
    return df.selectExpr(*[f"{folded(df, c)} AS {ticked(c)}" for c in df.columns])
