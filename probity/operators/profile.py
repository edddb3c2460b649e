"""Before / after profile of a table: NULLs per column and quick counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from probity.functions import fold_nan, quoted, ticked

NESTED = (T.ArrayType, T.MapType, T.StructType)


def null_counts(df: DataFrame) -> DataFrame:
    """One row per column with its number of NULLs, from one aggregate."""
    numbered = list(enumerate(df.columns))
    counted = fold_nan(df).selectExpr(
        *[f"count_if({ticked(c)} IS NULL) AS c{i}" for i, c in numbered]
    )
    pairs = ", ".join(
        f"named_struct('column_name', {quoted(c)}, 'nulls', c{i})" for i, c in numbered
    )
    return counted.selectExpr(f"inline(array({pairs}))")


def footer_scan(spark: SparkSession, path: str, schema: T.StructType, names: Sequence[str]) -> DataFrame:
    """Rows of Parquet files and values of some columns, as Spark reads them out of the footers.

    A session of its own has the settings that push the counts into the reader.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    counts = [F.count(ticked(name)).alias(f"c{i}") for i, name in enumerate(names)]
    return own.read.schema(schema).parquet(path).agg(F.count(F.lit(1)).alias("n"), *counts)


def null_counts_of_files(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``null_counts`` of Parquet files, counted when this is called.

    ``schema`` must have the columns of the files in the files' order. Footers have the
    NULLs of every column chunk, so no values are read, but of float and double columns,
    whose NaN count as NULL, and of nested columns and those behind one, whose chunks
    Spark looks for at another place. Files without such statistics are scanned.
    """
    nested = [i for i, f in enumerate(schema.fields) if isinstance(f.dataType, NESTED)]
    before = schema.fields[: min(nested, default=len(schema.fields))]
    plain = [f.name for f in before if not isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    found: dict[str, int] = {}
    if plain:
        try:
            n, *counts = [c or 0 for c in footer_scan(spark, path, schema, plain).first()]  # NULL without row groups
            found = {name: n - c for name, c in zip(plain, counts, strict=True)}
        except (Py4JJavaError, PySparkException):  # no statistics in some footer
            found = {}
    others = T.StructType([f for f in schema.fields if f.name not in found])
    if others.fields:
        scanned = null_counts(spark.read.schema(others).parquet(path)).collect()
        found |= {r["column_name"]: r["nulls"] for r in scanned}
    rows = [(f.name, found[f.name]) for f in schema.fields]
    return spark.createDataFrame(rows, "column_name STRING, nulls LONG")


def missing_before_after(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """NULLs per column before and after, aligned by column name.

    A column only one side has keeps NULL for the other side.
    """
    return aligned(null_counts(raw), null_counts(clean))


def aligned(raw_counts: DataFrame, clean_counts: DataFrame) -> DataFrame:
    """Two counts of NULLs per column side by side, and their difference."""
    nothing = "CAST(NULL AS BIGINT)"
    before = raw_counts.selectExpr(
        "column_name", "nulls AS raw_nulls", f"{nothing} AS clean_nulls"
    )
    after = clean_counts.selectExpr(
        "column_name", f"{nothing} AS raw_nulls", "nulls AS clean_nulls"
    )
    return before.union(after).groupBy("column_name").agg(
        F.expr("max(raw_nulls) AS raw_nulls"), F.expr("max(clean_nulls) AS clean_nulls")
    ).selectExpr("*", "raw_nulls - clean_nulls AS resolved")


def quick_stats(
    tables: Mapping[str, DataFrame], key: str, amount: str, currency: str, home: str
) -> DataFrame:
    """NULL keys, negative amounts and other currencies, one row per labelled table.

    A NULL currency counts as another currency here.
    """

    def stats(label: str, df: DataFrame) -> DataFrame:
        counted = fold_nan(df.select(ticked(key), ticked(amount), ticked(currency))).selectExpr(
            f"count_if({ticked(key)} IS NULL) AS null_keys",
            f"count_if({ticked(amount)} < 0) AS negative_amounts",
            f"count_if(NOT ({ticked(currency)} <=> {quoted(home)})) AS other_currency",
        )
        return counted.selectExpr(f"{quoted(label)} AS dataset", "*")

    return reduce(DataFrame.union, [stats(label, df) for label, df in tables.items()])


def sample_rows(df: DataFrame, order_by: str | Sequence[str], n: int = 100) -> DataFrame:
    """The first ``n`` rows in the given order.

    Each task keeps its first ``n`` and one task picks among those, so ``n`` is for
    looking at rows, not for cutting tables.
    """
    columns = [order_by] if isinstance(order_by, str) else order_by
    return df.orderBy(*[ticked(c) for c in columns]).limit(n)
