"""Typed readers, table writers and one-row JSON documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from probity.functions import fold_nan, listed, ticked
from probity.model import SUMMARY_SCHEMA
from probity.sources import exact_csv

# Texts read as missing, the default list of the pandas CSV reader.
NA_VALUES = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

INPUT_POSITION = "input_position"


def conform(df: DataFrame, schema: T.StructType, lenient: bool = False) -> DataFrame:
    """Cast the columns named in ``schema`` to its types and fold NaN into NULL.

    Columns are matched by name; others stay as they are, missing ones stay
    missing. Text that cannot be cast fails the job, or gives NULL if lenient.
    """

    wanted = {f.name: f.dataType for f in schema.fields}
    cast = "TRY_CAST" if lenient else "CAST"

    def typed(field: T.StructField) -> str:
        name, target = ticked(field.name), wanted.get(field.name, field.dataType)
        if target == field.dataType:
            return name
        return f"{cast}({name} AS {target.simpleString()}) AS {name}"

    return fold_nan(df.selectExpr(*[typed(f) for f in df.schema.fields]))


def with_input_position(df: DataFrame, fmt: str) -> DataFrame:
    """Add where each row stands in its files, for a keep-first order.

    ``df`` must be a plain file scan. Row order inside a split is fixed, so file,
    split and running number order the rows as the files do.
    """
    parts = ["_metadata.file_path"]
    if fmt == "parquet":
        parts.append("_metadata.row_index")
    else:
        parts += ["_metadata.file_block_start", "monotonically_increasing_id() AS number"]
    return df.selectExpr("*", f"struct({', '.join(parts)}) AS {INPUT_POSITION}")


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    na_values: Sequence[str] | None = None,
    lenient: bool = False,
    multi_line: bool = False,
    position: bool = False,
) -> DataFrame:
    """CSV with a header row, in the types of ``schema``, which are applied by column name.

    What ``write_table`` wrote is read by its note, value for value. Of any other
    file every column is read as text first and ``na_values`` become NULL, the
    usual texts for missing values if none are given. Given ones hold for both.

    A row with more or fewer fields than the header, or a file with another
    header, fails every read, also one of a few columns or none; if lenient, rows
    are filled up or cut. ``multi_line`` is for line breaks inside quotes in files
    without a note; such files cannot be split.
    """
    note = exact_csv.note_of(spark, path)
    if note is not None:
        text = exact_csv.texts_of(spark, path, note)
        names = [f.name for f in note.schema.fields if isinstance(f.dataType, T.StringType)]
    else:
        text = _foreign(spark, path, lenient, multi_line)
        names = text.columns
        na_values = NA_VALUES if na_values is None else na_values
    if position:
        text = with_input_position(text, "csv")
    found = text if note is None else exact_csv.values_of(text, note)
    if na_values is not None:
        missing = listed(na_values)
        folded = [
            f"CASE WHEN {ticked(c)} NOT IN ({missing}) THEN {ticked(c)} END AS {ticked(c)}"
            if c in names
            else ticked(c)
            for c in found.columns
        ]
        found = found.selectExpr(*folded)
    return conform(found, schema, lenient)


def _foreign(spark: SparkSession, path: str, lenient: bool, multi_line: bool) -> DataFrame:
    """All columns of CSV files as text."""
    reader = (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("enforceSchema", lenient)
        .option("mode", "PERMISSIVE" if lenient else "FAILFAST")
        .option("columnPruning", False)
    )
    names = reader.csv(path).columns
    return reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in names])).csv(path)


def read_parquet(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    lenient: bool = False,
    position: bool = False,
) -> DataFrame:
    df = spark.read.parquet(path)
    return conform(with_input_position(df, "parquet") if position else df, schema, lenient)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Overwrite a table and return its row count, taken while writing.

    Both formats keep every value; for CSV ``exact_csv`` says how.
    """
    if fmt == "csv":
        return exact_csv.write(df, path)
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").format(fmt).save(path)
    return seen.get["rows"]


def write_document(df: DataFrame, path: str) -> None:
    """Write a one-row frame as a JSON document."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_document(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """A saved run summary as one row."""
    return read_document(spark, path, SUMMARY_SCHEMA)
