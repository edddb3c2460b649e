"""CSV files that keep every value, with a note of how they are written beside them.

Every column is written as text that its type is read back from exactly: times to
the microsecond (those of a time zone in UTC), bytes as base64, nested values as
JSON. NULL is an empty field. What an empty field cannot say is marked by a
backslash: ``\\E`` is the empty text, ``\\N`` is NULL in a table of one column, and a
text that begins with a backslash gets one more. A text with the character of code 0,
which CSV readers drop, is ``\\X`` and its base64. Files are cut by rows, so that
those with line breaks inside values, which cannot be split, are read by many tasks.

The note is one line of JSON in a folder whose name readers of the table pass over.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from probity.functions import quoted, ticked
from probity.session import exists

#: Folder of the note below that of the table.
NOTE = "_written_as"
#: Rows of a file at most.
ROWS_PER_FILE = 100_000
VERSION = 1

_NULL, _EMPTY, _CODED, _ESCAPE = map(quoted, ("\\N", "\\E", "\\X", "\\"))
_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"
_NESTED = (T.ArrayType, T.MapType, T.StructType)
_JSON = "map('timestampFormat', \"yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX\", " + (
    "'timestampNTZFormat', \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\", 'timeZone', 'UTC', 'ignoreNullFields', 'false')"
)


@dataclass(frozen=True)
class Note:
    """How a table was written."""

    schema: T.StructType
    rows: int
    rows_per_file: int
    line_breaks: bool

    def text(self) -> str:
        return json.dumps(
            {
                "version": VERSION,
                "schema": self.schema.jsonValue(),
                "rows": self.rows,
                "rows_per_file": self.rows_per_file,
                "line_breaks": self.line_breaks,
                "null": "an empty field, or \\N",
                "empty_text": "\\E",
                "base64_text": "\\X",
                "escape": "\\",
                "times": "ISO 8601 to the microsecond; with a time zone: UTC",
            }
        )

    @staticmethod
    def parsed(text: str) -> Note:
        found = json.loads(text)
        if found["version"] != VERSION:
            raise ValueError(f"CSV written as version {found['version']}, known is {VERSION}")
        schema = T.StructType.fromJson(found["schema"])
        return Note(schema, found["rows"], found["rows_per_file"], found["line_breaks"])


def _written(field: T.StructField, alone: bool) -> str:
    """A column as the text of its field."""
    name, kind = ticked(field.name), field.dataType
    if isinstance(kind, T.StringType):
        marked = f"""CASE WHEN {name} = '' THEN {_EMPTY}
          WHEN contains({name}, char(0)) THEN concat({_CODED}, base64(CAST({name} AS BINARY)))
          WHEN startswith({name}, {_ESCAPE}) THEN concat({_ESCAPE}, {name}) ELSE {name} END"""
    elif isinstance(kind, T.TimestampType):
        marked = f"concat(CAST(timestampadd(MICROSECOND, unix_micros({name}), {_EPOCH}) AS STRING), 'Z')"
    elif isinstance(kind, T.BinaryType):
        marked = f"CASE WHEN octet_length({name}) = 0 THEN {_EMPTY} ELSE base64({name}) END"
    elif isinstance(kind, _NESTED):
        marked = f"to_json({name}, {_JSON})"
    elif isinstance(kind, T.NullType):
        marked = "CAST(NULL AS STRING)"
    else:
        marked = f"CAST({name} AS STRING)"
    return f"coalesce({marked}, {_NULL}) AS {name}" if alone else f"{marked} AS {name}"


def _read(field: T.StructField, text: str) -> Column:
    """The value of a field's text."""
    name, kind = ticked(text), field.dataType
    plain = f"CASE WHEN {name} = {_EMPTY} THEN '' WHEN {name} <> {_NULL} THEN {name} END"
    if isinstance(kind, T.StringType):
        value = f"""CASE WHEN {name} = {_EMPTY} THEN ''
          WHEN startswith({name}, {_CODED}) THEN CAST(unbase64(substr({name}, 3)) AS STRING)
          WHEN startswith({name}, {_ESCAPE})
          THEN CASE WHEN {name} <> {_NULL} THEN substr({name}, 2) END ELSE {name} END"""
    elif isinstance(kind, T.BinaryType):
        value = f"unbase64({plain})"
    elif isinstance(kind, _NESTED):
        return F.from_json(F.expr(plain), kind, {"mode": "FAILFAST", "timeZone": "UTC"}).alias(field.name)
    elif isinstance(kind, T.NullType):
        value = "NULL"
    else:
        value = f"CAST({plain} AS {kind.simpleString()})"
    return F.expr(f"{value} AS {ticked(field.name)}")


def write(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> int:
    """Overwrite a table and return its row count, taken while writing.

    The note comes last, so a table whose writing was broken off has none.
    """
    seen, fields = Observation(), df.schema.fields
    texts = df.selectExpr(*[_written(f, len(fields) == 1) for f in fields])
    broken = " OR ".join(f"{ticked(f.name)} RLIKE '[\r\n]'" for f in fields) or "false"
    counted = texts.observe(seen, F.count(F.lit(1)).alias("rows"), F.expr(f"count_if({broken}) AS broken"))
    (
        counted.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("quoteAll", len(fields) == 1)  # a blank line is no row
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", rows_per_file)
        .csv(path)
    )
    note = Note(df.schema, seen.get["rows"], rows_per_file, seen.get["broken"] > 0)
    line = df.sparkSession.range(1).select(F.lit(note.text()).alias("value"))
    line.coalesce(1).write.mode("overwrite").text(_place(path))
    return note.rows


def _place(path: str) -> str:
    return f"{path.rstrip('/')}/{NOTE}"


def note_of(spark: SparkSession, path: str) -> Note | None:
    """How the table at ``path`` was written; None if it isn't one of ours."""
    if not exists(spark, _place(path)):
        return None
    return Note.parsed(spark.read.text(_place(path)).first()[0])


def texts_of(spark: SparkSession, path: str, note: Note) -> DataFrame:
    """The fields of a table as they are in its files, a plain scan. Malformed rows fail every read."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in note.schema.names])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", note.line_breaks)
        .option("lineSep", "\n")
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("columnPruning", False)
        .csv(path)
    )


def values_of(texts: DataFrame, note: Note) -> DataFrame:
    """The values of the fields, in the types they were written with; other columns stay."""
    known = set(note.schema.names)
    others = [ticked(c) for c in texts.columns if c not in known]
    return texts.select(*[_read(f, f.name) for f in note.schema.fields], *[F.expr(c) for c in others])
