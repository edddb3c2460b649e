"""Put known defects into a table, to test a rule set against them.

Rows are chosen by an expression over their key, so the same rows are hit
whatever the partitioning. Defects are applied in order; a later one
overwrites an earlier one on the same column. All expressions are SQL text.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probity.functions import date_literal, listed, quoted, ticked


def every(key: str, modulus: int, rest: int) -> str:
    """Choose the rows with ``key mod modulus = rest``."""
    return f"pmod({key}, {modulus}) = {rest}"


def share(key: str, percent: float, seed: int) -> str:
    """Choose about ``percent`` % of the rows by a seeded hash of their key."""
    return f"pmod(xxhash64({key}, {seed}), 1000000) < {round(percent * 10_000)}"


@dataclass(frozen=True)
class Defect:
    """``value`` replaces the column where ``where`` is true."""

    column: str
    where: str
    value: str


def null_out(column: str, where: str) -> Defect:
    return Defect(column, where, "NULL")


def orphan(column: str, where: str, suffix: str = "X") -> Defect:
    """A key the parent table cannot have: the old one and a letter."""
    return Defect(column, where, f"concat({ticked(column)}, {quoted(suffix)})")


def negate(column: str, where: str) -> Defect:
    return Defect(column, where, f"-{ticked(column)}")


def pick(column: str, where: str, values: Sequence[str], index: str) -> Defect:
    """One of ``values``, chosen by a whole number."""
    value = f"get(array({listed(values)}), CAST(pmod({index}, {len(values)}) AS INT))"
    return Defect(column, where, value)


def fixed(column: str, where: str, value: str | date) -> Defect:
    literal = date_literal(value) if isinstance(value, date) else quoted(value)
    return Defect(column, where, literal)


def copied_key(column: str, where: str, other: str) -> Defect:
    """The key of another row in place of the own one."""
    return Defect(column, where, other)


def inject(df: DataFrame, defects: Sequence[Defect], mask: str | None = None) -> DataFrame:
    """The table with its defects.

    ``mask`` names a further column whose bit k says whether defect k hit the row,
    even where a later one has overwritten it; it holds 63 defects.
    """
    if mask:
        if len(defects) > 63:
            raise ValueError("a mask holds 63 defects")
        df = df.withColumn(mask, F.expr("0L"))
    for place, defect in enumerate(defects):
        if mask:
            bit = f"{ticked(mask)} | CASE WHEN {defect.where} THEN {1 << place}L ELSE 0L END"
            df = df.withColumn(mask, F.expr(bit))
        hit = f"CASE WHEN {defect.where} THEN {defect.value} ELSE {ticked(defect.column)} END"
        df = df.withColumn(defect.column, F.expr(hit))
    return df


# Fixed values.
AUDIT_EVENTS = ("CREATED", "UPDATED", "REVIEWED", "FLAGGED", "APPROVED")
AUDIT_USERS = range(10, 25)
AUDIT_YEAR_START = date(2024, 1, 1)
AUDIT_YEAR_DAYS = 366
EVENT_ID_LENGTH = 12


def hex_number(digest: str, start: int = 1) -> str:
    """A number below 65536 out of four digits of a hexadecimal digest."""
    return f"CAST(conv(substr({digest}, {start}, 4), 16, 10) AS BIGINT)"


def audit_events(
    df: DataFrame, key: str, identity: str | None = None, id_length: int = EVENT_ID_LENGTH
) -> DataFrame:
    """One to three audit events per row, all their values derived from its identity.

    ``identity`` is a column that tells all rows apart, where ``key`` does not;
    rows of the same identity would give the same events. The id's length in
    hexadecimal digits bounds how many events can have ids of their own.
    """
    text = f"CAST({ticked(identity or key)} AS STRING)"
    numbered = df.selectExpr(
        ticked(key),
        f"{text} AS identity",
        f"explode(sequence(1L, 1L + {hex_number(f'md5({text})')} % 3)) AS copy",
    )
    seeded = numbered.selectExpr(
        ticked(key), "md5(concat(identity, '#', CAST(copy AS STRING))) AS digest"
    )
    event = f"CAST({hex_number('digest', 1)} % {len(AUDIT_EVENTS)} AS INT)"
    user = f"{AUDIT_USERS.start} + {hex_number('digest', 5)} % {len(AUDIT_USERS)}"
    day = f"CAST({hex_number('digest', 9)} % {AUDIT_YEAR_DAYS} AS INT)"
    return seeded.selectExpr(
        f"substr(digest, 1, {id_length}) AS event_id",
        ticked(key),
        f"get(array({listed(AUDIT_EVENTS)}), {event}) AS event_type",
        f"concat('USR-', lpad(CAST({user} AS STRING), 3, '0')) AS user_id",
        f"CAST(date_add({date_literal(AUDIT_YEAR_START)}, {day}) AS TIMESTAMP_NTZ) AS timestamp",
    )
