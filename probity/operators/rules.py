"""Constructors for the row rules. Column names, sets and limits are parameters."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from probity.functions import date_literal, listed, quoted, ticked
from probity.model import RowRule, Severity

TEN_DIGITS = "^[0-9]{10}$"
HIGH = Severity("HIGH")
MEDIUM = Severity("MEDIUM")
LOW = Severity("LOW")


def as_day(as_of: date | datetime) -> date:
    return as_of.date() if isinstance(as_of, datetime) else as_of


# Text in a date column is cast strictly: what is no date fails the job under ANSI mode.
def _moment(name: str) -> str:
    return f"CAST({ticked(name)} AS TIMESTAMP_NTZ)"


def _day(name: str) -> str:
    return f"CAST({ticked(name)} AS DATE)"


def not_null(field: str) -> RowRule:
    return RowRule(
        "Completeness",
        field,
        f"Missing values found in '{field}'",
        f"{ticked(field)} IS NULL",
        (field,),
        Severity("HIGH", 5, "MEDIUM"),
    )


def non_negative(field: str, description: str) -> RowRule:
    return RowRule("Validity", field, description, f"{ticked(field)} < 0", (field,), HIGH)


def allowed(
    field: str, values: Iterable[str], description: str, severity: Severity = HIGH
) -> RowRule:
    bad = f"{ticked(field)} NOT IN ({listed(sorted(values))})"
    return RowRule("Validity", field, description, bad, (field,), severity)


def matches_pattern(field: str, pattern: str = TEN_DIGITS) -> str:
    return f"CAST({ticked(field)} AS STRING) RLIKE {quoted(pattern)}"


def matches(field: str, description: str, pattern: str = TEN_DIGITS) -> RowRule:
    bad = f"NOT ({matches_pattern(field, pattern)})"
    return RowRule("Validity", field, description, bad, (field,), HIGH)


def ends_after_start(start: str, end: str, description: str) -> RowRule:
    bad = f"{_moment(end)} <= {_moment(start)}"
    return RowRule("Consistency", f"{start} / {end}", description, bad, (start, end), HIGH)


def not_before(field: str, earliest: str, description: str) -> RowRule:
    bad = f"{_moment(field)} < {_moment(earliest)}"
    return RowRule(
        "Consistency", f"{field} / {earliest}", description, bad, (field, earliest), HIGH
    )


def at_most_ratio(part: str, whole: str, ratio: float, description: str) -> RowRule:
    bad = f"{ticked(part)} > {ticked(whole)} * {ratio}D"
    return RowRule("Consistency", f"{part} / {whole}", description, bad, (part, whole), MEDIUM)


def not_future(field: str, as_of: date | datetime, description: str) -> RowRule:
    bad = f"{_day(field)} > {date_literal(as_day(as_of))}"
    return RowRule("Timeliness", field, description, bad, (field,), MEDIUM)


def not_stale(
    field: str,
    status_field: str,
    status: str,
    max_age_days: int,
    as_of: date | datetime,
    description: str,
) -> RowRule:
    age = f"datediff({date_literal(as_day(as_of))}, {_day(field)})"
    return RowRule(
        "Timeliness",
        f"{field} + {status_field}",
        description,
        f"{age} > {max_age_days} AND {ticked(status_field)} = {quoted(status)}",
        (field, status_field),
        LOW,
    )
