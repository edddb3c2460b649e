"""Literals and names in SQL text, surrogate ids, number formatting."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from datetime import date, datetime

ID_LENGTH = 16


def quoted(text: str) -> str:
    """A string literal, the same under any setting of the parser.

    What settings give a meaning (backslashes, quotes, and ``${...}``, which is
    substituted) is written by its bytes.
    """
    if any(c in text for c in "\\'$"):
        return f"CAST(X'{text.encode().hex()}' AS STRING)"
    return f"'{text}'"


def listed(texts: Iterable[str]) -> str:
    return ", ".join(quoted(t) for t in texts)


def ticked(name: str) -> str:
    """A column name."""
    return "`" + name.replace("`", "``") + "`"


def date_literal(day: date) -> str:
    return f"DATE '{day:%Y-%m-%d}'"


def moment_literal(moment: datetime) -> str:
    return f"TIMESTAMP_NTZ '{moment.isoformat(sep=' ')}'"


def surrogate_id(name: str, run_ts: datetime, place: str = "", length: int = ID_LENGTH) -> str:
    """Id of one catalogue row, for a caller that needs it before the row is written.

    ``place`` tells rows of one name and time apart.
    """
    return hashlib.md5(f"{name}{run_ts.isoformat()}{place}".encode()).hexdigest()[:length]


def last_chars(text: str, n: int) -> str:
    """The last ``n`` characters of a text expression."""
    return f"right({text}, {n})"


def thousands(number: str) -> str:
    """2000 as ``2,000``."""
    return f"format_number({number}, 0)"
