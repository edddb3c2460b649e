"""An exact sample of any size, without sorting the table.

Rows are ordered by a digest of their key, then of the whole row. The digest up to
which rows are taken is found by histograms, each of the part of the digests that the
one before leaves open, and the sample is a filter. So a sample of a third of a
table costs a few scans of its key and no task holds more than a histogram.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probity.functions import ticked

#: Hexadecimal digits of a histogram, which has so many powers of 16 of counts at most.
DIGITS = 3
#: Digests of a part that are fetched to end the search.
FEW = 10_000
#: Digits of a key's digest, and of a key's and a row's.
KEY_DIGITS, ALL_DIGITS = 32, 64


def _key_digest(key: str) -> str:
    # NULL comes first, before every digest
    return f"coalesce(md5(CAST({ticked(key)} AS STRING)), repeat(' ', {KEY_DIGITS}))"


def _place(df: DataFrame, key: str, digits: int) -> str:
    """The first ``digits`` of a row's place, or more; the row's own digest only if need be."""
    if digits <= KEY_DIGITS:
        return _key_digest(key)
    row = "md5(to_json(struct(*)))"
    return f"concat({_key_digest(key)}, {row})"


@dataclass(frozen=True)
class Cut:
    """Rows with a place before ``prefix`` and ``more`` of the ``there`` that begin with it."""

    prefix: str
    more: int
    there: int


def find_cut(df: DataFrame, key: str, n: int) -> Cut | None:
    """Where the first ``n`` rows end; None if there are no more rows than that."""
    prefix, more = "", n
    while True:
        known = len(prefix)
        step = DIGITS if known % KEY_DIGITS + DIGITS <= KEY_DIGITS else KEY_DIGITS - known % KEY_DIGITS
        place = _place(df, key, known + step)
        placed = df.selectExpr(f"{place} AS place").filter(F.col("place").startswith(prefix))
        counted = placed.groupBy(F.substring("place", known + 1, step).alias("digits")).count()
        for row in sorted(counted.collect()):  # 16 ** DIGITS rows at most, and one for NULL
            if more < row["count"]:
                prefix, there = prefix + row["digits"], row["count"]
                break
            more -= row["count"]
        else:
            return None
        if not more or len(prefix) == ALL_DIGITS:
            return Cut(prefix, more, there)
        if there <= FEW:
            placed = df.selectExpr(f"{_place(df, key, ALL_DIGITS)} AS place").filter(F.col("place").startswith(prefix))
            places = sorted(r["place"] for r in placed.collect())
            last = places[more - 1]
            first = places.index(last)
            return Cut(last, more - first, places.count(last))


def sample_at_most(df: DataFrame, key: str, n: int) -> DataFrame:
    """Exactly ``n`` rows, or all if there are fewer: those of the least digests of their key.

    Among rows of one key the digest of the whole row decides; rows that are the
    same in all columns are any of each other. The order of the result is open.
    Histograms are counted when this is called.
    """
    if n <= 0:
        return df.limit(0)
    cut = find_cut(df, key, n)
    if cut is None:
        return df
    length = len(cut.prefix)
    place = F.substring(F.expr(_place(df, key, length)), 1, length)
    if cut.more == cut.there:
        return df.filter(place <= cut.prefix)
    taken = df.filter(place < cut.prefix)
    if not cut.more:
        return taken
    # rows of one place are the same in all columns: one of them as often as is wanted
    one = df.filter(place == cut.prefix).limit(1)
    names = [ticked(c) for c in df.columns]
    copies = one.selectExpr(*names, f"explode(sequence(1L, {cut.more}L)) AS `copy of`").select(*names)
    return taken.unionByName(copies)
