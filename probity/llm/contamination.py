"""Benchmark items in documents, within a budget of edits.

An item with a budget of e edits is cut into e + 1 pieces: wherever it occurs
with at most e edits, one piece occurs unchanged. All pieces are searched at once
by an automaton; around each hit, Myers' bit-parallel algorithm gives the least
edit distance between the item and any stretch of the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import reduce

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probity.llm.scratch import let_go

#: Edits allowed per character of an item.
RATE = 0.08
#: Characters under which an item has no edits and is found as whole words only.
WORDS_ONLY = 13
#: Characters of benchmark items searched for at once; more are searched for in blocks.
BLOCK_CHARS = 4_000_000

# Letters of scripts that write no spaces between words.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")

HIT_TYPE = "array<struct<item_id: bigint, distance: int, start: int, end: int>>"


def normalised(text: str) -> str:
    """Lower case, white space as single spaces."""
    return " ".join(text.lower().split())


def pieces_of(item: str, budget: int) -> list[tuple[int, str]]:
    """The item cut into budget + 1 pieces of nearly equal length: (place, piece)."""
    cuts = [len(item) * k // (budget + 1) for k in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def letters_of(item: str) -> dict[str, int]:
    """For each character a number with the bits of its places in the item."""
    bits: dict[str, int] = {}
    for k, c in enumerate(item):
        bits[c] = bits.get(c, 0) | 1 << k
    return bits


def nearest(letters: dict[str, int], length: int, text: str) -> tuple[int, int]:
    """The least edit distance of the item to any stretch of ``text``, and the first such end."""
    full, top = (1 << length) - 1, 1 << (length - 1)
    plus, minus, score = full, 0, length
    best, end = length, 0
    for k, c in enumerate(text, 1):
        equal = letters.get(c, 0)
        vertical = equal | minus
        across = ((((equal & plus) + plus) ^ plus) | equal) & full
        up = minus | (full & ~(across | plus))
        down = plus & across
        if up & top:
            score += 1
        elif down & top:
            score -= 1
            if score < best:
                best, end = score, k
        up, down = (up << 1) & full, (down << 1) & full
        plus = down | (full & ~(vertical | up))
        minus = up & vertical
    return best, end


def _one_word(a: str, b: str) -> bool:
    return a.isalnum() and b.isalnum() and not _UNSPACED.search(a + b)


def place_of_words(item: str, text: str, begin: int, end: int) -> int:
    """The first place of the item in ``text[begin:end]`` where no word goes on beyond it; else -1."""
    at = text.find(item, begin, end)
    while at >= 0:
        stop = at + len(item)
        inside = at > 0 and _one_word(text[at - 1], text[at])
        if not inside and not (stop < len(text) and _one_word(text[stop - 1], text[stop])):
            return at
        at = text.find(item, at + 1, end)
    return -1


class Finder:
    """Finds the items of one block in texts."""

    def __init__(self, items: Sequence[tuple[int | None, str]], rate: float) -> None:
        self.items = []
        places: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            text = normalised(text)
            if not text:
                continue
            budget = int(len(text) * rate) if len(text) >= WORDS_ONLY else 0
            for at, piece in pieces_of(text, budget):
                places.setdefault(piece, []).append((len(self.items), at))
            self.items.append((item_id, text, budget, letters_of(text), letters_of(text[::-1])))
        self._automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self._automaton.add_word(piece, (len(piece), where))
        if places:
            self._automaton.make_automaton()

    def _windows(self, text: str) -> Iterator[tuple[int, int, int]]:
        """Stretches that may hold an item: (item, begin, end), overlapping ones joined."""
        spans: dict[int, list[tuple[int, int]]] = {}
        for last, (length, where) in self._automaton.iter(text):
            for item, at in where:
                begin = last + 1 - length - at
                _, own, budget, _, _ = self.items[item]
                spans.setdefault(item, []).append((begin - budget, begin + len(own) + budget))
        for item, found in spans.items():
            found.sort()
            begin, end = found[0]
            for a, b in found[1:]:
                if a > end:
                    yield item, max(begin, 0), min(end, len(text))
                    begin, end = a, b
                end = max(end, b)
            yield item, max(begin, 0), min(end, len(text))

    def __call__(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, start, end) of the best place of each item within its budget.

        Places are of the normalised text.
        """
        if not text or not self.items:
            return []
        text = normalised(text)
        best: dict[int, tuple[int, int, int]] = {}
        for item, begin, end in self._windows(text):
            item_id, own, budget, letters, backwards = self.items[item]
            window = text[begin:end]
            at = window.find(own)
            if len(own) < WORDS_ONLY:
                start = place_of_words(own, text, begin, end)
                if start < 0:
                    continue
                found = (0, start, start + len(own))
            elif at >= 0:
                found = (0, begin + at, begin + at + len(own))
            else:
                distance, stop = nearest(letters, len(own), window)
                if distance > budget:
                    continue
                _, length = nearest_prefix(backwards, len(own), window[:stop][::-1], distance)
                found = (distance, begin + stop - length, begin + stop)
            if item not in best or found < best[item]:
                best[item] = found
        return [(self.items[k][0], *best[k]) for k in sorted(best)]


def nearest_prefix(letters: dict[str, int], length: int, text: str, distance: int) -> tuple[int, int]:
    """How much of the beginning of ``text`` is at ``distance`` from the whole item."""
    for size in range(max(length - distance, 0), length + distance + 1):
        if whole_distance(letters, length, text[:size]) == distance:
            return distance, size
    return distance, length


def whole_distance(letters: dict[str, int], length: int, text: str) -> int:
    """The edit distance of the item to the whole of ``text``."""
    full, top = (1 << length) - 1, 1 << (length - 1)
    plus, minus, score = full, 0, length
    for c in text:
        equal = letters.get(c, 0)
        vertical = equal | minus
        across = ((((equal & plus) + plus) ^ plus) | equal) & full
        up = minus | (full & ~(across | plus))
        down = plus & across
        score += 1 if up & top else -1 if down & top else 0
        up, down = ((up << 1) | 1) & full, (down << 1) & full
        plus = down | (full & ~(vertical | up))
        minus = up & vertical
    return score


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks of about BLOCK_CHARS characters, fetched one at a time."""
    items = (
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
        .filter(F.length("text") > 0)
        .distinct()
    )
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-chars // BLOCK_CHARS))
    for k in range(blocks):
        block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k
        found = [tuple(r) for r in items.filter(block).collect()]
        yield sorted(found, key=lambda i: (i[0] is not None, i[0] or 0, i[1]))


def _hits(items: list[tuple[int | None, str]], rate: float):
    made: list[Finder] = []

    @F.pandas_udf(HIT_TYPE)
    def hits(texts: pd.Series) -> pd.Series:
        if not made:
            let_go()
            made.append(Finder(items, rate))
        return texts.map(
            lambda t: [
                dict(zip(("item_id", "distance", "start", "end"), h, strict=True)) for h in made[0](t)
            ]
        )

    return hits


def contamination(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """doc_id, item_id, distance, start, end: every item in every document, at its best place.

    ``benchmark`` has item_id and text; empty and NULL items are left out. An item of
    under WORDS_ONLY characters is found as whole words, without edits. Hits of a NULL
    item_id have that id. Upper case and white space don't count; ``start`` and ``end``
    are places in the text without them. A NULL or empty text has no item; each
    row of a repeated document is searched; other columns are ignored; an empty
    table on either side gives no rows.
    """
    found = [
        docs.select("doc_id", F.explode(_hits(items, rate)("text")).alias("hit"))
        for items in _blocks(benchmark)
    ]
    return reduce(DataFrame.union, found).select("doc_id", "hit.*")


def without_contamination(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows of ``docs`` that hold no item of the benchmark; NULL texts stay."""
    for items in _blocks(benchmark):
        found: Column = F.size(_hits(items, rate)("text"))
        docs = docs.filter(found == 0)
    return docs
