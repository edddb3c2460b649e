"""Toxicity by the nearest labelled examples.

Examples are a bounded, documented sample of the labelled documents. Texts are
TF-IDF vectors of length one over all their terms, where a term's IDF is raised by how
far its smoothed rate of label 1 is above that of all examples. The nearest examples
by cosine vote with their cosine as weight, and isotonic regression on the examples
(each voted on by the others) turns votes into rates.

The neighbours are exact. Examples lie in blocks of alike ones. Cosines over a
text's rarer terms come from an inverted index; the most frequent terms are a matrix
with the largest weight of each term in each block, which bounds what a block can
add. Blocks that can't hold a nearer example are skipped, and the examples that can be
among the nearest are taken again in full precision.

Terms are counted by the tasks that read the examples, and one task lays out the
index, whose size ``EXAMPLES`` and ``BYTES`` bound. The driver passes on its
compressed bytes and fits the calibration to a vote and a label of each example.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probity.llm.scratch import kept, let_go, saved

#: Labelled documents that examples are taken from at most, and bytes of their texts.
EXAMPLES, BYTES = 8000, 64_000_000
#: Examples of the mean rate that a term's rate of label 1 begins with, and the least weight of a term.
PRIOR_EXAMPLES, FLOOR = 10.0, 0.1
NEIGHBOURS = 10
#: Letters of a word's beginning that are a term too, so that its forms meet.
STEM = 5
#: Examples per block of the index, and blocks of a text that are looked at before others are skipped.
BLOCK, FIRST_BLOCKS = 64, 4
#: Terms that are a matrix, texts multiplied with it at once, and more than its rounding.
FREQUENT, TOGETHER, OFF = 768, 512, 1e-5
#: Votes for the mean label that each vote begins with.
PRIOR_VOTES = 1.0
#: Examples that the index is made of at once, so that a worker needs little more than the index.
AT_ONCE = 500
#: Bytes of one row of the stored index.
PART_BYTES = 8_000_000

_EDGES = ".,;:!?\"'()[]{}<>|*#%&/\\-_=+~`…“”‘’«»¿¡"
SCORE_TYPE = "struct<score: double, evidence: array<struct<doc_id: bigint, cosine: double, toxic: int>>>"


def terms_of(text: str | None) -> list[str]:
    """Words in lower case without the marks around them, and the beginnings of longer words."""
    if not text:
        return []
    words = [w.strip(_EDGES) for w in text.lower().split()]
    return words + [w[:STEM] + "*" for w in words if len(w) > STEM]


def counted(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hashes of a text's terms, ascending, and how often it has each."""
    counts = Counter(terms_of(text))
    counts.pop("", None)
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(t) for t in counts), np.uint64, len(counts))
    order = np.argsort(hashes)
    return hashes[order], np.fromiter(counts.values(), np.int64, len(counts))[order]


def _planes(values: np.ndarray) -> bytes:
    """Whole numbers as bytes, all lowest ones first, compressed."""
    octets = np.ascontiguousarray(values, "<i8").view(np.uint8).reshape(-1, 8)
    return zstandard.compress(np.ascontiguousarray(octets.T).tobytes(), 3)


def _numbers(data: bytes) -> np.ndarray:
    octets = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(octets.T).view("<i8").reshape(-1)


def _rising(values: np.ndarray) -> np.ndarray:
    """Differences of values that rise, as signed numbers."""
    return np.diff(values, prepend=values.dtype.type(0)).view(np.int64)


@dataclass
class Examples:
    """Examples by ascending doc_id: labels, and their terms' codes and counts one after another."""

    ids: np.ndarray
    labels: np.ndarray
    starts: np.ndarray
    codes: np.ndarray
    counts: np.ndarray | None
    terms: np.ndarray  # hash of each code, ascending
    df: np.ndarray
    ones: np.ndarray  # examples of label 1 with the term

    @staticmethod
    def of(rows: Sequence[tuple[int, int, np.ndarray, np.ndarray]]) -> Examples:
        """From rows of doc_id, label, hashes, counts."""
        rows = sorted(rows, key=lambda r: r[0])
        sizes = np.array([len(r[2]) for r in rows], np.int64)
        labels = np.array([r[1] for r in rows], np.int64)
        hashes = np.concatenate([np.zeros(0, np.uint64), *[r[2] for r in rows]])
        terms, codes = np.unique(hashes, return_inverse=True)
        return Examples(
            np.array([r[0] for r in rows], np.int64),
            labels,
            np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64),
            codes.astype(np.int32),
            np.concatenate([np.zeros(0, np.int64), *[r[3] for r in rows]]),
            terms,
            np.bincount(codes, minlength=len(terms)),
            np.bincount(codes, np.repeat(labels, sizes), len(terms)).astype(np.int64),
        )

    def stored(self) -> dict[str, bytes]:
        # codes rise within an example, so their differences are small numbers but at its start
        return {
            "ids": _planes(_rising(self.ids)),
            "labels": _planes(self.labels),
            "starts": _planes(_rising(self.starts)),
            "codes": _planes(_rising(self.codes.astype(np.int64))),
            "counts": _planes(self.counts),
            "terms": _planes(_rising(self.terms)),
            "df": _planes(self.df),
            "ones": _planes(self.ones),
        }

    @staticmethod
    def loaded(data: dict[str, bytes]) -> Examples:
        terms = np.cumsum(_numbers(data["terms"]).view(np.uint64), dtype=np.uint64)
        return Examples(
            np.cumsum(_numbers(data["ids"])), _numbers(data["labels"]), np.cumsum(_numbers(data["starts"])),
            np.cumsum(_numbers(data["codes"]), dtype=np.int32), _numbers(data["counts"]).astype(np.int32),
            terms, _numbers(data["df"]), _numbers(data["ones"]),
        )

    @property
    def base(self) -> float:
        return float(self.labels.mean()) if len(self.labels) else 0.0

    @property
    def told_apart(self) -> bool:
        """Whether there are examples of both labels."""
        return 0 < self.base < 1

    def term_weights(self) -> tuple[np.ndarray, float]:
        """The weight of each term, and that of a term no example has."""
        total, base = len(self.ids), self.base
        odds = (self.ones + PRIOR_EXAMPLES * base) / (self.df - self.ones + PRIOR_EXAMPLES * (1 - base))
        telling = np.maximum(np.log(odds * (1 - base) / base), 0)
        idf = np.log((1 + total) / (1 + self.df)) + 1
        return (telling + FLOOR) * idf, FLOOR * (math.log(1 + total) + 1)


class Index:
    """Examples by term, in blocks of alike ones with the largest weight of each frequent term.

    ``looked_at`` and ``skipped`` count the blocks of the searches so far.
    """

    def __init__(self, starts: np.ndarray, codes: np.ndarray, weights: np.ndarray, terms: int, likeness: np.ndarray) -> None:
        self.starts, self.codes, self.weights = starts, codes, weights
        self.size = len(starts) - 1
        self.blocks = -(-self.size // BLOCK)
        self.order = np.argsort(likeness, kind="stable").astype(np.int32)  # examples by their place
        place = np.empty(self.size, np.int32)
        place[self.order] = np.arange(self.size, dtype=np.int32)
        df = np.zeros(terms, np.int64)
        for _, _, own in _some(starts):
            df += np.bincount(codes[own], minlength=terms)
        frequent = np.argsort(-df, kind="stable")[:FREQUENT]
        self.slot = np.full(terms, -1, np.int32)
        self.slot[frequent] = np.arange(len(frequent))
        self.dense = np.zeros((len(frequent), self.blocks * BLOCK), np.float32)
        self.first = np.concatenate([[0], np.cumsum(np.where(self.slot < 0, df, 0))])
        self.posted = np.empty(self.first[-1], np.int32)
        self.own = np.empty(self.first[-1], np.float32)
        free = self.first[:-1].copy()  # where the next example with a rare term goes
        for begin, end, own in _some(starts):
            of = np.repeat(place[begin:end], np.diff(starts[begin : end + 1]))
            some, weight = codes[own], weights[own]
            slots = self.slot[some]
            often = slots >= 0
            self.dense[slots[often], of[often]] = weight[often]
            rare = np.flatnonzero(~often)
            rare = rare[np.argsort(some[rare], kind="stable")]
            terms_, heads, many = np.unique(some[rare], return_index=True, return_counts=True)
            to = np.arange(len(rare)) + np.repeat(free[terms_] - heads, many)
            self.posted[to], self.own[to] = of[rare], weight[rare]
            free[terms_] += many
        self.most = self.dense.reshape(len(frequent), self.blocks, BLOCK).max(axis=2)
        self._query = np.zeros(terms)
        self.looked_at = self.skipped = 0

    def nearest(
        self, queries: Sequence[tuple[np.ndarray, np.ndarray]], k: int, but: Sequence[int] | None = None
    ) -> list[list[tuple[int, float]]]:
        """For each query (codes, weights), the ``k`` examples of the greatest cosine above 0.

        Of equal ones the first. ``but`` names an example for each query that doesn't count.
        """
        found: list[list[tuple[int, float]]] = []
        for at in range(0, len(queries), TOGETHER):
            found += self._together(queries[at : at + TOGETHER], k, None if but is None else but[at : at + TOGETHER])
        return found

    def _together(self, queries: Sequence, k: int, but: Sequence[int] | None) -> list[list[tuple[int, float]]]:
        if not self.size:
            return [[] for _ in queries]
        frequent = np.zeros((len(queries), len(self.dense)), np.float32)
        nearly = np.zeros((len(queries), self.blocks * BLOCK), np.float32)
        for q, (codes, weights) in enumerate(queries):
            slots = self.slot[codes]
            frequent[q, slots[slots >= 0]] = weights[slots >= 0]
            rare = slots < 0
            places, own = _ranges(self.first, codes[rare])
            if len(places):
                added = self.own[places] * np.repeat(weights[rare], own)
                nearly[q] = np.bincount(self.posted[places], added, nearly.shape[1])
        if but is not None:
            place = np.empty(self.size, np.int64)
            place[self.order] = np.arange(self.size)
            out = (np.arange(len(queries)), place[np.asarray(but)])
        bound = frequent @ self.most + nearly.reshape(len(queries), self.blocks, BLOCK).max(axis=2) + OFF
        done = np.zeros(bound.shape, bool)

        def look(wanted: np.ndarray) -> None:
            """Add the frequent terms' share for the wanted blocks of each query."""
            for block in np.flatnonzero(wanted.any(axis=0)):
                some, columns = np.flatnonzero(wanted[:, block]), slice(block * BLOCK, (block + 1) * BLOCK)
                nearly[some, columns] += frequent[some] @ self.dense[:, columns]
            done[wanted] = True

        parts = range(BLOCK, len(queries), BLOCK)  # a copy of all would be as large as they are

        def least() -> np.ndarray:
            """What the last of the nearest has at least, for each query."""
            if but is not None:
                nearly[out] = 0
            if k >= self.size:
                return np.zeros(len(queries))
            return np.concatenate([np.partition(some, -k, axis=1)[:, -k] for some in np.split(nearly, parts)]) - OFF

        best = np.argpartition(-bound, min(FIRST_BLOCKS, self.blocks) - 1, axis=1)[:, :FIRST_BLOCKS]
        wanted = np.zeros(bound.shape, bool)
        np.put_along_axis(wanted, best, True, axis=1)
        look(wanted)
        look(~done & (bound >= least()[:, None]))
        self.looked_at += int(done.sum())
        self.skipped += int((~done).sum())
        limit = least()
        # a block that was skipped has less than its bound, which is below the limit
        nearly[np.repeat(~done, BLOCK, axis=1)] = 0
        return [self._exactly(*queries[q], k, nearly[q], limit[q]) for q in range(len(queries))]

    def _exactly(
        self, codes: np.ndarray, weights: np.ndarray, k: int, nearly: np.ndarray, limit: float
    ) -> list[tuple[int, float]]:
        some = np.flatnonzero((nearly > 0) & (nearly >= limit))
        if not len(some):
            return []
        some = np.sort(self.order[some])
        self._query[codes] = weights
        place, own = _ranges(self.starts, some)
        products = self._query[self.codes[place]] * self.weights[place]
        self._query[codes] = 0
        cosine = np.round(np.bincount(np.repeat(np.arange(len(some)), own), products, len(some)), 12)
        best = np.lexsort((some, -cosine))[:k]
        return [(int(some[e]), float(cosine[e])) for e in best if cosine[e] > 0]


def _some(starts: np.ndarray) -> Iterator[tuple[int, int, slice]]:
    """First and end of AT_ONCE examples after the others, and where their terms are."""
    for begin in range(0, len(starts) - 1, AT_ONCE):
        end = min(begin + AT_ONCE, len(starts) - 1)
        yield begin, end, slice(starts[begin], starts[end])


def _ranges(starts: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places from ``starts[c]`` up to ``starts[c + 1]`` of the chosen, and how many each has."""
    own = starts[chosen + 1] - starts[chosen]
    ends = np.cumsum(own)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts[chosen] - ends + own, own), own


def _vote(near: Sequence[tuple[int, float]], labels: np.ndarray, base: float) -> float:
    weight = sum(c for _, c in near)
    return (sum(c * labels[e] for e, c in near) + PRIOR_VOTES * base) / (weight + PRIOR_VOTES)


def isotonic(raw: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Votes and rates of the non-decreasing step function nearest to the labels."""
    values, place = np.unique(raw, return_inverse=True)
    weight = np.bincount(place).astype(float)
    mean = np.bincount(place, weights=labels) / weight
    pools: list[list[float]] = []
    for v, m, w in zip(values, mean, weight, strict=True):
        pools.append([v, m, w])
        while len(pools) > 1 and pools[-2][1] >= pools[-1][1]:
            last, before = pools.pop(), pools[-1]
            total = before[2] + last[2]
            before[0] = (before[0] * before[2] + last[0] * last[2]) / total
            before[1] = (before[1] * before[2] + last[1] * last[2]) / total
            before[2] = total
    # with half an example of each label, so that no rate is 0 or 1
    rates = [(m * w + 0.5 * labels.mean()) / (w + 0.5) for _, m, w in pools]
    return np.array([p[0] for p in pools]), np.maximum.accumulate(rates)


class Searcher:
    """Vectors of texts and their nearest examples."""

    def __init__(self, examples: Examples) -> None:
        self.examples = examples
        self.term_weights, self.unknown = examples.term_weights()
        weights = np.empty(len(examples.codes))
        likeness = np.full(len(examples.ids), -1, np.int64)
        for begin, end, own in _some(examples.starts):
            starts = examples.starts[begin : end + 1] - own.start
            codes, counts = examples.codes[own], examples.counts[own]
            place = np.repeat(np.arange(end - begin), np.diff(starts))
            some = (1 + np.log(counts)) * self.term_weights[codes]
            weights[own] = some / np.sqrt(np.bincount(place, some * some, end - begin))[place]
            # brings examples of one language together: the term each has most often
            order = np.lexsort((-examples.df[codes], -counts, place))
            firsts = order[starts[:-1][np.diff(starts) > 0]]
            likeness[begin + place[firsts]] = codes[firsts]
        examples.counts = None  # no longer needed
        self.index = Index(examples.starts, examples.codes, weights, len(examples.terms), likeness)

    def vector(self, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes and weights of length one; terms of no example count for the length."""
        terms = self.examples.terms
        codes = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
        known = terms[codes] == hashes
        times = 1 + np.log(counts)
        strange = times[~known] * self.unknown
        codes = codes[known]
        weights = times[known] * self.term_weights[codes]
        return codes, weights / (math.sqrt(weights @ weights + strange @ strange) or 1.0)

    def vote(self, near: Sequence[tuple[int, float]]) -> float:
        return _vote(near, self.examples.labels, self.examples.base)


def _searcher(key: str, sent: Broadcast) -> Searcher:
    return kept(key, lambda: Searcher(Examples.loaded(sent.value)))


@dataclass
class Model:
    """The examples' index, as workers get it, and the calibration of votes."""

    sent: Broadcast | None
    key: str
    ids: list[int]
    raw: np.ndarray
    rate: np.ndarray
    base: float
    none_rate: float

    def scorer(self) -> Callable[[Sequence[str | None]], list[tuple[float, list[tuple[int, float, int]]]]]:
        """What scores texts in a worker."""
        key, sent, raw, rate, base, none_rate = (
            self.key, self.sent, self.raw, self.rate, self.base, self.none_rate
        )

        def many(texts: Sequence[str | None]) -> list[tuple[float, list[tuple[int, float, int]]]]:
            if sent is None:
                return [(base, [])] * len(texts)
            own, found = _searcher(key, sent), []
            e = own.examples
            place, once = pd.factorize(np.array(["" if t is None else t for t in texts], object))
            for at in range(0, len(once), TOGETHER):
                vectors = [own.vector(*counted(t)) for t in once[at : at + TOGETHER]]
                for near in own.index.nearest(vectors, NEIGHBOURS):
                    score = float(np.interp(own.vote(near), raw, rate)) if near else none_rate
                    found.append((score, [(int(e.ids[x]), c, int(e.labels[x])) for x, c in near]))
            return [found[k] for k in place]

        return many


_COUNTED_SCHEMA = "doc_id LONG, toxic INT, size LONG, hashes BINARY, counts BINARY"
_COUNTED = ["doc_id", "toxic", "size", "hashes", "counts"]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    let_go()
    for batch in batches:
        texts = batch.column(2).to_pylist()
        found = [counted(t) for t in texts]
        sizes = pa.array([len((t or "").encode()) for t in texts], pa.int64())
        hashes = pa.array([h.tobytes() for h, _ in found], pa.binary())
        counts = pa.array([c.astype("<i8").tobytes() for _, c in found], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), sizes, hashes, counts], _COUNTED)


def _row(doc_id: int, toxic: int, hashes: bytes, counts: bytes) -> tuple[int, int, np.ndarray, np.ndarray]:
    return doc_id, toxic, np.frombuffer(hashes, np.uint64), np.frombuffer(counts, "<i8")


def _laid_out(most: int) -> Callable:
    """The index of the examples that come first, as long as their texts have so many bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total = [], 0
        for batch in batches:
            for doc_id, toxic, size, hashes, counts in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                total += size
                if total <= most or not rows:
                    rows.append(_row(doc_id, toxic, hashes, counts))
        if not rows:
            return
        stored = Examples.of(rows).stored()
        rows.clear()
        let_go()
        for name, data in stored.items():
            for part, at in enumerate(range(0, len(data), PART_BYTES)):
                one = [pa.array([name]), pa.array([part], pa.int32()), pa.array([data[at : at + PART_BYTES]], pa.binary())]
                yield pa.RecordBatch.from_arrays(one, ["name", "part", "data"])

    return run


def _votes(key: str, sent: Broadcast) -> Callable:
    """The vote of all other examples on each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _searcher(key, sent)
        ids = own.examples.ids
        for batch in batches:
            rows = [_row(*r) for r in zip(*[c.to_pylist() for c in batch.columns], strict=True)]
            place = np.minimum(np.searchsorted(ids, [r[0] for r in rows]), len(ids) - 1)
            kept = [k for k, r in enumerate(rows) if ids[place[k]] == r[0]]
            vectors = [own.vector(*rows[k][2:]) for k in kept]
            near = own.index.nearest(vectors, NEIGHBOURS, [int(place[k]) for k in kept])
            columns = [
                pa.array([rows[k][0] for k in kept], pa.int64()),
                pa.array([rows[k][1] for k in kept], pa.int32()),
                pa.array([len(rows[k][2]) > 0 for k in kept], pa.bool_()),
                pa.array([round(own.vote(n), 9) if n else None for n in near], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "toxic", "has_terms", "vote"])

    return run


def fit(docs: DataFrame, labels: DataFrame, learn: Column, folder: str, examples: int = EXAMPLES, most: int = BYTES) -> Model:
    """A model of ``labels`` (doc_id, toxic) on the texts of ``docs``, from rows where ``learn`` holds.

    Takes up to ``examples`` labelled documents, those of the least hashed doc_id, each
    text once, and of these as many as have ``most`` bytes together, the first one
    always. ``labels`` is the only input besides the texts; a NULL label or doc_id
    is none; of contradicting labels of a document the larger counts. Without examples
    of both labels every score is the mean label, 0 without any. ``folder`` takes the
    counted terms and the index.
    """
    usable = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").filter(learn)
    chosen = (
        usable.groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(examples)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(chosen), "doc_id"  # as many rows as examples at most
    )
    once = texts.groupBy(F.sha2(F.coalesce("text", F.lit("")), 256)).agg(
        F.min_by(F.struct("doc_id", "toxic", "text"), "doc_id").alias("e")
    )
    terms = saved(once.select("e.*").mapInArrow(_count, _COUNTED_SCHEMA), folder, "examples")
    first = terms.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id")
    index = saved(first.mapInArrow(_laid_out(most), "name STRING, part INT, data BINARY"), folder, "index")
    data: dict[str, bytes] = {}
    for row in sorted(index.collect(), key=lambda r: (r["name"], r["part"])):  # bounded by the texts' bytes
        data[row["name"]] = data.get(row["name"], b"") + bytes(row["data"])
    nothing, key = np.zeros(0), uuid.uuid4().hex
    if not data:
        return Model(None, key, [], nothing, nothing, 0.0, 0.0)
    ids, marks = np.cumsum(_numbers(data["ids"])).tolist(), _numbers(data["labels"])
    base = float(marks.mean())
    if not 0 < base < 1:
        return Model(None, key, ids, nothing, nothing, base, base)
    sent = docs.sparkSession.sparkContext.broadcast(data)
    del data
    voted = terms.select("doc_id", "toxic", "hashes", "counts").mapInArrow(
        _votes(key, sent), "doc_id LONG, toxic INT, has_terms BOOLEAN, vote DOUBLE"
    )
    rows = sorted(tuple(r) for r in voted.collect())  # a row for each example
    found = [(vote, toxic) for _, toxic, _, vote in rows if vote is not None]
    raw, rate = (
        isotonic(np.array([v for v, _ in found]), np.array([t for _, t in found], float))
        if found
        else (np.zeros(1), np.array([base]))
    )
    without = [toxic for _, toxic, has_terms, _ in rows if not has_terms]
    return Model(sent, key, ids, raw, rate, base, (sum(without) + base) / (len(without) + 1))


def scores(text: Column, model: Model) -> Column:
    """The score of a text, 0 to 1, and the examples that speak for it."""
    many = model.scorer()

    @F.pandas_udf(SCORE_TYPE)
    def score(texts: pd.Series) -> pd.DataFrame:
        found = many(texts.tolist())
        names = ("doc_id", "cosine", "toxic")
        return pd.DataFrame(
            {
                "score": [s for s, _ in found],
                "evidence": [[dict(zip(names, e, strict=True)) for e in own] for _, own in found],
            }
        )

    return score(text)


def only_score(text: Column, model: Model) -> Column:
    """The score alone."""
    many = model.scorer()

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([s for s, _ in many(texts.tolist())], dtype="float64")

    return score(text)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and evidence of every row; a NULL or empty text has the rate of texts without terms."""
    return docs.select("doc_id", scores(F.col("text"), model).alias("s")).select("doc_id", "s.*")
