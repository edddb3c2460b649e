"""Language-model scores by a probabilistic suffix tree over words.

A state of the tree is a context of up to two words. The root holds how often each
token follows anything, with one added. A longer context s with n followers of
T kinds gives the probability

    P(a | s) = (n(s a) + T P(a | parent)) / (n + T)

where the parent is its longest suffix that is a state. It is a state if it passes
a divergence test: the training tokens that follow it, each predicted from all
others, must be likelier by more than ``LEAST_GAIN`` nats than its parent makes
them. A token is scored in the longest suffix of what precedes it that is a state.

The work is laid out by what it needs to meet:

1. Tasks turn texts into chunks: distinct words as 64-bit hashes, tokens as places
   among them. Chunks are written once.
2. The chunks' words meet in ranges of hashes, and each chunk gets its words' numbers
   and counts back.
3. Each chunk deals its tokens, with two words before each, into buckets by the
   word before. All contexts that end with a word, the subtree of that word, are then
   in one bucket, which tests and scores them there. A word that precedes more
   than ``HEAVY`` tokens is dealt over several buckets by the word before it; what
   follows such a word is counted apart and handed to its buckets.
4. The buckets' sums, whole multiples of 2 ** -24, meet by chunk.

A chunk, a range and a word's share of a bucket have sizes that don't grow with the
corpus; words, contexts and counts are in no task or broadcast as a whole.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probity.llm.scratch import saved
from probity.llm.shingles import batches, mixed, shingle_hashes

U = np.uint64
#: Tokens after which a chunk ends; a longer text is a chunk of its own size.
CHUNK = 2_000_000
#: Words of chunks that meet in one range.
RANGE = 2_000_000
#: Tokens of a bucket on average, and tokens from which a word's subtree is dealt over several.
BUCKET, HEAVY = 1_500_000, 4_000_000
#: Tokens of a bucket whose contexts of two words are tested at once, about.
TOGETHER = 500_000
#: What the divergence test asks for, in nats.
LEAST_GAIN = 2.0
#: Parts of one that sums are counted in.
UNIT = 1 << 24

#: The end of a text as a word's hash, and the start as a word's number; no word has these.
END, START = U(1), 0
_STEP = U(0xD1342543DE82EF95)


def chained(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """One hash of two."""
    return mixed(mixed(x.astype(U)) * _STEP + y.astype(U))


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each different value, in their order, and for each place the number of its value."""
    order = np.argsort(values)
    ordered = values[order]
    new = np.ones(len(values), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    del ordered
    counted = np.cumsum(new, dtype=np.int32)
    counted -= 1
    number = np.empty(len(values), np.int32)
    number[order] = counted
    return order[new], number


def _squeezed(values: np.ndarray) -> bytes:
    """Numbers as bytes, all lowest ones first, compressed."""
    small = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1)
    return zstandard.compress(np.ascontiguousarray(small.T).tobytes(), 3)


def _restored(data: bytes, kind: str) -> np.ndarray:
    octets = np.frombuffer(zstandard.decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(octets.reshape(size, -1).T).view(kind).reshape(-1)


def _steps(values: np.ndarray) -> bytes:
    """Whole numbers by their differences, the sign in the lowest bit."""
    steps = np.diff(values.astype("<i8"), prepend=0)
    return _squeezed((steps << 1) ^ (steps >> 63))


def _from_steps(data: bytes) -> np.ndarray:
    steps = _restored(data, "<i8")
    return np.cumsum((steps >> 1) ^ -(steps & 1))


def _sorted_hashes(words: np.ndarray) -> bytes:
    return _squeezed(np.diff(words, prepend=U(0)))


def _from_sorted_hashes(data: bytes) -> np.ndarray:
    return np.cumsum(_restored(data, "<u8"), dtype=U)


def _table(rows: list, schema: pa.Schema) -> pa.Table:
    """A table of rows, which may be none."""
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _arrow(schema: str) -> pa.Schema:
    """The Arrow schema of a table whose columns are whole numbers, lists of them, or bytes."""
    kinds = {
        "INT": pa.int32(), "LONG": pa.int64(), "BINARY": pa.binary(), "ARRAY<LONG>": pa.list_(pa.int64()),
        "DOUBLE": pa.float64(), "BOOLEAN": pa.bool_(),
    }
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in schema.split(", "))])


# --- chunks

CHUNK_SCHEMA = (
    "chunk LONG, tokens LONG, learnt LONG, kinds LONG, doc_ids ARRAY<LONG>, learn BINARY, sizes BINARY, "
    "words BINARY, total BINARY, known BINARY, places BINARY"
)


def _rarest_last(total: np.ndarray) -> np.ndarray:
    """The words of a chunk in the order their places are written in."""
    return np.argsort(-total, kind="stable")


def _chunk_row(number: int, docs: list[tuple], hashes: list[np.ndarray]) -> pa.RecordBatch:
    sizes = np.array([n for _, _, n in docs], "<u4")
    learn = np.array([bool(own) for _, own, _ in docs])
    tokens = np.concatenate(hashes)
    words, places, total = np.unique(tokens, return_inverse=True, return_counts=True)
    own = np.bincount(places, np.repeat(learn, sizes), len(words)).astype("<i8")
    rank = np.empty(len(words), "<u4")
    rank[_rarest_last(total)] = np.arange(len(words))
    row = (
        number, len(tokens), int(own.sum()), len(words), [i for i, _, _ in docs], learn.astype(np.uint8).tobytes(),
        _squeezed(sizes), _sorted_hashes(words), _squeezed(total.astype("<i8")), _squeezed(own), _squeezed(rank[places]),
    )
    return _table([row], _arrow(CHUNK_SCHEMA)).to_batches()[0]


def _with_ends(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The hashes of several texts with an end behind each."""
    return np.insert(hashes, np.cumsum(sizes), END)


def _chunks(limit: int) -> Callable:
    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, docs, hashes, total = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in given:
            ids, learn, texts = (c.to_pylist() for c in batch.columns)
            texts = [(t or "").encode() for t in texts]
            for begin, end in batches(texts):
                found, sizes = shingle_hashes(texts[begin:end], 1)
                hashes.append(_with_ends(found, sizes))
                docs += zip(ids[begin:end], learn[begin:end], (sizes + 1).tolist(), strict=True)
                total += len(hashes[-1])
                if total >= limit:
                    yield _chunk_row(number, docs, hashes)
                    number, docs, hashes, total = number + 1, [], [], 0
        if docs:
            yield _chunk_row(number, docs, hashes)

    return run


# --- words

ASK_SCHEMA = "part INT, chunk LONG, words BINARY, total BINARY, known BINARY"
ANSWER_SCHEMA = "chunk LONG, part INT, numbers BINARY, total BINARY, known BINARY, kinds LONG, most LONG"


def _asked(parts: int) -> Callable:
    """A chunk's words with their counts, cut into ranges of hashes."""

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            for chunk, words, total, known in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                words, total, known = _from_sorted_hashes(words), _restored(total, "<i8"), _restored(known, "<i8")
                part = ((words >> U(32)) * U(parts)) >> U(32)
                ends = np.searchsorted(part, np.arange(parts + 1, dtype=U))
                rows = [
                    (k, chunk, _sorted_hashes(words[a:b]), _squeezed(total[a:b]), _squeezed(known[a:b]))
                    for k, (a, b) in enumerate(zip(ends, ends[1:], strict=False))
                    if b > a
                ]
                yield from _table(rows, _arrow(ASK_SCHEMA)).to_batches()

    return run


def _answered(parts: int) -> Callable:
    """The numbers and whole counts of the words of a range, for each chunk that has some."""

    def run(asked: pa.Table) -> pa.Table:
        rows = asked.to_pylist()
        words = [_from_sorted_hashes(r["words"]) for r in rows]
        some, number = distinct(np.concatenate(words))
        total, known = (
            np.bincount(number, np.concatenate([_restored(r[c], "<i8") for r in rows]), len(some)).astype("<i8")
            for c in ("total", "known")
        )
        ends, found, kinds = np.cumsum([len(w) for w in words]), [], int((known > 0).sum())
        for row, begin, end in zip(rows, np.concatenate([[0], ends[:-1]]), ends, strict=True):
            own = number[begin:end]
            numbers = own * parts + row["part"] + 1
            counts = [_squeezed(total[own]), _squeezed(known[own])]
            found.append((row["chunk"], row["part"], _steps(numbers), *counts, kinds, int(total[own].max())))
            kinds = 0
        return _table(found, _arrow(ANSWER_SCHEMA))

    return run


# --- buckets

PIECE_SCHEMA = (
    "bucket INT, chunk LONG, words BINARY, known BINARY, before BINARY, second BINARY, token BINARY, "
    "doc BINARY, doc_ids ARRAY<LONG>, learn BINARY, sizes BINARY, n_known BINARY, base BINARY"
)
PAIR_SCHEMA = "before LONG, token LONG, bucket INT, n LONG, known LONG"


class _Dealt:
    """The tokens of a chunk with what precedes them, and the bucket of each.

    Words are places in ``words``, which begins with the start, a word that no text has as
    a token; the others come in the order of their training counts, the greatest first.
    """

    def __init__(self, chunk: pa.Table, answers: pa.Table, buckets: int, heavy: int) -> None:
        (self.row,) = chunk.to_pylist()
        parts = sorted(answers.to_pylist(), key=lambda r: r["part"])
        numbers, known, total = (
            np.concatenate([read(r[c]) for r in parts])
            for c, read in (("numbers", _from_steps), ("known", _counts), ("total", _counts))
        )
        order = np.lexsort((numbers, -known))
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(1, len(order) + 1)
        self.words = np.concatenate([[START], numbers[order]])
        self.known = np.concatenate([[0], known[order]])
        own = _counts(self.row["total"])
        self.sizes = _restored(self.row["sizes"], "<u4").astype(np.int64)
        self.learn = np.frombuffer(self.row["learn"], np.uint8).astype(bool)
        self.token = place[_rarest_last(own)][_restored(self.row["places"], "<u4")]
        starts = np.cumsum(self.sizes) - self.sizes
        end = self.token[self.sizes[0] - 1]
        total = np.concatenate([[0], total[order]])
        total[0] = total[end]  # as often as texts end they start
        self.doc = np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)
        self.before = np.concatenate([self.token[:1], self.token[:-1]])
        self.before[starts] = 0
        self.second = np.concatenate([self.before[:1], self.before[:-1]])
        self.second[starts] = 0
        self.shares = np.where(total > heavy, -(-total // heavy), 1)
        first = chained(self.words, np.zeros(1))
        self.bucket = (first % U(buckets)).astype(np.int32)[self.before]
        some = np.flatnonzero((self.shares > 1)[self.before])
        if len(some):
            before = self.before[some]
            share = first[self.second[some]] % self.shares[before].astype(U)
            self.bucket[some] = chained(first[before], share) % U(buckets)


def _counts(data: bytes) -> np.ndarray:
    return _restored(data, "<i8")


def _pieces(buckets: int, learnt: int, kinds: int, heavy: int) -> Callable:
    """The share of each bucket in a chunk; one of them has the chunk's documents too."""

    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        dealt = _Dealt(chunk, answers, buckets, heavy)
        base = np.log10((dealt.known + 1) / (learnt + kinds + 1))
        docs = len(dealt.sizes)
        own = [
            dealt.row["doc_ids"], dealt.row["learn"], dealt.row["sizes"],
            _squeezed(np.bincount(dealt.doc, dealt.known[dealt.token] > 0, docs).astype("<u4")),
            np.bincount(dealt.doc, base[dealt.token], docs).tobytes(),
        ]
        order = np.lexsort((dealt.before, dealt.bucket))
        ends = np.flatnonzero(np.diff(dealt.bucket[order], prepend=-1, append=-2))
        rows = []
        for begin, end in zip(ends, ends[1:], strict=False):
            some = order[begin:end]
            three = np.concatenate([dealt.before[some], dealt.second[some], dealt.token[some]])
            first, places = distinct(three)
            words, parts = three[first], np.split(places.astype("<u4"), 3)
            doc = dealt.doc[some] * 2 + dealt.learn[dealt.doc[some]]
            rows.append(
                [int(dealt.bucket[some[0]]), dealt.row["chunk"], _steps(dealt.words[words]),
                 _steps(dealt.known[words]), *map(_squeezed, parts), _squeezed(doc.astype("<u4")), *own]
            )
            own = [None] * 5
        return _table(rows, _arrow(PIECE_SCHEMA))

    return run


def _heavy_pairs(buckets: int, heavy: int) -> Callable:
    """What follows the words that are dealt over several buckets, and in which buckets."""

    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        dealt = _Dealt(chunk, answers, buckets, heavy)
        some = np.flatnonzero(dealt.shares[dealt.before] > 1)
        before, token, bucket = dealt.before[some], dealt.token[some], dealt.bucket[some]
        first, place = distinct(chained(chained(before, token), bucket))
        n = np.bincount(place, dealt.learn[dealt.doc[some]], len(first)).astype(np.int64)
        columns = [dealt.words[before[first]], dealt.words[token[first]], bucket[first], n, dealt.known[token[first]]]
        return pa.table([pa.array(c) for c in columns], schema=_arrow(PAIR_SCHEMA))

    return run


def _heavy_states(pairs: DataFrame, folder: str, learnt: int, kinds: int, least: float) -> DataFrame:
    """bucket, before, token, p, state: the level of one word, for words that several buckets share."""
    met = pairs.groupBy("before", "token").agg(
        F.sum("n").cast("double").alias("n"), F.max("known").alias("known"), F.collect_set("bucket").alias("buckets")
    )
    p = (F.col("known") + 1) / F.lit(float(learnt + kinds + 1))
    rows = saved(met.select("before", "token", "n", "buckets", p.alias("parent")), folder, "pairs")
    sums = rows.groupBy("before").agg(F.sum("n").alias("total"), F.count_if(F.col("n") > 0).cast("double").alias("kinds"))
    with_sums = rows.join(sums, "before")
    others = "kinds - IF(n = 1, 1, 0)"
    gain = f"CASE WHEN n > 0 AND total > 1 THEN n * ln((n - 1 + ({others}) * parent) / (total - 1 + {others}) / parent) END"
    states = with_sums.groupBy("before").agg(
        F.coalesce(F.expr(f"sum({gain}) > {least}"), F.lit(False)).alias("state")
    )
    own = "IF(state, (n + kinds * parent) / (total + kinds), parent)"
    return with_sums.join(states, "before").selectExpr(
        "explode(buckets) AS bucket", "before", "token", f"{own} AS p", "state"
    )


# --- the tree of a bucket


def grown(n: np.ndarray, context: np.ndarray, parent: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The probabilities of followers in their contexts, and whether each context is a state.

    ``n`` counts each follower in training, ``context`` numbers its context from 0,
    ``parent`` is its probability in the parent. A context that is no state has
    the parent's probabilities.
    """
    size = int(context.max(initial=-1)) + 1
    total = np.bincount(context, n, size)[context]
    kinds = np.bincount(context, n > 0, size)[context]
    left = kinds - (n == 1)
    tested = (n > 0) & (total > 1)
    without = np.where(tested, (n - 1 + left * parent) / np.where(tested, total - 1 + left, 1), parent)
    gain = np.bincount(context, n * np.log(without / parent), size)[context]
    state = (total > 1) & (gain > least)
    return np.where(state, (n + kinds * parent) / np.where(state, total + kinds, 1), parent), state


def tree(
    before: np.ndarray, second: np.ndarray, token: np.ndarray, known: np.ndarray, learn: np.ndarray,
    learnt: int, kinds: int, least: float, heavy: tuple | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """For each token the probability it has, and the length of the state that gives it.

    Words are places in ``known``, their training counts. ``heavy`` has the level of one
    word for words whose tokens aren't all here: before, token, probability and
    whether the word is a state.
    """
    width = np.int64(len(known))
    pair = before * width + token
    first, of_pair = distinct(pair)
    pair = pair[first]
    own = np.bincount(of_pair, learn, len(first))
    parent = ((known + 1) / (learnt + kinds + 1))[token[first]]
    p, state = grown(own, distinct(before[first])[1], parent, least)
    if heavy is not None:
        at = np.searchsorted(pair, heavy[0] * width + heavy[1])
        p[at], state[at] = heavy[2], heavy[3]
    found, length = np.empty(len(token)), np.empty(len(token), np.int8)
    slices = -(-len(token) // TOGETHER)
    slice_of = (second + before) % slices if slices > 1 else np.zeros(len(token), np.int32)
    for number in range(slices):  # all that follows a context is in one slice
        some = np.flatnonzero(slice_of == number)
        context = distinct(second[some] * width + before[some])[1]
        first, of_triple = distinct(context * width + token[some])
        own = np.bincount(of_triple, learn[some], len(first))
        above = of_pair[some[first]]
        deep, long = grown(own, distinct(context[first])[1], p[above], least)
        found[some], length[some] = deep[of_triple], np.where(long, 2, state[above])[of_triple]
    return found, length


PART_SCHEMA = (
    "chunk LONG, docs BINARY, score BINARY, one BINARY, two BINARY, "
    "doc_ids ARRAY<LONG>, learn BINARY, sizes BINARY, n_known BINARY, base BINARY"
)


def _scored(learnt: int, kinds: int, least: float) -> Callable:
    def run(pieces: pa.Table, heavy: pa.Table) -> pa.Table:
        rows = pieces.to_pylist()
        if not rows:
            return _table([], _arrow(PART_SCHEMA))
        listed = [_from_steps(r["words"]) for r in rows]
        first, places = distinct(np.concatenate(listed))
        words = np.concatenate(listed)[first]
        known = np.concatenate([_from_steps(r["known"]) for r in rows])[first]
        places = np.split(places.astype(np.int32), np.cumsum([len(w) for w in listed])[:-1])
        before, second, token = (
            np.concatenate([own[_restored(r[c], "<u4")] for r, own in zip(rows, places, strict=True)])
            for c in ("before", "second", "token")
        )
        docs = [_restored(r["doc"], "<u4") for r in rows]
        ends, doc = np.cumsum([len(d) for d in docs]), np.concatenate(docs)
        side = None
        if heavy.num_rows:
            side = [heavy[c].to_numpy() for c in ("before", "token", "p", "state")]
            side[:2] = [np.searchsorted(words, w) for w in side[:2]]
        del listed, docs, places
        p, length = tree(before, second, token, known, (doc & 1).astype(bool), learnt, kinds, least, side)
        del before, second, token, known
        score, parts = np.log10(p), []
        for row, begin, end in zip(rows, np.concatenate([[0], ends[:-1]]), ends, strict=True):
            own = doc[begin:end] >> 1
            total = np.bincount(own, score[begin:end])
            seen = np.flatnonzero(np.bincount(own))
            used = [np.bincount(own, length[begin:end] == k)[seen].astype("<u4") for k in (1, 2)]
            whole = np.round(total[seen] * -UNIT).astype("<i8")
            parts.append(
                [row["chunk"], _steps(seen), _squeezed(whole), *map(_squeezed, used),
                 *[row[c] for c in ("doc_ids", "learn", "sizes", "n_known", "base")]]
            )
        return _table(parts, _arrow(PART_SCHEMA))

    return run


SCORE_SCHEMA = (
    "doc_id LONG, learnt BOOLEAN, n_tokens LONG, n_known LONG, train_tokens LONG, base_score DOUBLE, score DOUBLE, "
    "by_one_word LONG, by_two_words LONG"
)


def _summed(learnt: int) -> Callable:
    def run(parts: pa.Table) -> pa.Table:
        rows = parts.to_pylist()
        own = next(r for r in rows if r["doc_ids"] is not None)
        sizes = _restored(own["sizes"], "<u4").astype(np.int64)
        score, used = np.zeros(len(sizes), np.int64), np.zeros((2, len(sizes)), np.int64)
        for row in rows:
            docs = _from_steps(row["docs"])
            score[docs] += _restored(row["score"], "<i8")
            for k, name in enumerate(("one", "two")):
                used[k, docs] += _restored(row[name], "<u4")
        columns = [
            own["doc_ids"],
            np.frombuffer(own["learn"], np.uint8).astype(bool),
            sizes,
            _restored(own["n_known"], "<u4").astype(np.int64),
            np.full(len(sizes), learnt),
            np.frombuffer(own["base"], "<f8"),
            score / -UNIT,
            *used,
        ]
        schema = _arrow(SCORE_SCHEMA)
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def score(
    docs: DataFrame,
    learn: Column,
    folder: str,
    chunk: int = CHUNK,
    bucket: int = BUCKET,
    heavy: int = HEAVY,
    least: float = LEAST_GAIN,
    part: int = RANGE,
) -> DataFrame:
    """Every row's log10 probability under a tree learnt from the rows where ``learn`` holds.

    Input: doc_id and text; other columns are ignored, also ones named like those
    here. A token is a word (a run of anything but ASCII white space, A to Z as a to z)
    or the end, which each text has once; a NULL text is empty. Returns doc_id, learnt,
    n_tokens, n_known (tokens that are training tokens too), train_tokens (of all),
    base_score (the root's, log10 of (count + 1) / (tokens + kinds + 1)), score (the
    tree's), and how many tokens were scored by a state of one or two words.
    Repeated rows are texts of their own, a NULL doc_id stays, NULL in ``learn`` is
    no, and an empty table gives no rows. Two words of one 64-bit hash count as one.

    ``folder`` takes the written chunks, counts and pairs. Tokens after a pair of
    words meet in one bucket, however many they are.
    """
    given = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(learn, F.lit(False)).alias("learn"), "text"
    )
    chunks = saved(given.mapInArrow(_chunks(chunk), CHUNK_SCHEMA), folder, "chunks")
    learnt, tokens, words = [n or 0 for n in chunks.agg(F.sum("learnt"), F.sum("tokens"), F.sum("kinds")).first()]
    parts = max(1, math.ceil(words / part))
    asked = chunks.select("chunk", "words", "total", "known").mapInArrow(_asked(parts), ASK_SCHEMA)
    answers = saved(asked.groupBy("part").applyInArrow(_answered(parts), ANSWER_SCHEMA), folder, "words")
    kinds, most = [n or 0 for n in answers.agg(F.sum("kinds"), F.max("most")).first()]

    buckets = max(1, math.ceil(tokens / bucket))
    dealt = (
        chunks.select("chunk", "doc_ids", "learn", "sizes", "total", "places")
        .groupBy("chunk")
        .cogroup(answers.select("chunk", "part", "numbers", "total", "known").groupBy("chunk"))
    )
    pieces = dealt.applyInArrow(_pieces(buckets, learnt, kinds, heavy), PIECE_SCHEMA)
    pairs = docs.sparkSession.createDataFrame([], PAIR_SCHEMA)
    if most > heavy:
        pairs = dealt.applyInArrow(_heavy_pairs(buckets, heavy), PAIR_SCHEMA)
    side = _heavy_states(pairs, folder, learnt, kinds, least)
    scored = (
        pieces.groupBy("bucket").cogroup(side.groupBy("bucket")).applyInArrow(_scored(learnt, kinds, least), PART_SCHEMA)
    )
    return scored.groupBy("chunk").applyInArrow(_summed(learnt), SCORE_SCHEMA)
