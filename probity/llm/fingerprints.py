"""One-permutation MinHash fingerprints in packed low-order bits.

Each shingle is hashed once: some bits of the hash choose a bin, the rest are
its value there, and a bin keeps its least value. An empty bin takes the value
of a filled one, found by hashing the bin's number and the attempt until one is
hit (optimal densification); the attempts are the same for all texts. Of every
bin the lowest bits are stored. Two fingerprints agree in a bin where the sets'
least shingle is the same, or by chance, which the estimate takes off.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from probity.llm.scratch import new_folder, saved
from probity.llm.shingles import U, batches, mixed, shingle_hashes

WORDS = 5
BINS = 512
BITS = 4
#: Rows taken from an Arrow batch at once.
ROWS = 500

_EMPTY = np.iinfo(np.uint64).max


@lru_cache(maxsize=2)
def _attempts(bins: int, tries: int) -> np.ndarray:
    """The bin that each bin turns to at each attempt: a row per attempt."""
    key = np.arange(tries, dtype=np.uint64)[:, None] * U(bins) + np.arange(bins, dtype=np.uint64)
    return (mixed(key + U(0x2545F4914F6CDD1D)) % U(bins)).astype(np.int64)


def _densified(values: np.ndarray) -> np.ndarray:
    """Fills the empty bins of each row that has a filled one."""
    rows, bins = values.shape
    empty = values == _EMPTY
    row, column = np.nonzero(empty & ~empty.all(axis=1)[:, None])
    filled, attempt, tries = values.copy(), 0, 64
    while len(row):
        if attempt == tries:
            tries *= 4
        source = _attempts(bins, tries)[attempt, column]
        hit = ~empty[row, source]
        filled[row[hit], column[hit]] = values[row[hit], source[hit]]
        row, column = row[~hit], column[~hit]
        attempt += 1
    return filled


def fingerprints(
    texts: Sequence[bytes], words: int = WORDS, bins: int = BINS, bits: int = BITS
) -> list[bytes]:
    """The packed fingerprint of each text (UTF-8); of a text without words, the empty one."""
    out: list[bytes] = []
    for begin, end in batches(texts):
        hashes, counts = shingle_hashes(texts[begin:end], words)
        values = np.full((len(counts), bins), _EMPTY, U)
        owner = np.repeat(np.arange(len(counts)), counts)
        slot = owner * bins + (hashes % U(bins)).astype(np.int64)
        np.minimum.at(values.reshape(-1), slot, hashes // U(bins))
        low = (mixed(_densified(values)) & U((1 << bits) - 1)).astype(np.uint8)
        spread = np.unpackbits(low[:, :, None], axis=2, count=bits, bitorder="little")
        packed = np.packbits(spread.reshape(len(counts), -1), axis=1, bitorder="little")
        out += [p.tobytes() if n else b"" for p, n in zip(packed, counts, strict=True)]
    return out


def likeness(
    left: Sequence[bytes], right: Sequence[bytes], bins: int = BINS, bits: int = BITS
) -> np.ndarray:
    """Estimated Jaccard similarity of each pair, 0 to 1; two empty fingerprints are alike."""
    size = bins * bits // 8
    both = [bool(a) and bool(b) for a, b in zip(left, right, strict=True)]
    blank = bytes(size)

    def table(side: Sequence[bytes]) -> np.ndarray:
        own = b"".join(s if b else blank for s, b in zip(side, both, strict=True))
        raw = np.frombuffer(own, np.uint8).reshape(len(side), size)
        return np.unpackbits(raw, axis=1, bitorder="little").reshape(len(side), bins, bits)

    agree = (table(left) == table(right)).all(axis=2).mean(axis=1)
    chance = 2.0**-bits
    found = np.clip((agree - chance) / (1 - chance), 0.0, 1.0)
    same = np.array([not a and not b for a, b in zip(left, right, strict=True)])
    return np.where(both, found, np.where(same, 1.0, 0.0))


_RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.binary()),
        ("print", pa.binary()),
        ("edited_print", pa.binary()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
        ("file", pa.int64()),
        ("edge", pa.string()),
        ("text", pa.string()),
    ]
)
_RESULT_SCHEMA = (
    "doc_id LONG, n_chars LONG, edited_sha256 BINARY, print BINARY, edited_print BINARY, "
    "near_edited DOUBLE, near_next DOUBLE, file LONG, edge STRING, text STRING"
)


def _rows(ids: list, texts: list[str], following: list[str]) -> pa.RecordBatch:
    """Results of texts and of those edited with the head of the text that follows each."""
    thirds = [len(t) // 3 for t in texts]
    edited = [
        (t[: len(t) - k] + f[:k]).encode() for t, f, k in zip(texts, following, thirds, strict=True)
    ]
    plain = [t.encode() for t in texts]
    # what follows a row is mostly the next row, so each text is hashed once
    chain = bool(texts) and texts[1:] == following[:-1]
    own = fingerprints([*plain, *([following[-1].encode()] if chain else [])])
    after = own[1:] if chain else fingerprints([f.encode() for f in following])
    own, changed = own[: len(texts)], fingerprints(edited)
    columns = [
        ids,
        [len(t) for t in texts],
        [hashlib.sha256(e).digest() for e in edited],
        own,
        changed,
        likeness(own, changed),
        likeness(own, after),
        *[[None] * len(ids)] * 3,
    ]
    arrays = [pa.array(c, f.type) for c, f in zip(columns, _RESULT, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=_RESULT)


def _edge(kind: str, doc_id, text: str) -> pa.RecordBatch:
    row = [doc_id, *[None] * 6, TaskContext.get().partitionId(), kind, text]
    return pa.RecordBatch.from_arrays(
        [pa.array([v], f.type) for v, f in zip(row, _RESULT, strict=True)], schema=_RESULT
    )


def _in_order(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of all rows but the last, and the first and the last row as edges."""
    ids, texts, began = [], [], False
    for batch in batches_:
        for at in range(0, batch.num_rows, ROWS):
            some = batch.slice(at, ROWS)
            ids += some.column(0).to_pylist()
            texts += some.column(1).to_pylist()
            if not began:
                yield _edge("first", ids[0], texts[0])
                began = True
            if len(ids) > 1:
                yield _rows(ids[:-1], texts[:-1], texts[1:])
            ids, texts = ids[-1:], texts[-1:]
    if began:
        yield _edge("last", ids[0], texts[0])


def _at_edges(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches_:
        if batch.num_rows:
            yield _rows(*[c.to_pylist() for c in batch.columns])


def neighbour_fingerprints(docs: DataFrame) -> DataFrame:
    """Each document, its text edited with the head of the next, and how alike they are.

    The last third of a text (in code points, rounded down) gives way to as many
    from the head of the next document's, in descending doc_id; the first follows
    the last. Returns doc_id, n_chars, edited_sha256, print, edited_print,
    near_edited, near_next. A NULL text is empty; NULL doc_ids come last; rows of
    one doc_id go by text; a single row follows itself; an empty table gives no
    rows; other columns are ignored.

    Texts are shuffled once, by ranges of doc_id. Where one range meets the next,
    the two texts are kept and joined by the number of the range.
    """
    folder = new_folder(docs.sparkSession)
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    order = [F.desc_nulls_last("doc_id"), F.col("text")]
    ordered = texts.repartitionByRange(order[0]).sortWithinPartitions(*order)
    found = saved(ordered.mapInArrow(_in_order, _RESULT_SCHEMA), folder, "prints")
    files = found.filter("edge = 'last'").select("file")  # a row per range
    follows = F.lead("file").over(Window.orderBy("file"))
    first = F.min("file").over(Window.partitionBy())
    linked = files.select("file", F.coalesce(follows, first).alias("next"))
    heads = found.filter("edge = 'first'").selectExpr("file AS next", "text AS following")
    edges = (
        found.filter("edge = 'last'")
        .select("file", "doc_id", "text")
        .join(linked, "file")
        .join(heads, "next")
        .select("doc_id", "text", "following")
        .mapInArrow(_at_edges, _RESULT_SCHEMA)
    )
    whole = found.filter("edge IS NULL").union(edges).drop("file", "edge", "text")
    return whole.withColumn("edited_sha256", F.lower(F.hex("edited_sha256")))
