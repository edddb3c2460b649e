"""Packing token pieces into sequences: best fit, certified by lower bounds, repacked in rounds.

Pieces are dealt to partitions of bounded size and each is packed by best-fit
decreasing. Dual-feasible functions give a lower bound of each partition's
sequences; where the count equals it, no packing of that partition is better.
The others give up the pieces of their unfilled sequences, certified ones those
of their emptiest sequence (a bound per partition says nothing of what the
leftovers of several could share), and these are dealt and packed anew, as
long as that saves sequences and the bound over all pieces isn't met.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probity.llm.scratch import new_folder, saved
from probity.llm.tokens import encoder

#: Mean pieces per partition; a partition is packed in one task's memory.
PARTITION_PIECES = 50_000
#: Rounds of exchange at most; each must save sequences.
ROUNDS = 8
#: Rows taken from an Arrow batch at once.
ROWS = 200

_PIECE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("ids", pa.binary()),
    ]
)
PIECE_SCHEMA = "doc_id LONG, piece INT, start LONG, length LONG, ids_crc32 LONG, ids BINARY"
_KEPT = "uid LONG, doc_id LONG, piece INT, start LONG, length LONG, ids_crc32 LONG"
_PACKED = f"{_KEPT}, part LONG, bin LONG, offset LONG, fill LONG, bins LONG, bound LONG, worst BOOLEAN"


def pieces(
    docs: DataFrame, vocabulary: str, end_id: int, capacity: int, ids: bool, special: bool = True
) -> DataFrame:
    """The pieces of each document's ids and its end id: whole, or cut if longer than ``capacity``.

    All but the first piece of a cut document have ``capacity`` ids. The ids
    themselves (unsigned 32 bit, least byte first) are there if asked for.
    """
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, special)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                out: list[list] = [[] for _ in _PIECE]
                for doc_id, text in zip(*[c.to_pylist() for c in some.columns], strict=True):
                    own = encode(text) + end
                    n = len(own) // 4
                    starts = [0, *range(n % capacity or capacity, n, capacity)]
                    for k, (a, b) in enumerate(zip(starts, [*starts[1:], n], strict=True)):
                        part = own[a * 4 : b * 4]
                        row = (doc_id, k, a, b - a, zlib.crc32(part), part if ids else None)
                        for column, value in zip(out, row, strict=True):
                            column.append(value)
                arrays = [pa.array(c, f.type) for c, f in zip(out, _PIECE, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=_PIECE)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        cut, PIECE_SCHEMA
    )


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences that pieces need at least; ``counts[n]`` pieces have length n.

    The best of three families of dual-feasible functions: the length itself; it
    with lengths above capacity - k raised to capacity and those below k lowered
    to nothing; and the rounding x -> floor((k + 1) x / capacity) / k, which
    leaves multiples of capacity / (k + 1) as they are.
    """
    counts = counts.astype(object)  # exact whole numbers
    length = np.arange(capacity + 1).astype(object)
    number = np.concatenate([[0], np.cumsum(counts)])
    volume = np.concatenate([[0], np.cumsum(counts * length)])
    best = -(-volume[-1] // capacity)
    for k in range(1, capacity // 2 + 1):
        large = number[-1] - number[capacity - k + 1]
        middle = volume[capacity - k + 1] - volume[k]
        best = max(best, large - (-middle // capacity))
    for k in range(1, 41):
        scaled = (k + 1) * length
        # in units of 1 / k of the capacity times capacity, so that all is whole
        value = np.where(scaled % capacity == 0, length * k, scaled // capacity * capacity)
        best = max(best, -(-(counts * value).sum() // (capacity * k)))
    return int(best)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-fit decreasing: the bin and the place in it of each length."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, used = 0, 0  # rooms: a bit for each room that some bin has
    for i, length in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fits = rooms >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            own = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, own, used = capacity, used, used + 1
        bins[i], offsets[i] = own, capacity - room
        if room > length:
            by_room[room - length].append(own)
            rooms |= 1 << (room - length)
    return bins, offsets


def _packed(items: DataFrame, parts: int, salt: int, capacity: int) -> DataFrame:
    """Each partition packed by itself, with its count of bins and their lower bound."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        lengths = pdf["length"].to_numpy()
        pdf["bin"], pdf["offset"] = best_fit(lengths, capacity)
        fill = np.bincount(pdf["bin"], weights=lengths).astype(np.int64)
        pdf["fill"], pdf["bins"] = fill[pdf["bin"]], len(fill)
        pdf["bound"] = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        pdf["worst"] = pdf["bin"] == int(fill.argmin())
        return pdf

    part = F.pmod(F.xxhash64("uid", F.lit(salt)), F.lit(parts)).alias("part")
    columns = ["uid", "doc_id", "piece", "start", "length", "ids_crc32"]
    return items.select(*columns, part).groupBy("part").applyInPandas(one, _PACKED)


def _bins(packed: DataFrame, where: str = "true") -> int:
    """Bins: each has one piece that begins it."""
    return packed.filter("offset = 0").filter(where).count()


def pack(
    docs: DataFrame,
    vocabulary: str,
    end_id: int,
    capacity: int = 1024,
    partition_pieces: int = PARTITION_PIECES,
    special: bool = True,
) -> DataFrame:
    """All ``docs`` (doc_id, text) as pieces of sequences of at most ``capacity`` tokens.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset. A NULL
    or empty text is its end id alone. Repeated rows are packed each; NULL
    doc_ids stay NULL; other columns are ignored; an empty table gives no rows.
    """
    folder = new_folder(docs.sparkSession)
    own = pieces(docs, vocabulary, end_id, capacity, ids=False, special=special)
    items = saved(
        own.select(F.monotonically_increasing_id().alias("uid"), *own.columns[:-1]), folder, "pieces"
    )
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in items.groupBy("length").count().collect():  # as many rows as lengths
        counts[length] = n
    least, total = lower_bound(counts, capacity), int(counts.sum())

    parts = max(1, -(-total // partition_pieces))
    now = saved(_packed(items, parts, 0, capacity), folder, "round0")
    settled, rounds, used = [], 0, _bins(now)
    give = f"fill < {capacity} AND (bins > bound OR worst)"
    while used > least and rounds < ROUNDS:
        pool = now.filter(give)
        size, before = pool.count(), _bins(pool)
        if before < 2:
            break
        parts = max(1, -(-size // partition_pieces))
        again = saved(_packed(pool, parts, rounds + 1, capacity), folder, f"round{rounds + 1}")
        saves = before - _bins(again)
        if saves <= 0:
            break
        settled.append(_numbered(now.filter(f"NOT ({give})"), rounds))
        now, rounds, used = again, rounds + 1, used - saves
    return reduce(DataFrame.union, [*settled, _numbered(now, rounds)])


def _numbered(packed: DataFrame, number: int) -> DataFrame:
    sequence = f"{number}L * {1 << 48}L + part * {1 << 24}L + bin AS sequence_id"
    return packed.selectExpr(
        "doc_id", "piece", "start", "length", "ids_crc32", sequence, "offset"
    )


def sequences(
    packed: DataFrame,
    docs: DataFrame,
    vocabulary: str,
    end_id: int,
    capacity: int = 1024,
    special: bool = True,
) -> DataFrame:
    """The sequences themselves: sequence_id and its ids. doc_ids must not repeat."""
    own = pieces(docs, vocabulary, end_id, capacity, ids=True, special=special).select("doc_id", "piece", "ids")
    placed = packed.select("doc_id", "piece", "sequence_id", "offset").join(own, ["doc_id", "piece"])
    in_order = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(in_order.alias("own")).select(
        "sequence_id", F.expr("aggregate(own, X'', (a, x) -> concat(a, x.ids)) AS ids")
    )
