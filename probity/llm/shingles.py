"""Hashes of word shingles, for a whole batch of texts at once.

Words are runs of bytes other than the six ASCII white spaces, with A to Z in
lower case. A word's hash is a polynomial in an odd base over its bytes, taken as
a difference of running sums, mixed; a shingle's hash is a mixed sum over its
words' hashes. All in unsigned 64-bit arithmetic, so the same everywhere.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = 0xD1342543DE82EF95
_LENGTH = U(0xA0761D6478BD642F)
#: Bytes hashed at once at most, unless one text is longer; a worker needs about a hundred times that.
BATCH_BYTES = 1_000_000

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, size: int) -> np.ndarray:
    """base ** 0 to base ** size, kept and doubled as needed."""
    table = _powers.get(base)
    if table is None or len(table) <= size:
        table = np.ones(1, U)
        factor = base
        while len(table) <= size:
            table = np.concatenate([table, table * U(factor)])
            factor = factor * factor % (1 << 64)
        _powers[base] = table
    return table


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit numbers that spreads each bit over all."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def shingle_hashes(texts: Sequence[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of ``words`` words, text by text, and how many each text has.

    A text with fewer words has its whole sequence as one; without words, none.
    Repeated shingles are repeated.
    """
    joined = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    space = _SPACE[joined]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space])))
    starts, ends = edge[::2], edge[1::2]
    n = len(starts)
    bounds = np.cumsum([len(t) + 1 for t in texts])  # a text's words start before its bound
    per_text = np.diff(np.concatenate([[0], np.searchsorted(starts, bounds)]))
    if not n:
        return np.zeros(0, U), np.zeros(len(texts), np.int64)
    up, down = _power_table(_BASE, len(joined)), _power_table(_INVERSE, len(joined))
    sums = np.concatenate([[U(0)], np.cumsum((_LOWER[joined] + U(1)) * up[: len(joined)])])
    word = mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U) * _LENGTH)

    first = np.cumsum(per_text) - per_text
    count = np.where(per_text >= words, per_text - words + 1, np.minimum(per_text, 1))
    at = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
    short = np.repeat(np.where(per_text < words, per_text, words), count)
    total = np.zeros(len(at), U)
    padded = np.concatenate([word, np.zeros(words, U)])
    for k in range(words):
        factor = U(pow(_STEP, k + 1, 1 << 64))
        total += np.where(short > k, padded[at + k], U(0)) * factor
    return mixed(total + short.astype(U)), count


def batches(texts: Sequence[bytes]):
    """Ranges of the texts of about BATCH_BYTES."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > BATCH_BYTES:
            yield begin, i
            begin, size = i, 0
        size += len(text) + 1
    if begin < len(texts):
        yield begin, len(texts)
