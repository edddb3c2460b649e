"""k-means over bit planes.

A vector of 64 components is turned into integers, and bit i of all of them into
one 64-bit word, its plane i. The highest plane weighs negative, as in two's
complement, so a vector takes as many planes as its largest component needs. The
dot product of two vectors is the sum over their pairs of planes of the planes'
weights times the number of ones in both; distances follow from dot products.
All of it is whole numbers, so results do not depend on the order of summing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probity.llm.scratch import saved

#: Components of a vector, one for each bit of a word.
WIDTH = 64
#: Integers below 2 ** LARGEST in size have squared distances that a long holds.
LARGEST = 27
#: Vectors compared at once.
ROWS = 4096

_PLANES = pa.schema([("vec_id", pa.int64()), ("planes", pa.binary())])
_ASSIGNED = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])
_SUMS = pa.schema([("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])


def weights(planes: int) -> np.ndarray:
    """What a one in each plane adds to a component."""
    found = np.int64(1) << np.arange(planes, dtype=np.int64)
    found[-1] = -found[-1]
    return found


def planes_needed(values: np.ndarray) -> np.ndarray:
    """Planes of each row of integers: the bits of its largest, and one for the sign."""
    size = (values ^ (values >> 63)).max(axis=1)
    return np.frexp(size.astype(float))[1] + 1


def pack(values: np.ndarray, planes: int) -> np.ndarray:
    """Rows of 64 integers as rows of so many words."""
    bits = (values[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").view("<u8")[:, :, 0]


def unpack(words: np.ndarray) -> np.ndarray:
    """The integers of rows of words."""
    n, planes = words.shape
    octets = np.ascontiguousarray(words, "<u8").view(np.uint8).reshape(n, planes, 8)
    bits = np.unpackbits(octets, axis=2, bitorder="little")
    return np.einsum("npk,p->nk", bits.astype(np.int64), weights(planes))


def dots(some: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Dot products of all rows of words with all others, by counting common ones."""
    total = np.zeros((len(some), len(others)), np.int64)
    for own, weight in zip(some.T, weights(some.shape[1]), strict=True):
        for theirs, other in zip(others.T, weights(others.shape[1]), strict=True):
            total += weight * other * np.bitwise_count(own[:, None] & theirs[None, :])
    return total


def lengths(words: np.ndarray) -> np.ndarray:
    """Squared lengths of rows of words, by counting common ones of their own planes."""
    total = np.zeros(len(words), np.int64)
    own = weights(words.shape[1])
    for i, one in enumerate(words.T):
        for j, other in enumerate(words.T):
            total += own[i] * own[j] * np.bitwise_count(one & other)
    return total


def nearest(words: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of the nearest centroid, the smallest of equally near ones, and the squared distance."""
    distance = lengths(words)[:, None] + lengths(centroids)[None, :] - 2 * dots(words, centroids)
    cluster = distance.argmin(axis=1)
    return cluster, distance[np.arange(len(words)), cluster]


def _packed(scale: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            values = np.floor(scale * given.astype(float).reshape(-1, WIDTH))
            wide = np.flatnonzero((np.abs(values) >= 2.0**LARGEST).any(axis=1))
            if len(wide):
                raise ValueError(f"components too large for a distance: vector {batch.column(0)[wide[0]]}")
            values = values.astype(np.int64)
            needed, rows = planes_needed(values), [b""] * len(values)
            for planes in np.unique(needed):
                chosen = np.flatnonzero(needed == planes)
                for row, words in zip(chosen, pack(values[chosen], int(planes)), strict=True):
                    rows[row] = words.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], schema=_PLANES)

    return run


def bit_planes(vectors: DataFrame, scale: int = WIDTH) -> DataFrame:
    """vec_id and planes of the vectors (vec_id, embedding) with 64 components, all finite numbers.

    A component x becomes floor(scale * x), computed in double. Vectors of
    another size, NULL ones and ones with a NULL, NaN or infinite component are
    left out; repeated rows stay, also those of a NULL vec_id. Other columns are
    ignored. A component of 2 ** 27 or more in size fails the job, as squared
    distances would not fit a long. An empty table gives no rows.
    """
    sound = f"""size(embedding) = {WIDTH} AND forall(embedding, x -> x IS NOT NULL
      AND NOT isnan(x) AND abs(CAST(x AS DOUBLE)) < double('Infinity'))"""
    given = vectors.selectExpr("CAST(vec_id AS LONG) AS vec_id", "CAST(embedding AS ARRAY<DOUBLE>) AS embedding")
    return given.filter(sound).mapInArrow(_packed(scale), "vec_id LONG, planes BINARY")


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and words of the rows of a batch, those with as many planes together."""
    rows = batch.column(1).to_pylist()
    sizes = np.array([len(r) // 8 for r in rows], int)
    for planes in np.unique(sizes):
        places = np.flatnonzero(sizes == planes)
        for at in range(0, len(places), ROWS):
            some = places[at : at + ROWS]
            yield some, np.frombuffer(b"".join(rows[i] for i in some), "<u8").reshape(-1, planes)


def _summed(centroids: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(centroids), np.int64)
        sums = np.zeros((len(centroids), WIDTH), np.int64)
        for batch in batches:
            for _, words in _groups(batch):
                cluster, _ = nearest(words, centroids)
                counts += np.bincount(cluster, minlength=len(centroids))
                np.add.at(sums, cluster, unpack(words))
        seen = np.flatnonzero(counts)
        columns = [pa.array(seen, pa.int32()), pa.array(counts[seen]), pa.array(sums[seen].tolist(), _SUMS.field(2).type)]
        yield pa.RecordBatch.from_arrays(columns, schema=_SUMS)

    return run


def _assigned(centroids: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int64)
            for places, words in _groups(batch):
                cluster[places], distance[places] = nearest(words, centroids)
            columns = [batch.column(0), pa.array(cluster), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, schema=_ASSIGNED)

    return run


@dataclass(frozen=True)
class Clustering:
    """Vectors (vec_id, cluster, distance), the centroids' integers, and the sum of distances of each."""

    vectors: DataFrame
    centroids: list[tuple[int, ...]]
    inertia: list[int]

    def digest(self, cluster: int) -> str:
        """The SHA-256 of a centroid's components in decimal, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.centroids[cluster])).encode()).hexdigest()

    def report(self) -> DataFrame:
        """The vectors with cluster_inertia, inertia and centroid_sha256."""
        whole = f"CAST({sum(self.inertia)} AS LONG) AS inertia"
        if not self.centroids:
            return self.vectors.selectExpr(
                "*", "CAST(0 AS LONG) AS cluster_inertia", whole, "'' AS centroid_sha256"
            )
        own = F.array(*[F.lit(i).cast("long") for i in self.inertia])
        digests = F.array(*[F.lit(self.digest(c)) for c in range(len(self.centroids))])
        return self.vectors.select(
            "*",
            own[F.col("cluster")].alias("cluster_inertia"),
            F.expr(whole),
            digests[F.col("cluster")].alias("centroid_sha256"),
        )


def _words(centroids: list[tuple[int, ...]]) -> np.ndarray:
    values = np.array(centroids, np.int64)
    return pack(values, int(planes_needed(values).max()))


def _moved(packed: DataFrame, centroids: list[tuple[int, ...]]) -> list[tuple[int, ...]]:
    """Every centroid as the whole mean of its vectors, rounded down; those without stay."""
    parts = packed.mapInArrow(_summed(_words(centroids)), "cluster INT, n LONG, sums ARRAY<LONG>")
    totals = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]) for i in range(WIDTH)])
    moved = list(centroids)
    for cluster, n, *sums in totals.collect():  # a row for each centroid at most
        moved[cluster] = tuple(s // n for s in sums)
    return moved


def cluster(
    vectors: DataFrame, folder: str, k: int = 16, rounds: int = 3, seed: int = 1, scale: int = WIDTH
) -> Clustering:
    """Group vectors (vec_id, embedding) around ``k`` centroids in so many rounds.

    The planes are written to ``folder`` once and read in each round. Centroids
    begin as the vectors of the least SHA-256 of ``seed:vec_id``, in that order;
    of rows of one vec_id the one with the lesser planes comes first, and a NULL
    vec_id last. With fewer vectors than ``k`` there are as many centroids as
    vectors. Which vectors are kept says ``bit_planes``. Tasks send a sum for each
    centroid, and the driver gets k rows a round.
    """
    packed = saved(bit_planes(vectors, scale), folder, "planes")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = packed.orderBy(order.asc_nulls_last(), "planes").limit(k).collect()
    centroids = [tuple(unpack(np.frombuffer(r["planes"], "<u8")[None, :])[0].tolist()) for r in first]
    for _ in range(rounds if centroids else 0):
        centroids = _moved(packed, centroids)
    if not centroids:
        return Clustering(packed.selectExpr("vec_id", "0 AS cluster", "0L AS distance"), [], [])
    assigned = packed.mapInArrow(_assigned(_words(centroids)), "vec_id LONG, cluster INT, distance LONG")
    assigned = saved(assigned, folder, "assigned")
    inertia = [0] * len(centroids)
    for row in assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect():
        inertia[row["cluster"]] = row["d"]
    return Clustering(assigned, centroids, inertia)
