"""Bit planes: exact arithmetic, clusters against plain k-means, and odd rows."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from texts import with_clashes

from probity.llm import planes

SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>"


def some_integers(rng, n, bits):
    return rng.integers(-(1 << bits), 1 << bits, (n, planes.WIDTH), dtype=np.int64)


@pytest.mark.parametrize("bits", [0, 1, 6, 13, 26])
def test_products_are_exact(bits):
    rng = np.random.default_rng(bits)
    a, b = some_integers(rng, 40, bits), some_integers(rng, 9, max(bits - 2, 0))
    wide, narrow = planes.planes_needed(a).max(), planes.planes_needed(b).max()
    x, y = planes.pack(a, int(wide)), planes.pack(b, int(narrow))
    assert (planes.unpack(x) == a).all()
    assert (planes.dots(x, y) == a @ b.T).all()
    assert (planes.lengths(x) == (a * a).sum(axis=1)).all()
    cluster, distance = planes.nearest(x, y)
    plain = ((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2)
    assert (distance == plain.min(axis=1)).all() and (cluster == plain.argmin(axis=1)).all()


def test_rows_take_the_planes_they_need():
    values = np.zeros((6, planes.WIDTH), np.int64)
    values[1, 3], values[2, 0], values[3, 63], values[4, 5], values[5, 1] = 1, -1, -2, 127, -128
    assert planes.planes_needed(values).tolist() == [1, 2, 1, 2, 8, 8]


def plain_clusters(vectors, k=16, rounds=3):
    """vec_id, cluster, distance, inertia of the cluster and of all, digest, by plain k-means."""
    kept = []
    for i, v in vectors:
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, tuple(math.floor(64 * float(np.float32(x))) for x in v)))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest()))
    centroids = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for n in range(len(centroids)):
            members = [v for (_, v), c in zip(kept, own, strict=True) if c == n]
            if members:
                centroids[n] = tuple(sum(x) // len(members) for x in zip(*members, strict=True))
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = [sum(d for _, c, d in found if c == n) for n in range(len(centroids))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, inertia[c], sum(inertia), digests[c]) for i, c, d in found), key=str)


def report(df, folder, **how):
    found = planes.cluster(df, str(folder), **how).report()
    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in found.select(*names).collect()), key=str)


def some_vectors(seed, n, spread=1.0):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, spread) for _ in range(64)] for _ in range(5)]
    return [(i, [x + draw.gauss(0, 0.3) for x in draw.choice(centres)]) for i in range(n)]


@pytest.mark.parametrize(("n", "spread"), [(300, 1.0), (60, 3000.0), (7, 1.0), (1, 0.0)])
def test_clusters_are_those_of_plain_k_means(spark, rows, tmp_path, n, spread):
    given = some_vectors(n, n, spread)
    assert report(rows(SCHEMA, given).repartition(5), tmp_path / "p") == plain_clusters(given)


def test_odd_rows(spark, rows, tmp_path):
    nan, inf = float("nan"), float("inf")
    flat = [0.5] * 64
    given = [
        *some_vectors(3, 40),
        (100, None), (101, []), (102, [1.0] * 63), (103, [1.0] * 65), (104, [None, *flat[1:]]),
        (105, [nan, *flat[1:]]), (106, [-inf, *flat[1:]]), (107, flat), (107, flat), (108, flat), (None, flat),
    ]
    found = report(with_clashes(rows(SCHEMA, given)), tmp_path / "p")
    assert found == plain_clusters(given)
    assert [r[0] for r in found].count(107) == 2 and any(r[0] is None for r in found)


def test_empty_table(spark, rows, tmp_path):
    assert report(rows(SCHEMA, []), tmp_path / "a") == []
    assert report(rows(SCHEMA, [(1, None)]), tmp_path / "b") == []


def test_components_without_a_distance_fail(spark, rows, tmp_path):
    with pytest.raises(Exception, match="too large"):
        report(rows(SCHEMA, [(5, [1e9] * 64)]), tmp_path / "p")
