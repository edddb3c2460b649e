"""Minimum-cost flows, cuts and the written shards."""

from __future__ import annotations

import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F
from texts import DOCS, odd_rows, with_clashes

from probity.llm import reshard
from probity.llm.queries import NEW_SHARDS, OLD_SHARDS, QUERIES
from probity.llm.scratch import new_folder


def cheapest(supply, capacity, cost) -> int:
    """By trying every way to send whole units."""
    units = [i for i, n in enumerate(supply) for _ in range(n)]
    best = None
    for ends in itertools.product(range(len(capacity)), repeat=len(units)):
        if all(ends.count(j) <= c for j, c in enumerate(capacity)):
            price = sum(cost(i, j) for i, j in zip(units, ends, strict=True))
            best = price if best is None else min(best, price)
    return best


def test_flow_is_the_cheapest():
    rng = random.Random(1)
    for _ in range(60):
        supply = [rng.randint(0, 3) for _ in range(3)]
        capacity = [rng.randint(0, 4) for _ in range(3)]
        if sum(capacity) < sum(supply):
            with pytest.raises(ValueError, match="hold less"):
                reshard.minimum_cost_flow(supply, capacity, lambda i, j: 1)
            continue
        table = [[rng.randint(0, 9) for _ in range(3)] for _ in range(3)]
        flow = reshard.minimum_cost_flow(supply, capacity, lambda i, j: table[i][j])
        assert [sum(n for (i, _), n in flow.items() if i == s) for s in range(3)] == supply
        assert all(sum(n for (_, j), n in flow.items() if j == t) <= capacity[t] for t in range(3))
        price = sum(n * table[i][j] for (i, j), n in flow.items())
        assert price == cheapest(supply, capacity, lambda i, j: table[i][j])


def test_what_can_stay_stays():
    flow = reshard.minimum_cost_flow([100, 20, 0], [40, 40, 40], lambda i, j: int(i != j))
    assert sum(n for (i, j), n in flow.items() if i != j) == 60


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text", "source")
    rows = {r["doc_id"]: r for r in docs.collect()}
    got = QUERIES["op8_sharding"](spark, f"/root/testdata/{sf}").collect()
    assert sorted(r["doc_id"] for r in got) == sorted(rows)
    shards: dict[int, list] = {}
    sizes = dict.fromkeys(range(OLD_SHARDS), 0)
    for r in got:
        text = rows[r["doc_id"]]["text"].encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 1, zlib.crc32(text))
        shards.setdefault(r["shard"], []).append(r)
        sizes[zlib.crc32(rows[r["doc_id"]]["source"].encode()) % OLD_SHARDS] += r["size"]
    mean = sum(r["size"] for r in got) / NEW_SHARDS
    largest = max(r["size"] for r in got)
    assert set(shards) == set(range(NEW_SHARDS))
    for own in shards.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - mean) <= largest / 2
    moved = sum(r["size"] for r in got if zlib.crc32(rows[r["doc_id"]]["source"].encode()) % OLD_SHARDS != r["shard"])
    fewest = sum(max(0, n - mean) for n in sizes.values())
    assert abs(moved - fewest) <= OLD_SHARDS * largest


def test_shards_that_keep_their_rows_are_not_rewritten(spark):
    rows = [(i, "x" * 99, i % 4) for i in range(400)] + [(i, "x" * 99, 3) for i in range(400, 500)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, at INT")
    folder = new_folder(spark)
    capacities = {0: 10_000, 1: 10_000, 2: 10_000, 3: 10_000, 4: 10_000}
    out = reshard.reshard(docs, F.col("at"), range(4), capacities, folder)
    sizes = {r["shard"]: r["count"] for r in out.groupBy("shard").count().collect()}
    assert sizes == {0: 100, 1: 100, 2: 100, 3: 100, 4: 100}
    written = spark.read.parquet(f"{folder}/shards")
    assert {r["shard"] for r in written.select("shard").distinct().collect()} == {3, 4}
    assert out.filter("shard = 4 AND old <> 3").count() == 0


def test_odd_rows(spark):
    docs = with_clashes(spark.createDataFrame(odd_rows(), DOCS))
    old = F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(3))
    out = reshard.reshard(docs, old, range(3), 4, new_folder(spark))
    assert out.count() == len(odd_rows())
    slots = reshard.with_slots(out.select("doc_id", "shard", "place")).collect()
    by_shard: dict[int, list] = {}
    for r in slots:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert len(slots) == len(odd_rows())
    assert reshard.reshard(docs.limit(0), old, range(3), 4, new_folder(spark)).count() == 0


def test_one_document_of_almost_all_bytes(spark):
    rows = [(0, "x" * 100_000)] + [(i, "y") for i in range(1, 50)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    out = reshard.reshard(docs, F.lit(0), range(1), 3, new_folder(spark))
    assert sorted(r["doc_id"] for r in out.collect()) == list(range(50))
