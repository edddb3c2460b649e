"""Moving documents between shards so that the fewest bytes move.

From the old shards' sizes and the new capacities a minimum-cost flow says how
many bytes go from which shard to which; staying costs nothing. Within a shard,
documents lie by a hash of their id, and each transfer is a range of it: its
ends are found by histograms that are refined where a cut falls, so neither the
driver nor a task ever holds more of a shard than one bucket's sums.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from probity.llm.scratch import saved

#: Bits of the hash that each histogram refines.
BITS = 10
#: Bits of the place by which the rows of a shard are numbered.
SLOT_BITS = 14
#: No document lies behind it but one of the last place of all.
END = (1 << 63) - 1


def minimum_cost_flow(
    supply: Sequence[int], capacity: Sequence[int], cost: Callable[[int, int], int]
) -> dict[tuple[int, int], int]:
    """Amounts from each source to each sink at the least total cost.

    Successive shortest paths with potentials. The capacities must hold the supply.
    """
    if sum(capacity) < sum(supply):
        raise ValueError("the new shards hold less than the old ones")
    n, m = len(supply), len(capacity)
    flow: dict[tuple[int, int], int] = {}
    left, room = list(supply), list(capacity)
    potential = [0] * (n + m)
    for source in range(n):
        while left[source]:
            distance, previous = [None] * (n + m), [-1] * (n + m)
            heap = [(0, source)]
            distance[source] = 0
            done = [False] * (n + m)
            while heap:
                d, u = heapq.heappop(heap)
                if done[u]:
                    continue
                done[u] = True
                if u < n:
                    steps = [(n + j, cost(u, j)) for j in range(m)]
                else:
                    steps = [(i, -cost(i, u - n)) for i in range(n) if flow.get((i, u - n))]
                for v, price in steps:
                    new = d + price + potential[u] - potential[v]
                    if distance[v] is None or new < distance[v]:
                        distance[v], previous[v] = new, u
                        heapq.heappush(heap, (new, v))
            reached = max(d for d in distance if d is not None)
            potential = [
                p + (reached if d is None else d) for p, d in zip(potential, distance, strict=True)
            ]
            end = min(
                (j for j in range(m) if room[j] and distance[n + j] is not None),
                key=lambda j: potential[n + j] - potential[source],
            )
            path = [n + end]
            while path[-1] != source:
                path.append(previous[path[-1]])
            path.reverse()
            amount = min(left[source], room[end])
            for a, b in zip(path, path[1:], strict=False):
                if a >= n:
                    amount = min(amount, flow[b, a - n])
            for a, b in zip(path, path[1:], strict=False):
                key, sign = ((a, b - n), 1) if a < n else ((b, a - n), -1)
                flow[key] = flow.get(key, 0) + sign * amount
            left[source] -= amount
            room[end] -= amount
    return {key: amount for key, amount in flow.items() if amount}


@dataclass(frozen=True)
class Segment:
    """Documents of ``old`` with a hash place below ``upto`` (None: the rest) go to ``new``."""

    old: int
    new: int
    upto: int | None


def place_of(doc_id: Column) -> Column:
    """Where a document lies in its shard."""
    return F.xxhash64(doc_id)


def _find_cuts(sizes: DataFrame, cuts: Sequence[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """For each cut (old shard, bytes before it): nearby places, each with the bytes below it.

    ``sizes`` has old, place, size. Histograms of the place's next bits, where the
    cuts fall only, lead to one place on either side.
    """
    spark = sizes.sparkSession
    unsigned = F.col("place").bitwiseXOR(F.lit(-(1 << 63)))  # in the order of the places
    state = [(old, 0, 0, target) for old, target in cuts]  # prefix, bytes below it, target
    for level in range(-(-64 // BITS)):
        used = level * BITS
        bits = min(BITS, 64 - used)
        wanted = spark.createDataFrame(
            sorted({(old, prefix) for old, prefix, _, _ in state}), "old LONG, prefix LONG"
        )
        prefix = F.shiftrightunsigned(unsigned, 64 - used) if used else F.lit(0).cast("long")
        bucket = F.shiftrightunsigned(unsigned, 64 - used - bits).bitwiseAND((1 << bits) - 1)
        counted = (
            sizes.select("old", prefix.alias("prefix"), bucket.alias("bucket"), "size", "place")
            .join(F.broadcast(wanted), ["old", "prefix"])
            .groupBy("old", "prefix", "bucket")
            .agg(
                F.sum("size").alias("size"),
                F.min("place").alias("low"),
                F.max("place").alias("high"),
            )
            .collect()  # 2 ** BITS rows a cut at most
        )
        of: dict[tuple[int, int], list] = {}
        for r in sorted(counted, key=lambda r: r["bucket"]):
            of.setdefault((r["old"], r["prefix"]), []).append(r)
        after, near, single = [], [], True
        for old, head, below, target in state:
            rows = of[old, head]
            chosen, at = rows[-1], below
            for r in rows:
                if at + r["size"] >= target or r is rows[-1]:
                    chosen = r
                    break
                at += r["size"]
            following = [r["low"] for r in rows if r["bucket"] > chosen["bucket"]]
            near.append([(chosen["low"], at), (following[0] if following else None, at + chosen["size"])])
            after.append((old, (head << bits) | chosen["bucket"], at, target))
            single &= chosen["low"] == chosen["high"]
        if level:
            # a bucket that was last in its prefix ends where the coarser one did
            near = [
                [n[0], (n[1][0] if n[1][0] is not None else o[1][0], n[1][1])]
                for n, o in zip(near, found, strict=True)
            ]
        found, state = near, after
        if single:
            break
    return found


def plan_segments(
    sizes: DataFrame,
    old: Sequence[int],
    capacities: Mapping[int, int] | int,
    cost: Callable[[int, int], int] = lambda a, b: int(a != b),
) -> tuple[list[Segment], dict[tuple[int, int], int]]:
    """The ranges to move, and the flow they follow.

    ``sizes`` has old (a shard number, of ``old``), place and size. ``capacities``
    is a size per new shard, or their number, for equal ones.
    """
    sums = sizes.groupBy("old").agg(F.sum("size").alias("size")).collect()  # a row per old shard
    held = {s: 0 for s in old} | {r["old"]: r["size"] for r in sums}
    total = sum(held.values())
    if isinstance(capacities, int):
        capacities = {
            j: total * (j + 1) // capacities - total * j // capacities for j in range(capacities)
        }
    olds, news = sorted(held), sorted(capacities)
    flow = minimum_cost_flow(
        [held[s] for s in olds],
        [capacities[s] for s in news],
        lambda i, j: cost(olds[i], news[j]),
    )
    moves = {(olds[i], news[j]): n for (i, j), n in flow.items()}
    chains, cuts = {}, []
    for s in olds:
        own = sorted((k for k in moves if k[0] == s), key=lambda k: (k[1] != s, k[1]))
        chains[s] = [k[1] for k in own]
        at = 0
        for k in own[:-1]:
            at += moves[k]
            cuts.append((s, at))
    near = _find_cuts(sizes, cuts) if cuts else []
    pick = _even_cuts(cuts, near, chains, held, capacities)
    segments, k = [], 0
    for s in olds:
        for j in chains[s][:-1]:
            segments.append(Segment(s, j, near[k][pick[k]][0]))
            k += 1
        segments.append(Segment(s, chains[s][-1] if chains[s] else news[0], None))
    return segments, moves


def _even_cuts(cuts, near, chains, held, capacities) -> list[int]:
    """For each cut the side of its document that leaves the new shards nearest to their capacities."""

    def off(pick: Sequence[int]) -> int:
        got, k = dict.fromkeys(capacities, 0), 0
        for s, chain in chains.items():
            at = 0
            for j in chain[:-1]:
                end = near[k][pick[k]][1]
                got[j] += end - at
                at, k = end, k + 1
            if chain:
                got[chain[-1]] += held[s] - at
        return sum((got[j] - capacities[j]) ** 2 for j in capacities)

    pick = [int(abs(n[1][1] - t) < abs(n[0][1] - t)) for (_, t), n in zip(cuts, near, strict=True)]
    best, better = off(pick), True
    while better:
        better = False
        for k in range(len(pick)):
            other = [*pick[:k], 1 - pick[k], *pick[k + 1 :]]
            if (now := off(other)) < best:
                pick, best, better = other, now, True
    return pick


def new_shard(docs: DataFrame, segments: Sequence[Segment]) -> DataFrame:
    """Adds ``shard`` to rows with old and place. The broadcast has a row per old shard."""
    table: dict[int, list[Segment]] = {}
    for s in segments:
        table.setdefault(s.old, []).append(s)
    rows = [
        (old, [END if s.upto is None else s.upto for s in own[:-1]], [s.new for s in own])
        for old, own in table.items()
    ]
    plan = docs.sparkSession.createDataFrame(rows, "old LONG, __ends ARRAY<LONG>, __news ARRAY<INT>")
    passed = F.size(F.filter("__ends", lambda end: end <= F.col("place")))
    located = docs.join(F.broadcast(plan), "old").withColumn("shard", F.get("__news", passed))
    return located.drop("__ends", "__news")


def reshard(
    docs: DataFrame,
    old: Column,
    shards: Sequence[int],
    capacities: Mapping[int, int] | int,
    folder: str,
    size: Column | None = None,
    key: str = "doc_id",
) -> DataFrame:
    """Write ``docs`` into new shards below ``folder`` and return the written table.

    ``old`` gives the shard (of ``shards``) in which each row lies. Only shards
    that give or get rows are rewritten; rows of the others are returned from
    ``docs``. The columns old, place and shard are added; columns of these names
    are replaced. Equal keys stay together, NULL ones too. ``size`` is the bytes of the text plus
    one if not given; a NULL text has none. An empty table gives no rows.
    """
    taken = [c for c in docs.columns if c not in ("old", "place", "shard")]
    placed = docs.select(*taken, old.cast("long").alias("old"), place_of(F.col(key)).alias("place"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1 if size is None else size
    sizes = saved(placed.select("old", "place", size.alias("size")), f"{folder}/plan", "sizes")
    segments, moves = plan_segments(sizes, shards, capacities)
    changed = {s for a, b in moves if a != b for s in (a, b)}
    located = new_shard(placed, segments)
    rewritten = located.filter(F.col("shard").isin(*changed)) if changed else located.limit(0)
    (
        rewritten.repartitionByRange("shard", "place")
        .sortWithinPartitions("shard", "place", key)
        .write.partitionBy("shard")
        .parquet(f"{folder}/shards")
    )
    schema = located.schema
    back = docs.sparkSession.read.schema(schema).parquet(f"{folder}/shards").select(*schema.names)
    untouched = sorted(set(shards) - changed)
    if not untouched:
        return back
    return back.union(located.filter(F.col("shard").isin(*untouched)))


def with_slots(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """Adds ``slot``, the place from 0 on in each shard, to rows with shard, place and ``key``.

    Rows are counted per shard and bucket of places, and numbered within a bucket,
    so no task needs a whole shard.
    """
    rows = rows.withColumn("__bucket", F.shiftright("place", 64 - SLOT_BITS))
    before = Window.partitionBy("shard").orderBy("__bucket")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("shard", "__bucket")
        .agg(F.count("*").alias("__n"))
        .select("shard", "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    )
    inner = Window.partitionBy("shard", "__bucket").orderBy("place", key)
    return (
        rows.withColumn("__within", F.row_number().over(inner) - 1)
        .join(starts, ["shard", "__bucket"])
        .withColumn("slot", F.col("__base") + F.col("__within"))
        .drop("__base", "__within", "__bucket")
    )
