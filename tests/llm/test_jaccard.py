"""The Jaccard join against all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from texts import DOCS, odd_rows, with_clashes

from probity.llm import jaccard
from probity.llm.components import components
from probity.llm.scratch import new_folder, saved


def set_of(text: str | None, size: int) -> frozenset:
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def by_all_pairs(rows: list[tuple], how: jaccard.Likeness) -> dict:
    """Set size and least reachable id of each id, by comparing every pair."""
    sets = {i: set_of(t, how.words) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if both and both * how.den >= how.num * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


def family(rng: random.Random, words: int, copies: int, most: float) -> list[str]:
    """A text and copies of it with ever more words replaced."""
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = [" ".join(base)]
    for k in range(copies):
        own = list(base)
        for _ in range(int(words * most * k / max(copies, 1))):
            own[rng.randrange(words)] = f"z{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("how", [jaccard.Likeness(4, 85, 100), jaccard.Likeness(), jaccard.Likeness(1, 1, 2)])
def test_components_are_those_of_all_pairs(spark, how):
    rng = random.Random(how.words)
    texts = []
    for words in (1, 3, 6, 8, 15, 40, 120, 700):
        texts += family(rng, words, 14, 0.05)
        texts += family(rng, words, 6, 0.3)
    passage = " ".join(f"p{k}" for k in range(60))
    texts += [f"{' '.join(f'q{rng.randrange(9**6)}' for _ in range(60))} {passage}" for _ in range(30)]
    texts += [texts[20]] * 5 + ["", None, " \n"]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(6)
    got = {r["doc_id"]: (r["n"], r["component"]) for r in jaccard.jaccard_components(docs, how).collect()}
    assert got == by_all_pairs(rows, how)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 400), st.integers(0, 80), st.integers(0, 80), st.integers(0, 10**6), st.booleans())
def test_linked_sets_share_a_kept_piece_and_have_near_sketches(size, less, more, seed, common):
    how = jaccard.Likeness(4, 85, 100)
    rng = np.random.default_rng(seed)
    pool = rng.integers(0, 1 << 63, size + more, np.uint64) * np.uint64(2)
    one = np.unique(pool[:size])
    two = np.unique(pool[min(less, size - 1) :])
    both = len(np.intersect1d(one, two))
    union = len(one) + len(two) - both
    if 100 * both < 85 * union or both == union:
        return
    weights = np.full(jaccard.COUNTERS, jaccard.WEIGHT)
    if common:
        weights[(pool[::3] >> np.uint64(40)).astype(int) % jaccard.COUNTERS] = 1
    counts = np.array([len(one), len(two)])
    keys, held = jaccard.piece_keys(np.concatenate([one, two]), counts, how, weights)
    assert set(keys[: held[0]].tolist()) & set(keys[held[0] :].tolist())
    sketches = jaccard.parity_sketches(np.concatenate([one, two]), counts)
    bits = sum(bin(int(a) ^ int(b) & (1 << 64) - 1).count("1") for a, b in sketches.astype(np.uint64).T.tolist())
    assert bits <= union - both


def test_components_of_links(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    links += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(70)]
    root: dict[int, int] = {}

    def find(x):
        root.setdefault(x, x)
        return x if root[x] == x else find(root[x])

    for a, b in links:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    frame = spark.createDataFrame(links, "a LONG, b LONG")
    got = {r["node"]: r["component"] for r in components(frame).collect()}
    assert got == {x: find(x) for x in root}
    assert components(frame.limit(0)).count() == 0


def test_odd_rows(spark):
    docs = with_clashes(spark.createDataFrame(odd_rows(), DOCS))
    found = jaccard.jaccard_components(docs).collect()
    assert len(found) == len(odd_rows())
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[11]["component"] == by_id[10]["component"] == 10
    assert [by_id[k]["component"] for k in range(4)] == [0, 1, 2, 3]
    assert [by_id[k]["n"] for k in range(6)] == [0, 0, 0, 0, 1, 1]
    left = jaccard.one_of_each(docs)
    assert left.columns == docs.columns
    assert sorted([r["doc_id"] if r["doc_id"] is not None else -1 for r in left.collect()]) == [-1, *range(11)]
    assert jaccard.one_of_each(docs.limit(0)).count() == 0
    assert jaccard.jaccard_components(docs.limit(0)).count() == 0


def test_one_of_each_component_stays(spark):
    rows = [(i, f"{'common words that all texts share here ' * 9} {i % 3} {i % 3} {i % 3}") for i in range(30)]
    rows += [(None, rows[0][1]), (5, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    kept = jaccard.one_of_each(docs, jaccard.Likeness(5, 99, 100)).collect()
    assert sorted(r["doc_id"] for r in kept) == [0, 1, 2]


def test_one_of_each_gives_back_columns_of_any_name(spark):
    docs = spark.createDataFrame(
        [(1, "one two three four five six", "a", "b"), (2, "one two three four five six", "c", "d")],
        "doc_id LONG, text STRING, __hash STRING, text_hash STRING",
    )
    assert [tuple(r) for r in jaccard.one_of_each(docs).collect()] == [(1, "one two three four five six", "a", "b")]


def test_hot_pieces_in_blocks_give_the_same_components(spark, monkeypatch):
    """A template that a third of the rows share, without links; compared in blocks, and by blocks alone."""
    how = jaccard.Likeness(words=3, num=60, den=100)
    rng = random.Random(21)
    template = " ".join(f"t{k}" for k in range(40))
    texts = [f"{template} {' '.join(f'own{rng.randrange(9**6)}' for _ in range(rng.choice([20, 40])))}" for _ in range(40)]
    for words in (20, 60):
        texts += family(rng, words, 20, 0.1)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(4)
    want = by_all_pairs(rows, how)
    monkeypatch.setattr(jaccard, "HOT_CLASSES", 5)
    for rounds in (jaccard.STAR_ROUNDS, 0):
        monkeypatch.setattr(jaccard, "STAR_ROUNDS", rounds)
        got = {r["doc_id"]: (r["n"], r["component"]) for r in jaccard.jaccard_components(docs, how).collect()}
        assert got == want


def test_keys_are_dealt_out_once(spark):
    keyed = spark.range(400).selectExpr("id AS class", "array(id, id % 7 + 1000, id % 50 + 2000) AS keys")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        held = jaccard._held(saved(keyed.union(keyed), new_folder(spark), "keys"))
        got = {(r["class"], r["key"]) for r in held.collect()}
        plan = held._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {(k, key) for k in range(400) for key in (k % 7 + 1000, k % 50 + 2000)}
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(key" in line]
    assert len([line for line in exchanges if "Reused" not in line]) == 1
