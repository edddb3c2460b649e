"""The suffix tree against one built of dictionaries, its probabilities, and odd rows."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from texts import DOCS, odd_rows, with_clashes

from probity.llm import suffix_tree

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER)), None]


class Tree:
    """The same tree as dictionaries; the start is the symbol 0, the end None."""

    def __init__(self, texts, least=suffix_tree.LEAST_GAIN):
        self.count, self.after = Counter(), defaultdict(Counter)
        for text in texts:
            line = [0, 0, *tokens(text)]
            for c, b, a in zip(line, line[1:], line[2:], strict=False):
                self.count[a] += 1
                self.after[b,][a] += 1
                self.after[c, b][a] += 1
        self.n, self.kinds = sum(self.count.values()), len(self.count)
        self.states = set()
        for length in (1, 2):  # a state's parent must be known before it
            self.states |= {s for s in self.after if len(s) == length and self._gain(s) > least}

    def root(self, a):
        return (self.count[a] + 1) / (self.n + self.kinds + 1)

    def parent(self, s, a):
        return self.p(s[1:], a) if len(s) > 1 else self.root(a)

    def _gain(self, s):
        after, total = self.after[s], sum(self.after[s].values())
        if total < 2:
            return -1
        gain = 0
        for a, n in after.items():
            left, up = len(after) - (n == 1), self.parent(s, a)
            gain += n * math.log((n - 1 + left * up) / (total - 1 + left) / up)
        return gain

    def state(self, s):
        return s if s in self.states else self.state(s[1:]) if s else ()

    def p(self, s, a):
        s = self.state(s)
        if not s:
            return self.root(a)
        after = self.after[s]
        return (after[a] + len(after) * self.parent(s, a)) / (sum(after.values()) + len(after))

    def score(self, text):
        line, total, used = [0, 0, *tokens(text)], 0.0, [0, 0, 0]
        for c, b, a in zip(line, line[1:], line[2:], strict=False):
            total += math.log10(self.p((c, b), a))
            used[len(self.state((c, b)))] += 1
        base = sum(math.log10(self.root(a)) for a in line[2:])
        return len(line) - 2, sum(a in self.count for a in line[2:]), self.n, base, total, used[1], used[2]


def some_texts(seed=3, n=80):
    draw = random.Random(seed)
    words = ["the", "The", "a", "of", "cat", "dog", "über", *[f"w{k}" for k in range(40)]]
    lines = [" ".join(draw.choices(words, k=9)) for _ in range(12)]
    texts = []
    for _ in range(n):
        own = [draw.choice(lines) if draw.random() < 0.5 else " ".join(draw.choices(words, k=draw.randint(0, 12)))]
        texts.append(draw.choice([" ", "\n", "  \t"]).join(own * draw.randint(1, 3)))
    return texts


def compare(found, given, learnt):
    """All rows, whatever their order, against the dictionaries' tree."""
    tree = Tree([text for i, text in given if learnt(i)])
    want = sorted(((i, learnt(i), *tree.score(text)) for i, text in given), key=str)
    got = sorted((tuple(r) for r in found.collect()), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[7:] for g in got] == [w[7:] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9)
        assert g[6] == pytest.approx(w[6], abs=1e-5)
    return tree


@pytest.mark.parametrize(
    "sizes", [{}, {"chunk": 60, "bucket": 100, "heavy": 10_000, "part": 30}, {"chunk": 90, "bucket": 150, "heavy": 40, "part": 50}]
)
def test_scores_are_those_of_the_dictionaries(spark, rows, tmp_path, sizes):
    given = list(enumerate(some_texts()))
    docs = rows("doc_id LONG, text STRING", given).repartition(3)
    found = suffix_tree.score(docs, F.col("doc_id") % 4 != 1, str(tmp_path / "t"), **sizes)
    tree = compare(found, given, lambda i: i % 4 != 1)
    assert {len(s) for s in tree.states} == {1, 2}
    # the distribution in any state sums to one, with what no training text has
    for s in [(), *tree.states]:
        assert sum(tree.p(s, a) for a in [*tree.count, "never seen"]) == pytest.approx(1)


def test_tree_of_one_bucket_is_a_sum_over_contexts():
    n = np.array([3, 1, 0, 2])
    p, state = suffix_tree.grown(n, np.array([0, 0, 0, 1]), np.full(4, 0.01), 2.0)
    assert state.tolist() == [True] * 4
    assert p[0] == pytest.approx((3 + 2 * 0.01) / 6) and p[2] == pytest.approx(2 * 0.01 / 6)
    assert p[3] == pytest.approx((2 + 0.01) / 3)


def test_slices_of_a_bucket_change_nothing(monkeypatch):
    rng = np.random.default_rng(4)
    before, second, token = rng.integers(0, 9, (3, 4000)).astype(np.int32)
    known, learn = rng.integers(1, 50, 9), rng.random(4000) < 0.8
    whole = suffix_tree.tree(before, second, token, known, learn, 4000, 9, 2.0)
    monkeypatch.setattr(suffix_tree, "TOGETHER", 300)
    sliced = suffix_tree.tree(before, second, token, known, learn, 4000, 9, 2.0)
    assert (whole[0] == sliced[0]).all() and (whole[1] == sliced[1]).all()


def test_odd_rows(spark, rows, tmp_path):
    docs = with_clashes(rows(DOCS, odd_rows()))
    given = [(r[0], r[1]) for r in odd_rows()]
    compare(suffix_tree.score(docs, F.col("doc_id") > 2, str(tmp_path / "t")), given, lambda i: (i or 0) > 2)


def test_empty_tables_and_nothing_to_learn_from(spark, rows, tmp_path):
    empty = rows("doc_id LONG, text STRING", [])
    assert suffix_tree.score(empty, F.lit(True), str(tmp_path / "a")).collect() == []
    given = [(1, "a b"), (2, None)]
    docs = rows("doc_id LONG, text STRING", given)
    compare(suffix_tree.score(docs, F.lit(None).cast("boolean"), str(tmp_path / "b")), given, lambda i: False)


def test_query_on_held_out_rows(spark, sf_dir):
    from zlib import crc32

    from probity.llm.queries import op12_suffix_tree

    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    held = {i: crc32(str(i).encode()) % 7 == 2 for i, _ in docs}
    tree = Tree([t for i, t in docs if not held[i]])
    found = {r["doc_id"]: r for r in op12_suffix_tree(spark, sf_dir).collect()}
    assert found.keys() == held.keys()
    for i, text in docs:
        n, known, total, base, own, *_ = tree.score(text)
        r = found[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] == pytest.approx(own, abs=1e-5)
    outside = [r for r in found.values() if r["held_out"]]
    assert sum(r["score"] for r in outside) > sum(r["base_score"] for r in outside)
