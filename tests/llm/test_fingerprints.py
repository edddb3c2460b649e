"""One-permutation MinHash against exact sets and a plain version."""

from __future__ import annotations

import hashlib
import re

import numpy as np
from texts import DOCS, ODD, odd_rows, with_clashes

from probity.llm import fingerprints, shingles
from probity.llm.queries import QUERIES


def words_of(text: str) -> list[str]:
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def set_of(text: str, size: int = 5) -> set:
    w = words_of(text)
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0


def test_shingle_hashes_tell_shingles_apart():
    texts = [t or "" for t in ODD] + ["A b C d E f", "a  b\nc\td e F"]
    for size in (1, 4, 5):
        hashes, counts = shingles.shingle_hashes([t.encode() for t in texts], size)
        lists = [
            [tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))] if (w := words_of(t)) else []
            for t in texts
        ]
        assert counts.tolist() == [len(own) for own in lists]
        flat = [s for own in lists for s in own]
        assert len(set(flat)) == len(set(hashes.tolist())) == len(set(zip(flat, hashes.tolist(), strict=True)))


def test_plain_version_gives_the_same_fingerprint():
    text = b"one two three four five six seven eight nine"
    hashes, _ = shingles.shingle_hashes([text], 5)
    bins = [None] * 64
    for h in hashes.tolist():
        if bins[h % 64] is None or h // 64 < bins[h % 64]:
            bins[h % 64] = h // 64
    tries = fingerprints._attempts(64, 4096)
    for k in range(64):
        if bins[k] is None:
            source = next(row[k] for row in tries if hashes.size and row[k] in {h % 64 for h in hashes.tolist()})
            bins[k] = ("from", int(source))
    bins = [bins[b[1]] if isinstance(b, tuple) else b for b in bins]
    low = shingles.mixed(np.array(bins, np.uint64)) & np.uint64(15)
    bits = [int(v) >> j & 1 for v in low for j in range(4)]
    want = np.packbits(np.array(bits, np.uint8), bitorder="little").tobytes()
    assert fingerprints.fingerprints([text], bins=64, bits=4) == [want]


def test_likeness_is_near_the_similarity_of_the_sets(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    rows = sorted(map(tuple, rows), reverse=True)
    got = {r["doc_id"]: r for r in QUERIES["op1_fingerprints"](spark, sf_dir).collect()}
    assert len(got) == len(rows)
    off = []
    for k, (doc_id, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        r = got[doc_id]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        off.append(r["near_edited"] - jaccard(set_of(text), set_of(edited)))
        off.append(r["near_next"] - jaccard(set_of(text), set_of(following)))
        if text == following:
            assert r["near_next"] == 1.0
    assert abs(np.mean(off)) < 0.005
    assert np.sqrt(np.mean(np.square(off))) < 0.04


def test_equal_texts_have_equal_fingerprints_and_empty_ones_are_alike():
    a, b, c, d = fingerprints.fingerprints([b"x y z", b"x y z", b"", b" \n"])
    assert a == b != c == d
    assert fingerprints.likeness([a, c, c], [b, d, a]).tolist() == [1.0, 1.0, 0.0]


def test_odd_rows(spark):
    docs = with_clashes(spark.createDataFrame(odd_rows(), DOCS).repartition(7))
    got = fingerprints.neighbour_fingerprints(docs).collect()
    assert len(got) == len(odd_rows())
    order = sorted(odd_rows(), key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    want = []
    for k, (doc_id, text, *_) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        want.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted([tuple(r)[:3] for r in got], key=key) == sorted(want, key=key)
    assert fingerprints.neighbour_fingerprints(docs.limit(0)).count() == 0
    alone = fingerprints.neighbour_fingerprints(docs.filter("doc_id = 6")).collect()
    assert len(alone) == 1
    assert alone[0]["near_next"] == 1.0
