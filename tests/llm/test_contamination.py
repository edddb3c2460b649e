"""Edit matching against dynamic programming."""

from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from texts import DOCS, odd_rows, with_clashes

from probity.llm import contamination
from probity.llm.queries import QUERIES

ITEM = "The quick brown fox jumps over the lazy dog while seven wizards quietly boxed five dozen jugs"


def least(item: str, text: str, anywhere: bool) -> int:
    """The edit distance of the item to the text, or to any stretch of it."""
    row = [0 if anywhere else j for j in range(len(text) + 1)]
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row) if anywhere else row[-1]


@settings(max_examples=300, deadline=None)
@given(st.text("abc", min_size=1, max_size=12), st.text("abc", max_size=20))
def test_bit_parallel_distances(item, text):
    letters = contamination.letters_of(item)
    distance, end = contamination.nearest(letters, len(item), text)
    assert distance == least(item, text, anywhere=True)
    assert distance == min(least(item, text[a:end], anywhere=False) for a in range(end + 1))
    assert contamination.whole_distance(letters, len(item), text) == least(item, text, anywhere=False)


def edited(text: str, edits: int, rng: random.Random) -> str:
    letters = list(text)
    for _ in range(edits):
        at = rng.randrange(len(letters))
        how = rng.randrange(3)
        if how == 0:
            letters[at] = "#"
        elif how == 1:
            del letters[at]
        else:
            letters.insert(at, "#")
    return "".join(letters)


def test_every_place_within_the_budget_is_found_and_no_other():
    rng = random.Random(3)
    find = contamination.Finder([(7, ITEM)], 0.1)
    budget = int(len(ITEM) * 0.1)
    own = contamination.normalised(ITEM)
    for trial in range(300):
        inner = edited(ITEM, trial % 20, rng)
        text = "pack my box with " + inner + " and more words"
        got = find(text)
        distance = least(own, contamination.normalised(text), anywhere=True)
        assert bool(got) == (distance <= budget)
        if got:
            [(item_id, found, start, end)] = got
            assert (item_id, found) == (7, distance)
            assert least(own, contamination.normalised(text)[start:end], anywhere=False) == distance


def test_case_and_white_space_do_not_count():
    find = contamination.Finder([(1, ITEM)], 0.05)
    assert find("x\n\n" + ITEM.upper().replace(" ", " \t\n"))[0][:2] == (1, 0)
    assert find(ITEM[: len(ITEM) // 2]) == []


def test_query_equals_a_search_in_each_document(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    whole = {
        (d["doc_id"], i["item_id"])
        for d in docs
        for i in items
        if contamination.normalised(i["text"]) in contamination.normalised(d["text"])
    }
    got = QUERIES["op5_decontamination"](spark, sf_dir).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got if r["distance"] == 0} == whole
    assert whole


def test_blocks_give_what_one_block_gives(spark, monkeypatch, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    once = sorted(map(tuple, contamination.contamination(docs, items).collect()))
    monkeypatch.setattr(contamination, "BLOCK_CHARS", 2000)
    assert sorted(map(tuple, contamination.contamination(docs, items).collect())) == once


def test_odd_rows(spark):
    docs = with_clashes(spark.createDataFrame([*odd_rows(), (99, ITEM, None, None, None)], DOCS))
    items = spark.createDataFrame(
        [(1, ITEM, "x"), (1, ITEM, "x"), (2, None, "x"), (3, "", "x"), (None, "short", "x")],
        "item_id LONG, text STRING, doc_id STRING",
    )
    got = contamination.contamination(docs, items).collect()
    assert [(r["doc_id"], r["item_id"], r["distance"]) for r in got] == [(99, 1, 0)]
    left = contamination.without_contamination(docs, items)
    assert left.columns == docs.columns
    assert left.count() == len(odd_rows())
    assert contamination.without_contamination(docs, items.limit(0)).count() == docs.count()
    assert contamination.contamination(docs.limit(0), items).count() == 0


def test_short_items_and_items_without_an_id_reject_documents(spark):
    items = spark.createDataFrame(
        [(1, "What is the capital of Peru?"), (2, "Why?"), (3, " \n"), (None, "Name the boiling point of tin"), (4, "你好")],
        "item_id LONG, text STRING",
    )
    texts = [
        "so: what is  the capitol of Peru? Lima",
        "they ask why? often",
        "somewhy? not",
        "name the boiling point of tin, please",
        "他说你好吗",
        "nothing here",
        None,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    got = {(r["doc_id"], r["item_id"], r["distance"]) for r in contamination.contamination(docs, items).collect()}
    assert got == {(0, 1, 1), (1, 2, 0), (3, None, 0), (4, 4, 0)}
    left = contamination.without_contamination(docs, items).collect()
    assert {r["doc_id"] for r in left} == {2, 5, 6}


def test_every_place_of_a_short_item_is_found():
    rng = random.Random(4)
    item = "who wrote the odyssey in greek"
    find = contamination.Finder([(7, item)], contamination.RATE)
    for trial in range(200):
        text = "zz " + edited(item, trial % 6, rng) + " qq"
        distance = least(item, text, anywhere=True)
        assert [h[1] for h in find(text)] == ([distance] if distance <= 2 else [])
