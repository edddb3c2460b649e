"""The stages on planted cases, and the whole run."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from texts import DOCS, odd_rows, with_clashes
from tokenizers import Tokenizer

import corpus_pipeline
from probity.llm import contamination, secrets

FILTERS = corpus_pipeline.STAGES[:-1]


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_stages_are_named_and_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity",
        "near_copies",
        "decontamination",
        "secrets",
        "packing",
    ]


@pytest.mark.parametrize(("name", "stage"), FILTERS)
def test_stages_return_the_columns_of_documents(spark, docs, sf_dir, name, stage):
    out = stage(spark, docs, sf_dir)
    assert out.schema.names == docs.schema.names
    assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    assert 0 < out.count() <= docs.count()


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_stages_stand_odd_rows_and_none(spark, sf_dir, name, stage):
    odd = with_clashes(spark.createDataFrame(odd_rows(), DOCS))
    assert stage(spark, odd, sf_dir).count() >= 11
    assert stage(spark, odd.limit(0), sf_dir).count() == 0


def test_planted_cases(spark, docs, sf_dir):
    rng = random.Random(11)
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first()["text"]
    clean = [words(rng, 120) for _ in range(20)]
    base = words(rng, 200)
    near = base.split()
    near[50], near[120] = "changed", "too"
    planted = [
        *[(10_000 + k, t) for k, t in enumerate(clean)],
        (20_000, base),
        (20_001, base),
        (20_002, " ".join(near)),
        (20_003, words(rng, 60) + " " + item + " " + words(rng, 60)),
        (20_004, words(rng, 30) + " such scum and an idiot, worthless trash " + words(rng, 30)),
        (20_005, words(rng, 40) + " password = hunter2hunter2 " + words(rng, 40)),
    ]
    rows = [(i, t, "en", "src", len(t)) for i, t in planted]
    now = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    left = {}
    for name, stage in FILTERS:
        now = stage(spark, now, sf_dir)
        left[name] = {r["doc_id"]: r for r in now.filter("doc_id >= 10000").collect()}
    assert 20_004 not in left["toxicity"]
    assert {20_000, 20_001, 20_002, 20_003, 20_005} <= set(left["toxicity"])
    assert 20_000 in left["near_copies"]
    assert not {20_001, 20_002} & set(left["near_copies"])
    assert 20_003 in left["near_copies"]
    assert 20_003 not in left["decontamination"]
    masked = left["secrets"][20_005]
    assert "hunter2" not in masked["text"]
    assert corpus_pipeline.MASK in masked["text"]
    assert masked["n_chars"] == len(masked["text"])
    assert set(range(10_000, 10_020)) | {20_000, 20_005} == set(left["secrets"])
    for k, text in enumerate(clean):
        assert left["secrets"][10_000 + k]["text"] == text


def test_run_packs_what_the_filters_leave(spark, docs, sf_dir):
    now = docs
    for _, stage in FILTERS:
        now = stage(spark, now, sf_dir)
    texts = dict(now.select("doc_id", "text").collect())
    find = contamination.Finder(
        [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()],
        contamination.RATE,
    )
    assert not any(find(t) for t in texts.values())
    scanned = secrets.scan_versions(now, f"{corpus_pipeline.new_folder(spark)}/l", "doc_id")
    assert scanned.filter("size(found) > 0").count() == 0
    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    got: dict[int, list] = {}
    for r in corpus_pipeline.run(spark, sf_dir).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert set(got) == set(texts)
    for doc_id, own in got.items():
        ids = [*tokenizer.encode(texts[doc_id], add_special_tokens=False).ids, corpus_pipeline.END_ID]
        own.sort(key=lambda r: r["piece"])
        assert sum(r["length"] for r in own) == len(ids)
        for r in own:
            part = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()
            assert zlib.crc32(part) == r["ids_crc32"]
