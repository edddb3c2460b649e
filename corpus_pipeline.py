"""The corpus pipeline: documents through five stages, each written and read again.

Each stage takes documents (doc_id, text, lang, source, n_chars, and any further columns,
whatever their names) and all but the last give back the same columns. No stage fails on
a NULL in any column, on empty or very long texts or on an empty table, which stays empty;
what each does with them says its docstring.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from probity.llm import contamination, jaccard, packing, secrets, toxicity
from probity.llm.scratch import importable, new_folder, saved

#: Documents with at least this score are rejected.
TOXIC_FROM = 0.3
VOCABULARY, END_ID, CAPACITY = "byte_bpe_50k.json", 2, 1024
#: What a secret is replaced by.
MASK = "[SECRET]"


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below TOXIC_FROM, learnt from all labels of ``labels``.

    A NULL or empty text has the rate of the examples without words, so it stays unless
    most of those are toxic. Repeated rows have the same score and stay or go together.
    Labels of a NULL doc_id aren't learnt; documents with one are scored like others.
    """
    importable(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels, F.lit(True), new_folder(spark))
    return docs.filter(toxicity.only_score(F.col("text"), model) < TOXIC_FROM)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row of the least doc_id, then of the least hash of its text.

    Copies link at a Jaccard similarity of 0.8 over shingles of five words, and groups are
    what links connect. Of rows of one doc_id and text one stays. A NULL doc_id comes
    after all others. Rows of a NULL, empty or blank text are no copies and all stay.
    """
    importable(spark)
    return jaccard.one_of_each(docs, jaccard.Likeness(words=5, num=80, den=100))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any item of ``benchmark``, up to eight edits in a hundred characters.

    A NULL or empty text has no item and stays; so does every row if the benchmark is
    empty. Items of a NULL item_id count, NULL and empty items don't. Repeated rows stay or go together.
    """
    importable(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination.without_contamination(docs, benchmark)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with MASK in place of every secret and n_chars counted anew where there was one.

    A NULL or empty text stays as it is; each of repeated rows is masked.
    """
    return secrets.masked(docs, f"{new_folder(spark)}/ledger", "doc_id", MASK)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents' tokens, each in its place in a sequence of CAPACITY at most.

    A NULL or empty text is its end token alone. Repeated rows are packed each; a NULL
    doc_id stays NULL.
    """
    importable(spark)
    return packing.pack(docs, public_tokenizers.path(VOCABULARY), END_ID, CAPACITY, special=True)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_copies", keep_one_of_near_copies),
    ("decontamination", drop_benchmark),
    ("secrets", mask_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_folder(spark)
    for number, (name, stage) in enumerate(STAGES):
        docs = saved(stage(spark, docs, sf_dir), folder, f"{number}_{name}")
    return docs


ORACLE_SQL = None
