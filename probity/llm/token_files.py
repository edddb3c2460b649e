"""Token ids in files of fixed-width bit-packed blocks.

Every id takes the bits that the largest id of the vocabulary needs. 64 ids fill
``width`` 64-bit words exactly, so a group of 64 is unpacked by whole columns of
words and any group of a block is found by its number alone. A block is one row
of a Parquet table: whole documents in ascending order, how many ids each has,
how many ids of its file come before it, and the packed words. What precedes a
file is the sum over the files before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from probity.llm.tokens import encoder

GROUP = 64
#: Ids after which a block ends; a longer document has a block of its own size.
BLOCK_IDS = 1 << 16
#: Rows taken from an Arrow batch at once.
ROWS = 200

BLOCK_SCHEMA = (
    "file INT, block INT, first LONG, n_ids LONG, width INT, "
    "doc_ids ARRAY<LONG>, counts ARRAY<LONG>, words BINARY"
)
_BLOCK_ARROW = pa.schema(
    [
        ("file", pa.int32()),
        ("block", pa.int32()),
        ("first", pa.int64()),
        ("n_ids", pa.int64()),
        ("width", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())),
        ("counts", pa.list_(pa.int64())),
        ("words", pa.binary()),
    ]
)
_IDS_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])


def bits_for(vocabulary: int) -> int:
    """The bits of the largest of ``vocabulary`` ids, at least one."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids below 2 ** width as words, the last group filled up with zeros."""
    groups = -(-len(ids) // GROUP)
    table = np.zeros(groups * GROUP, np.uint64)
    table[: len(ids)] = ids
    table = table.reshape(groups, GROUP)
    words = np.zeros((groups, width), "<u8")
    for column in range(GROUP):
        word, shift = divmod(column * width, 64)
        words[:, word] |= table[:, column] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= table[:, column] >> np.uint64(64 - shift)
    return words.tobytes()


def unpack(words: bytes, width: int, start: int, count: int) -> np.ndarray:
    """``count`` ids from ``start`` on; reads the groups that hold them only."""
    first, last = start // GROUP, -(-(start + count) // GROUP)
    size = width * 8
    table = np.frombuffer(words, "<u8", (last - first) * width, first * size)
    table = table.reshape(last - first, width)
    ids = np.empty((last - first, GROUP), "<u4")
    mask = np.uint64((1 << width) - 1)
    for column in range(GROUP):
        word, shift = divmod(column * width, 64)
        value = table[:, word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | (table[:, word + 1] << np.uint64(64 - shift))
        ids[:, column] = value & mask
    return ids.reshape(-1)[start - first * GROUP :][:count]


def _blocks(path: str, end_id: int, special: bool):
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, special)
        width = bits_for(max(encode.tokenizer.get_vocab_size(True), end_id + 1))
        file = TaskContext.get().partitionId()
        block, first, doc_ids, counts, parts, total = 0, 0, [], [], [], 0

        def done() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4")
            row = [file, block, first, total, width, doc_ids, counts, pack(ids, width)]
            arrays = [pa.array([v], f.type) for v, f in zip(row, _BLOCK_ARROW, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, schema=_BLOCK_ARROW)

        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                for doc_id, text in zip(*[c.to_pylist() for c in some.columns], strict=True):
                    ids = encode(text)
                    doc_ids.append(doc_id)
                    counts.append(len(ids) // 4 + 1)
                    parts += [ids, end]
                    total += counts[-1]
                    if total >= BLOCK_IDS:
                        yield done()
                        block, first = block + 1, first + total
                        doc_ids, counts, parts, total = [], [], [], 0
        if doc_ids:
            yield done()

    return write


def write_ids(
    docs: DataFrame, vocabulary: str, folder: str, end_id: int, special: bool = True
) -> None:
    """Write the ids of all ``docs`` (doc_id, text), in ascending doc_id order.

    NULL and empty texts have the end id only; NULL doc_ids come first; rows of
    one doc_id are ordered by text. An empty table gives an empty file. Other
    columns are ignored. The text is shuffled once, by ranges of doc_id.
    """
    (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(_blocks(vocabulary, end_id, special), BLOCK_SCHEMA)
        .write.option("compression", "zstd")
        .parquet(folder)
    )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = unpack(row["words"], row["width"], 0, row["n_ids"])
            ends = np.cumsum(row["counts"])
            starts = ends - row["counts"]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(starts + row["at"], pa.int64()),
                    pa.array([ids[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]),
                ],
                schema=_IDS_ARROW,
            )


def _stored(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(BLOCK_SCHEMA).parquet(folder)


def _placed(spark: SparkSession, folder: str) -> DataFrame:
    """The blocks with ``at``, the ids before them in all files.

    What is broadcast has two numbers for each file, that is, for each task that wrote.
    """
    files = _stored(spark, folder).groupBy("file").agg(F.sum("n_ids").alias("n_ids"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    blocks = _stored(spark, folder).join(F.broadcast(starts), "file")
    return blocks.withColumn("at", F.col("base") + F.col("first"))


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids before it in all files), ids (unsigned 32 bit, least byte first)."""
    blocks = _placed(spark, folder).select("at", "n_ids", "width", "doc_ids", "counts", "words")
    return blocks.mapInArrow(_read, "doc_id LONG, start LONG, ids BINARY")


def ids_between(spark: SparkSession, folder: str, start: int, stop: int) -> DataFrame:
    """The blocks' shares of positions ``start`` to ``stop``: start, ids.

    Only blocks that overlap are read, and of them only the groups that hold the ids.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                low, high = max(start, row["at"]), min(stop, row["at"] + row["n_ids"])
                ids = unpack(row["words"], row["width"], low - row["at"], high - low)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([low], pa.int64()), pa.array([ids.tobytes()])], names=["start", "ids"]
                )

    return (
        _placed(spark, folder)
        .select("at", "n_ids", "width", "words")
        .filter((F.col("at") < stop) & (F.col("at") + F.col("n_ids") > start))
        .mapInArrow(cut, "start LONG, ids BINARY")
    )
