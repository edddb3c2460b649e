"""Exact Jaccard join of documents on word shingles, by parity sketches.

Shingles are hashed into sketches in two ways. In the 1024-bit parity sketch each
shingle flips one bit, so two sets differ in at least as many shingles as their
sketches differ in bits. For each band of set sizes the shingles are also dealt
to pieces, each the XOR of its shingles' hashes. Where sets of a band may differ
in d shingles, at least (pieces - d) pieces are equal, so each set may leave out
its (pieces - d - 1) least telling pieces: what a piece tells depends on its
shingles alone, and the most telling one of the equal pieces is left out by
neither side. Pairs that share a piece and whose parity sketches are near enough
are verified on the shingles.

Documents of equal sets are one class. Within a piece that many classes share,
classes are first compared with one centre at a time, and only classes that are
still in different components are then compared with each other, so a large group
of copies costs a few links for each, not one for each pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probity.llm.components import components
from probity.llm.scratch import free_name, in_files, let_go, new_folder, saved
from probity.llm.shingles import BATCH_BYTES, U, batches, mixed, shingle_hashes

SKETCH_LONGS = 16
SKETCH_BITS = SKETCH_LONGS * 64
#: Counters for how common shingles are.
COUNTERS = 1 << 18
#: What a shingle tells at most; a common one tells less.
WEIGHT = 16
#: Comparisons with a centre before all classes of different components are compared.
STAR_ROUNDS = 2
#: Classes of a piece from which their comparisons are dealt over several tasks.
HOT_CLASSES = 2000
#: Rows taken from an Arrow batch at once.
ROWS = 1000


@dataclass(frozen=True)
class Likeness:
    """Sets link when ``den * intersection >= num * union``; shingles have ``words`` words."""

    words: int = 5
    num: int = 80
    den: int = 100

    def differ(self, sizes: int) -> int:
        """The shingles in which linked sets of ``sizes`` shingles together differ at most."""
        return (self.den - self.num) * sizes // (self.den + self.num)

    def largest(self, size: int) -> int:
        """The size that a linked set has at most."""
        return size * self.den // self.num

    def bands(self, size: int) -> list[tuple[int, int, int]]:
        """(band, pieces, pieces to keep) for a set; band k has pairs whose larger size is k bits long."""
        found = []
        for k in range(size.bit_length(), self.largest(size).bit_length() + 1):
            top = (1 << k) - 1
            d = self.differ(2 * top)
            if d:
                own = self.differ(size + min(top, self.largest(size)))
                found.append((k, d * 7 // 5 + 5, own + 1))
        return found


def shingle_sets(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of each text in ascending order, text by text, and their counts."""
    hashes, counts = shingle_hashes(texts, words)
    ends = np.cumsum(counts)
    for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True):
        hashes[a:b].sort()
    owner = np.repeat(np.arange(len(counts)), counts)
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], np.bincount(owner[new], minlength=len(counts))


_SET = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_hash", pa.int64()),
        ("n", pa.int64()),
        ("class", pa.int64()),
        ("counter", pa.int64()),
        ("seen", pa.int64()),
    ]
)
_SET_SCHEMA = "doc_id LONG, text_hash LONG, n LONG, class LONG, counter LONG, seen LONG"


def _encoded(column: pa.Array) -> list[bytes]:
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def _segments(values: np.ndarray, counts: np.ndarray, how: np.ufunc) -> np.ndarray:
    """``how`` over each text's values; 0 for a text without any."""
    out = np.zeros(len(counts), values.dtype)
    some = counts > 0
    if some.any():
        starts = (np.cumsum(counts) - counts)[some]
        out[some] = how.reduceat(values, starts)
    return out


def _classes(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The same number for equal sets, by order-free sums of two hashes of each shingle."""
    one = _segments(mixed(hashes ^ U(0x51ED270B35A1E9C7)), counts, np.add)
    two = _segments(mixed(hashes ^ U(0x8F1BBCDC6ED9EBA1)), counts, np.bitwise_xor)
    return mixed(one ^ mixed(two + counts.astype(U))).view(np.int64)


def _read_sets(words: int):
    def read(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        seen, total = np.zeros(COUNTERS, np.int64), 0
        for batch in stream:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                texts = _encoded(some.column(2))
                for a, b in batches(texts):
                    hashes, counts = shingle_sets(texts[a:b], words)
                    seen += np.bincount((hashes >> U(40)).astype(np.int64) % COUNTERS, minlength=COUNTERS)
                    total += len(hashes)
                    none = pa.nulls(b - a, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [
                            some.column(0).slice(a, b - a),
                            some.column(1).slice(a, b - a),
                            pa.array(counts),
                            pa.array(_classes(hashes, counts)),
                            none,
                            none,
                        ],
                        schema=_SET,
                    )
        common = np.flatnonzero(seen > 4 * (total // COUNTERS + 1))
        none = pa.nulls(len(common), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, none, none, none, pa.array(common), pa.array(seen[common])], schema=_SET
        )

    return read


def _weights(sets: DataFrame, documents: int) -> np.ndarray:
    """What a shingle tells, by its counter: less, the more documents have it.

    This only decides which pieces are left out; the result does not depend on it.
    At most COUNTERS rows are fetched.
    """
    weights = np.full(COUNTERS, WEIGHT, np.uint8)
    counted = sets.filter("counter IS NOT NULL").groupBy("counter").agg(F.sum("seen").alias("seen"))
    for row in counted.collect():
        weights[row["counter"]] = max(1, min(WEIGHT, int(np.log2(max(documents, 1) / row["seen"] + 1) * 2)))
    return weights


_KEYS = pa.schema(
    [
        ("class", pa.int64()),
        ("n", pa.int64()),
        *[(f"s{i}", pa.int64()) for i in range(SKETCH_LONGS)],
        ("keys", pa.list_(pa.int64())),
    ]
)
_KEYS_SCHEMA = (
    "class LONG, n LONG, " + ", ".join(f"s{i} LONG" for i in range(SKETCH_LONGS)) + ", keys ARRAY<LONG>"
)


def piece_keys(
    hashes: np.ndarray, counts: np.ndarray, how: Likeness, weights: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The keys of the pieces that each set keeps, set by set, and how many those are."""
    plan = [(i, *band) for i, n in enumerate(counts.tolist()) if n for band in how.bands(n)]
    if not plan:
        return np.zeros(0, np.int64), np.zeros(len(counts), np.int64)
    owner, band, pieces, keep = np.array(plan, np.int64).T
    size = counts[owner]
    begin = (np.cumsum(counts) - counts)[owner]
    use = np.repeat(np.arange(len(plan)), size)
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + begin[use]
    token = hashes[at]
    first = np.cumsum(pieces) - pieces
    place = first[use] + (mixed(token ^ U(0x3C6EF372FE94F82B)) % pieces[use].astype(U)).astype(np.int64)
    total = int(pieces.sum())
    told = np.bincount(place, weights=weights[(token >> U(40)).astype(np.int64) % COUNTERS], minlength=total)
    order = np.argsort(place, kind="stable")
    found = np.zeros(total, U)
    filled, starts = np.unique(place[order], return_index=True)
    found[filled] = np.bitwise_xor.reduceat(mixed(token + U(0xA54FF53A5F1D36F1))[order], starts)
    mine = np.repeat(np.arange(len(plan)), pieces)
    number = (np.arange(total) - first[mine]).astype(U)
    keys = mixed(found ^ mixed(number * U(64) + band[mine].astype(U)))
    # the least that a kept piece tells: at most pieces - keep tell less
    by_told = np.lexsort((told, mine))
    least = told[by_told[first + np.maximum(pieces - keep, 0)]]
    kept = told >= least[mine]
    return keys[kept].view(np.int64), np.bincount(owner[mine[kept]], minlength=len(counts))


def parity_sketches(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A row of SKETCH_LONGS numbers for each set."""
    owner = np.repeat(np.arange(len(counts)), counts)
    bit = (hashes & U(SKETCH_BITS - 1)).astype(np.int64)
    flips = np.bincount(owner * SKETCH_BITS + bit, minlength=len(counts) * SKETCH_BITS) & 1
    return np.packbits(flips.astype(np.uint8).reshape(len(counts), -1), axis=1).view("<i8")


def _read_keys(how: Likeness, weights: np.ndarray):
    def read(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        done: set[int] = set()  # a class comes once from each task
        for batch in stream:
            for at in range(0, batch.num_rows, ROWS):
                texts = _encoded(batch.slice(at, ROWS).column(0))
                for a, b in batches(texts):
                    hashes, counts = shingle_sets(texts[a:b], how.words)
                    classes = _classes(hashes, counts)
                    new = np.zeros(len(counts), bool)
                    for i, own in enumerate(classes.tolist()):
                        if counts[i] and own not in done:
                            done.add(own)
                            new[i] = True
                    if not new.any():
                        continue
                    hashes, classes, counts = hashes[np.repeat(new, counts)], classes[new], counts[new]
                    keys, held = piece_keys(hashes, counts, how, weights)
                    ends = pa.array(np.concatenate([[0], np.cumsum(held)]).astype(np.int32))
                    sketches = parity_sketches(hashes, counts)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(classes),
                            pa.array(counts),
                            *[pa.array(np.ascontiguousarray(sketches[:, i])) for i in range(SKETCH_LONGS)],
                            pa.ListArray.from_arrays(ends, pa.array(keys)),
                        ],
                        schema=_KEYS,
                    )

    return read


def _near(left: str, right: str, how: Likeness) -> Column:
    """Whether sizes and sketches allow a link."""
    bits = " + ".join(f"bit_count({left}.s{i} ^ {right}.s{i})" for i in range(SKETCH_LONGS))
    low, high = f"least({left}.n, {right}.n)", f"greatest({left}.n, {right}.n)"
    return F.expr(
        f"{low} * {how.den} >= {high} * {how.num} AND "
        f"({bits}) * {how.den + how.num} <= {how.den - how.num} * ({left}.n + {right}.n)"
    )


def _linked(how: Likeness):
    @F.pandas_udf("boolean")
    def linked(left: pd.Series, right: pd.Series) -> pd.Series:
        one, two = [t.encode() for t in left], [t.encode() for t in right]
        out = np.zeros(len(one), bool)
        begin = 0
        while begin < len(one):
            end, size = begin, 0
            while end < len(one) and (end == begin or size < BATCH_BYTES):
                size += len(one[end]) + len(two[end])
                end += 1
            a, na = shingle_sets(one[begin:end], how.words)
            b, nb = shingle_sets(two[begin:end], how.words)
            ea, eb = np.cumsum(na).tolist(), np.cumsum(nb).tolist()
            for i, (x, y, n, m) in enumerate(zip(ea, eb, na.tolist(), nb.tolist(), strict=True)):
                both = len(np.intersect1d(a[x - n : x], b[y - m : y], assume_unique=True))
                out[begin + i] = both * how.den >= how.num * (n + m - both)
            begin = end
        return pd.Series(out)

    return linked


def jaccard_components(docs: DataFrame, how: Likeness = Likeness()) -> DataFrame:
    """doc_id, text_hash, n (set size), component (its least doc_id) for each row of ``docs``.

    Words are runs of other than the six ASCII white spaces, A to Z in lower case.
    A text with fewer words than a shingle has one shingle; a NULL, empty or blank
    text has none and is linked with nothing. Repeated rows are linked like other
    equal texts. A NULL doc_id is never the least, unless all are. Other columns
    are ignored; an empty table gives no rows.
    """
    folder = new_folder(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text"
    )
    sets = saved(rows.mapInArrow(_read_sets(how.words), _SET_SCHEMA), folder, "sets")
    own = sets.filter("counter IS NULL").select("doc_id", "text_hash", "n", "class")
    documents = own.count()
    read = _read_keys(how, _weights(sets, documents))
    keyed = saved(docs.select("text").mapInArrow(read, _KEYS_SCHEMA), folder, "keys")
    links = _links(docs, own, keyed, how, folder)

    classes = own.filter("n > 0").groupBy("class").agg(F.min("doc_id").alias("least"))
    grouped = components(links).withColumnRenamed("node", "class")
    named = saved(
        classes.join(grouped, "class", "left").select(
            "class", "least", F.coalesce("component", "class").alias("group")
        ),
        folder,
        "classes",
        documents,
    )
    of_group = named.groupBy("group").agg(F.min("least").alias("component"))
    of_class = named.join(of_group, "group").select("class", "component")
    linked = own.filter("n > 0").join(of_class, "class").select("doc_id", "text_hash", "n", "component")
    alone = own.filter("n = 0").select("doc_id", "text_hash", "n", F.col("doc_id").alias("component"))
    return in_files(linked.union(alone), documents)


def one_of_each(docs: DataFrame, how: Likeness = Likeness()) -> DataFrame:
    """``docs`` with one row of each component: that of the least doc_id, then text hash.

    Rows of a text without words all stay. The removed rows' keys are joined away.
    """
    found = jaccard_components(docs, how).filter("n > 0")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first")
    kept = found.groupBy("component", F.when(F.col("component").isNull(), F.col("text_hash")))
    kept = kept.agg(first).select("first.doc_id", "first.text_hash").alias("k")
    own = free_name(docs, "text_hash")
    rows = docs.withColumn(own, F.xxhash64("text")).alias("d")
    worded = F.col("d.text").rlike("[^\\x20\\x09-\\x0D]")
    same = F.expr(f"CAST(d.doc_id AS LONG) <=> k.doc_id AND d.{own} = k.text_hash")
    stay = rows.filter(worded).join(kept, same, "left_semi")
    once = stay.dropDuplicates(["doc_id", own])
    blank = rows.filter(~F.coalesce(worded, F.lit(False)))
    return once.union(blank).select(*docs.columns)


def _links(
    docs: DataFrame, own: DataFrame, keyed: DataFrame, how: Likeness, folder: str
) -> DataFrame:
    """Verified links (a, b) between classes, enough to connect all that are linked."""
    held = saved(_held(keyed), folder, "held")
    held_by = held.groupBy("class").agg(F.count("*").alias("weight"))
    classes = held.select("class").distinct().count()
    sketched = [F.first(c).alias(c) for c in keyed.columns if c not in ("class", "keys")]
    sketches = saved(
        keyed.drop("keys").join(held_by, "class").groupBy("class", "weight").agg(*sketched),
        folder,
        "sketches",
        classes,
    )
    texts = saved(_texts(docs, own, held_by), folder, "texts")
    links: list[DataFrame] = []
    for number in range(STAR_ROUNDS + 1):
        group = F.col("class")
        now = sketches
        if links:
            joined = components(reduce(DataFrame.union, links)).withColumnRenamed("node", "class")
            now = sketches.join(joined, "class", "left")
            group = F.coalesce("component", "class")
        now = now.select(*sketches.columns, group.alias("group"))
        now = saved(now, folder, f"groups{number}", classes)
        if number < STAR_ROUNDS:
            found = _centre_pairs(held, now, how, number)
        else:
            found = _all_pairs(held, now, how, folder)
        pairs = saved(found, folder, f"pairs{number}", classes)
        verified = _verified(pairs, texts, how).distinct()  # a stage of its own writes
        links.append(saved(verified, folder, f"links{number}", classes))
    return reduce(DataFrame.union, links)


def _held(keyed: DataFrame) -> DataFrame:
    """class and key, for keys of several classes.

    All keys are dealt out once, both to find the shared ones and to take their classes. A
    class has a key once from each task, and many others, so no key has many of all rows.
    """
    spread = keyed.select("class", F.explode("keys").alias("key")).repartition("key")
    shared = spread.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    return spread.join(shared.filter("low <> high").select("key"), "key").distinct()


def _open(held: DataFrame, now: DataFrame) -> DataFrame:
    """Classes by key, for keys that have classes of different components."""
    grouped = held.join(now.select("class", "weight", "group"), "class")
    mixed_keys = grouped.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high"))
    return grouped.join(mixed_keys.filter("low <> high").select("key"), "key")


def _centre_pairs(held: DataFrame, now: DataFrame, how: Likeness, number: int) -> DataFrame:
    """Each class with the centre of each of its keys, where they may link and aren't yet.

    The first centre of a key is its class with the most shared keys, as the text
    from which others were copied has; later ones are any.
    """
    rows = _open(held, now)
    rank = F.xxhash64("class", F.lit(number)) if number else F.col("weight")
    centre = rows.groupBy("key").agg(F.max(F.struct(rank, F.col("class"), F.col("group"))).alias("c"))
    pairs = (
        rows.join(centre.select("key", F.col("c.class").alias("centre"), F.col("c.group").alias("to")), "key")
        .filter("group <> to")
        .select("class", "centre")
        .distinct()
    )
    return (
        pairs.alias("p")
        .join(now.alias("l"), F.expr("l.class = p.centre"))
        .join(now.alias("r"), F.expr("r.class = p.class"))
        .filter(_near("l", "r", how))
        .select(F.col("l.class").alias("a"), F.col("r.class").alias("b"))
    )


def _all_pairs(held: DataFrame, now: DataFrame, how: Likeness, folder: str) -> DataFrame:
    """Classes that share a key, may link and are still in different components.

    The classes of a key with more than HOT_CLASSES are dealt to blocks, and each pair
    of blocks is a group of its own, so no task compares more than two blocks.
    """
    opened = saved(_open(held, now).select("key", "class"), folder, "open")
    blocks = opened.groupBy("key").agg(F.ceil(F.count("*") / HOT_CLASSES).cast("int").alias("blocks"))
    hot = blocks.filter("blocks > 1")
    rows = opened.join(now.drop("weight"), "class").join(hot, "key", "left")
    rows = rows.withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    dealt = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")}).drop("blocks", "other")
    left, right = dealt.filter("own = lo").alias("l"), dealt.filter("own = hi").alias("r")
    same = F.expr(
        "l.key = r.key AND l.lo = r.lo AND l.hi = r.hi AND (l.lo < l.hi OR l.class < r.class) AND l.group <> r.group"
    )
    pairs = left.join(right, same & _near("l", "r", how))
    return pairs.select(
        F.least("l.class", "r.class").alias("a"), F.greatest("l.class", "r.class").alias("b")
    ).distinct()


def _texts(docs: DataFrame, own: DataFrame, held_by: DataFrame) -> DataFrame:
    """One text for each class that shares a key."""
    first = own.groupBy("class").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    wanted = first.join(held_by, "class").select("class", "first.*").alias("w")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text"
    ).alias("d")
    same = F.expr("d.doc_id <=> w.doc_id AND d.text_hash = w.text_hash")
    return rows.join(wanted, same).select("w.class", "d.text").dropDuplicates(["class"])


def _verified(pairs: DataFrame, texts: DataFrame, how: Likeness) -> DataFrame:
    one = texts.select(F.col("class").alias("a"), F.col("text").alias("left"))
    two = texts.select(F.col("class").alias("b"), F.col("text").alias("right"))
    both = pairs.join(one, "a").join(two, "b")
    return both.filter(_linked(how)("left", "right")).select("a", "b")
