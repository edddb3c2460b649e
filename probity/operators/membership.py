"""Rows whose key belongs to a set of keys, safe when one key has a third of the rows.

The set is worked out first, in one narrow aggregate, and written to the shared
scratch folder. Rows and keys then meet in a semi join, which Spark makes a
broadcast where its own threshold allows. A key with more than 1 / SLICES of the
table would overload one task of a shuffle: its rows are cut into slices of about
that size. Fewer than SLICES keys can be that large, whatever the table, and what
is known of them is a 64-bit hash and a number each, which bounds it in bytes too.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from probity.functions import ticked
from probity.operators.measure import comparable, is_orphan, key_columns, key_counts, key_presence
from probity.session import remove_folder, scratch_dir

SLICES = 2000
#: Rows of a key from which slicing it is worth while.
HOT_ROWS = 100_000


@dataclass(frozen=True)
class KeySet:
    """A written set of keys with ``n`` rows each, and what was measured on the way."""

    frame: DataFrame
    keys: tuple[str, ...]
    path: str
    table_rows: int
    size: int
    largest: int

    def slices(self, hot_rows: int = HOT_ROWS) -> dict[int, int]:
        """For the hash of each hot key, into how many slices its rows are cut."""
        above = max(self.table_rows // SLICES, hot_rows)
        if self.largest <= above:
            return {}
        hashed = f"xxhash64({', '.join(ticked(k) for k in self.keys)}) AS hash"
        hot = self.frame.filter(f"n > {above}").selectExpr(hashed, f"ceil(n / {above}) AS slices")
        return {r["hash"]: r["slices"] for r in hot.collect()}

    def drop(self) -> None:
        """Delete the written set; frames derived from it can't be read any more."""
        remove_folder(self.frame.sparkSession, self.path)


def settle(counted: DataFrame, keys: Sequence[str], wanted: str) -> KeySet:
    """Write the keys meeting ``wanted``. ``counted`` has every key of the table and ``n``.

    The writing job itself takes the measurements. It runs when this is called.
    """
    spark = counted.sparkSession
    path = f"{scratch_dir(spark)}/keys"
    seen = Observation()
    measured = counted.observe(
        seen,
        F.expr("coalesce(sum(n), 0L) AS table_rows"),
        F.expr(f"count_if({wanted}) AS size"),
        F.expr(f"coalesce(max(CASE WHEN {wanted} THEN n END), 0L) AS largest"),
    )
    chosen = measured.filter(wanted).select(*[ticked(k) for k in keys], "n")
    chosen.write.parquet(path)
    frame = spark.read.schema(chosen.schema).parquet(path)
    return KeySet(frame, tuple(keys), path, **seen.get)


def _semi_join(rows: DataFrame, own: Sequence[str], key_set: KeySet, hot_rows: int) -> DataFrame:
    """The rows whose ``own`` columns are a key of the set.

    A row's slice is the number of the task that reads it, so a task that runs
    again after a loss gives its rows the same slices.
    """
    want = [f"__want{i}" for i in range(len(own))]
    named = [f"{ticked(k)} AS {name}" for k, name in zip(key_set.keys, want, strict=True)]
    wanted = key_set.frame.selectExpr(*named)
    same = " AND ".join(f"{a} <=> {b}" for a, b in zip(own, want, strict=True))
    slices = key_set.slices(hot_rows)
    if not slices:
        return rows.join(wanted, F.expr(same), "left_semi")
    hashes = ", ".join(f"{h}L" for h in slices)
    numbers = ", ".join(f"{h}L, {n}L" for h, n in slices.items())

    def cut(columns: Sequence[str]) -> str:
        hashed = f"xxhash64({', '.join(columns)})"
        return f"CASE WHEN {hashed} IN ({hashes}) THEN try_element_at(map({numbers}), {hashed}) ELSE 1L END"

    number = f"pmod(CAST(spark_partition_id() AS BIGINT), {cut(own)}) AS __slice"
    by_slice = wanted.selectExpr("*", f"explode(sequence(0L, {cut(want)} - 1L)) AS __want_slice")
    sliced = F.expr(f"{same} AND __slice = __want_slice")
    return rows.selectExpr("*", number).join(by_slice, sliced, "left_semi")


def rows_in(
    df: DataFrame, columns: Sequence[str], key_set: KeySet, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """The rows of ``df`` whose ``columns`` are a key of the set."""
    own = [f"__own{i}" for i in range(len(columns))]
    rows = df.selectExpr("*", *[f"{c} AS {name}" for c, name in zip(columns, own, strict=True)])
    return _semi_join(rows, own, key_set, hot_rows).select(*[ticked(c) for c in df.columns])


def duplicate_rows(
    df: DataFrame,
    keys: Sequence[str],
    digest: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every row that shares its key with another one; NULL keys equal each other.

    Use ``digest`` for keys of long text, so that key sets stay narrow.
    """
    repeated = settle(key_counts(df, keys, digest), keys, "n > 1")
    return rows_in(df, key_columns(df, keys, digest), repeated, hot_rows)


def orphan_rows(
    child: DataFrame,
    parent: DataFrame,
    key: str,
    parent_key: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rows of ``child`` with a key the parent lacks; a NULL key is no orphan."""
    present = key_presence(child, parent, key, parent_key).withColumnRenamed("key", key)
    lost = settle(present, [key], is_orphan(key))
    own = comparable(child, key, parent.schema[parent_key].dataType)
    return rows_in(child, [own], lost, hot_rows)
