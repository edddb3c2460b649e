"""Checks on tables that grow by files: every file is read once.

What the checks need of a file is its tally: narrow counts by check and key that add
up over files. A delivery reads the files that are new, adds one batch of their tally
to the stored ones, and with it the files' names, so a file counts if and only if its
batch does. Metrics are made of the stored tallies alone.

A row group of a file is read by one task, however many rows it has, and what a task adds
up it holds in memory. So the rows of large deliveries are first dealt out by their place in
the files, and stored tallies by their key.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from probity.model import Check, ForeignKey, UniqueKey
from probity.operators import tally
from probity.operators.measure import _bound, graded
from probity.sources.commits import BatchTable

FILE, PLACE = "__file", "__place"
#: Rows, of files or of tallies, that a task is to add up.
ROWS = 500_000


def _plain(path: str) -> str:
    """A file's name with one slash behind the scheme, however many it is given with."""
    return re.sub("^([a-z0-9]+):/+", r"\1:/", path)


def _signature(checks: Sequence[Check], schemas: Mapping[str, T.StructType]) -> str:
    """A name for what is counted; other checks or types are counted anew."""
    for check in checks:
        if not isinstance(check.rule, (UniqueKey, ForeignKey)) and not isinstance(check.rule.violated, str):
            raise ValueError("stored checks need rules as SQL text")
    told = repr((list(checks), sorted((n, s.json()) for n, s in schemas.items())))
    return hashlib.sha256(told.encode()).hexdigest()[:16]


def _parts(rows: DataFrame) -> int:
    """How many tasks are to add up rows of files. Counting these reads the footers only."""
    return -(-rows.count() // ROWS)


def _added_up(tallies: DataFrame) -> DataFrame:
    """Stored tallies added up. A batch has each key once, so no task gets many of one key."""
    parts = _parts(tallies)
    return tally.tally(tallies if parts < 2 else tallies.repartition(parts, "slot", "key"))


class CheckState:
    """Stored tallies of the files of some datasets, below ``path``.

    ``schemas`` has the columns of each dataset's files; ``prepare`` may change the
    rows of a dataset before they are checked, each by itself and keeping ``__file``.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        checks: Sequence[Check],
        schemas: Mapping[str, T.StructType],
        prepare: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None,
    ) -> None:
        self.spark, self.checks, self.schemas = spark, list(checks), dict(schemas)
        self.prepare = dict(prepare or {})
        self.names = tally.datasets_of(self.checks)
        self.state = BatchTable(
            spark, f"{path.rstrip('/')}/{_signature(self.checks, self.schemas)}", tally.TALLY_SCHEMA
        )
        # Tables without rows, for the types by which keys are compared.
        self._empty = {name: self._prepared(name, spark.createDataFrame([], self.schemas[name])) for name in self.names}

    def _prepared(self, name: str, df: DataFrame) -> DataFrame:
        if name not in self.prepare:
            return df
        return self.prepare[name](df)

    def _file_slot(self, name: str) -> int:
        return -1 - len(self.names) - self.names.index(name)

    def files(self, name: str) -> list[str]:
        """The files of a dataset that have been read."""
        rows = self.state.read().filter(F.col("slot") == self._file_slot(name)).select("key").distinct()
        return sorted(r["key"] for r in rows.collect())

    def new_files(self, name: str, folder: str) -> list[str]:
        """The Parquet files below ``folder`` that have not been read."""
        there = self.spark.read.schema(self.schemas[name]).parquet(folder).inputFiles()
        known = set(self.files(name))
        return sorted(f for f in there if _plain(f) not in known)

    def scan(self, name: str, files: Sequence[str]) -> DataFrame:
        """The rows of files, with the name of each row's file; many are dealt to tasks of about ROWS each."""
        read = self.spark.read.schema(self.schemas[name]).parquet(*map(unquote, files))
        file = F.regexp_replace(F.col("_metadata.file_path"), "^([a-z0-9]+):/+", "$1:/")
        place = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
        parts = _parts(read)
        if parts < 2:
            return read.select("*", file.alias(FILE))
        return read.select("*", file.alias(FILE), place.alias(PLACE)).repartition(parts, PLACE).drop(PLACE)

    def deliver(self, name: str, folder: str) -> list[str]:
        """Count the files below ``folder`` that are new, and return their names.

        Files must not change once they are there. One delivery of a dataset at a
        time: the batch is not added if another one has added a file of it.
        """
        before = set(self.state.version()[1])
        files = self.new_files(name, folder)
        if not files:
            return []
        rows = self._prepared(name, self.scan(name, files))
        per_file = F.struct(
            F.lit(self._file_slot(name)).alias("slot"),
            F.col(FILE).alias("key"),
            F.lit(1).cast("long").alias("n"),
            F.lit(0).cast("long").alias("m"),
        )
        counted = tally.entries(rows, name, self.checks, self._empty, self.names, [per_file])
        # A file without rows has no entry of its own.
        named = self.spark.createDataFrame([(self._file_slot(name), _plain(f), 0, 0) for f in files], tally.TALLY_SCHEMA)
        batch = self.state.write_batch(tally.tally(counted.union(named)))

        def change(batches: list[str]) -> list[str]:
            if set(batches) - before and set(self.files(name)) & set(map(_plain, files)):
                raise RuntimeError(f"another delivery of {name} has read the same files")
            return [*batches, batch]

        self.state.commit(change)
        return files

    def metrics(self) -> DataFrame:
        """One row per check that applies, over all files read so far."""
        added_up = _added_up(self.state.read())
        applies = tally.applying(self.checks, self._empty)
        return graded(tally.counts(added_up, self.checks, applies, _bound))

    def compact(self) -> None:
        """Add all batches up into one."""
        batches = self.state.version()[1]
        if len(batches) > 1:
            self.state.replace(batches, _added_up(self.state.read()))
