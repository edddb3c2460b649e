"""The shared folder for intermediate tables of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Narrow rows per file of a written table.
ROWS_PER_FILE = 100_000
ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from the folder the driver has it from.

    That is enough where they see the same folder; elsewhere ship it with --py-files.
    """
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])


def new_folder(spark: SparkSession) -> str:
    """A new folder below the one the cluster names in ``spark.checkpoint.dir``.

    Where that is unset, a local session gets a temporary folder; a cluster raises.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="probity-llm-")
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def free_name(df: DataFrame, name: str) -> str:
    """``name``, longer if ``df`` has a column of it, in whatever case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def in_files(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of about so many narrow rows, in as few partitions as these make files of fair size."""
    return df.coalesce(max(1, -(-rows // ROWS_PER_FILE)))


def saved(df: DataFrame, folder: str, name: str, rows: int | None = None) -> DataFrame:
    """``df`` written as Parquet and read again: its lineage ends there.

    With ``rows``, about how many narrow rows it has, it makes few files.
    """
    path = f"{folder}/{name}"
    (df if rows is None else in_files(df, rows)).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: What this Python worker keeps from task to task: one thing at most.
_KEPT: dict[object, object] = {}


def kept(key: object, make: Callable[[], object]) -> object:
    """What ``make`` gives, kept by the worker until something else is."""
    if key not in _KEPT:
        let_go()  # before, so that both are never held at once
        _KEPT[key] = make()
        _give_back()
    return _KEPT[key]


def let_go() -> None:
    """Free what the worker keeps from an operator before this one."""
    _KEPT.clear()
    _give_back()


def _give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
