"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_own: list[str] = []


def builder(app_name: str = "probity") -> SparkSession.Builder:
    """A session builder with the settings the library is tested with."""
    return (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )


def scratch_dir(spark: SparkSession) -> str:
    """A new folder all executors can reach, under the folder the session names."""
    base = spark.conf.get(CHECKPOINT_DIR, None) or (_own[-1] if _own else None)
    if not base:
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by the cluster")
    return f"{base.rstrip('/')}/probity-{uuid.uuid4().hex}"


def use_scratch(base: str) -> None:
    """Where ``scratch_dir`` is to be if a session names no folder: for tests on one machine."""
    _own.append(base)


def _file_system(spark: SparkSession, path: str):  # noqa: ANN202
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), folder


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of this path, in whatever file system it is."""
    files, folder = _file_system(spark, path)
    return files.exists(folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there, in whatever file system it is."""
    files, folder = _file_system(spark, path)
    files.delete(folder, True)
