"""The steps of a run, stored as they end, so that a run that was broken off can go on.

Each run has one file of JSON lines, a line for each try of a step. It is written
aside and renamed over the last one whenever a step ends, so it always holds whole
lines. A run has one driver, which is the only one to write its file.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from probity.model import STEPS_SCHEMA
from probity.session import exists

SUCCESS, FAILED = "success", "failed"
#: Characters of an error's text that are kept.
MESSAGE = 500


class StepLedger:
    """The steps of the run ``run_id``, below the folder ``path`` of all runs."""

    def __init__(self, spark: SparkSession, path: str, run_id: str) -> None:
        if not run_id or set(run_id) & set("/\\:*?[]{}"):
            raise ValueError(f"a run id is the name of a file: {run_id!r}")
        self.spark, self.run_id = spark, run_id
        jvm = spark._jvm
        self._jvm, self._paths = jvm, jvm.org.apache.hadoop.fs.Path
        self._path = self._paths(f"{path.rstrip('/')}/{run_id}.json")
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._files = self._path.getFileSystem(conf)
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files.getUri(), conf)
        self.rows: list[dict] = self._load()

    def _load(self) -> list[dict]:
        if not self._files.exists(self._path):
            return []
        stream = self._files.open(self._path)
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return [json.loads(line) for line in text.splitlines()]

    def _save(self) -> None:
        folder = self._path.getParent()
        aside = self._paths(folder, f".{self.run_id}-{uuid.uuid4().hex}")
        stream = self._files.create(aside, True)
        try:
            stream.write(bytearray("".join(json.dumps(r) + "\n" for r in self.rows).encode()))
        finally:
            stream.close()
        kind = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark._sc._gateway.new_array(kind, 1)
        options[0] = kind.OVERWRITE
        qualified = [self._files.makeQualified(p) for p in (aside, self._path)]
        self._context.rename(*qualified, options)

    def done(self, step: str) -> dict | None:
        """The stored row of a step that ended well."""
        return next((r for r in self.rows if r["step"] == step and r["status"] == SUCCESS), None)

    def _add(self, step: str, status: str, started: datetime, ms: int, rows: int | None, state: object, message: str) -> None:
        tries = sum(r["step"] == step for r in self.rows)
        self.rows.append(
            {
                "run_id": self.run_id,
                "seq": len(self.rows),
                "step": step,
                "attempt": tries + 1,
                "status": status,
                "started_at": started.isoformat(timespec="microseconds"),
                "duration_ms": ms,
                "rows": rows,
                "state": json.dumps(state),
                "message": message,
            }
        )
        self._save()

    def run(self, step: str, action: Callable[[], object], rows: Callable[[object], int | None] = lambda _: None) -> object:
        """Do a step and return what it gives, or what it gave if it has been done.

        What it gives must be JSON. A step that raises is stored as failed, with the
        time it took and the error, and raises.
        """
        stored = self.done(step)
        if stored:
            return json.loads(stored["state"])
        started, clock = datetime.now(timezone.utc).replace(tzinfo=None), time.monotonic()

        def taken() -> int:
            return int((time.monotonic() - clock) * 1000)

        try:
            state = json.loads(json.dumps(action()))
        except BaseException as error:
            text = f"{type(error).__name__}: {error}"[:MESSAGE]
            self._add(step, FAILED, started, taken(), None, None, text)
            raise
        self._add(step, SUCCESS, started, taken(), rows(state), state, "")
        return state

    def duration_ms(self, step: str) -> int:
        return self.done(step)["duration_ms"]


def stored_steps(spark: SparkSession, path: str) -> DataFrame:
    """The steps of all runs below ``path``, those of a run in the order of ``seq``."""
    if not exists(spark, path):
        return spark.createDataFrame([], STEPS_SCHEMA)
    return spark.read.schema(STEPS_SCHEMA).json(path)
