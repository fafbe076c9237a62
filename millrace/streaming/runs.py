"""Runs of streaming queries: told by a listener in the run log, and started again from their checkpoint when they fail."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..sources.tables import _fs

LOG = "run_id string, name string, status string, attempt int, at timestamp, rows_in bigint, error_summary string"


class RunListener(StreamingQueryListener):
    """Keeps a row of each event of named queries: running at the start, failed with its error or success at the end, with the rows read.

    The rows of a run are few: one for its start and one for its end. `rows()` gives them, and `store` writes them to the log."""

    def __init__(self):
        self.events: list[tuple] = []
        self._runs: dict[str, list] = {}

    def onQueryStarted(self, event) -> None:
        name, attempt = _parts(event.name)
        self._runs[str(event.runId)] = [name, attempt, 0]
        self._add(str(event.runId), "running", None)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        run = self._runs.get(str(p.runId))
        if run:
            run[2] += p.numInputRows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) in self._runs:
            self._add(str(event.runId), "failed" if event.exception else "success", event.exception)

    def _add(self, run: str, status: str, error: str | None) -> None:
        name, attempt, rows = self._runs[run]
        self.events.append((run, name, status, attempt, datetime.now(timezone.utc), rows, error[:2000] if error else None))


def _parts(name: str | None) -> tuple[str | None, int]:
    base, _, attempt = (name or "").rpartition("#")
    return (base, int(attempt)) if attempt.isdigit() else (name, 1)


def run_with_retry(spark: SparkSession, name: str, start: Callable[[str], object], log: str, tries: int = 3, wait: float = 1.0, growth: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> str:
    """Start a query (start(name) starts it on its checkpoint and returns it) and wait for its end; after a failure start it again from its
    checkpoint, `wait` seconds later and then each time `growth` times as long, up to `tries` starts. Writes a row to the log (Parquet at
    `log`, as LOG) for every start and every end, and returns the last status: success or failed. The error of a run is in its row."""
    status = "failed"
    for attempt in range(1, tries + 1):
        listener = RunListener()
        spark.streams.addListener(listener)
        error = None
        try:
            try:
                start(f"{name}#{attempt}").awaitTermination()
                status = "success"
            except Exception as e:
                status, error = "failed", str(e)
            # Events come by a queue of their own.
            for _ in range(100):
                if any(e[2] in ("success", "failed") for e in listener.events):
                    break
                sleep(0.1)
        finally:
            spark.streams.removeListener(listener)
        events = listener.events or [("", name, status, attempt, datetime.now(timezone.utc), 0, error[:2000] if error else None)]
        spark.createDataFrame(events, LOG).coalesce(1).write.mode("append").parquet(log)
        if status == "success":
            break
        if attempt < tries:
            sleep(wait * growth ** (attempt - 1))
    return status


def read_log(spark: SparkSession, log: str) -> DataFrame:
    fs, at = _fs(spark, log)
    return spark.read.schema(LOG).parquet(log) if fs.exists(at) else spark.createDataFrame([], LOG)


def last_status(log: DataFrame) -> DataFrame:
    """name, starts, status, error_summary: of each query the number of its starts and how the last one stands."""
    last = F.max_by(F.struct("status", "error_summary"), F.struct("attempt", F.col("status") != "running"))
    return log.groupBy("name").agg(F.count_if(F.col("status") == "running").alias("starts"), last.alias("x")).select("name", "starts", "x.status", "x.error_summary")
