"""Rates and losses of running streams, as a table: a listener writes a row for every trigger."""

from __future__ import annotations

import datetime as dt
import threading

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS = """query string, run string, batch bigint, at timestamp, started timestamp, rows bigint, rows_per_second double, processed_per_second double, seconds double,
state_rows bigint, dropped_rows bigint, watermark timestamp"""


def _time(text: str | None) -> dt.datetime | None:
    return None if not text else dt.datetime.fromisoformat(text.replace("Z", "+00:00"))


class ProgressTable(StreamingQueryListener):
    """Appends the progress of all streaming queries of a session to a table; use it as a context manager.

    Rows are held until `every` of them came or a query ends, and are written by Spark into the shared folder. A trigger
    that is run again after a failure has the same run and batch, so `progress` counts it once.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 100):
        super().__init__()
        self.spark, self.path, self.every = spark, path, every
        self._rows: list[tuple] = []
        self._started: dict[str, dt.datetime | None] = {}
        self._lock, self._ended = threading.Lock(), threading.Condition()
        self._done: set[str] = set()

    def __enter__(self) -> ProgressTable:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)
        self.flush()

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._started[str(event.runId)] = _time(event.timestamp)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        state = p.stateOperators
        row = (p.name or str(p.id), str(p.runId), p.batchId, _time(p.timestamp), self._started.get(str(p.runId)), p.numInputRows, p.inputRowsPerSecond, p.processedRowsPerSecond, p.batchDuration / 1000,
               sum(s.numRowsTotal for s in state), sum(s.numRowsDroppedByWatermark for s in state), _time(p.eventTime.get("watermark")))
        with self._lock:
            self._rows.append(row)
            full = len(self._rows) >= self.every
        if full:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.flush()
        with self._ended:
            self._done.add(str(event.runId))
            self._ended.notify_all()

    def flush(self) -> None:
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)

    def wait_for(self, run: str, seconds: float = 60) -> bool:
        """Until the rows of an ended query are written: its events come a little after it."""
        with self._ended:
            return self._ended.wait_for(lambda: str(run) in self._done, seconds)

    def table(self) -> DataFrame:
        return progress(self.spark, self.path)


def progress(spark: SparkSession, path: str) -> DataFrame:
    """One row per trigger that ran; each batch of a run counts once."""
    return spark.read.schema(PROGRESS).parquet(path).dropDuplicates(["run", "batch"])


def rates(progressed: DataFrame) -> DataFrame:
    """Per query: rows, triggers with rows, seconds since its first start, rows per minute, dropped rows and their share of all.

    The running time spans restarts: from the first start to the end of the last trigger."""
    end = F.max(F.unix_micros("at") / 1e6 + F.col("seconds"))
    start = F.min(F.unix_micros(F.coalesce("started", "at")) / 1e6)
    out = progressed.groupBy("query").agg(F.sum("rows").alias("rows"), F.count_if(F.col("rows") > 0).alias("triggers"), (end - start).alias("running_seconds"), F.sum("dropped_rows").alias("dropped_rows"))
    return out.select("query", "rows", "triggers", "running_seconds", F.when(F.col("running_seconds") > 0, F.col("rows") * 60 / F.col("running_seconds")).otherwise(0.0).alias("rows_per_minute"), "dropped_rows",
                      F.when(F.col("rows") > 0, F.col("dropped_rows") / F.col("rows")).otherwise(0.0).alias("dropped_share"))
