"""What running streams report of themselves: observed counts, throughput, and how far they are behind."""

from __future__ import annotations

import json
import threading
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

METRICS = "query string, batch_id long, recorded_at string, rows long, rows_per_second double, duration_ms long, watermark string, behind long, state_rows long, observed map<string,string>"


def observe_counts(stream: DataFrame, name: str, **counts: Column) -> DataFrame:
    """The stream, of which each batch reports its rows and how many of them meet each condition."""
    return stream.observe(name, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(k) for k, c in counts.items()])


def _leaves(x: Any) -> list[int]:
    if isinstance(x, str):
        try:
            x = json.loads(x)
        except ValueError:
            return []
    if isinstance(x, dict):
        return [n for v in x.values() for n in _leaves(v)]
    return [x] if isinstance(x, int) and not isinstance(x, bool) else []


def offsets_behind(progress: dict[str, Any]) -> int | None:
    """Offsets, over all partitions of all sources, between what a batch ended with and the newest there were; null if no source says."""
    behind = [sum(_leaves(s.get("latestOffset"))) - sum(_leaves(s.get("endOffset"))) for s in progress.get("sources", []) if _leaves(s.get("latestOffset"))]
    return sum(behind) if behind else None


def metrics_row(progress: dict[str, Any]) -> tuple:
    """A row of METRICS from a progress report."""
    seconds = progress.get("durationMs", {}).get("triggerExecution", 0) / 1000
    rows = sum(s.get("numInputRows", 0) for s in progress.get("sources", []))
    observed = {f"{name}.{k}": str(v) for name, x in (progress.get("observedMetrics") or {}).items() for k, v in x.items()}
    state = sum(o.get("numRowsTotal", 0) for o in progress.get("stateOperators", []))
    mark = (progress.get("eventTime") or {}).get("watermark")
    return progress.get("name"), progress["batchId"], progress["timestamp"], rows, rows / seconds if seconds else 0.0, round(seconds * 1000), mark, offsets_behind(progress), state, observed


class MetricsLog(StreamingQueryListener):
    """Appends a row of METRICS for every batch with input of the queries whose names begin with ``prefix``.

    A row is one small file; compact the table, or roll it up by day, as any log.
    Use it as a context: what has been reported by then is written when it closes.
    """

    def __init__(self, spark: SparkSession, path: str, prefix: str = ""):
        super().__init__()
        self.spark, self.path, self.prefix = spark, path, prefix
        self.names: dict[str, str] = {}
        self.ended = threading.Condition()
        self.open = 0
        self.failed: Exception | None = None

    def __enter__(self) -> MetricsLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *problem: Any) -> None:
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        with self.ended:
            self.ended.wait_for(lambda: self.open <= 0, timeout=30)
        self.spark.streams.removeListener(self)
        if self.failed and not problem[0]:
            raise self.failed

    def onQueryStarted(self, event: Any) -> None:
        with self.ended:
            self.open += 1

    def onQueryProgress(self, event: Any) -> None:
        try:
            progress = json.loads(event.progress.json)
            row = metrics_row(progress)
            if (row[0] or "").startswith(self.prefix) and row[3]:
                self.spark.createDataFrame([row], METRICS).coalesce(1).write.mode("append").parquet(self.path)
        except Exception as problem:  # a listener must not stop the stream; it is raised when the log closes
            self.failed = problem

    def onQueryIdle(self, event: Any) -> None:
        pass

    def onQueryTerminated(self, event: Any) -> None:
        with self.ended:
            self.open -= 1
            self.ended.notify_all()
