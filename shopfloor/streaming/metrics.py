"""Counters of running streams as a table: what their rows were observed to be, rows, flush times and state."""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from shopfloor import constants as K
from shopfloor.operators.wide import MISSING, counts
from shopfloor.schemas import columns

METRIC = columns("query string, batch long, metric string, value double, at_ms long")
#: Kinds of alerts, each counted at each level.
KINDS = ("OVER_REPORT", "LAG", "MISSING_REPORT")
#: Rows that the driver holds before it writes them.
HELD = 5000


def observed_changes(wide: DataFrame) -> DataFrame:
    """The rows as they are, with ``quality`` and, by channel, ``dim_miss`` counted on the way; no pass is added."""
    kept = F.coalesce(counts(wide), F.lit(False))
    quality = {"changes": F.count(F.lit(1)), "dirty": F.count_if(F.col("outputtype").isNull() | F.col("outputdatetime").isNull()), "deleted": F.count_if(F.coalesce("is_deleted", F.lit(False))), "filtered": F.count_if(~kept)}
    of = lambda channel, c: F.count_if((F.col("outputtype") == channel) & (F.coalesce(c, F.lit("")) == ""))
    missing = {f"{channel}_{name}": of(channel, c) for channel in K.CHANNELS.values() for name, c in MISSING.items()}
    named = lambda d: [c.alias(n) for n, c in d.items()]
    return wide.observe("quality", *named(quality)).observe("dim_miss", *named(missing))


def observed_alerts(alerts: DataFrame) -> DataFrame:
    """Alert rows as they are, with those that rose to a level counted by type and level."""
    fired = [F.count_if((F.col("alert_type") == kind) & (F.col("level") == level)).alias(f"{kind}_{level}") for kind in KINDS for level in K.LEVELS[1:]]
    return alerts.observe("alert_fired", *fired)


class Metrics(StreamingQueryListener):
    """Gathers the figures of every batch of the session's streams, and writes them to ``path`` as rows of METRIC.

    A batch that runs again gives its figures again; the last ones count (``read``). HELD rows at most wait in the driver.
    """

    def __init__(self, spark: SparkSession, path: str):
        super().__init__()
        self.spark, self.path = spark, path
        self.rows: list[tuple] = []
        self.ended: dict[str, threading.Event] = {}
        self.lock = threading.Lock()

    def _end(self, run: str) -> threading.Event:
        with self.lock:
            return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryIdle(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        p = event.progress
        found = {"rows": p.numInputRows, "flush_ms": p.durationMs.get("addBatch", 0)}
        found |= {"state_rows": sum(s.numRowsTotal for s in p.stateOperators), "state_bytes": sum(s.memoryUsedBytes for s in p.stateOperators), "late_dropped": sum(s.numRowsDroppedByWatermark for s in p.stateOperators)}
        for name, row in p.observedMetrics.items():
            found |= {f"{name}.{c}": v for c, v in row.asDict().items()}
        at = time.time_ns() // 1_000_000
        self.rows += [(str(p.id), p.batchId, metric, float(v or 0), at) for metric, v in found.items()]
        if len(self.rows) >= HELD:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def flush(self) -> None:
        rows, self.rows = self.rows, []
        if rows:
            self.spark.createDataFrame(rows, METRIC).coalesce(1).write.mode("append").parquet(self.path)

    def settled(self, query, seconds: float = 60) -> bool:
        """Waits until all events of an ended query have come, and writes what is held."""
        came = self._end(str(query.runId)).wait(seconds)
        self.flush()
        return came


def read(spark: SparkSession, path: str) -> DataFrame:
    """query, batch, metric and value, each once."""
    rows = spark.read.schema(METRIC).parquet(path)
    return rows.groupBy("query", "batch", "metric").agg(F.max_by("value", "at_ms").alias("value"))


def totals(metrics: DataFrame, prefixes: tuple[str, ...] = ("quality.", "dim_miss.", "alert_fired.")) -> DataFrame:
    """The counters that add up, over all batches."""
    wanted = F.lit(False)
    for p in prefixes:
        wanted = wanted | F.col("metric").startswith(p)
    return metrics.where(wanted).groupBy("metric").agg(F.sum("value").cast("bigint").alias("value"))
