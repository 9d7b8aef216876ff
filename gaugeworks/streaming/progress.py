"""Progress of streaming queries as a table: batches, durations, state and failures.

A listener writes one small file per event under the folder, named by query, run and batch, so an
event that is told twice takes its own place. The table is read with a fixed schema.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from gaugeworks import files

SCHEMA = (
    "kind STRING, query_id STRING, run_id STRING, name STRING, at STRING, batch_id BIGINT, input_rows BIGINT,"
    " duration_ms BIGINT, state_rows BIGINT, state_bytes BIGINT, late_rows BIGINT, error STRING"
)


class ProgressLog(StreamingQueryListener):
    """Lands what the queries of a session report; add it with ``spark.streams.addListener``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def _land(self, file: str, **fields: object) -> None:
        files.write_text(self.spark, f"{self.path}/{file}.json", json.dumps(fields) + "\n")

    def onQueryStarted(self, event) -> None:
        run, query = str(event.runId), str(event.id)
        self._land(f"{run}-started", kind="started", query_id=query, run_id=run, name=event.name, at=event.timestamp)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        run, state = str(p.runId), p.stateOperators
        self._land(
            f"{run}-batch-{p.batchId}-{p.timestamp.replace(':', '')}",
            kind="progress", query_id=str(p.id), run_id=run, name=p.name, at=p.timestamp, batch_id=p.batchId,
            input_rows=p.numInputRows, duration_ms=p.durationMs.get("triggerExecution"),
            state_rows=sum(s.numRowsTotal for s in state), state_bytes=sum(s.memoryUsedBytes for s in state),
            late_rows=sum(s.numRowsDroppedByWatermark for s in state),
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run, query = str(event.runId), str(event.id)
        error = (event.errorClassOnException or event.exception) if event.exception else None
        self._land(f"{run}-ended", kind="failed" if error else "ended", query_id=query, run_id=run, error=error)

    def wait(self, query: StreamingQuery, seconds: float = 30.0) -> None:
        """Until the end of a query that has stopped is landed: events come a little later."""
        until = time.monotonic() + seconds
        while not files.exists(self.spark, f"{self.path}/{query.runId}-ended.json"):
            if time.monotonic() > until:
                raise TimeoutError(f"no end of run {query.runId} in {self.path}")
            time.sleep(0.05)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """All events as landed; ``at`` as a point in time."""
    if not files.names(spark, path):
        rows = spark.createDataFrame([], SCHEMA)
    else:
        rows = spark.read.schema(SCHEMA).json(path)
    return rows.withColumn("at", F.to_timestamp("at"))


def runs(progress: DataFrame) -> DataFrame:
    """(query_id, run_id, batches, input_rows, busy_ms, outcome): one row per run."""
    batch = F.col("kind") == "progress"
    ended = F.max(F.when(F.col("kind").isin("ended", "failed"), F.col("kind")))
    return progress.groupBy("query_id", "run_id").agg(
        F.countDistinct(F.when(batch & (F.col("input_rows") > 0), F.col("batch_id"))).alias("batches"),
        F.coalesce(F.sum(F.when(batch, F.col("input_rows"))), F.lit(0)).alias("input_rows"),
        F.coalesce(F.sum(F.when(batch, F.col("duration_ms"))), F.lit(0)).alias("busy_ms"),
        F.coalesce(ended, F.lit("running")).alias("outcome"),
    )
