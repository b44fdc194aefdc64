"""What streaming queries did, batch by batch, kept for as long as the folder is.

Spark holds the last hundred progress reports of a query in memory.  The log writes each
report as a file of its own, named by query and batch: a batch that runs again after a
lost driver replaces its report, so sums over the log count every batch once.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tickbars.session import files_of

REPORT = "query STRING, batch BIGINT, rows BIGINT, late BIGINT, state_rows BIGINT, observed MAP<STRING, BIGINT>"


class ProgressLog(StreamingQueryListener):
    """A listener that keeps the figures of every batch of the session's queries in *folder*.

    Counts given to ``DataFrame.observe`` on a streaming frame are kept under ``observed``
    as ``<name>.<column>``.  Use as a context manager around queries.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._running: set[str] = set()
        self._changed = threading.Condition()

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        self.wait()
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        with self._changed:
            self._running.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if "addBatch" not in progress.durationMs:
            return  # nothing ran
        observed = {
            f"{name}.{column}": value
            for name, row in (progress.observedMetrics or {}).items()
            for column, value in row.asDict().items()
        }
        report = {
            "query": str(progress.id), "batch": progress.batchId, "rows": progress.numInputRows,
            "late": sum(op.numRowsDroppedByWatermark for op in progress.stateOperators),
            "state_rows": sum(op.numRowsTotal for op in progress.stateOperators), "observed": observed,
        }
        files, path = files_of(self.spark, f"{self.folder}/query={progress.id}/{progress.batchId:012d}.json")
        out = files.create(path, True)
        try:
            out.write(bytearray(json.dumps(report).encode()))
        finally:
            out.close()

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._running.discard(str(event.runId))
            self._changed.notify_all()

    def wait(self, seconds: float = 60.0) -> None:
        """Until the reports of all queries that have ended are written."""
        with self._changed:
            self._changed.wait_for(lambda: not self._running, seconds)

    def reports(self) -> DataFrame:
        """A row for each batch."""
        return self.spark.read.schema(REPORT).option("recursiveFileLookup", "true").json(self.folder)

    def totals(self) -> DataFrame:
        """Batches, rows and late rows of all reports, one row."""
        return self.reports().agg(
            F.count(F.lit(1)).alias("batches"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum("late"), F.lit(0)).alias("late"),
        )

    def observed(self) -> DataFrame:
        """Sums of the observed counts: name, total."""
        each = self.reports().select(F.explode("observed").alias("name", "value"))
        return each.groupBy("name").agg(F.sum("value").alias("total"))
