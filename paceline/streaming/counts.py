"""Durable counts of what a stream flushed: batches, rows and failures.

A listener keeps the totals of each run of a query in a small file in a shared folder, so they
outlive the query, the session and its list of recent progress. Totals go to two files in turn: a
driver that dies while it writes one leaves the other.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from paceline.sources.scratch import write_text

TOTALS = "query string, run string, batches long, rows long, failures long, ended boolean, error string"


class FlushCounts(StreamingQueryListener):
    """Counts batches that ended, their rows, and runs that ended in an error, below ``path``.

    A batch that fails and is run again after a restart counts once, in the run that ended it.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.runs: dict[str, dict] = {}

    def _run(self, event) -> dict:
        start = {"query": str(event.id), "run": str(event.runId), "batches": 0, "rows": 0, "failures": 0, "ended": False, "error": None}
        return self.runs.setdefault(str(event.runId), {"total": start, "batch": -1, "rows": 0, "writes": 0})

    def _keep(self, run: dict) -> None:
        name = f"{run['total']['run']}-{run['writes'] % 2}.json"
        run["writes"] += 1
        write_text(self.spark, f"{self.path}/{name}", json.dumps(run["total"]) + "\n")

    def onQueryStarted(self, event) -> None:
        self._keep(self._run(event))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        run, rows = self._run(progress), int(progress.numInputRows)
        if progress.batchId > run["batch"] and rows:
            run["batch"] = progress.batchId
            run["total"]["batches"] += 1
            run["total"]["rows"] += rows
            self._keep(run)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run = self._run(event)
        run["total"]["ended"] = True
        if event.exception:
            run["total"].update(failures=1, error=event.exception[:2000])
        self._keep(run)

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Until the end of a query's run has been counted; events arrive a little after the fact."""
        until = time.time() + seconds
        while not self.runs.get(str(query.runId), {"total": {"ended": False}})["total"]["ended"]:
            if time.time() > until:
                raise TimeoutError(f"no end of run {query.runId} within {seconds} s")
            time.sleep(0.1)


def run_counts(spark: SparkSession, path: str) -> DataFrame:
    """The totals of every run (:data:`TOTALS`)."""
    rows = spark.read.schema(TOTALS).json(path).where("run IS NOT NULL")
    last = F.max_by(F.struct("*"), F.struct(F.col("ended"), "batches", "failures")).alias("last")
    return rows.groupBy("run").agg(last).select("last.*")


def flush_counts(spark: SparkSession, path: str) -> DataFrame:
    """``query, runs, batches, rows, failures`` over all runs of each query."""
    return run_counts(spark, path).groupBy("query").agg(
        F.count(F.lit(1)).alias("runs"), *[F.sum(c).alias(c) for c in ("batches", "rows", "failures")])
