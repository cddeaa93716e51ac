"""Counters of a stream, kept: what a batch observed and what its watermark dropped."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tallybrook.sources.commits import create_once

#: Rows that stateful operators left out for being later than the watermark.
DROPPED = "dropped_by_watermark"
COUNTERS_DDL = "name string, value bigint, run string, batch_id bigint"


class BatchCounters(StreamingQueryListener):
    """Writes a small file for every batch of every stream of the session: the observed metrics by
    name, and the rows dropped by watermarks.

    The file of a batch is written once, under the stream's id and the batch's, so a batch that is
    run again after a failure counts once. Spark reports progress after a batch; a driver that dies
    between the two leaves the batch without a file, and a stage that is computed again because
    an executor was lost may be observed twice: counters inform, they decide nothing.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._ended: dict[str, threading.Event] = {}
        self.failures: list[str] = []

    def _event(self, run_id) -> threading.Event:
        return self._ended.setdefault(str(run_id), threading.Event())

    def onQueryStarted(self, event) -> None:
        self._event(event.runId)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        try:
            self._keep(event.progress)
        except Exception as error:  # noqa: BLE001 - a listener must not end the stream
            self.failures.append(repr(error))

    def onQueryTerminated(self, event) -> None:
        self._event(event.runId).set()

    def _keep(self, progress) -> None:
        dropped = sum(o.numRowsDroppedByWatermark for o in progress.stateOperators)
        counts = {name: value for row in progress.observedMetrics.values() for name, value in row.asDict().items()}
        if not progress.numInputRows and not dropped:
            return
        counts[DROPPED] = dropped
        lines = "".join(json.dumps({"name": name, "value": value}) + "\n" for name, value in sorted(counts.items()))
        create_once(self.spark, f"{self.path}/run={progress.id}/batch_id={progress.batchId}/counters.json", lines)

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the stream has ended and all it reported is written."""
        query.awaitTermination()
        if not self._event(query.runId).wait(seconds):
            raise TimeoutError("the end of the stream was not reported")
        if self.failures:
            raise RuntimeError(f"counters were lost: {self.failures}")


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """``name, value, run, batch_id``."""
    return spark.read.schema(COUNTERS_DDL).json(path)


def total_counts(counters: DataFrame) -> DataFrame:
    """``outcome, n_messages`` over all batches and streams."""
    return counters.groupBy(F.col("name").alias("outcome")).agg(F.sum("value").alias("n_messages"))
