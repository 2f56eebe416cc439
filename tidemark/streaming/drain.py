"""Run a streaming query to the end of its input and report on the whole run."""

from __future__ import annotations

import threading
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

DELIVERY_SECONDS = 60.0  # for the last events of a query that has ended


@dataclass(frozen=True)
class RunReport:
    """Totals over all micro-batches of one run, not just the last."""

    input_rows: int
    batches: int


class _Progress(StreamingQueryListener):
    """Input rows of each micro-batch of one run; every event is delivered, however many there are."""

    def __init__(self, run_id: str):
        self.run_id, self.rows, self.ended = run_id, {}, threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if str(event.progress.runId) == self.run_id:
            self.rows[event.progress.batchId] = event.progress.numInputRows

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self.run_id:
            self.ended.set()


def drain(spark: SparkSession, query: StreamingQuery) -> RunReport:
    """Wait for an ``availableNow`` query to finish; failures are raised.

    Spark keeps the latest events of a query only, so they are taken as they come. Those of batches
    that were over before this began to listen are still among the kept ones.
    """
    streams = spark.streams
    progress = _Progress(str(query.runId))
    streams.addListener(progress)
    try:
        early = {event["batchId"]: event["numInputRows"] for event in query.recentProgress}
        query.awaitTermination()
        progress.ended.wait(DELIVERY_SECONDS)
        late = {event["batchId"]: event["numInputRows"] for event in query.recentProgress}
    finally:
        streams.removeListener(progress)
    rows = early | late | progress.rows
    return RunReport(sum(rows.values()), sum(1 for n in rows.values() if n))
