"""What running queries have read, refused and dropped, and runs that end by themselves."""

from __future__ import annotations

import threading
import time
from collections import defaultdict
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

ROWS, DROPPED, REJECTED = "n_in", "n_dropped", "n_rejected"


def observed(stream: DataFrame, name: str, rejected: Column) -> DataFrame:
    """``stream``, whose batches tell how many of their rows are ``rejected``."""
    return stream.observe(name, F.count_if(rejected).alias(REJECTED))


class Totals(StreamingQueryListener):
    """Totals per query name over all batches: rows read, rows refused, late rows dropped by state.

    A window aggregation drops late rows after they were counted together within their task, so its
    number is of groups; state that holds single rows drops single rows.
    """

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self._totals: dict[str, dict[str, int]] = defaultdict(lambda: {ROWS: 0, DROPPED: 0, REJECTED: 0})

    def of(self, name: str) -> dict[str, int]:
        with self._lock:
            return dict(self._totals[name])

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._lock:
            own = self._totals[progress.name]
            own[ROWS] += progress.numInputRows
            own[DROPPED] += sum(state.numRowsDroppedByWatermark for state in progress.stateOperators)
            own[REJECTED] += sum(row[REJECTED] for row in progress.observedMetrics.values())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


@contextmanager
def watched(spark: SparkSession) -> Iterator[Totals]:
    """Totals of the queries that run meanwhile."""
    totals = Totals()
    spark.streams.addListener(totals)
    try:
        yield totals
    finally:
        spark.streams.removeListener(totals)


def run_until_idle(spark: SparkSession, queries: Sequence[StreamingQuery], quiet: int = 3, wait: int = 1) -> None:
    """Let queries with a processing-time trigger run until none has had data ``quiet`` times in a row.

    Waits on any of them to end, so the failure of one is raised at once; in the end all are stopped.
    """
    calm = 0
    try:
        while calm < quiet:
            if spark.streams.awaitAnyTermination(wait):
                for query in queries:
                    if not query.isActive and query.exception():
                        raise query.exception()
                spark.streams.resetTerminated()
            busy = any(
                query.isActive
                and (query.lastProgress is None or query.status["isDataAvailable"] or query.status["isTriggerActive"])
                for query in queries
            )
            calm = 0 if busy else calm + 1
    finally:
        for query in queries:
            query.stop()
        spark.streams.resetTerminated()
    # The listener hears of the last batches a moment later.
    time.sleep(1)
