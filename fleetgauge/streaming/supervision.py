"""What became of the streaming queries of a session: end, error, dropped rows."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

OUTCOME = ("query STRING, batches BIGINT, rows BIGINT, dropped BIGINT, ended BOOLEAN, "
           "stopped BOOLEAN, error STRING")


@dataclass
class Outcome:
    """One run of a query; ``dropped`` are the rows that came after the watermark."""

    query: str
    batches: set[int] = field(default_factory=set)
    rows: int = 0
    dropped: int = 0
    ended: bool = False
    stopped: bool = False
    error: str | None = None


class Supervisor(StreamingQueryListener):
    """Counts per run of a query. Its memory grows with the runs, not with their batches' rows."""

    def __init__(self) -> None:
        self._changed = threading.Condition()
        self._runs: dict[str, Outcome] = {}

    def onQueryStarted(self, event) -> None:
        with self._changed:
            self._runs[str(event.runId)] = Outcome(event.name or str(event.id))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._changed:
            run = self._runs.setdefault(
                str(progress.runId), Outcome(progress.name or str(progress.id)))
            # a trigger without new data may report an earlier batch again
            run.batches.add(progress.batchId)
            run.rows += progress.numInputRows
            run.dropped += sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            run = self._runs.setdefault(str(event.runId), Outcome(str(event.id)))
            run.ended = True
            # a query that is stopped within a batch reports that as an error
            run.error = None if run.stopped else event.exception
            self._changed.notify_all()

    def stop(self, query: StreamingQuery) -> None:
        """Stop a query that has not ended by itself."""
        with self._changed:
            run = self._runs.setdefault(
                str(query.runId), Outcome(query.name or str(query.id)))
            run.stopped = query.isActive and not run.ended
        query.stop()

    def wait(self, seconds: float) -> bool:
        """Whether every run has been reported as ended, within ``seconds``.

        Reports come after a query has ended, in order; one that ended has no more to come.
        """
        with self._changed:
            return self._changed.wait_for(
                lambda: all(run.ended for run in self._runs.values()), seconds)

    def failed(self) -> bool:
        with self._changed:
            return any(run.error is not None for run in self._runs.values())

    def outcomes(self, spark: SparkSession) -> DataFrame:
        """A row per run: ``query, batches, rows, dropped, ended, stopped, error``."""
        with self._changed:
            rows = [(r.query, len(r.batches), r.rows, r.dropped, r.ended, r.stopped, r.error)
                    for r in self._runs.values()]
        return spark.createDataFrame(rows, OUTCOME)


@contextmanager
def supervised(spark: SparkSession) -> Iterator[Supervisor]:
    """A supervisor of the queries that are started within."""
    supervisor = Supervisor()
    spark.streams.addListener(supervisor)
    try:
        yield supervisor
    finally:
        spark.streams.removeListener(supervisor)


def await_outcomes(spark: SparkSession, supervisor: Supervisor, stop_others: bool = False,
                   seconds: float = 60.0) -> DataFrame:
    """Block until all active queries have ended; what became of each.

    A query that fails leaves the others running, or stops them if ``stop_others``. Its
    error is a value of the result and is not raised. ``seconds`` bounds the wait for the
    reports after the last query has ended.
    """
    while active := spark.streams.active:
        if stop_others and supervisor.failed():
            for query in active:
                supervisor.stop(query)
        else:
            supervisor.wait(1.0)
    supervisor.wait(seconds)
    return supervisor.outcomes(spark)
