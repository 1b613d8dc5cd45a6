"""Ending a running stream: when it has nothing to do for a while, or after so many messages."""

from __future__ import annotations

import threading
import time

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class _Watch(StreamingQueryListener):
    """Rows per batch of one run of a query, and when the last of them came."""

    def __init__(self, run: str):
        self._run = run
        self._rows: dict[int, int] = {}
        self.changed = threading.Condition()
        self.last = self.empty = time.monotonic()

    def note(self, batch: int, rows: int) -> None:
        with self.changed:
            if rows and batch not in self._rows:
                self._rows[batch] = rows
                self.last = time.monotonic()
            elif not rows:
                self.empty = time.monotonic()
            self.changed.notify_all()

    def total(self) -> int:
        return sum(self._rows.values())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if str(event.progress.runId) == self._run:
            self.note(event.progress.batchId, event.progress.numInputRows)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self._run:
            with self.changed:
                self.changed.notify_all()


def until(spark: SparkSession, query: StreamingQuery, *, idle: float | None = None, messages: int | None = None, poll: float = 0.2) -> str:
    """Wait until a running query of the session ``spark`` has read no row for ``idle`` seconds, or ``messages`` rows in all, then stop it.

    Returns ``idle``, ``messages`` or ``ended`` (it stopped by itself; a failure is raised). Only finished batches count, so at
    least ``messages`` rows were read: a stream's position moves by whole batches. A batch that is under way is not idle;
    one that the stop cuts off is repeated when the stream starts again from its checkpoint, so nothing is lost.
    """
    watch = _Watch(str(query.runId))
    spark.streams.addListener(watch)
    try:
        for done in query.recentProgress:
            watch.note(done.batchId, done.numInputRows)
        why = "ended"
        while query.isActive:
            if messages is not None and watch.total() >= messages:
                why = "messages"
                break
            status = query.status
            # a stream with timers keeps running batches without rows; a batch with rows tells of itself at its end only
            quiet = watch.empty if status["isTriggerActive"] or status["isDataAvailable"] else time.monotonic()
            if idle is not None and quiet - watch.last >= idle:
                why = "idle"
                break
            with watch.changed:
                watch.changed.wait(poll)
        if why == "ended":
            query.awaitTermination()
        else:
            query.stop()
        return why
    finally:
        spark.streams.removeListener(watch)
