"""What streams have counted, batch by batch.

Rows are counted by observed metrics of the frames themselves and reach the driver through a listener: the
progress that a query keeps covers its last hundred batches only, and its input rows count a file twice where
two branches of a query read it.
"""

from __future__ import annotations

import threading
from collections import Counter
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

N = "n"
BATCHES = "_batches"  # how many batches have counted, among the rows by name


def counted(df: DataFrame, name: str) -> DataFrame:
    """The frame, with its rows counted under a name in each batch."""
    return df.observe(name, F.count(F.lit(1)).alias(N))


class _Listener(StreamingQueryListener):
    def __init__(self):
        self._batches: dict[str, dict[int, dict[str, int]]] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def ended(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def batches(self, run: str) -> dict[int, dict[str, int]]:
        with self._lock:
            return dict(self._batches.get(run, {}))

    def forget(self, run: str) -> None:
        with self._lock:
            self._batches.pop(run, None)
            self._ended.pop(run, None)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = {name: row[N] for name, row in progress.observedMetrics.items() if N in row}
        with self._lock:
            self._batches.setdefault(str(progress.runId), {}).setdefault(progress.batchId, {}).update(seen)

    def onQueryTerminated(self, event) -> None:
        self.ended(str(event.runId)).set()


_listeners: WeakKeyDictionary[SparkSession, _Listener] = WeakKeyDictionary()


def listen(spark: SparkSession) -> _Listener:
    """The session's listener. Call it before a query starts, or its first batches are missed."""
    if spark not in _listeners:
        listener = _Listener()
        spark.streams.addListener(listener)
        _listeners[spark] = listener
    return _listeners[spark]


def by_batch(spark: SparkSession, query: StreamingQuery) -> dict[int, dict[str, int]]:
    """Rows by name of each batch so far."""
    return listen(spark).batches(str(query.runId))


def totals(spark: SparkSession, query: StreamingQuery) -> Counter[str]:
    """Rows by name over all batches so far; a name that has not counted gives zero."""
    out: Counter[str] = Counter()
    for counts in by_batch(spark, query).values():
        out.update({**counts, BATCHES: 1})
    return out


def finish(spark: SparkSession, query: StreamingQuery, wait_seconds: float = 120.0) -> Counter[str]:
    """Wait for a query that stops by itself; give its rows by name. The end of a query comes to the listener
    after all of its batches."""
    listener, run = listen(spark), str(query.runId)
    query.awaitTermination()
    if not listener.ended(run).wait(wait_seconds):
        raise RuntimeError(f"the listener has not heard of the end of stream {run}")
    found = totals(spark, query)
    listener.forget(run)
    return found
