"""Keeps the metrics of a streaming job alive together."""

from __future__ import annotations

import queue
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tickbars.operators.metric import MARKET_TOPIC, Metric
from tickbars.streaming.hops import Hop
from tickbars.streaming.jobs import metric_starters

#: How often a metric is started again before the job is given up.
MOST_RESTARTS = 5


class JobFailed(Exception):
    """A metric failed more often than the job allows."""


class _Ends(StreamingQueryListener):
    """Puts the run ids of queries that end into a queue, with what they failed of."""

    def __init__(self) -> None:
        self.seen: queue.SimpleQueue[tuple[str, str | None]] = queue.SimpleQueue()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.seen.put((str(event.runId), event.exception))


class Supervisor:
    """The metrics of ``stream_job`` running side by side, restarted when one fails.

    One listener hears of every query that ends. When a metric fails, those that build on
    its table, directly or not, are stopped first; then it and they are started again in
    order, each from its own checkpoint, so what was written stays and what was not comes
    once. The others go on untouched. A metric that fails more than ``most_restarts``
    times ends the job: all are stopped, and ``watch`` raises ``JobFailed``.
    """

    def __init__(
        self,
        spark: SparkSession,
        source: Callable[[], DataFrame],
        root: str,
        metrics: Sequence[Metric] | None = None,
        *,
        processing_time: str = "1 second",
        partitions: int | None = None,
        hop: Hop | None = None,
        most_restarts: int = MOST_RESTARTS,
    ):
        """``source`` gives the stream of ticks anew for every start of a metric on it."""
        self.spark = spark
        self.starters = metric_starters(
            spark, source, root, metrics, processing_time, partitions, hop
        )
        self.most = most_restarts
        self.restarts = dict.fromkeys(self.starters, 0)
        self.running: dict[str, StreamingQuery] = {}
        self._ends = _Ends()

    def __enter__(self) -> Supervisor:
        self.spark.streams.addListener(self._ends)
        try:
            self._start(self.starters)
        except BaseException:
            self.stop()
            raise
        return self

    def __exit__(self, *_) -> None:
        self.stop()

    def stop(self) -> None:
        """Stop every metric, those that build on others first."""
        for table in reversed(list(self.running)):
            self.running.pop(table).stop()
        self.spark.streams.removeListener(self._ends)

    def watch(self, seconds: float) -> None:
        """Look after the metrics for so long."""
        until = time.monotonic() + seconds
        while (left := until - time.monotonic()) > 0:
            try:
                run, failure = self._ends.seen.get(timeout=left)
            except queue.Empty:
                return
            self._ended(run, failure)

    def process_all(self) -> None:
        """Until every metric has taken what its source held, whatever fails meanwhile."""
        for table in list(self.starters):
            while True:
                query = self.running[table]
                try:
                    query.processAllAvailable()
                    break
                except Exception:
                    # Its end is in the queue, or about to be; then it runs again.
                    run = str(query.runId)
                    while str(self.running[table].runId) == run:
                        self.watch(0.2)

    def _ended(self, run: str, failure: str | None) -> None:
        found = [t for t, q in self.running.items() if str(q.runId) == run]
        if not found or failure is None:
            # One that was stopped here, or a query that is not of this job.
            return
        [table] = found
        self.restarts[table] += 1
        if self.restarts[table] > self.most:
            self.stop()
            raise JobFailed(f"{table} failed {self.restarts[table]} times: {failure}")
        again = [table, *self.dependants(table)]
        for name in reversed(again):
            self.running[name].stop()
        self._start(again)

    def dependants(self, table: str) -> list[str]:
        """The metrics that build on ``table``, in the order in which they start."""
        found = {table}
        for name, (metric, _) in self.starters.items():
            if metric.source_table != MARKET_TOPIC and metric.source_table in found:
                found.add(name)
        return [name for name in self.starters if name in found and name != table]

    def _start(self, tables) -> None:
        for table in tables:
            self.running[table] = self.starters[table][1]()
        # Dependants stand behind what they build on, however often it was started.
        self.running = {t: self.running[t] for t in self.starters if t in self.running}
