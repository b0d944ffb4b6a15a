"""The streaming job: metrics over one source, each written to its own table."""

from __future__ import annotations

import functools
import threading
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tickbars.operators.bars import Ohlc
from tickbars.operators.metric import MARKET_TOPIC, Metric, StreamedMetric
from tickbars.operators.rolling import RollingMean
from tickbars.schemas import TICK
from tickbars.session import (
    ROCKSDB_PROVIDER,
    exists,
    file_system,
    make_folder,
    session_conf,
)
from tickbars.streaming.hops import Hop, TableHop
from tickbars.streaming.means import MeanTable, start_mean

# How far event time and bar time wait for late rows.
EVENT_DELAY = "2 seconds"
BAR_DELAY_SECONDS = 5

_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    # State is uploaded as changes, not as whole snapshots, on every batch.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def stream_conf(partitions: int | None) -> dict[str, str]:
    """State settings. A stream keeps its partition count for life, and it is not
    coalesced at run time: give ``partitions`` where the session's count does not suit
    the cluster."""
    count = {} if partitions is None else {"spark.sql.shuffle.partitions": str(partitions)}
    return {**_STATE_CONF, **count}


def default_metrics() -> list[Metric]:
    """Five-minute bars and their rolling means over 9 and 12 bars."""
    bars = Ohlc(window_minutes=5)
    return [
        bars,
        RollingMean(9, source_table=bars.target_table),
        RollingMean(12, source_table=bars.target_table),
    ]


def with_event_watermark(ticks: DataFrame, delay: str = EVENT_DELAY) -> DataFrame:
    return ticks.withWatermark("event_time", delay)


def start_table(
    df: DataFrame,
    root: str,
    table: str,
    processing_time: str | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """Append a stream to the Parquet table ``root/table``; its checkpoint lies beside it.

    Without ``processing_time`` the query takes what there is and ends.
    """
    return _start(TableHop(df.sparkSession, root), df, root, table, processing_time, partitions)


def _start(
    hop: Hop,
    rows: DataFrame,
    root: str,
    table: str,
    processing_time: str | None,
    partitions: int | None,
) -> StreamingQuery:
    trigger = (
        {"availableNow": True} if processing_time is None else {"processingTime": processing_time}
    )
    with session_conf(rows.sparkSession, stream_conf(partitions)):
        return hop.start(rows, table, f"{root}/_checkpoints/{table}", **trigger)


def stream_job(
    spark: SparkSession,
    source: DataFrame,
    root: str,
    metrics: Sequence[Metric] | None = None,
    processing_time: str | None = None,
    partitions: int | None = None,
    max_files_per_trigger: int | None = None,
    hop: Hop | None = None,
) -> dict[str, StreamingQuery]:
    """Start every metric; one that builds on another reads what that one writes.

    ``hop`` is where metrics go: Parquet tables under ``root`` unless it is given. Bars
    are stored anyway, so means read them from there instead of repeating the aggregation.
    Without ``processing_time`` each query runs to its end, in the order given, and is
    finished on return; otherwise all of them keep running side by side. Checkpoints, and
    the tails and tables of means, are under ``root``.
    """
    hop = TableHop(spark, root, max_files_per_trigger) if hop is None else hop
    starters = metric_starters(
        spark, lambda: source, root, metrics, processing_time, partitions, hop
    )
    queries = {}
    for table, (_, start) in starters.items():
        queries[table] = start()
        if processing_time is None:
            queries[table].awaitTermination()
    return queries


def metric_starters(
    spark: SparkSession,
    source: Callable[[], DataFrame],
    root: str,
    metrics: Sequence[Metric] | None = None,
    processing_time: str | None = None,
    partitions: int | None = None,
    hop: Hop | None = None,
) -> dict[str, tuple[Metric, Callable[[], StreamingQuery]]]:
    """Per target table the metric and what starts it, in the order given.

    A start goes on from the metric's checkpoint, so it can be repeated after a failure.
    """
    metrics = default_metrics() if metrics is None else metrics
    hop = TableHop(spark, root) if hop is None else hop
    schemas = {m.target_table: m.schema for m in metrics}

    def start(metric: Metric) -> StreamingQuery:
        if metric.source_table == MARKET_TOPIC:
            rows = source()
        else:
            rows = hop.stream(metric.source_table, schemas[metric.source_table])
        table = metric.target_table
        if isinstance(metric, StreamedMetric):
            stream = metric.stream(with_event_watermark(rows))
            return _start(hop, stream, root, table, processing_time, partitions)
        means = MeanTable(spark, metric, root, BAR_DELAY_SECONDS, hop.append(table))
        return start_mean(means, rows, root, processing_time)

    return {m.target_table: (m, functools.partial(start, m)) for m in metrics}


def land(ticks: DataFrame, folder: str, name: str) -> None:
    """Add ``ticks`` as ``folder/name``, whole at once: streams that read ``folder/*`` while
    it is written see none of it or all. Where renaming a folder takes several steps, as on
    object stores, land while the streams rest, as ``replay`` does."""
    spark = ticks.sparkSession
    beside = f"{folder.rstrip('/')}-landing/{name}"
    ticks.select(TICK.names).write.mode("overwrite").parquet(beside)
    make_folder(spark, folder)
    fs, source = file_system(spark, beside)
    if not fs.rename(source, file_system(spark, f"{folder}/{name}")[1]):
        raise OSError(f"{folder}/{name} could not be landed")


class LateRows(StreamingQueryListener):
    """Counts the rows behind the watermark of every query while it listens.

    A query's own record of its progress has the last hundred micro-batches only.
    """

    def __init__(self) -> None:
        self._rows: dict[str, int] = {}
        self._over: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:
        self._over.setdefault(str(event.runId), threading.Event())

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        late = sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)
        self._rows[run] = self._rows.get(run, 0) + late

    def onQueryTerminated(self, event) -> None:
        self._over.setdefault(str(event.runId), threading.Event()).set()

    def count(self, query: StreamingQuery, wait_seconds: float = 60) -> int:
        """Late rows of a query that has ended, after partial aggregation."""
        run = str(query.runId)
        if not self._over.setdefault(run, threading.Event()).wait(wait_seconds):
            raise TimeoutError(f"no end of query {query.name} was reported")
        return self._rows.get(run, 0)


@contextmanager
def counted_late_rows(spark: SparkSession) -> Iterator[LateRows]:
    listener = LateRows()
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        spark.streams.removeListener(listener)


def replay(
    spark: SparkSession,
    slices: Iterable[DataFrame],
    root: str,
    metrics: Sequence[Metric] | None = None,
) -> int:
    """Stream history in time order and return the number of late rows of its bars.

    ``slices`` are ticks in chronological order, such as one day's files each. A slice is
    landed whole and streamed to the end before the next, so that the watermark never
    passes rows that are still to come, however the files within it are ordered. Run
    again with the same slices after a failure, it lands none twice and goes on.
    """
    landing = f"{root}/ticks"
    late = 0
    with counted_late_rows(spark) as listener:
        for number, ticks in enumerate(slices):
            part = f"{landing}/{number:06d}"
            landed = f"{root}/_landed/{number:06d}"
            # A marker of our own: whether a job writes _SUCCESS is a setting.
            if not exists(spark, landed):
                ticks.select(TICK.names).write.mode("overwrite").parquet(part)
                make_folder(spark, landed)
            source = spark.readStream.schema(TICK).parquet(f"{landing}/*")
            for query in stream_job(spark, source, root, metrics).values():
                late += listener.count(query)
    return late


def open_bars(ticks: DataFrame, bars: Ohlc, delay_seconds: int = 2) -> DataFrame:
    """The bars a finished stream has not emitted, because no later event closed them.

    They are a batch query over the last ticks only; written to the stream's own table
    they would come twice, once the stream goes on.
    """
    # One value, as a number: a clock time would go through the driver's own zone.
    newest = ticks.agg(F.max(F.unix_seconds("event_time"))).first()[0]
    if newest is None:
        return bars.batch(ticks)
    watermark = newest - delay_seconds
    width = bars.window_minutes * 60
    # A window ends after the watermark when it starts in or after the watermark's own.
    # Compared as a timestamp, the bound reaches the scan of a stored tick table.
    oldest_open = F.timestamp_seconds(F.lit(watermark - watermark % width))
    return bars.batch(ticks.filter(F.col("event_time") >= oldest_open))
