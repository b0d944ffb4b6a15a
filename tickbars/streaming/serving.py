"""The serving table: recent entries per topic and ticker, bounded by retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickbars.operators.latest import RETENTION, keep_last, latest_bar, latest_n
from tickbars.operators.messages import (
    BAR_FIELDS,
    INDICATOR_FIELDS,
    as_bars,
    as_indicators,
    serving_entries,
)
from tickbars.operators.ranges import NEWEST, OLDEST, entry_range, in_time
from tickbars.session import exists, file_system, make_folder, remove

# The topics read when none is named.
BAR_TOPIC = "OHLC_5M"
INDICATOR_TOPIC = "OHLC_5M_EMA_9"

_TEXT_COLUMNS = [*BAR_FIELDS.values(), *INDICATOR_FIELDS.values()]

ENTRY = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("ticker", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("entry_id", T.LongType()),
        T.StructField("kind", T.StringType()),
        *[T.StructField(name, T.StringType()) for name in _TEXT_COLUMNS],
    ]
)
_NUMBERS = {"open", "high", "low", "close", "volume"}

#: A read of one key opens only the row groups that may hold it, by dictionary or bloom
#: filter, and of those only the pages that hold its ids, by the column index.
_FILES = {
    "parquet.bloom.filter.enabled#topic": "true",
    "parquet.bloom.filter.enabled#ticker": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
    "parquet.block.size": str(16 << 20),
    "parquet.page.row.count.limit": "2000",
}


class ServingTable:
    """Parquet in two kinds of parts: one per micro-batch, and snapshots of all so far.

    A part is named by its batch id and written by overwriting, so a batch that runs
    again after a failure leaves no entry twice. No part has more than ``keep`` entries
    per topic and ticker, and rows are sorted by both, so that a read of one skips the
    others. Every ``compact_every`` batches a snapshot takes all; what the snapshot before
    it had replaced is then deleted, so readers have as long as ``compact_every`` batches,
    and the number of parts is bounded. Reads find the newest snapshot by its folder's
    name and apply the same bound, so it holds exactly at any time.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keep: int = RETENTION,
        compact_every: int = 50,
    ):
        self.spark = spark
        self.path = path
        self.keep = keep
        self.compact_every = compact_every

    def append(self, entries: DataFrame, batch_id: int) -> None:
        rows = entries.select(ENTRY.names)
        if (batch_id + 1) % self.compact_every:
            self._write(rows, "batch", batch_id)
            return
        before = self._newest_snapshot(batch_id)
        self._write(self._stored(batch_id).unionByName(rows), "snapshot", batch_id)
        self._delete_before(before)

    def read(self) -> DataFrame:
        """The newest ``keep`` entries of each topic and ticker."""
        return self._bounded(self._stored())

    def bars(
        self, ticker: str, count: int | None = None, topic: str = BAR_TOPIC
    ) -> DataFrame:
        """The newest ``count`` bars of a ticker, oldest first."""
        return in_time(as_bars(self._newest(topic, ticker, count)))

    def indicators(
        self, ticker: str, count: int | None = None, topic: str = INDICATOR_TOPIC
    ) -> DataFrame:
        """The newest ``count`` indicator values of a ticker, oldest first."""
        return in_time(as_indicators(self._newest(topic, ticker, count)))

    def indicator_range(
        self,
        ticker: str,
        min_id: int | str = OLDEST,
        max_id: int | str = NEWEST,
        count: int | None = None,
        topic: str = INDICATOR_TOPIC,
    ) -> DataFrame:
        """Indicator values of a ticker with ids in a range, both ends included.

        Only ids from the range on are read: what lies before it is neither in it nor
        among the newest that retention keeps.
        """
        entries = self._newest(topic, ticker, None, min_id)
        return in_time(as_indicators(entry_range(entries, None, min_id, max_id, count)))

    def point(self, ticker: str, entry_id: int, topic: str = BAR_TOPIC) -> DataFrame:
        """The entry of one id, if retention still has it."""
        entries = self._newest(topic, ticker, None, entry_id)
        return entries.filter(F.col("entry_id") == entry_id)

    def _newest(
        self, topic: str, ticker: str, count: int | None, least: int | str = OLDEST
    ) -> DataFrame:
        key = (F.col("topic") == topic) & (F.col("ticker") == ticker)
        if least != OLDEST:
            key = key & (F.col("entry_id") >= int(least))
        # Filtered first: nothing is pushed through the cut, which goes by task.
        stored = self._bounded(self._stored().filter(key))
        return latest_n(stored, ["topic", "ticker"], ["entry_id"], count)

    def header(
        self, ticker: str, topic: str = BAR_TOPIC, indicator_topic: str = INDICATOR_TOPIC
    ) -> DataFrame:
        """A ticker's newest served bar, its change, and its newest indicator value."""
        bars, means = self.bars(ticker, 2, topic), self.indicators(ticker, 1, indicator_topic)
        return latest_bar(
            bars.select(
                "ticker",
                F.col("timestamp").alias("window_end"),
                *[F.col(new).alias(old) for old, new in BAR_FIELDS.items() if new in _NUMBERS],
            ),
            means.select(
                "ticker", F.col("timestamp").alias("snapshot_time"), F.col("ema").alias("ema_value")
            ),
        )

    def vacuum(self) -> None:
        """Delete the parts the newest snapshot replaces; readers of them must be done."""
        self._delete_before(self._newest_snapshot())

    def _delete_before(self, snapshot: int) -> None:
        for part, stale in (("batch", snapshot), ("snapshot", snapshot - 1)):
            for batch_id in self._ids(part):
                if batch_id <= stale:
                    remove(self.spark, self._folder(part, batch_id))

    def _folder(self, part: str, batch_id: int) -> str:
        return f"{self.path}/part={part}/upto={batch_id}"

    def _write(self, rows: DataFrame, part: str, batch_id: int) -> None:
        folder = self._folder(part, batch_id)
        sorted_rows = self._bounded(rows).sortWithinPartitions("topic", "ticker", "entry_id")
        sorted_rows.write.mode("overwrite").options(**_FILES).parquet(folder)
        # A marker of our own: whether a job writes _SUCCESS is a setting.
        make_folder(self.spark, f"{folder}/_whole")

    def _bounded(self, rows: DataFrame) -> DataFrame:
        return keep_last(rows, ["topic", "ticker"], ["entry_id"], self.keep)

    def _ids(self, part: str) -> list[int]:
        """Batch ids of the parts that were written to their end, from folder names."""
        fs, folder = file_system(self.spark, f"{self.path}/part={part}")
        if not fs.exists(folder):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(folder)]
        ids = [int(name[5:]) for name in names if name.startswith("upto=")]
        return [i for i in ids if exists(self.spark, f"{self._folder(part, i)}/_whole")]

    def _newest_snapshot(self, before: int | None = None) -> int:
        return max((i for i in self._ids("snapshot") if before is None or i < before), default=-1)

    def _stored(self, before: int | None = None) -> DataFrame:
        newest = self._newest_snapshot(before)
        later = [i for i in self._ids("batch") if i > newest and (before is None or i < before)]
        folders = [self._folder("batch", i) for i in later]
        if newest >= 0:
            folders.append(self._folder("snapshot", newest))
        if not folders:
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).parquet(*folders)


def serve_job(
    messages: DataFrame,
    table: ServingTable,
    checkpoint: str,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Land a stream of topic, value and offset in the serving table."""
    writer = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: table.append(serving_entries(batch), batch_id)
    )
    if processing_time is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=processing_time).start()
