"""Partial bars: what a bar needs to be merged with others, so that ticks are read once.

A partial bar also has the places of its open and close in the order of ticks, and the
number of ticks. Merging takes the open of the least place and the close of the greatest,
whatever order the parts come in; so wider bars come from narrower ones, and a file that
lands late is merged in without a look at the ticks that are already counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.operators.bars import Ohlc
from tickbars.schemas import BAR
from tickbars.session import exists

PARTIAL = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("open_price", T.DoubleType()),
        T.StructField("open_at", T.LongType()),
        T.StructField("high_price", T.DoubleType()),
        T.StructField("low_price", T.DoubleType()),
        T.StructField("close_price", T.DoubleType()),
        T.StructField("close_at", T.LongType()),
        T.StructField("volume", T.LongType()),
        T.StructField("ticks", T.LongType()),
    ]
)
_VALUES = PARTIAL.names[2:]


def counted(order: str = "Arrival") -> list[Column]:
    """A partial bar's values as aggregates over ticks; ``order`` is a bigint column."""
    # A tick without a price neither opens nor closes a bar.
    place = F.when(F.col("Price").isNotNull(), F.col(order))
    return [
        F.min_by("Price", place).alias("open_price"),
        F.min(place).alias("open_at"),
        F.max("Price").alias("high_price"),
        F.min("Price").alias("low_price"),
        F.max_by("Price", place).alias("close_price"),
        F.max(place).alias("close_at"),
        F.sum("Quantity").alias("volume"),
        F.count("*").alias("ticks"),
    ]


def merged() -> list[Column]:
    """The same values as aggregates over partial bars."""
    return [
        F.min_by("open_price", "open_at").alias("open_price"),
        F.min("open_at").alias("open_at"),
        F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"),
        F.max_by("close_price", "close_at").alias("close_price"),
        F.max("close_at").alias("close_at"),
        F.sum("volume").alias("volume"),
        F.sum("ticks").alias("ticks"),
    ]


def partial_bars(ticks: DataFrame, minutes: int, order: str = "Arrival") -> DataFrame:
    """One partial bar per ticker and ``minutes``: one hash aggregate, one shuffle."""
    start = _window_start(F.unix_seconds("event_time"), minutes)
    return (
        ticks.filter(F.col("event_time").isNotNull())
        .groupBy(F.col("Ticker").alias("ticker"), start.alias("start"))
        .agg(*counted(order))
        .select("ticker", F.timestamp_seconds("start").alias("window_start"), *_VALUES)
    )


def merge_bars(partials: DataFrame, minutes: int) -> DataFrame:
    """Partial bars of ``minutes`` from any as narrow or narrower whose width divides it."""
    start = _window_start(F.unix_seconds("window_start"), minutes)
    return (
        partials.groupBy("ticker", start.alias("start"))
        .agg(*merged())
        .select("ticker", F.timestamp_seconds("start").alias("window_start"), *_VALUES)
    )


def as_bars(partials: DataFrame, minutes: int) -> DataFrame:
    """Merged partial bars of ``minutes`` as bars."""
    end = F.timestamp_seconds(F.unix_seconds("window_start") + minutes * 60)
    return partials.withColumn("window_end", end).select(BAR.names)


def _window_start(seconds: Column, minutes: int) -> Column:
    return seconds - F.pmod(seconds, F.lit(minutes * 60))


class BarLevels:
    """Partial bars of several widths under ``root``, kept by landed file and day.

    A file's ticks are read once, for the narrowest bars; each wider level is merged from
    the file's part of the level before. A file that lands again replaces its own parts.
    One that lands late, with ticks of windows that have bars already, adds parts to
    their days, and reads merge them: nothing that was written before is opened.
    """

    def __init__(self, spark: SparkSession, root: str, minutes: Sequence[int] = (5, 60, 1440)):
        for narrow, wide in zip(minutes, minutes[1:]):
            if wide % narrow:
                raise ValueError(f"{wide} minutes are no multiple of {narrow}")
        self.spark = spark
        self.root = root
        self.minutes = list(minutes)

    def add(self, ticks: DataFrame, name: str, order: str = "Arrival") -> None:
        """Land the ticks of the file ``name``."""
        part = partial_bars(ticks, self.minutes[0], order)
        for place, minutes in enumerate(self.minutes):
            if place:
                part = merge_bars(self._part(self.minutes[place - 1], name), minutes)
            self._write(part, minutes, name)

    def partials(self, minutes: int) -> DataFrame:
        """One partial bar per ticker and window, over all files."""
        return merge_bars(self._stored(minutes), minutes)

    def bars(self, minutes: int) -> DataFrame:
        return as_bars(self.partials(minutes), minutes)

    def changed(self, minutes: int, name: str) -> DataFrame:
        """The bars that the file ``name`` has a part in, with it: what readers of bars
        have to take anew when it lands late. Other days are not read."""
        own = self._part(minutes, name).select("day", "ticker", "window_start")
        touched = self._stored(minutes).join(own, ["day", "ticker", "window_start"], "semi")
        return as_bars(merge_bars(touched, minutes), minutes)

    def rewrite(self, root: str) -> BarLevels:
        """The same bars under a new ``root`` with one part a day, for faster reads."""
        levels = BarLevels(self.spark, root, self.minutes)
        for minutes in self.minutes:
            levels._write(self.partials(minutes), minutes, "all")
        return levels

    def _write(self, partials: DataFrame, minutes: int, name: str) -> None:
        (
            partials.withColumn("day", F.date_format("window_start", "yyyyMMdd"))
            .hint("rebalance", "day")
            .sortWithinPartitions("day", "ticker", "window_start")
            .write.mode("overwrite")
            .partitionBy("day")
            .parquet(self._folder(minutes, name))
        )

    def _folder(self, minutes: int, name: str) -> str:
        return f"{self.root}/minutes={minutes}/file={name}"

    def _part(self, minutes: int, name: str) -> DataFrame:
        return self._stored(minutes).where(F.col("file") == name)

    def _stored(self, minutes: int) -> DataFrame:
        parts = [T.StructField(name, T.StringType()) for name in ("file", "day")]
        schema = T.StructType([*PARTIAL.fields, *parts])
        level = f"{self.root}/minutes={minutes}"
        if not exists(self.spark, level):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", level).parquet(level)


class ChainedOhlc(Ohlc):
    """Bars made of narrower bars within one streaming query, as two chained aggregations.

    The narrow bars close when the watermark passes them and then go on as rows at their
    ``window_time``; the wide ones close by the watermark that the first step hands down.
    State is one row per open narrow and per open wide window, however many ticks there
    are. In batch the two steps are merged, and the bars are those of ``Ohlc``.
    """

    def __init__(self, window_minutes: int = 60, source_minutes: int = 5, **given):
        if window_minutes % source_minutes:
            raise ValueError(f"{window_minutes} minutes are no multiple of {source_minutes}")
        self.source_minutes = source_minutes
        super().__init__(window_minutes, **given)
        if len(self.order) > 1:
            raise ValueError("places of merged bars are one column")

    def batch(self, ticks: DataFrame) -> DataFrame:
        narrow = partial_bars(ticks, self.source_minutes, self.order[0])
        return as_bars(merge_bars(narrow, self.window_minutes), self.window_minutes)

    def stream(self, ticks: DataFrame) -> DataFrame:
        narrow = ticks.groupBy(
            F.col("Ticker").alias("ticker"),
            F.window("event_time", f"{self.source_minutes} minutes"),
        ).agg(*counted(self.order[0]))
        wide = F.window(F.window_time("window"), f"{self.window_minutes} minutes")
        return (
            narrow.groupBy("ticker", wide)
            .agg(*merged())
            .select(
                "ticker",
                F.col("window.start").alias("window_start"),
                F.col("window.end").alias("window_end"),
                *BAR.names[3:],
            )
        )
