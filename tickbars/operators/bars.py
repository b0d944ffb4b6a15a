"""Tumbling open/high/low/close/volume bars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbars.functions.times import NANOS_PER_SECOND
from tickbars.operators.metric import MARKET_TOPIC, StreamedMetric
from tickbars.schemas import BAR


class Ohlc(StreamedMetric):
    """One bar per ticker and ``window_minutes``, aligned to the epoch, end exclusive.

    Open and close are the first and last price in ``order``. By default that is the
    arrival position, which every source of this package stamps in time order: one
    fixed-width column, so Spark aggregates by hash and only one row per task, ticker
    and window is shuffled, however hot the ticker is. Several columns, such as
    ``("Timestamp", "Arrival")`` for rows whose arrival does not follow time, make Spark
    sort its input before the partial aggregation instead.
    """

    schema = BAR

    def __init__(
        self,
        window_minutes: int = 5,
        *,
        order: str | Sequence[str] = "Arrival",
        source_table: str = MARKET_TOPIC,
        target_table: str | None = None,
    ):
        self.window_minutes = window_minutes
        self.order = [order] if isinstance(order, str) else list(order)
        super().__init__(source_table, target_table)

    @property
    def name(self) -> str:
        return f"OHLC_{self.window_minutes}M"

    def batch(self, ticks: DataFrame) -> DataFrame:
        # A bigint start second is a narrower key than a window struct.
        seconds = F.call_function("div", F.col("Timestamp"), F.lit(NANOS_PER_SECOND))
        width = F.lit(self.window_minutes * 60)
        bars = (
            ticks.filter(F.col("Timestamp").isNotNull())
            .groupBy(
                F.col("Ticker").alias("ticker"),
                (seconds - F.pmod(seconds, width)).alias("start"),
            )
            .agg(*self._prices())
        )
        return bars.select(
            "ticker",
            F.timestamp_seconds("start").alias("window_start"),
            F.timestamp_seconds(F.col("start") + width).alias("window_end"),
            *_PRICE_COLUMNS,
        )

    def stream(self, ticks: DataFrame) -> DataFrame:
        """Needs a watermark on ``event_time``; a bar comes out once, when it is closed."""
        window = F.window("event_time", f"{self.window_minutes} minutes")
        return (
            ticks.groupBy(F.col("Ticker").alias("ticker"), window)
            .agg(*self._prices())
            .select(
                "ticker",
                F.col("window.start").alias("window_start"),
                F.col("window.end").alias("window_end"),
                *_PRICE_COLUMNS,
            )
        )

    def _prices(self) -> list[Column]:
        order = F.col(self.order[0]) if len(self.order) == 1 else F.struct(*self.order)
        # A tick without a price neither opens nor closes a bar.
        order = F.when(F.col("Price").isNotNull(), order)
        return [
            F.min_by("Price", order).alias("open_price"),
            F.max("Price").alias("high_price"),
            F.min("Price").alias("low_price"),
            F.max_by("Price", order).alias("close_price"),
            F.sum("Quantity").alias("volume"),
        ]


_PRICE_COLUMNS = ["open_price", "high_price", "low_price", "close_price", "volume"]
