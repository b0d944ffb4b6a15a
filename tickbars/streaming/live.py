"""Bars of a live stream that leave no window open, and the rows that came too late.

A window closes when the watermark has passed its end and its ticker gets rows, or when
its ticker has been silent for a while by the clock: then nothing newer may come to move
the watermark. Each bar comes out once. A row of a closed window is not dropped: it comes
out as it is, with the window it missed, so that late rows and the rows in bars are all
rows. This is the one streamed metric whose state needs a timer, and so a Python worker;
where neither silence nor late rows matter, ``Ohlc.stream`` is the native way.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from tickbars.schemas import BAR
from tickbars.session import exists, session_conf
from tickbars.streaming.jobs import stream_conf

IDLE_SECONDS = 5

_BAR_STATE = T.StructType(
    [
        *BAR.fields[3:],
        T.StructField("open_at", T.LongType()),
        T.StructField("close_at", T.LongType()),
        T.StructField("ticks", T.LongType()),
    ]
)
#: What a row that came too late still has, apart from the window it missed.
_LATE = T.StructType(
    [
        T.StructField("Timestamp", T.LongType()),
        T.StructField("Price", T.DoubleType()),
        T.StructField("Quantity", T.LongType()),
        T.StructField("Arrival", T.LongType()),
    ]
)
LIVE = T.StructType(
    [
        *BAR.fields,
        T.StructField("ticks", T.LongType()),
        *_LATE.fields,
        # "bar" or "late"
        T.StructField("kind", T.StringType()),
    ]
)
_MILLIS = 1000


class LiveBars(StatefulProcessor):
    """One ticker's open windows, by their start, and the time up to which all are closed."""

    def __init__(self, window_minutes: int, idle_seconds: int = IDLE_SECONDS):
        self.width = window_minutes * 60 * _MILLIS
        self.idle = idle_seconds * _MILLIS

    def init(self, handle) -> None:
        self._handle = handle
        self._windows = handle.getMapState("windows", "start bigint", _BAR_STATE)
        self._closed = handle.getValueState("closed", "until bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        closed = max(self._closed.get()[0] if self._closed.exists() else 0,
                     timerValues.getCurrentWatermarkInMs())
        for frame in rows:
            start = frame["Timestamp"] // 1_000_000
            start = start - start % self.width
            late = start + self.width <= closed
            if late.any():
                yield self._late(key[0], frame[late], start[late])
            for at, ticks in frame[~late].groupby(start[~late]):
                self._merge(int(at), ticks)
        yield from self._emitted(key[0], closed)
        # Also the windows that the watermark passed while the ticker had none.
        self._closed.update((closed,))
        for timer in list(self._handle.listTimers()):
            self._handle.deleteTimer(timer)
        self._handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        ends = [start + self.width for (start,) in self._windows.keys()]
        if ends:
            yield from self._emitted(key[0], max(ends))
            before = self._closed.get()[0] if self._closed.exists() else 0
            self._closed.update((max(before, *ends),))

    def close(self) -> None:
        pass

    def _merge(self, start: int, ticks: pd.DataFrame) -> None:
        priced = ticks[ticks["Price"].notna()].sort_values("Arrival")
        sizes = ticks["Quantity"].dropna()
        new = {
            "volume": int(sizes.sum()) if len(sizes) else None,
            "ticks": len(ticks),
        }
        if len(priced):
            prices, places = priced["Price"], priced["Arrival"]
            new |= {
                "open_price": float(prices.iloc[0]),
                "high_price": float(prices.max()),
                "low_price": float(prices.min()),
                "close_price": float(prices.iloc[-1]),
                "open_at": int(places.iloc[0]),
                "close_at": int(places.iloc[-1]),
            }
        if self._windows.containsKey((start,)):
            held = dict(zip(_BAR_STATE.names, self._windows.getValue((start,)), strict=True))
            new = _joined(held, new)
        self._windows.updateValue((start,), tuple(new.get(n) for n in _BAR_STATE.names))

    def _emitted(self, ticker: str, until: int) -> Iterator[pd.DataFrame]:
        """Bars of the windows that end by ``until``; they are forgotten."""
        done = sorted(start for (start,) in self._windows.keys() if start + self.width <= until)
        if not done:
            return
        rows = []
        for start in done:
            held = dict(zip(_BAR_STATE.names, self._windows.getValue((start,)), strict=True))
            rows.append({**held, "kind": "bar", **self._window(ticker, start)})
            self._windows.removeKey((start,))
        yield _frame(rows)

    def _late(self, ticker: str, frame: pd.DataFrame, start: pd.Series) -> pd.DataFrame:
        rows = frame[_LATE.names].to_dict("records")
        return _frame(
            [
                {**row, "kind": "late", **self._window(ticker, int(at))}
                for row, at in zip(rows, start, strict=True)
            ]
        )

    def _window(self, ticker: str, start: int) -> dict:
        times = [pd.Timestamp(at, unit="ms", tz="UTC") for at in (start, start + self.width)]
        return {"ticker": ticker, "window_start": times[0], "window_end": times[1]}


def _joined(a: dict, b: dict) -> dict:
    """One partial bar of two; places tell which opens and which closes."""
    out = {"ticks": a["ticks"] + b["ticks"]}
    volumes = [x["volume"] for x in (a, b) if x.get("volume") is not None]
    out["volume"] = sum(volumes) if volumes else None
    priced = [x for x in (a, b) if x.get("open_at") is not None]
    if priced:
        first = min(priced, key=lambda x: x["open_at"])
        last = max(priced, key=lambda x: x["close_at"])
        out |= {
            "open_price": first["open_price"],
            "open_at": first["open_at"],
            "high_price": max(x["high_price"] for x in priced),
            "low_price": min(x["low_price"] for x in priced),
            "close_price": last["close_price"],
            "close_at": last["close_at"],
        }
    return out


def _frame(rows: list[dict]) -> pd.DataFrame:
    """Rows of the output; whole numbers may be missing, and stay whole."""
    frame = pd.DataFrame(rows, columns=LIVE.names)
    for field in LIVE.fields:
        if isinstance(field.dataType, T.LongType):
            frame[field.name] = frame[field.name].astype("Int64")
        elif isinstance(field.dataType, T.DoubleType):
            frame[field.name] = frame[field.name].astype("float64")
    return frame


def live_bars(
    ticks: DataFrame, window_minutes: int = 5, idle_seconds: int = IDLE_SECONDS
) -> DataFrame:
    """Bars and late rows of a stream of ticks, in one stream; ``kind`` tells them apart.

    Needs a watermark on ``event_time``. Rows without a time take no part. Ticks are read
    in whole Arrow batches per ticker; state is a row per open window. All ticks of one
    ticker in a micro-batch go through one task, so triggers should be short.
    """
    return (
        ticks.where("event_time is not null")
        .select(
            "Ticker", "Timestamp", "Price", F.col("Quantity").cast("bigint").alias("Quantity"),
            "Arrival", "event_time",
        )
        .groupBy("Ticker")
        .transformWithStateInPandas(
            LiveBars(window_minutes, idle_seconds), LIVE, "append", "processingTime"
        )
    )


class LiveTable:
    """What ``live_bars`` has written under ``root/table``, a folder a kind."""

    def __init__(self, spark: SparkSession, root: str, table: str):
        self.spark = spark
        self.path = f"{root}/{table}"
        self.checkpoint = f"{root}/_checkpoints/{table}"

    def start(
        self,
        rows: DataFrame,
        processing_time: str = "1 second",
        partitions: int | None = None,
    ) -> StreamingQuery:
        """The engine's file sink keeps what a failed batch has written from being read.

        Every state partition has a Python worker in every micro-batch, filled or not, so
        ``partitions`` should be no more than the tickers need.
        """
        writer = rows.writeStream.format("parquet").outputMode("append").partitionBy("kind")
        options = {"path": self.path, "checkpointLocation": self.checkpoint}
        with session_conf(self.spark, stream_conf(partitions)):
            return writer.options(**options).trigger(processingTime=processing_time).start()

    def bars(self) -> DataFrame:
        return self._kind("bar").select(*BAR.names, "ticks")

    def late(self) -> DataFrame:
        window = [F.col(c) for c in ("ticker", "window_start", "window_end")]
        return self._kind("late").select(*window, *_LATE.names)

    def _kind(self, kind: str) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], LIVE)
        return self.spark.read.schema(LIVE).parquet(self.path).where(F.col("kind") == kind)


def wait_for_silence(
    query: StreamingQuery, idle_seconds: int = IDLE_SECONDS, most_seconds: float = 600
) -> None:
    """Until a running stream has taken all its input and closed what silence closes.

    Its triggers go on without input, for the timers, so the engine's own way of waiting
    for all input would not end.
    """
    until = time.monotonic() + most_seconds
    while time.monotonic() < until:
        if not query.isActive:
            raise RuntimeError(f"the stream ended: {query.exception()}")
        batches = query.recentProgress
        filled = [b["timestamp"] for b in batches if b["numInputRows"]]
        # The first batch after a start may be an earlier one run again, which looks for
        # no new input.
        if len(batches) > 1 and not batches[-1]["numInputRows"]:
            # Timers that expired by a batch's time have fired when it is over.
            began = _seconds(filled[-1] if filled else batches[0]["timestamp"])
            if _seconds(batches[-1]["timestamp"]) >= began + idle_seconds:
                return
        time.sleep(0.1)
    raise TimeoutError("the stream did not fall silent")


def _seconds(timestamp: str) -> float:
    return pd.Timestamp(timestamp).timestamp()
