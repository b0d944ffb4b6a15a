"""Bars of streams that fall silent, and rows that come too late."""

from pyspark.sql import functions as F

from test_streaming import random_ticks, rows_of, ticks
from tickbars.operators.bars import Ohlc
from tickbars.schemas import BAR, TICK
from tickbars.streaming.jobs import with_event_watermark
from tickbars.streaming.live import LiveTable, live_bars, wait_for_silence

IDLE = 3


def streamed(spark, root, parts, minutes=5, idle=IDLE):
    """Each part streamed until silence has closed its windows."""
    table = LiveTable(spark, root, "LIVE")
    counts = []
    for k, part in enumerate(parts):
        part.select(TICK.names).write.parquet(f"{root}/ticks/{k}")
        source = spark.readStream.schema(TICK).parquet(f"{root}/ticks/*")
        rows = live_bars(with_event_watermark(source), minutes, idle)
        query = table.start(rows, partitions=2)
        try:
            wait_for_silence(query, idle, 60)
        finally:
            query.stop()
        counts.append(table.bars().count())
    return table, counts


def test_no_window_is_left_open_and_no_bar_comes_twice(spark, tmp_path):
    """The first part ends with a window's end, the next ticker by ticker later."""
    first = [r for r in random_ticks(1, 300, 0, 9000)] + [("D", 100, 1.0), ("D", 8990, 2.0)]
    second = random_ticks(2, 300, 9000, 18000)
    frame = ticks(spark, first + second)
    n = F.col("Arrival")
    frame = frame.withColumn("Price", F.when(n % 5 > 0, F.col("Price"))).withColumn(
        "Quantity", F.when(n % 7 > 0, F.col("Quantity"))
    )
    table, counts = streamed(
        spark, str(tmp_path), [frame.filter(n < len(first)), frame.filter(n >= len(first))]
    )
    batch = Ohlc(5).batch(frame)
    assert rows_of(table.bars(), *BAR.names) == rows_of(batch, *BAR.names)
    assert 0 < counts[0] < counts[1] == batch.count()
    assert table.late().count() == 0
    assert table.bars().agg(F.sum("ticks")).first()[0] == frame.count()


def test_late_rows_and_rows_in_bars_are_all_rows(spark, tmp_path):
    first = [("A", 10, 1.0), ("A", 400, 2.0), ("A", 1000, 3.0)]
    # Windows up to 900 are closed by the watermark at 998, A's to 1200 by its silence.
    second = [("A", 20, 9.0), ("B", 30, 9.0), ("A", 950, 5.0), ("B", 950, 5.0), ("A", 2000, 4.0)]
    frame = ticks(spark, first + second)
    parts = [frame.filter("Arrival < 3"), frame.filter("Arrival >= 3")]
    table, _ = streamed(spark, str(tmp_path), parts)
    end = F.unix_seconds("window_end")
    assert rows_of(table.late(), "ticker", end, "Arrival", "Price") == [
        ("A", 300, 3, 9.0), ("A", 1200, 5, 5.0), ("B", 300, 4, 9.0)
    ]
    assert rows_of(table.bars(), "ticker", end, "open_price", "ticks") == [
        ("A", 300, 1.0, 1), ("A", 600, 2.0, 1), ("A", 1200, 3.0, 1), ("A", 2100, 4.0, 1),
        ("B", 1200, 5.0, 1),
    ]


def test_the_watermark_closes_windows_before_silence_does(spark, tmp_path):
    """A ticker that goes on gets its bars by the watermark, long before its silence."""
    root, idle = str(tmp_path), 600
    table = LiveTable(spark, root, "LIVE")
    frame = ticks(spark, random_ticks(3, 400, 0, 12000) + [("A", 12500, 1.0)])
    for k, part in enumerate(("Arrival < 200", "Arrival between 200 and 399", "Arrival > 399")):
        frame.filter(part).select(TICK.names).write.parquet(f"{root}/ticks/{k}")
        source = spark.readStream.schema(TICK).parquet(f"{root}/ticks/*")
        query = table.start(live_bars(with_event_watermark(source), 5, idle), partitions=2)
        wait_for_silence(query, 0, 60)
        query.stop()
    # At the last batch the watermark was that of the rows before it.
    newest = frame.filter("Arrival < 400").agg(F.max(F.unix_seconds("event_time"))).first()[0]
    closed = Ohlc(5).batch(frame).filter(F.unix_seconds("window_end") <= newest - 2)
    got = rows_of(table.bars().filter("ticker = 'A'"), *BAR.names)
    assert got == rows_of(closed.filter("ticker = 'A'"), *BAR.names) and len(got) > 20


def test_an_empty_table(spark, tmp_path):
    table = LiveTable(spark, str(tmp_path), "NONE")
    assert table.bars().count() == table.late().count() == 0
