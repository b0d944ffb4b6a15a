"""Partial bars and bars made of bars, in batch and as a stream."""

import random

import pytest
from pyspark.sql import functions as F

from test_plans import plan_of
from test_streaming import random_ticks, rows_of, ticks
from tickbars.operators.bars import Ohlc
from tickbars.operators.partials import (
    BarLevels,
    ChainedOhlc,
    as_bars,
    merge_bars,
    partial_bars,
)
from tickbars.schemas import BAR, TICK
from tickbars.streaming.jobs import start_table, with_event_watermark

COLUMNS = BAR.names


def with_gaps(frame):
    """Some ticks have no price, others no quantity."""
    n = F.col("Arrival")
    return frame.withColumn("Price", F.when(n % 5 > 0, F.col("Price"))).withColumn(
        "Quantity", F.when(n % 7 > 0, F.col("Quantity"))
    )


def all_bars(frame, minutes):
    return rows_of(Ohlc(minutes).batch(frame), *COLUMNS)


@pytest.mark.parametrize("minutes", [5, 60, 1440])
def test_merged_bars_are_those_of_the_ticks(spark, minutes):
    frame = with_gaps(ticks(spark, random_ticks(1, 2000, 0, 200_000)))
    narrow = partial_bars(frame, 5)
    assert rows_of(as_bars(merge_bars(narrow, minutes), minutes), *COLUMNS) == all_bars(frame, minutes)
    # Merged in any number of steps, and from parts in any order.
    parts = merge_bars(partial_bars(frame.filter("Arrival % 2 = 1"), 5), minutes).unionByName(
        partial_bars(frame.filter("Arrival % 2 = 0"), 5)
    )
    assert rows_of(as_bars(merge_bars(parts, minutes), minutes), *COLUMNS) == all_bars(frame, minutes)


def test_a_late_file_corrects_what_it_touches(spark, tmp_path):
    rows = random_ticks(2, 3000, 0, 300_000)
    frame = with_gaps(ticks(spark, rows)).cache()
    late = (F.col("Arrival") % 11 == 3) & F.col("Timestamp").between(100_000 * 10**9, 120_000 * 10**9)
    levels = BarLevels(spark, str(tmp_path / "bars"))
    levels.add(frame.filter(~late & (F.col("Arrival") < 1500)), "a")
    levels.add(frame.filter(~late & (F.col("Arrival") >= 1500)), "b")
    for minutes in levels.minutes:
        assert rows_of(levels.bars(minutes), *COLUMNS) == all_bars(frame.filter(~late), minutes)
    for _ in range(2):  # A file that lands again adds nothing.
        levels.add(frame.filter(late), "late")
        for minutes in levels.minutes:
            assert rows_of(levels.bars(minutes), *COLUMNS) == all_bars(frame, minutes)
    touched = {(r.Ticker, r.at) for r in frame.filter(late).select(
        "Ticker", F.floor(F.unix_seconds("event_time") / 3600).alias("at")).distinct().collect()}
    changed = levels.changed(60, "late")
    want = [r for r in all_bars(frame, 60) if (r[0], int(r[1].timestamp()) // 3600) in touched]
    assert touched and rows_of(changed, *COLUMNS) == want
    again = levels.rewrite(str(tmp_path / "again"))
    assert rows_of(again.bars(60), *COLUMNS) == all_bars(frame, 60)
    assert again.partials(5).agg(F.sum("ticks")).first()[0] == 3000


def test_levels_do_not_read_ticks_again(spark, tmp_path):
    source = str(tmp_path / "ticks")
    ticks(spark, random_ticks(3, 200, 0, 90_000)).write.parquet(source)
    levels = BarLevels(spark, str(tmp_path / "bars"))
    levels.add(spark.read.parquet(source), "a")
    for minutes in levels.minutes:
        files = levels.bars(minutes).inputFiles()
        assert files and all(f"/bars/minutes={minutes}/" in name for name in files)
        plan = plan_of(levels.bars(minutes))
        # One hash aggregate around one shuffle, as for ticks.
        assert "SortAggregate" not in plan and plan.count("Exchange") == 1


def test_empty_levels_and_unfit_widths(spark, tmp_path):
    levels = BarLevels(spark, str(tmp_path / "bars"))
    assert levels.bars(60).count() == 0
    levels.add(ticks(spark, random_ticks(1, 5, 0, 10)).limit(0), "none")
    assert levels.bars(60).count() == 0
    with pytest.raises(ValueError):
        BarLevels(spark, "x", (5, 12))
    with pytest.raises(ValueError):
        ChainedOhlc(60, 7)
    with pytest.raises(ValueError):
        ChainedOhlc(60, 5, order=("Timestamp", "Arrival"))


def test_bars_on_bars_over_several_batches(spark, tmp_path):
    rng = random.Random(4)
    parts = [random_ticks(i, 300, i * 9000, (i + 1) * 9000) for i in range(4)]
    everything = [r for part in parts for r in part]
    frame = with_gaps(ticks(spark, everything)).cache()
    bars, root = ChainedOhlc(60, 5), str(tmp_path)
    batches = 0
    for k in range(4):
        slice_ = frame.filter(F.col("Arrival").between(k * 300, k * 300 + 299))
        slice_.select(TICK.names).repartition(rng.randint(1, 3)).write.parquet(f"{root}/ticks/{k}")
        source = spark.readStream.schema(TICK).parquet(f"{root}/ticks/*")
        query = start_table(bars.stream(with_event_watermark(source)), root, "OHLC_60M")
        query.awaitTermination()
        batches += len(query.recentProgress)
        assert len(query.lastProgress.stateOperators) == 2
    assert batches >= 4
    newest = max(int(r[1]) for r in everything)
    closed = bars.batch(frame).filter(F.unix_seconds("window_end") <= newest - 2)
    stored = spark.read.schema(BAR).parquet(f"{root}/OHLC_60M")
    assert rows_of(stored, *COLUMNS) == rows_of(closed, *COLUMNS)
    assert len(rows_of(closed, *COLUMNS)) > 15
    assert all_bars(frame, 60) == rows_of(bars.batch(frame), *COLUMNS)
