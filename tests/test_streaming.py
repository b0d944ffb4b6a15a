import random

import pytest
from pyspark.sql import functions as F

from tickbars.functions.times import event_time
from tickbars.operators.bars import Ohlc
from tickbars.operators.messages import serving_entries, to_messages
from tickbars.operators.rolling import RollingMean
from tickbars.schemas import BAR, INDICATOR, TICK
from tickbars.streaming.jobs import (
    counted_late_rows,
    default_metrics,
    open_bars,
    replay,
    start_table,
    stream_job,
    with_event_watermark,
)
from tickbars.session import session_conf
from tickbars.streaming.hops import MessageHop, TableHop, typed_rows
from tickbars.streaming.means import MeanTable, start_mean
from tickbars.streaming.serving import ENTRY, ServingTable, serve_job


def ticks(spark, rows):
    """Ticks from (ticker, second, price), numbered in the order given."""
    frame = spark.createDataFrame(
        [(t, int(s * 10**9), float(p), i) for i, (t, s, p) in enumerate(rows)],
        "Ticker string, Timestamp bigint, Price double, Arrival bigint",
    )
    return frame.select(
        F.lit("2024-01-01").alias("Date"),
        "Timestamp",
        F.lit("TRADE").alias("EventType"),
        "Ticker",
        "Price",
        F.lit(1).alias("Quantity"),
        F.lit("").alias("Exchange"),
        F.lit("").alias("Conditions"),
        "Arrival",
        event_time(F.col("Timestamp")).alias("event_time"),
    )


def rows_of(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def random_ticks(seed, count, start, stop):
    rng = random.Random(seed)
    return sorted(
        ((rng.choice("ABBBBC"), rng.uniform(start, stop), round(rng.uniform(1, 9), 2))
         for _ in range(count)),
        key=lambda r: r[1],
    )


def test_default_metrics():
    assert [m.name for m in default_metrics()] == ["OHLC_5M", "OHLC_5M_EMA_9", "OHLC_5M_EMA_12"]


def test_replay_in_slices_equals_the_batch(spark, tmp_path):
    """Means see bars over several micro-batches and must go on where they stopped."""
    parts = [random_ticks(i, 400, i * 9000, (i + 1) * 9000) for i in range(4)]
    # Numbered over all slices, so that arrival follows time.
    everything = [r for part in parts for r in part]
    frame = ticks(spark, everything).cache()
    bounds = [0, 400, 800, 1200, 1600]
    slices = [
        frame.filter(F.col("Arrival").between(lo, hi - 1)) for lo, hi in zip(bounds, bounds[1:])
    ]
    bars = Ohlc(5)
    metrics = [bars, RollingMean(9, source_table="OHLC_5M")]
    root = str(tmp_path)
    assert replay(spark, slices, root, metrics) == 0

    newest = max(int(r[1]) for r in everything)
    batch = bars.batch(frame)
    closed = batch.filter(F.unix_seconds("window_end") <= newest - 2)
    stored = spark.read.parquet(f"{root}/OHLC_5M")
    assert rows_of(stored, *batch.columns) == rows_of(closed, *batch.columns)

    means = RollingMean(9).batch(closed).withColumn("ema_value", F.round("ema_value", 8))
    table = MeanTable(spark, metrics[1], root)
    streamed = table.read().unionByName(table.waiting())
    streamed = streamed.withColumn("ema_value", F.round("ema_value", 8))
    assert streamed.count() > 200
    assert rows_of(streamed, *means.columns) == rows_of(means, *means.columns)

    # What the stream left open is what the batch has more.
    left = open_bars(frame, bars)
    assert rows_of(left, *batch.columns) == rows_of(
        batch.filter(F.unix_seconds("window_end") > newest - 2), *batch.columns
    )


def test_a_second_run_adds_nothing(spark, tmp_path):
    root = str(tmp_path)
    ticks(spark, random_ticks(1, 200, 0, 9000)).select(TICK.names).write.parquet(f"{root}/ticks")
    for _ in range(2):
        source = spark.readStream.schema(TICK).parquet(f"{root}/ticks")
        stream_job(spark, source, root, [Ohlc(5)])
    stored = spark.read.parquet(f"{root}/OHLC_5M")
    assert stored.count() == stored.select("ticker", "window_end").distinct().count() > 0


def test_a_replay_goes_on_after_a_failure(spark, tmp_path):
    parts = [random_ticks(i, 100, i * 3000, (i + 1) * 3000) for i in range(3)]
    frame = ticks(spark, [r for part in parts for r in part])
    slices = [frame.filter(F.col("Arrival").between(i * 100, i * 100 + 99)) for i in range(3)]

    def failing():
        yield from slices[:2]
        raise OSError("executor lost")

    # The rows of a slice lie in several files, in no order of time.
    slices = [s.repartition(3) for s in slices]
    with pytest.raises(OSError):
        replay(spark, failing(), f"{tmp_path}/a", [Ohlc(5)])
    assert replay(spark, slices, f"{tmp_path}/a", [Ohlc(5)]) == 0
    replay(spark, slices, f"{tmp_path}/b", [Ohlc(5)])
    columns = ["ticker", F.unix_seconds("window_end"), "open_price", "close_price", "volume"]
    again, once = [spark.read.parquet(f"{tmp_path}/{r}/OHLC_5M") for r in "ab"]
    assert rows_of(again, *columns) == rows_of(once, *columns)
    assert again.count() > 50


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    root = str(tmp_path)
    first = [("A", 10, 1.0), ("A", 400, 2.0), ("A", 1000, 3.0)]
    # Windows up to 900 are closed at 998; 950 lies in the open one.
    late = [("A", 20, 9.0), ("B", 30, 9.0), ("A", 950, 5.0), ("A", 2000, 4.0)]
    assert replay(spark, [ticks(spark, first), ticks(spark, late)], root, [Ohlc(5)]) == 2
    stored = spark.read.parquet(f"{root}/OHLC_5M")
    got = rows_of(stored, "ticker", F.unix_seconds("window_end"), "high_price", "volume")
    assert got == [("A", 300, 1.0, 1), ("A", 600, 2.0, 1), ("A", 1200, 5.0, 2)]


def test_a_window_closes_two_seconds_after_its_end(spark, tmp_path):
    for name, last, closed in (("early", 301, 0), ("just", 302, 1)):
        root = str(tmp_path / name)
        replay(spark, [ticks(spark, [("A", 10, 1.0), ("A", last, 2.0)])], root, [Ohlc(5)])
        assert spark.read.parquet(f"{root}/OHLC_5M").count() == closed


def test_open_bars_of_nothing(spark):
    assert open_bars(ticks(spark, [("A", 1, 1.0)]).limit(0), Ohlc(5)).count() == 0


def mean_rows(spark, rows):
    return spark.createDataFrame(rows, "ticker string, s double, n long, close_price double").select(
        "ticker", F.timestamp_micros((F.col("s") * 1000000).cast("long")).alias("window_end"), "n", "close_price"
    )


def run_means(spark, root, table, batches):
    for batch in batches:
        mean_rows(spark, batch).write.mode("append").parquet(f"{root}/bars")
        stream = spark.readStream.schema(mean_rows(spark, []).schema).parquet(f"{root}/bars")
        start_mean(table, stream, root).awaitTermination()


def seconds(frame):
    return {
        (r.ticker, r.s, r.n): r.ema_value
        for r in frame.withColumn("s", F.unix_micros("snapshot_time") / 1000000).collect()
    }


@pytest.mark.parametrize("periods", [1, 3])
@pytest.mark.parametrize("split", [None, 7])
def test_no_row_within_the_watermark_is_lost(spark, tmp_path, periods, split):
    """Equal times and times out of order over micro-batches, a missing value, a late row."""
    metric = RollingMean(periods, ties=["n"], split=split)
    table = MeanTable(spark, metric, str(tmp_path))
    batches = [
        [("A", 10.0, 1, 2.0), ("A", 11.0, 2, 4.0), ("B", 9.0, 3, None)],
        [("A", 11.0, 4, 1.0), ("A", 8.0, 5, 7.0), ("B", 12.0, 6, 8.0)],
        [("A", 30.0, 7, None), ("A", 31.0, 8, 6.0)],
        [("A", 25.0, 9, 100.0), ("A", 40.0, 10, 3.0)],
    ]
    run_means(spark, str(tmp_path), table, batches)
    kept = [r for batch in batches for r in batch if r[2] != 9]
    want = seconds(RollingMean(periods, ties=["n"]).batch(mean_rows(spark, kept)))
    emitted, waiting = seconds(table.read()), seconds(table.waiting())
    assert table.late() == 1
    assert not set(emitted) & set(waiting) and {k[2] for k in waiting} == {10}
    assert {**emitted, **waiting} == want
    assert table.read().schema == metric.schema


def test_a_mean_does_not_depend_on_the_cuts(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.choice("AB"), float(i // 7), i, rng.uniform(1, 9)) for i in range(300)]
    metric = RollingMean(5, ties=["n"])
    want = {k: round(v, 8) for k, v in seconds(metric.batch(mean_rows(spark, rows))).items()}
    for name, size in (("a", 50), ("b", 111)):
        table = MeanTable(spark, metric, f"{tmp_path}/{name}")
        run_means(
            spark, f"{tmp_path}/{name}", table, [rows[i : i + size] for i in range(0, 300, size)]
        )
        got = seconds(table.read().unionByName(table.waiting()))
        assert {k: round(v, 8) for k, v in got.items()} == want


def test_a_repeated_batch_of_means_adds_nothing(spark, tmp_path):
    table = MeanTable(spark, RollingMean(3, ties=["n"]), str(tmp_path))
    batches = [[("A", float(i * 10 + k), i * 10 + k, 1.0 + k) for k in range(10)] for i in range(3)]
    for number, batch in enumerate(batches):
        table.process(mean_rows(spark, batch), number)
        table.process(mean_rows(spark, batch), number)
    want = seconds(RollingMean(3, ties=["n"]).batch(mean_rows(spark, sum(batches, []))))
    assert seconds(table.read().unionByName(table.waiting())) == want


def test_means_over_a_repeated_hour(spark, tmp_path):
    """Clocks of New York go back at 2024-11-03 06:00 UTC; an hour's text comes twice."""
    rows = [("A", 1730606400.0 + 3600 * i, i, float(i)) for i in range(8)]
    with session_conf(spark, {"spark.sql.session.timeZone": "America/New_York"}):
        table = MeanTable(spark, RollingMean(3, ties=["n"]), str(tmp_path))
        run_means(spark, str(tmp_path), table, [rows[:3], rows[3:5], rows[5:]])
        got = seconds(table.read().unionByName(table.waiting()))
    assert got == {("A", s, n): sum(range(max(0, n - 2), n + 1)) / min(3, n + 1) for _, s, n, _ in rows}


def test_late_rows_are_counted_beyond_a_hundred_batches(spark, tmp_path):
    """A query's own progress keeps a few batches only; the listener hears all."""
    root = str(tmp_path)
    with session_conf(spark, {"spark.sql.streaming.numRecentProgressUpdates": "2"}):
        with counted_late_rows(spark) as listener:
            rows = [("A", 1000.0 * i, i, 1.0) for i in range(1, 7)]
            for i, row in enumerate(rows):
                late = ("A", 1.0, 100 + i, 1.0)
                mean_rows(spark, [row, late]).coalesce(1).write.mode("append").parquet(f"{root}/in")
            stream = (
                spark.readStream.schema(mean_rows(spark, []).schema)
                .option("maxFilesPerTrigger", 1)
                .parquet(f"{root}/in")
                .withWatermark("window_end", "2 seconds")
                .groupBy("ticker", F.window("window_end", "5 minutes"))
                .count()
            )
            query = start_table(stream, root, "counts")
            query.awaitTermination()
            # Spark judges a batch by the watermark before the last one.
            assert listener.count(query) == 4
            assert len(query.recentProgress) <= 2


def test_a_stream_keeps_the_partitions_it_is_given(spark, tmp_path):
    ticks(spark, random_ticks(1, 50, 0, 900)).select(TICK.names).write.parquet(f"{tmp_path}/ticks")
    for given, count in ((3, 3), (None, 5)):
        with session_conf(spark, {"spark.sql.shuffle.partitions": "5"}):
            source = spark.readStream.schema(TICK).parquet(f"{tmp_path}/ticks")
            root = f"{tmp_path}/{count}"
            query = start_table(
                Ohlc(5).stream(with_event_watermark(source)), root, "t", partitions=given
            )
            query.awaitTermination()
            [state] = query.recentProgress[0].stateOperators
            assert state.numShufflePartitions == count


def test_metric_table_can_be_read_before_it_has_rows(spark, tmp_path):
    stream = TableHop(spark, str(tmp_path)).stream("OHLC_5M_EMA_9", INDICATOR)
    query = start_table(stream, str(tmp_path), "copy")
    query.awaitTermination()
    assert query.exception() is None


def test_job_over_topics(spark, tmp_path):
    """Bars and means travel as JSON messages; in another zone, over a repeated hour."""
    start = 1730606400
    frame = ticks(spark, [(t, start + s, p) for t, s, p in random_ticks(6, 200, 0, 14000)])
    frame.select(TICK.names).write.parquet(f"{tmp_path}/ticks")
    hop = MessageHop(spark, str(tmp_path))
    metrics = [Ohlc(5), RollingMean(3, source_table="OHLC_5M")]
    with session_conf(spark, {"spark.sql.session.timeZone": "America/New_York"}):
        for _ in range(2):
            source = spark.readStream.schema(TICK).parquet(f"{tmp_path}/ticks")
            stream_job(spark, source, str(tmp_path), metrics, hop=hop)
        bars = typed_rows(hop.read("OHLC_5M"), BAR)
        closed = Ohlc(5).batch(frame).join(bars.select("ticker", "window_end"), ["ticker", "window_end"])
        assert rows_of(bars, *bars.columns) == rows_of(closed, *bars.columns)
        want = RollingMean(3).batch(closed).withColumn("ema_value", F.round("ema_value", 8))
        sent = typed_rows(hop.read(metrics[1].target_table), INDICATOR)
        means = sent.unionByName(MeanTable(spark, metrics[1], str(tmp_path)).waiting())
        means = means.withColumn("ema_value", F.round("ema_value", 8))
        assert sent.count() > 50
        assert rows_of(means, *want.columns) == rows_of(want, *want.columns)


# --- Serving ---------------------------------------------------------------------------


def bar_messages(spark, seconds, ticker="A", topic="OHLC_5M"):
    frame = spark.createDataFrame(
        [(ticker, s, float(s)) for s in seconds], "ticker string, s bigint, close_price double"
    ).select("ticker", F.timestamp_seconds("s").alias("window_end"), "close_price")
    return to_messages(frame, topic, F.unix_seconds("window_end"))


def serve(spark, root, table, sent):
    sent.write.mode("append").parquet(f"{root}/messages")
    stream = spark.readStream.schema(sent.schema).parquet(f"{root}/messages")
    serve_job(stream, table, f"{root}/checkpoint").awaitTermination()


def test_serving_keeps_the_newest_over_batches(spark, tmp_path):
    root = str(tmp_path)
    table = ServingTable(spark, f"{root}/table", keep=10, compact_every=2)
    assert table.read().count() == 0
    for batch in range(5):
        sent = bar_messages(spark, range(batch * 4, batch * 4 + 4)).union(
            bar_messages(spark, [batch], "B")
        )
        serve(spark, root, table, sent)
        total = (batch + 1) * 4
        ids = sorted(r.entry_id for r in table.read().filter("ticker = 'A'").collect())
        assert ids == list(range(max(0, total - 10), total))
        assert table.read().filter("ticker = 'B'").count() == batch + 1
    table.vacuum()
    assert table.read().count() == 15
    # Each kind of part is bounded: what the snapshot replaced is gone.
    left = [p.name for p in (tmp_path / "table" / "part=batch").glob("upto=*")]
    assert sorted(left) == ["upto=4"]


def test_the_number_of_served_parts_is_bounded(spark, tmp_path):
    table = ServingTable(spark, f"{tmp_path}/table", keep=3, compact_every=3)
    for batch_id in range(14):
        first = batch_id * 20
        table.append(serving_entries(bar_messages(spark, range(first, first + 20))), batch_id)
        parts = list((tmp_path / "table").glob("part=*/upto=*"))
        assert len(parts) <= 2 * 3 + 2
    stored = spark.read.schema(ENTRY).parquet(f"{tmp_path}/table/*/*")
    assert stored.count() <= 3 * 8
    assert sorted(r.entry_id for r in table.read().collect()) == [277, 278, 279]
    header = table.header("A").first()
    assert (header.close, header.change, header.ema) == (279.0, 1.0, 0.0)


def test_a_repeated_batch_is_not_counted_twice(spark, tmp_path):
    table = ServingTable(spark, f"{tmp_path}/table", keep=10, compact_every=2)
    for batch_id in (0, 0, 1, 1, 2, 2):
        table.append(serving_entries(bar_messages(spark, [batch_id])), batch_id)
    assert sorted(r.entry_id for r in table.read().collect()) == [0, 1, 2]


def test_a_batch_that_fails_after_writing_is_run_again(spark, tmp_path):
    class FailsOnce(ServingTable):
        failures = 1

        def append(self, entries, batch_id):
            super().append(entries, batch_id)
            if self.failures:
                self.failures = 0
                raise OSError("executor lost")

    root = str(tmp_path)
    table = FailsOnce(spark, f"{root}/table", compact_every=1)
    with pytest.raises(Exception, match="executor lost"):
        serve(spark, root, table, bar_messages(spark, range(5)))
    serve(spark, root, table, bar_messages(spark, range(5, 8)))
    assert sorted(r.entry_id for r in table.read().collect()) == list(range(8))


def test_serving_reads(spark, tmp_path):
    root = str(tmp_path)
    table = ServingTable(spark, f"{root}/table")
    means = spark.createDataFrame([("A", s, s / 2) for s in range(20)], "ticker string, s bigint, ema_value double")
    means = means.select("ticker", F.timestamp_seconds("s").alias("snapshot_time"), "ema_value")
    sent = bar_messages(spark, range(20)).union(
        to_messages(means, "OHLC_5M_EMA_9", F.unix_seconds("snapshot_time"))
    )
    serve(spark, root, table, sent)
    assert [r.close for r in table.bars("A", 3).collect()] == [17.0, 18.0, 19.0]
    assert table.bars("A").count() == 20 and table.bars("B").count() == 0
    assert [r.ema for r in table.indicators("A", 2).collect()] == [9.0, 9.5]
    assert [r.entry_id for r in table.indicator_range("A", 5, 7).collect()] == [5, 6, 7]
    assert [r.entry_id for r in table.indicator_range("A", count=2).collect()] == [0, 1]


def test_continuous_job_runs_side_by_side(spark, tmp_path):
    root = str(tmp_path)
    frame = ticks(spark, random_ticks(4, 200, 0, 9000))
    frame.select(TICK.names).write.parquet(f"{root}/ticks")
    source = spark.readStream.schema(TICK).parquet(f"{root}/ticks")
    metrics = [Ohlc(5), RollingMean(2, source_table="OHLC_5M")]
    queries = stream_job(spark, source, root, metrics, processing_time="1 second")
    try:
        assert all(q.isActive for q in queries.values())
        queries["OHLC_5M"].processAllAvailable()
        queries["OHLC_5M_EMA_2"].processAllAvailable()
    finally:
        for query in queries.values():
            query.stop()
    bars = spark.read.parquet(f"{root}/OHLC_5M")
    table = MeanTable(spark, metrics[1], root)
    assert bars.count() == table.read().count() + table.waiting().count() > 0
