import random

import pytest
from pyspark.sql import functions as F

from tickbars.operators.bars import Ohlc
from tickbars.operators.change import price_change
from tickbars.operators.latest import keep_last, latest_bar, latest_n
from tickbars.operators.metric import Metric
from tickbars.operators.ranges import entry_range
from tickbars.operators.rolling import RollingMean

TICKS = "Ticker string, Timestamp bigint, Price double, Quantity int, Arrival bigint"
SECOND = 10**9


def bars_of(spark, rows, **options):
    frame = Ohlc(5, **options).batch(spark.createDataFrame(rows, TICKS))
    times = [F.col(c).cast("string").alias(c) for c in ("window_start", "window_end")]
    picked = ["ticker", *times, "open_price", "high_price", "low_price", "close_price", "volume"]
    return sorted(tuple(r) for r in frame.select(picked).collect())


def test_names():
    assert Ohlc().name == "OHLC_5M" and Ohlc(60).target_table == "OHLC_60M"
    assert RollingMean(9, source_table="market_events").name == "market_events_EMA_9"
    assert RollingMean(9, source_table="X", target_table="T").target_table == "T"
    with pytest.raises(TypeError):
        Metric()


def test_window_start_is_inclusive_and_end_exclusive(spark):
    rows = [
        ("A", 300 * SECOND, 1.0, 1, 1),
        ("A", 599 * SECOND + 999999999, 2.0, 2, 2),
        ("A", 600 * SECOND, 3.0, 4, 3),
        ("A", -1 * SECOND, 9.0, 1, 0),
    ]
    assert bars_of(spark, rows) == [
        ("A", "1969-12-31 23:55:00", "1970-01-01 00:00:00", 9.0, 9.0, 9.0, 9.0, 1),
        ("A", "1970-01-01 00:05:00", "1970-01-01 00:10:00", 1.0, 2.0, 1.0, 2.0, 3),
        ("A", "1970-01-01 00:10:00", "1970-01-01 00:15:00", 3.0, 3.0, 3.0, 3.0, 4),
    ]


def test_open_and_close_follow_arrival_or_time(spark):
    rows = [("A", 3 * SECOND, 3.0, 1, 1), ("A", 1 * SECOND, 1.0, 1, 2), ("A", SECOND, 2.0, 1, 3)]
    [arrival] = bars_of(spark, rows)
    assert (arrival[3], arrival[6]) == (3.0, 2.0)
    [time] = bars_of(spark, rows, order=("Timestamp", "Arrival"))
    assert (time[3], time[6]) == (1.0, 3.0)


def test_missing_values(spark):
    rows = [
        ("A", SECOND, None, 1, 1),
        ("A", 2 * SECOND, 5.0, None, 2),
        ("A", None, 7.0, 1, 3),
    ]
    assert [b[3:] for b in bars_of(spark, rows)] == [(5.0, 5.0, 5.0, 5.0, 1)]
    assert bars_of(spark, []) == []


def test_volume_exceeds_int(spark):
    rows = [("A", SECOND, 1.0, 2**31 - 1, i) for i in range(3)]
    assert bars_of(spark, rows)[0][7] == 3 * (2**31 - 1)


def ticks_with_a_hot_key(spark):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        key = "HOT" if rng.random() < 0.6 else f"K{rng.randrange(5)}"
        second = rng.choice([rng.randrange(40_000), rng.randrange(100)])
        price = None if rng.random() < 0.05 else round(rng.uniform(1, 100), 2)
        rows.append((key, second, i, price))
    return rows, spark.createDataFrame(rows, "k string, s bigint, i bigint, v double").select(
        "k", F.timestamp_seconds("s").alias("t"), "i", "v"
    )


@pytest.mark.parametrize("periods", [1, 2, 9, 40])
@pytest.mark.parametrize("split", [None, 7, 600, 10**6, "range"])
def test_rolling_mean_equals_brute_force(spark, periods, split):
    rows, frame = ticks_with_a_hot_key(spark)
    metric = RollingMean(
        periods, key="k", time="t", value="v", ties=["i"], split=split
    )
    got = {r.i: r.ema_value for r in metric.batch(frame).collect()}
    assert len(got) == len(rows)
    for key in {r[0] for r in rows}:
        ordered = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
        for at, row in enumerate(ordered):
            frame_values = [
                r[3] for r in ordered[max(0, at - periods + 1) : at + 1] if r[3] is not None
            ]
            if not frame_values:
                assert got[row[2]] is None
            else:
                mean = sum(frame_values) / len(frame_values)
                assert got[row[2]] == pytest.approx(mean, abs=1e-9)


BARS = "ticker string, window_end timestamp, close_price double, high_price double, " \
    "low_price double, volume bigint"


def bar_frame(spark, rows):
    return spark.createDataFrame(
        [(t, s, c, c, c, v) for t, s, c, v in rows],
        BARS.replace("timestamp", "bigint"),
    ).withColumn("window_end", F.timestamp_seconds("window_end"))


def test_price_change_guards(spark):
    bars = bar_frame(spark, [("A", 1, 0.0, 1), ("A", 2, 5.0, 1), ("A", 3, 4.0, 1), ("B", 1, 2.0, 1)])
    rows = price_change(bars).orderBy("ticker", "window_end").collect()
    assert [(r.change, r.percent_change) for r in rows] == [
        (0.0, 0.0), (5.0, 0.0), (-1.0, -20.0), (0.0, 0.0)
    ]


def test_price_change_of_split_keys_is_the_same(spark):
    rng = random.Random(11)
    bars = bar_frame(
        spark,
        [(rng.choice("AAB"), s, float(rng.randrange(4)), 1) for s in range(0, 4000, 7)],
    )
    whole = sorted(tuple(r) for r in price_change(bars).collect())
    assert len(whole) == bars.count()
    for split in (5, 60, 3600, "range"):
        changes = price_change(bars, split=split)
        assert sorted(tuple(r) for r in changes.collect()) == whole


def test_latest_bar_without_indicator(spark):
    bars = bar_frame(spark, [("A", 1, 2.0, 3), ("A", 2, 4.0, None), ("B", 1, 1.0, 5)])
    means = spark.createDataFrame([("B", 1, 1.5), ("B", 0, 9.0)], "ticker string, s bigint, ema_value double")
    means = means.withColumn("snapshot_time", F.timestamp_seconds("s"))
    rows = {r.ticker: r for r in latest_bar(bars, means).collect()}
    assert (rows["A"].change, rows["A"].percent_change) == (2.0, 100.0)
    assert (rows["A"].ema, rows["A"].volume) == (0.0, 0)
    assert (rows["B"].ema, rows["B"].change) == (1.5, 0.0)


@pytest.mark.parametrize("count", [1, 5, 999, 1000, 1001, 1500, None])
def test_latest_n_of_a_hot_key(spark, count):
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 < 2, "HOT").otherwise(F.concat(F.lit("K"), F.col("id") % 7)).alias("k"),
        "id",
    )
    got, ids = {}, {}
    for r in latest_n(rows, ["k"], ["id"], count).collect():
        got.setdefault(r.k, []).append(r.id)
    for r in rows.collect():
        ids.setdefault(r.k, []).append(r.id)
    for key, all_ids in ids.items():
        assert sorted(got[key]) == sorted(all_ids)[-(count or len(all_ids)):]


def test_retention_is_exact(spark):
    rows = spark.range(2500).select(F.lit("k").alias("k"), "id")
    kept = keep_last(rows, ["k"], ["id"])
    assert kept.agg(F.count("*"), F.min("id")).first() == (1000, 1500)


def test_entry_range(spark):
    entries = spark.range(10).select(F.lit("A").alias("ticker"), F.col("id").alias("entry_id"))
    ids = lambda *a: [r.entry_id for r in entry_range(entries, "A", *a).collect()]
    assert ids() == list(range(10))
    assert ids(3, 5) == [3, 4, 5]
    assert ids("-", 2) == [0, 1, 2]
    assert ids("8", "+") == [8, 9]
    assert ids("-", "+", 2) == [0, 1]
    assert entry_range(entries, "B").count() == 0
