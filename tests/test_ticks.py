import gzip

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tickbars.operators.bars import Ohlc
from tickbars.operators.order import time_order, with_position
from tickbars.operators.messages import event_ticks, placed_messages
from tickbars.plans.jobs import publish_job
from tickbars.session import session_conf
from tickbars.sources.ticks import (
    convert_ticks,
    read_checked_ticks,
    read_converted_ticks,
    read_ticks,
    ticker_list,
)
from tickbars.sources.topics import MessageTable

HEADER = "Date,Timestamp,EventType,Ticker,Price,Quantity,Exchange,Conditions"


def put(root, day, ticker, lines, header=HEADER):
    folder = root / day[:4] / day
    folder.mkdir(parents=True, exist_ok=True)
    with gzip.open(folder / f"{ticker}.csv.gz", "wt") as out:
        out.write("\n".join([header, *lines]) + "\n")


@pytest.fixture
def root(tmp_path):
    data = tmp_path / "data"
    put(data, "20240311", "ORCA", [
        "2024-03-11,700,TRADE,ORCA,12.5,3,XQ,",
        "2024-03-11,1900,TRADE,ORCA,12.25,8,XQ,late",
    ])
    put(data, "20240311", "WREN", [
        "2024-03-11,100,TRADE,WREN,7.0,40,ZQ,",
        "2024-03-11,900,TRADE,WREN,7.5,2,ZQ,",
        "2024-03-11,2500,TRADE,WREN,7.25,6,ZQ,",
    ])
    put(data, "20240312", "ORCA", [
        '20240312,8:05:10.5,TRADE,ORCA,13.0,5,XQ,"odd, lot"',
        "20240312,8:05:10.5,TRADE,ORCA,13.1,6,XQ,",
    ])
    (data / "README.txt").write_text("not a folder of ticks")
    return str(data)


def test_merge_in_time_order(spark, root):
    ticks = time_order(read_ticks(spark, root, "ORCA, WREN", "20240311", "20240311"))
    rows = ticks.select("Timestamp", "Ticker", "Price", "Quantity", "Conditions").collect()
    assert [tuple(r) for r in rows] == [
        (100, "WREN", 7.0, 40, ""),
        (700, "ORCA", 12.5, 3, ""),
        (900, "WREN", 7.5, 2, ""),
        (1900, "ORCA", 12.25, 8, "late"),
        (2500, "WREN", 7.25, 6, ""),
    ]


def test_ticker_lists():
    assert ticker_list(" ORCA,,WREN , ORCA") == ["ORCA", "WREN"]
    assert ticker_list(["WREN ", "", "ORCA,WREN"]) == ["WREN", "ORCA"]


def test_dates_are_inclusive_and_missing_files_are_skipped(spark, root):
    assert read_ticks(spark, root, ["ORCA", "WREN", "NONE"], "20240311", "20240312").count() == 7
    assert read_ticks(spark, root, ["ORCA"], "20240312", "20991231").count() == 2
    empty = read_ticks(spark, root, ["NONE"], "20240311", "20240312")
    assert empty.count() == 0 and "event_time" in empty.columns
    with pytest.raises(AnalysisException):
        read_ticks(spark, f"{root}/no/such/root", ["ORCA"], "20240311", "20240312")


def test_only_selected_files_are_opened(spark, root, tmp_path):
    put(tmp_path / "data", "20240313", "ORCA", ["broken"], header="no,such,header")
    ticks = read_ticks(spark, root, ["ORCA"], "20240311", "20240312")
    assert ticks.count() == 4


def test_quotes_clock_and_arrival(spark, root):
    rows = read_ticks(spark, root, "ORCA", "20240311", "20240312").orderBy("Arrival").collect()
    assert [r.Price for r in rows] == [12.5, 12.25, 13.0, 13.1]
    assert rows[2].Conditions == "odd, lot"
    assert rows[2].Timestamp == 1710230710_500000000
    assert rows[2].Timestamp == rows[3].Timestamp and rows[2].Arrival < rows[3].Arrival


def test_bars_break_ties_by_place_in_the_file(spark, root):
    ticks = read_ticks(spark, root, "ORCA", "20240312", "20240312")
    bar = Ohlc(5).batch(ticks).first()
    assert (bar.open_price, bar.close_price, bar.volume) == (13.0, 13.1, 11)


def test_arrival_over_several_files_of_a_day(spark, tmp_path):
    folder = tmp_path / "day=20240311" / "symbol=ORCA"
    folder.mkdir(parents=True)
    for name, first in (("b", 100), ("a", 0), ("c", 200)):
        lines = [f"2024-03-11,{first + k},TRADE,ORCA,{first + k}.0,1,XQ," for k in range(50)]
        with gzip.open(folder / f"{name}.csv.gz", "wt") as out:
            out.write("\n".join([HEADER, *lines]) + "\n")
    ticks = read_ticks(
        spark, str(tmp_path), "ORCA", "20240311", "20240311",
        files="day={date}/symbol={ticker}/*.csv.gz",
    )
    rows = ticks.orderBy("Arrival").collect()
    assert len({r.Arrival for r in rows}) == 150
    assert [r.Timestamp for r in rows] == sorted(r.Timestamp for r in rows)
    bar = Ohlc(5).batch(ticks).first()
    assert (bar.open_price, bar.close_price) == (0.0, 249.0)


def test_bad_clocks_raise(spark, root, tmp_path):
    put(tmp_path / "data", "20240315", "X", ["2024-03-15,09:30,TRADE,X,1.0,1,XQ,"])
    with pytest.raises(Exception, match="09:30"):
        Ohlc(5).batch(read_ticks(spark, root, "X", "20240315", "20240315")).collect()


def test_other_columns_are_refused(spark, root, tmp_path):
    put(tmp_path / "data", "20240314", "X", ["1,2"], header="Ticker,Date")
    with pytest.raises(Exception):
        read_ticks(spark, root, "X", "20240314", "20240314").select("Date", "Price").collect()


def test_bad_numbers_raise(spark, root, tmp_path):
    put(tmp_path / "data", "20240316", "X", ["2024-03-16,1,TRADE,X,cheap,1,XQ,"])
    with pytest.raises(Exception, match="cheap"):
        read_ticks(spark, root, "X", "20240316", "20240316").collect()


def test_bad_lines_are_set_aside(spark, root, tmp_path):
    """Good rows and rejects are all lines, and both keep their place."""
    put(tmp_path / "data", "20240317", "X", [
        "2024-03-17,100,TRADE,X,1.5,1,XQ,",
        "2024-03-17,200,TRADE,X,cheap,1,XQ,",
        "2024-03-17,09:30,TRADE,X,1.0,1,XQ,",
        "2024-03-17,300",
        "2024-03-17,400,TRADE,X,1.5,1,XQ,,more,and more",
        "2024-03-17,500,TRADE,X,,,XQ,",
        "2024-03-17,600,TRADE,X,2.5,many,XQ,",
        '2024-03-17,700,TRADE,X,3.5,9,XQ,"a, b"',
    ])
    put(tmp_path / "data", "20240317", "Y", ["2024-03-17,100,TRADE,Y,1.5,1,XQ,"])
    good, bad = read_checked_ticks(spark, root, "X,Y", "20240317", "20240317")
    assert [(r.Timestamp, r.Price, r.Quantity, r.Conditions)
            for r in good.filter("Ticker = 'X'").orderBy("Arrival").collect()] == [
        (100, 1.5, 1, ""), (500, None, None, ""), (700, 3.5, 9, "a, b")
    ]
    rows = bad.orderBy("Arrival").collect()
    assert [r.reason for r in rows] == ["Price", "Timestamp", "fields", "fields", "Quantity"]
    assert [r.line for r in rows][:3] == [
        "2024-03-17,200,TRADE,X,cheap,1,XQ,", "2024-03-17,09:30,TRADE,X,1.0,1,XQ,", "2024-03-17,300"
    ]
    assert all(r.file.endswith("20240317/X.csv.gz") for r in rows)
    places = [r.Arrival for r in good.filter("Ticker = 'X'").collect()] + [r.Arrival for r in rows]
    assert max(places) - min(places) == 7 and len(set(places)) == 8
    assert good.count() + bad.count() == 9
    # Where nothing is wrong, both ways of reading agree.
    ticks = read_ticks(spark, root, "ORCA, WREN", "20240311", "20240312")
    checked, none = read_checked_ticks(spark, root, "ORCA, WREN", "20240311", "20240312")
    assert none.count() == 0 and checked.columns == ticks.columns
    assert checked.exceptAll(ticks).count() == 0 and checked.count() == 7
    empty, none = read_checked_ticks(spark, root, "NONE", "20240311", "20240312")
    assert empty.count() == none.count() == 0


def test_no_file_names_on_the_driver(spark, root, monkeypatch):
    """Files are numbered by Spark; the driver asks for one value only."""
    def refused(self):
        raise AssertionError("names were collected")

    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.inputFiles", refused)
    assert read_ticks(spark, root, "ORCA, WREN", "20240311", "20240312").count() == 7


def test_globs_are_no_tickers(spark, root):
    with pytest.raises(ValueError):
        read_ticks(spark, root, "{A,B}*", "20240311", "20240312")


def test_converted_ticks_are_the_same(spark, root, tmp_path):
    ticks = read_ticks(spark, root, "ORCA,WREN", "20240311", "20240312")
    path = str(tmp_path / "converted")
    # One day after the other, and one of them again.
    for day in ("20240312", "20240311", "20240312"):
        convert_ticks(read_ticks(spark, root, "ORCA,WREN", day, day), path)
    again = read_converted_ticks(spark, path, "ORCA, WREN", "20240311", "20240312")
    assert again.select(ticks.columns).exceptAll(ticks).count() == 0
    assert again.count() == 7
    part = read_converted_ticks(spark, path, "ORCA", "20240312", "20240312")
    assert part.count() == 2
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "day" in plan.split("PartitionFilters: ")[1].split("]")[0]
    assert "EqualTo(Ticker,ORCA)" in plan or "In(Ticker, [ORCA])" in plan


def test_positions_count_from_one_without_gaps(spark):
    # A third of the rows share one ticker and one time.
    ticks = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 97).alias("Timestamp"),
        F.when(F.col("id") % 3 == 0, "HOT").otherwise("T").alias("Ticker"),
        F.col("id").alias("Arrival"),
    )
    rows = with_position(ticks).orderBy("position").collect()
    assert [r.position for r in rows] == list(range(1, 3001))
    keys = [(r.Timestamp, r.Ticker, r.Arrival) for r in rows]
    assert keys == sorted(keys)


def test_publishing_keeps_each_tickers_order(spark, tmp_path):
    """A hot ticker, rows in no order, many write tasks, slices one after the other."""
    ticks = spark.range(4000).select(
        F.lit("2024-03-11").alias("Date"),
        ((F.col("id") * 7919) % 4000 * 1000000000).alias("Timestamp"),
        F.lit("TRADE").alias("EventType"),
        F.when(F.col("id") % 3 < 2, "HOT")
        .otherwise(F.concat(F.lit("T"), F.col("id") % 13))
        .alias("Ticker"),
        F.col("id").cast("double").alias("Price"),
        F.lit(1).alias("Quantity"),
        F.lit("").alias("Exchange"),
        F.lit("").alias("Conditions"),
        F.col("id").alias("Arrival"),
    )
    topic = MessageTable(spark, f"{tmp_path}/topic")
    assert topic.read().count() == 0
    half = F.col("Timestamp") < 2000 * 1000000000
    with session_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        publish_job(
            [ticks.filter(half), ticks.filter(~half)],
            lambda rows, k: topic.append(placed_messages(rows), k),
        )
    # The hot ticker's rows of a slice were written by several tasks of like size.
    files = topic.read().filter("key = 'HOT'").groupBy(F.input_file_name()).count().collect()
    assert len(files) > 8 and max(r[1] for r in files) < 700
    assert topic.read().select("offset").distinct().count() == 4000
    read = event_ticks(topic.read())
    rows = read.orderBy("Ticker", "Arrival").collect()
    keys = [(r.Ticker, r.Timestamp) for r in rows]
    assert len(rows) == 4000 and keys == sorted(keys)
    bars = Ohlc(60, order=("Timestamp", "Arrival"))
    with_time = ticks.withColumn("event_time", F.timestamp_seconds(F.col("Timestamp") / 1e9))
    columns = ["ticker", "open_price", "close_price"]
    assert sorted(bars.batch(read).select(columns).collect()) == sorted(
        bars.batch(with_time).select(columns).collect()
    )
