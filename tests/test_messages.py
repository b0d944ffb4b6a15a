import json

import pytest
from pyspark.sql import functions as F

from tickbars.operators import messages
from tickbars.schemas import schema_from_names, topic_schema
from tickbars.session import session_conf

BAR = {
    "ticker": "WREN", "window_start": 900, "window_end": 1200, "open_price": 7.25,
    "high_price": 8.5, "low_price": 7.0, "close_price": 8.0, "volume": 64,
}


def entries(spark, rows):
    sent = spark.createDataFrame(
        [(t, v if v is None or isinstance(v, str) else json.dumps(v), i)
         for i, (t, v) in enumerate(rows)],
        "topic string, value string, offset bigint",
    )
    return messages.serving_entries(sent)


def test_bar_message(spark):
    [row] = entries(spark, [("OHLC", BAR)]).collect()
    assert row.key == "OHLC:WREN"
    assert (row.open, row.start, row.end, row.volume) == ("7.25", "900", "1200", "64")
    assert row.ema is None


def test_indicator_message(spark):
    value = {"ticker": "A", "ema_value": 100.5, "snapshot_time": "2023-01-01T00:00:00"}
    served = entries(spark, [("OHLC_5M_EMA_9", value)])
    [row] = messages.as_indicators(served).collect()
    assert row.ema == 100.5 and str(row.timestamp) == "2023-01-01 00:00:00"
    assert messages.as_bars(served).count() == 0


@pytest.mark.parametrize(
    "value",
    [
        None, "", "not json", "{", "[]", "null",
        {"open_price": 1.0},
        {"ticker": None, "open_price": 1.0},
        {"ticker": "", "open_price": 1.0},
        {"ticker": "A"},
        {"ticker": "A", "open_price": None},
        {"ticker": "A", "ema_value": 1.0},
    ],
)
def test_messages_left_out(spark, value):
    assert entries(spark, [("OHLC", value)]).count() == 0


def test_routing(spark):
    topics = {
        "EMA": "EMA", "OHLC": "OHLC", "ohlc_5m": "OHLC", "OHLC_5M_EMA_9": "EMA",
        "schema": "EMA", "market": None, "": None,
    }
    frame = spark.createDataFrame([(t,) for t in topics], "topic string")
    rows = frame.select("topic", messages.message_kind(F.col("topic")).alias("kind"))
    assert {r.topic: r.kind for r in rows.collect()} == topics


def test_served_text_becomes_numbers_and_a_time(spark):
    value = {
        "ticker": "A", "open_price": "1.0", "high_price": "2.0", "low_price": "0.5",
        "close_price": "n/a", "volume": "1000", "window_end": "2023-01-01T00:00:00",
    }
    [row] = messages.as_bars(entries(spark, [("OHLC_5M", value)])).collect()
    assert (row.open, row.high, row.low, row.close, row.volume) == (1.0, 2.0, 0.5, None, 1000.0)
    assert str(row.timestamp) == "2023-01-01 00:00:00"


def test_decode_gives_nulls_for_broken_json(spark):
    schema = topic_schema("OHLC_5M")
    frame = spark.createDataFrame([(b'{"ticker":"A","volume":5}',), (b"{oops",)], "value binary")
    rows = messages.decode(frame, schema).collect()
    assert [(r.ticker, r.volume, r.open_price) for r in rows] == [("A", 5, None), (None, None, None)]


def test_schema_from_names():
    schema = schema_from_names({"a": "Double", "b": "LONG", "c": "string", "d": "decimal"})
    assert [f.dataType.simpleString() for f in schema] == ["double", "bigint", "string", "string"]
    assert all(f.nullable for f in schema)
    assert topic_schema("NO_SUCH_TOPIC") is None


def test_schema_from_a_file(tmp_path):
    (tmp_path / "T.json").write_text('{"ticker": "string", "volume": "long"}')
    assert topic_schema("T", tmp_path).simpleString() == "struct<ticker:string,volume:bigint>"
    assert topic_schema("OHLC_5M", tmp_path) is None
    assert topic_schema("OHLC_5M").simpleString() == (
        "struct<ticker:string,window_start:string,window_end:string,open_price:double,"
        "high_price:double,low_price:double,close_price:double,volume:bigint>"
    )


def test_messages_carry_times_as_text(spark):
    frame = spark.sql(
        "SELECT 'A' AS ticker, timestamp'2024-01-01 00:05:00' AS window_end, 1.5D AS close_price "
        "UNION ALL SELECT 'B', timestamp'2024-01-01 00:05:00.25', NULL"
    )
    rows = messages.to_messages(frame, "T", F.lit(7)).collect()
    assert [json.loads(r.value) for r in rows] == [
        {"ticker": "A", "window_end": "2024-01-01 00:05:00", "close_price": 1.5},
        {"ticker": "B", "window_end": "2024-01-01 00:05:00.25"},
    ]
    assert [(r.topic, r.offset) for r in rows] == [("T", 7)] * 2


def test_message_times_are_utc_in_any_zone(spark):
    # A clock that New York has twice, and one before the epoch.
    seconds = [300, 1730611800, 1730615400, -86399]
    frame = spark.createDataFrame([(s,) for s in seconds], "s long").select(
        "s", F.timestamp_seconds("s").alias("window_end")
    )
    with session_conf(spark, {"spark.sql.session.timeZone": "America/New_York"}):
        rows = messages.to_messages(frame, "T", F.col("s")).collect()
    assert {r.offset: json.loads(r.value)["window_end"] for r in rows} == {
        300: "1970-01-01 00:05:00",
        1730611800: "2024-11-03 05:30:00",
        1730615400: "2024-11-03 06:30:00",
        -86399: "1969-12-31 00:00:01",
    }
