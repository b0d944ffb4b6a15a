"""Topic messages: encoding, decoding, routing, and the shape of served entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.functions.times import bar_time, event_time, indicator_time, utc_clock
from tickbars.schemas import MARKET_EVENT
from tickbars.functions.values import to_number

# Fields of a message and the name each has in a served entry.
BAR_FIELDS = {
    "window_start": "start",
    "window_end": "end",
    "open_price": "open",
    "high_price": "high",
    "low_price": "low",
    "close_price": "close",
    "volume": "volume",
}
INDICATOR_FIELDS = {"ema_value": "ema", "snapshot_time": "time"}


def to_messages(df: DataFrame, topic: str, offset: Column) -> DataFrame:
    """Rows as JSON messages of ``topic``."""
    return df.select(
        F.lit(topic).alias("topic"),
        message_value(df).alias("value"),
        offset.cast("bigint").alias("offset"),
    )


def message_value(df: DataFrame) -> Column:
    """A row as JSON; times as UTC ``yyyy-MM-dd HH:mm:ss``, a fraction only if there is one."""
    return F.to_json(
        F.struct(
            *[
                utc_clock(F.col(f.name)).cast("string").alias(f.name)
                if isinstance(f.dataType, T.TimestampType)
                else F.col(f.name)
                for f in df.schema.fields
            ]
        )
    )


def decode(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Message values as flat typed columns; text that is not JSON gives nulls."""
    # A generator is run once per row. As a plain column the parse would be copied into
    # every filter that is later put on one of its fields.
    data = F.from_json(F.col("value").cast("string"), schema)
    return messages.select(F.inline(F.array(data)))


def event_messages(ticks: DataFrame) -> DataFrame:
    """Ticks as JSON messages keyed by ticker."""
    value = F.to_json(F.struct(*MARKET_EVENT.names))
    return ticks.select(F.col("Ticker").alias("key"), value.alias("value"))


def placed_messages(ticks: DataFrame) -> DataFrame:
    """The same of published ticks, with their ``offset``."""
    value = F.to_json(F.struct(*MARKET_EVENT.names))
    return ticks.select(F.col("Ticker").alias("key"), value.alias("value"), "offset")


def event_ticks(messages: DataFrame) -> DataFrame:
    """Messages of ticks back as ticks; the offset is the arrival position.

    Where offsets are a broker's, those of different partitions are not in order of time:
    bars over them should go by ``("Timestamp", "Arrival")``.
    """
    data = F.from_json("value", MARKET_EVENT)
    rows = messages.select(F.inline(F.array(data)), F.col("offset").alias("Arrival"))
    return rows.withColumn("event_time", event_time(F.col("Timestamp")))


def message_kind(topic: Column) -> Column:
    """``EMA`` or ``OHLC`` from the topic's name, the first of them taking precedence."""
    upper = F.upper(topic)
    return F.when(F.contains(upper, F.lit("EMA")), "EMA").when(
        F.contains(upper, F.lit("OHLC")), "OHLC"
    )


def serving_key(topic: Column, ticker: Column) -> Column:
    return F.concat_ws(":", topic, ticker)


def serving_entries(messages: DataFrame) -> DataFrame:
    """Messages of metric topics as entries, keyed by topic and ticker.

    Left out are topics of no known kind, empty or broken values, messages without a
    ticker, and messages whose payload is all null. Payload fields stay text, as the
    serving side holds them; ``as_bars`` and ``as_indicators`` read them as numbers.
    The message offset, which grows with arrival, becomes the entry id.
    """
    kind = F.col("kind")
    names = ["ticker", *BAR_FIELDS, *INDICATOR_FIELDS]
    payload = [
        F.when(kind == "OHLC", F.col(field)).alias(name)
        for field, name in BAR_FIELDS.items()
    ] + [
        F.when(kind == "EMA", F.col(field)).alias(name)
        for field, name in INDICATOR_FIELDS.items()
    ]
    # A generator again, so that one parse serves the filters and the fields.
    entries = (
        messages.select(
            "topic",
            F.col("offset").alias("entry_id"),
            message_kind(F.col("topic")).alias("kind"),
            F.col("value").cast("string").alias("value"),
        )
        .filter(kind.isNotNull())
        .select("topic", "entry_id", "kind", F.json_tuple("value", *names).alias(*names))
        .filter(F.col("ticker") != "")
        .select(
            "topic",
            "ticker",
            serving_key(F.col("topic"), F.col("ticker")).alias("key"),
            "entry_id",
            "kind",
            *payload,
        )
    )
    values = [*BAR_FIELDS.values(), *INDICATOR_FIELDS.values()]
    return entries.filter(F.coalesce(*values).isNotNull())


def as_bars(entries: DataFrame) -> DataFrame:
    """Served bars with numbers and a timestamp; what cannot be read is null."""
    numbers = ["open", "high", "low", "close", "volume"]
    return entries.filter(F.col("kind") == "OHLC").select(
        "topic",
        "ticker",
        "entry_id",
        "start",
        "end",
        *[to_number(F.col(c)).alias(c) for c in numbers],
        bar_time(F.col("end")).alias("timestamp"),
    )


def as_indicators(entries: DataFrame) -> DataFrame:
    """Served indicators with a number and a timestamp; what cannot be read is null."""
    return entries.filter(F.col("kind") == "EMA").select(
        "topic",
        "ticker",
        "entry_id",
        "time",
        to_number(F.col("ema")).alias("ema"),
        indicator_time(F.col("time")).alias("timestamp"),
    )


def for_tickers(df: DataFrame, tickers: list[str], column: str = "ticker") -> DataFrame:
    """Rows of ``tickers``; an empty list keeps every row."""
    return df.filter(F.col(column).isin(tickers)) if tickers else df
