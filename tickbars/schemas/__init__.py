"""Row shapes of ticks, bars, indicators and served entries."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import types as T

# Column names and types of the market event, bar and indicator rows.
MARKET_EVENT = T.StructType(
    [
        T.StructField("Date", T.StringType()),
        T.StructField("Timestamp", T.LongType()),
        T.StructField("EventType", T.StringType()),
        T.StructField("Ticker", T.StringType()),
        T.StructField("Price", T.DoubleType()),
        T.StructField("Quantity", T.IntegerType()),
        T.StructField("Exchange", T.StringType()),
        T.StructField("Conditions", T.StringType()),
    ]
)

BAR = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("open_price", T.DoubleType()),
        T.StructField("high_price", T.DoubleType()),
        T.StructField("low_price", T.DoubleType()),
        T.StructField("close_price", T.DoubleType()),
        T.StructField("volume", T.LongType()),
    ]
)

INDICATOR = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("snapshot_time", T.TimestampType()),
        T.StructField("ema_value", T.DoubleType()),
    ]
)

_AVRO_TYPES = {"string": "string", "bigint": "long", "double": "double", "int": "int"}

# The market event as an Avro record, for the Kafka topic.
MARKET_EVENT_AVRO = json.dumps(
    {
        "type": "record",
        "name": "MarketEvent",
        "fields": [
            {"name": f.name, "type": _AVRO_TYPES[f.dataType.simpleString()]}
            for f in MARKET_EVENT.fields
        ],
    }
)

# A tick as Arrival-stamped and stored, ready for the bar operators.
TICK = T.StructType(
    MARKET_EVENT.fields
    + [
        T.StructField("Arrival", T.LongType()),
        T.StructField("event_time", T.TimestampType()),
    ]
)

# The type names that a topic's schema file may use.
FIELD_TYPES = ("double", "long", "string")


def schema_from_names(columns: dict[str, str]) -> T.StructType:
    """The row shape that a topic's file describes; other type names stand for text."""
    row = T.StructType()
    for name, kind in columns.items():
        wanted = kind.strip().lower()
        row.add(name, wanted if wanted in FIELD_TYPES else "string")
    return row


def message_schema(row: T.StructType) -> T.StructType:
    """``row`` as its JSON message has it: times are text."""
    return T.StructType(
        [
            T.StructField(f.name, T.StringType())
            if isinstance(f.dataType, T.TimestampType)
            else f
            for f in row.fields
        ]
    )


#: Schema files of topics that the package brings.
TOPIC_FOLDER = Path(__file__).parent / "topics"

TOPIC_SCHEMAS = {"OHLC_5M": message_schema(BAR)}


def topic_schema(topic: str, folder: Path | str | None = None) -> T.StructType | None:
    """A topic's message schema, or None when it has none.

    With ``folder`` it is read from ``<folder>/<topic>.json``, which maps names to types.
    """
    if folder is None:
        return TOPIC_SCHEMAS.get(topic)
    path = Path(folder) / f"{topic}.json"
    return schema_from_names(json.loads(path.read_text())) if path.exists() else None
