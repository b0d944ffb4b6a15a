"""The market view over an ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.functions.times import event_time

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def as_ticks(events: DataFrame) -> DataFrame:
    """Events as ticks: type, value and the ``k`` of the properties as ticker, price, size.

    Event ids are given in arrival order. Columns that are not used are never read.
    """
    ts_ns = F.unix_micros(F.col("ts").cast("timestamp")) * 1000
    return events.select(
        F.date_format("ts", "yyyy-MM-dd").alias("Date"),
        ts_ns.alias("Timestamp"),
        F.lit("TRADE").alias("EventType"),
        F.col("event_type").alias("Ticker"),
        F.col("value").alias("Price"),
        F.get_json_object("props", "$.k").cast("int").alias("Quantity"),
        F.lit("").alias("Exchange"),
        F.lit("").alias("Conditions"),
        F.col("event_id").alias("Arrival"),
    ).withColumn("event_time", event_time(F.col("Timestamp")))


def market_ticks(spark: SparkSession, events_path: str) -> DataFrame:
    return as_ticks(spark.read.schema(EVENTS).parquet(events_path))


def market_tick_stream(
    spark: SparkSession, events_path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same ticks as a stream. Files must land in time order to be taken one by one;
    without a limit all files present form one batch, in which order does not matter."""
    reader = spark.readStream.schema(EVENTS)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # A glob serves a single file as well as a folder.
    return as_ticks(reader.parquet(f"{events_path.rstrip('/')}*"))
