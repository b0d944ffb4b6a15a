"""Topics in Kafka. Needs the public spark-sql-kafka and spark-avro packages on the session.

Neither package is part of a plain Spark installation, so these builders are the only
ones the tests do not run; everything behind them takes any DataFrame of messages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.avro.functions import from_avro, to_avro
from pyspark.sql.streaming import StreamingQuery

from tickbars.functions.times import event_time
from tickbars.operators.messages import message_value
from tickbars.operators.metric import MARKET_TOPIC
from tickbars.schemas import MARKET_EVENT, MARKET_EVENT_AVRO

# The metric topics served by default.
METRIC_TOPICS = ["OHLC_5M", "OHLC_5M_EMA_9", "OHLC_5M_EMA_12"]

# Registry framing: one zero byte and a four-byte schema id before the Avro body.
_FRAME_BYTES = 5


def event_stream(
    spark: SparkSession,
    servers: str,
    topic: str = MARKET_TOPIC,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Market events as a stream of ticks; the offset is the arrival position."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return decode_events(reader.load())


def decode_events(messages: DataFrame) -> DataFrame:
    """Registry-framed Avro values as ticks."""
    body = F.expr(f"substring(value, {_FRAME_BYTES + 1})")
    event = from_avro(body, MARKET_EVENT_AVRO)
    return (
        messages.select(event.alias("event"), F.col("offset").alias("Arrival"))
        .select("event.*", "Arrival")
        .withColumn("event_time", event_time(F.col("Timestamp")))
    )


def encode_events(ticks: DataFrame, schema_id: int) -> DataFrame:
    """Ticks as registry-framed Avro values, keyed by ticker so that its order holds."""
    event = F.struct(*MARKET_EVENT.names)
    frame = F.unhex(F.lit(f"00{schema_id:08x}"))
    return ticks.select(
        F.col("Ticker").cast("binary").alias("key"),
        F.concat(frame, to_avro(event, MARKET_EVENT_AVRO)).alias("value"),
    )


def topic_snapshot(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """All messages a topic holds now, from its earliest to its latest offset."""
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("endingOffsets", "latest")
        .load()
    )


def metric_message_stream(
    spark: SparkSession,
    servers: str,
    topics: list[str] | None = None,
    starting_offsets: str = "latest",
) -> DataFrame:
    """Messages of the metric topics; the query's checkpoint holds what was consumed."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics or METRIC_TOPICS))
        .option("startingOffsets", starting_offsets)
        .load()
        .select("topic", F.col("value").cast("string").alias("value"), "offset")
    )


def write_messages(messages: DataFrame, servers: str, topic: str) -> None:
    """Append ``key``/``value`` rows to a topic."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def start_topic(
    metric: DataFrame, servers: str, topic: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Append a streamed metric to a topic as JSON, keyed by ticker."""
    messages = metric.select(
        F.col("ticker").cast("binary").alias("key"), message_value(metric).alias("value")
    )
    writer = (
        messages.writeStream.queryName(topic)
        .format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return (writer.trigger(**trigger) if trigger else writer).start()
