"""Where a streamed metric goes and where the next one reads it: tables, messages or topics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickbars.operators.messages import message_value
from tickbars.schemas import message_schema
from tickbars.session import make_folder
from tickbars.sources import kafka


class Hop:
    """Takes a metric's rows under its table's name and gives them to the next metric."""

    def start(self, rows: DataFrame, table: str, checkpoint: str, **trigger) -> StreamingQuery:
        raise NotImplementedError

    def stream(self, table: str, schema: T.StructType) -> DataFrame:
        raise NotImplementedError

    def append(self, table: str) -> Callable[[DataFrame, int], None] | None:
        """What takes the rows of one micro-batch as well, if they go anywhere else than
        into a table of their own."""
        return None


class TableHop(Hop):
    """Parquet tables under ``root``.

    ``max_files_per_trigger`` bounds a micro-batch, for tables whose files land in order
    of time. The files of one micro-batch of bars do not: taken apart, some would be late.
    """

    def __init__(self, spark: SparkSession, root: str, max_files_per_trigger: int | None = None):
        self.spark = spark
        self.root = root
        self.limit = max_files_per_trigger

    def start(self, rows: DataFrame, table: str, checkpoint: str, **trigger) -> StreamingQuery:
        writer = rows.writeStream.queryName(table).format("parquet").outputMode("append")
        options = {"path": f"{self.root}/{table}", "checkpointLocation": checkpoint}
        return writer.options(**options).trigger(**trigger).start()

    def stream(self, table: str, schema: T.StructType) -> DataFrame:
        path = f"{self.root}/{table}"
        self.spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
        reader = self.spark.readStream.schema(schema)
        if self.limit is not None:
            reader = reader.option("maxFilesPerTrigger", self.limit)
        return reader.parquet(path)


class MessageHop(Hop):
    """JSON messages, keyed by ticker, in Parquet tables of key and value under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def path(self, table: str) -> str:
        return f"{self.root}/messages/{table}"

    def start(self, rows: DataFrame, table: str, checkpoint: str, **trigger) -> StreamingQuery:
        sent = metric_messages(rows).writeStream.queryName(table).format("parquet")
        options = {"path": self.path(table), "checkpointLocation": checkpoint}
        return sent.outputMode("append").options(**options).trigger(**trigger).start()

    def stream(self, table: str, schema: T.StructType) -> DataFrame:
        make_folder(self.spark, self.path(table))
        return typed_rows(self._reader(self.spark.readStream).parquet(self.path(table)), schema)

    def read(self, table: str) -> DataFrame:
        """The messages of ``table`` so far."""
        return self._reader(self.spark.read).parquet(self.path(table))

    def append(self, table: str) -> Callable[[DataFrame, int], None]:
        def write(rows: DataFrame, batch_id: int) -> None:
            part = f"{self.path(table)}/part-{batch_id:09d}"
            metric_messages(rows).write.mode("overwrite").parquet(part)

        return write

    @staticmethod
    def _reader(reader):
        return reader.schema("key string, value string").option("recursiveFileLookup", True)


class KafkaHop(Hop):
    """JSON messages in Kafka topics, keyed by ticker. Needs Spark's Kafka package."""

    def __init__(self, spark: SparkSession, servers: str):
        self.spark = spark
        self.servers = servers

    def start(self, rows: DataFrame, table: str, checkpoint: str, **trigger) -> StreamingQuery:
        return kafka.start_topic(rows, self.servers, table, checkpoint, **trigger)

    def stream(self, table: str, schema: T.StructType) -> DataFrame:
        sent = kafka.metric_message_stream(self.spark, self.servers, [table], "earliest")
        return typed_rows(sent, schema)

    def append(self, table: str) -> Callable[[DataFrame, int], None]:
        return lambda rows, _: kafka.write_messages(metric_messages(rows), self.servers, table)


def metric_messages(rows: DataFrame) -> DataFrame:
    """Rows of a metric as JSON, keyed by ticker."""
    return rows.select(F.col("ticker").alias("key"), message_value(rows).alias("value"))


def typed_rows(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """JSON messages of a metric as its rows; their times are UTC."""
    data = F.from_json(F.col("value").cast("string"), message_schema(schema))
    flat = messages.select(F.inline(F.array(data)))
    return flat.select(
        *[
            F.concat(F.col(f.name), F.lit("Z")).cast("timestamp").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in schema.fields
        ]
    )
