"""Topics as plain tables: keyed messages in Parquet, read and streamed by Spark itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tickbars.session import exists, make_folder

MESSAGE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("offset", T.LongType()),
    ]
)


class MessageTable:
    """A folder of Parquet parts of key, value and offset.

    Offsets come with the messages and say in which order they were published. A part is
    written by overwriting, so that one that is published again adds nothing twice.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def append(self, messages: DataFrame, part: int) -> None:
        rows = messages.select(MESSAGE.names)
        rows.write.mode("overwrite").parquet(f"{self.path}/part-{part:09d}")

    def read(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], MESSAGE)
        return self._reader(self.spark.read).parquet(self.path)

    def stream(self, max_files_per_trigger: int | None = None) -> DataFrame:
        make_folder(self.spark, self.path)
        reader = self._reader(self.spark.readStream)
        if max_files_per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return reader.parquet(self.path)

    @staticmethod
    def _reader(reader):
        return reader.schema(MESSAGE).option("recursiveFileLookup", True)
