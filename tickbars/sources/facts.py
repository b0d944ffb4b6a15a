"""Company facts, statements and news from CSV tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_facts(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """CSV with quoted commas, doubled quotes and line breaks in quotes.

    Without a schema the types are inferred, which reads the files once more.
    """
    reader = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", True)
    )
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)
