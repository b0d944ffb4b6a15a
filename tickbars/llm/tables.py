"""Helpers the operators share: tables, and places of tokenizer files."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.session import new_run_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: its lineage ends there.

    Executors keep a shuffle's files until the driver collects the plan that made them.
    """
    path = new_run_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, made longer until ``df`` has no column of it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def whole_row(df: DataFrame) -> Column:
    """A hash of all columns that can be hashed; a null differs from any value."""
    hashed = []
    for field in df.schema.fields:
        if "map<" not in field.dataType.simpleString() and field.dataType != T.VariantType():
            column = F.col(f"`{field.name}`")
            hashed += [column, column.isNull()]
    return F.xxhash64(*hashed)


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer's file, the same on driver and executors."""
    import public_tokenizers

    return str(public_tokenizers.path(name))
