"""Global time order of ticks, as a distributed sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickbars.operators.names import free, quoted
from tickbars.session import new_run_dir

PUBLISH_ORDER = ("Timestamp", "Ticker", "Arrival")


def time_order(ticks: DataFrame, order: Sequence[str] = PUBLISH_ORDER) -> DataFrame:
    """Ticks of all tickers merged in time order; input files need not be sorted."""
    return ticks.orderBy(*order)


def sorted_parts(
    df: DataFrame,
    order: Sequence[str],
    path: str | None = None,
    partitions: int | None = None,
    names: Sequence[str] = ("_part", "_place"),
) -> DataFrame:
    """``df`` range partitioned and sorted by ``order``, with each row's part and place
    as columns of the given ``names``.

    Parts are of like size, whatever value of ``order`` is frequent, as long as whole
    ``order`` tuples are not. They are written, so that later reads see one and the same
    split even when a task is run again. The table goes to ``path``, or under the shared
    folder, and is the caller's to delete. Give ``partitions`` where the session's count
    would make parts larger than a task can sort.
    """
    spark = df.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = path or new_run_dir(spark, "sorted-parts")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    (
        df.repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .withColumn(names[0], F.spark_partition_id())
        .withColumn(names[1], place)
        .write.parquet(path)
    )
    return spark.read.parquet(path)


def with_position(
    df: DataFrame,
    order: Sequence[str] = PUBLISH_ORDER,
    name: str = "position",
    path: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Number rows 1, 2, ... in ``order`` without bringing them into one task.

    A row's number is its place in its part of ``sorted_parts`` plus the rows of the
    parts before, which are as many numbers as there are parts.
    """
    part, place, offset = free(df, "_part", "_place", "_offset")
    placed = sorted_parts(df, order, path, partitions, (part, place))
    # Bounded by the partition count, hence the one-task window and the broadcast.
    before = W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part)
        .agg(F.count("*").alias("rows"))
        .select(part, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias(offset))
    )
    return placed.join(F.broadcast(offsets), part).select(
        *quoted(df), (F.col(offset) + F.col(place) + 1).alias(name)
    )
