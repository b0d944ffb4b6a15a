"""Newest rows per key, retention, and the snapshot of the newest bar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickbars.operators.change import price_change
from tickbars.operators.names import free

RETENTION = 1000
CANDLES = 60

_SALTS = 1024


def latest_n(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], count: int | None = CANDLES
) -> DataFrame:
    """The ``count`` newest rows of each key by ``order``; None keeps all.

    Groups of tasks are cut first, each in a task of its own, then their rows meet: a hot
    key never has more than ``count`` rows from each of a bounded number of groups in one
    task. Spark also cuts in every task before the shuffle, up to the count that
    ``spark.sql.optimizer.windowGroupLimitThreshold`` allows.
    """
    if count is None:
        return df
    # By task, not by row, so that the cut within a task stays at ``count`` rows.
    group = F.pmod(F.spark_partition_id(), F.lit(_SALTS))
    [salt] = free(df, "_salt")
    salted = _newest(df.withColumn(salt, group), [*keys, salt], order, count)
    return _newest(salted.drop(salt), keys, order, count)


def _newest(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], count: int
) -> DataFrame:
    newest_first = W.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    [rank] = free(df, "_rank")
    return (
        df.withColumn(rank, F.row_number().over(newest_first))
        .filter(F.col(rank) <= count)
        .drop(rank)
    )


def keep_last(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    keep: int = RETENTION,
) -> DataFrame:
    """Retention: what is left when each key holds no more than ``keep`` rows."""
    return latest_n(df, keys, order, keep)


def latest_row(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: dict[str, Column],
) -> DataFrame:
    """One row per key: ``columns`` taken from its newest row, combined before the shuffle.

    One column by one order column is a hash aggregate. More of either must stay
    together in a struct, for which Spark sorts each task's rows by key.
    """
    by = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    if len(columns) == 1:
        [(name, column)] = columns.items()
        return df.groupBy(*keys).agg(F.max_by(column, by).alias(name))
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    [newest] = free(df, "_newest")
    return df.groupBy(*keys).agg(F.max_by(row, by).alias(newest)).select(*keys, f"{newest}.*")


def latest_bar(bars: DataFrame, indicators: DataFrame) -> DataFrame:
    """Per ticker the newest bar, its change, and the newest indicator or 0 without one."""
    # Two bars carry the change; the rest of the history is cut before the shuffle.
    newest = latest_n(
        price_change(latest_n(bars, ["ticker"], ["window_end"], 2)),
        ["ticker"],
        ["window_end"],
        1,
    )
    means = latest_row(
        indicators, ["ticker"], ["snapshot_time"], {"ema": F.col("ema_value")}
    )
    return newest.join(means, "ticker", "left").select(
        "ticker",
        F.col("window_end").alias("time"),
        F.col("close_price").alias("close"),
        "change",
        "percent_change",
        F.col("high_price").alias("high"),
        F.col("low_price").alias("low"),
        F.coalesce("volume", F.lit(0)).alias("volume"),
        F.coalesce("ema", F.lit(0.0)).alias("ema"),
    )
