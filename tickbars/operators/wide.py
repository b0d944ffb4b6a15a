"""Means over wide frames: two sums a row, however many rows a frame has.

The rows of a key are cut into blocks as wide as the frame. A frame that ends in some
block then is the beginning of that block and the end of the one before; both are running
sums within a block. So a row costs one sum of its own and one looked up from a frame's
width before it, where a window over the frame would add up all its rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickbars.operators.names import free, quoted
from tickbars.operators.order import with_position


def with_wide_mean(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    width: int,
    value: str,
    name: str,
    *,
    hot: bool = False,
) -> DataFrame:
    """Add the mean of ``value`` over the current and up to ``width - 1`` earlier rows.

    Sums are of ``width`` values at most, so that nothing cancels. Nulls don't count.
    With ``hot``, a key may have more rows than a task: rows are numbered by a sort over
    all tasks, blocks are groups of their own, and the earlier sums come by a join.
    """
    number, block, first, own, before = free(
        df, "_number", "_block", "_first", "_own", "_before"
    )
    if hot:
        placed = with_position(df, [key, *order], number)
        # One row per key, combined in the tasks.
        firsts = placed.groupBy(F.col(key).alias(first)).agg(F.min(number).alias(own))
        rows = placed.join(firsts, F.col(key).eqNullSafe(F.col(first))).withColumn(
            number, F.col(number) - F.col(own)
        )
        rows = rows.drop(first, own)
    else:
        rows = df.withColumn(number, F.row_number().over(W.partitionBy(key).orderBy(*order)) - 1)
    rows = rows.withColumn(block, F.floor(F.col(number) / width))
    # Its last row's frame is the block itself.
    whole = F.col(number) % width == width - 1
    group = W.partitionBy(key, block)
    if not hot:
        summed = rows.withColumn(own, _sums(value, group.orderBy(number))).withColumn(
            before, _sums(value, group.orderBy(F.desc(number)))
        )
        earlier = F.lag(before, width - 1).over(W.partitionBy(key).orderBy(number))
        summed = summed.withColumn(before, F.when(~whole, earlier))
    else:
        ends = rows.select(
            F.col(key).alias(first),
            (F.col(number) + (width - 1)).alias(block),
            _sums(value, group.orderBy(F.desc(number))).alias(before),
        )
        starts = rows.withColumn(own, _sums(value, group.orderBy(number))).drop(block)
        met = F.col(key).eqNullSafe(F.col(first)) & (F.col(number) == F.col(block)) & ~whole
        summed = starts.join(ends, met, "left")
    total = F.coalesce(F.col(f"{own}.total"), F.lit(0.0)) + F.coalesce(
        F.col(f"{before}.total"), F.lit(0.0)
    )
    count = F.col(f"{own}.values") + F.coalesce(F.col(f"{before}.values"), F.lit(0))
    return summed.select(*quoted(df), F.when(count > 0, total / count).alias(name))


def _sums(value: str, window: WindowSpec) -> Column:
    """The running sum and the number of values, both up to the current row."""
    frame = window.rowsBetween(W.unboundedPreceding, W.currentRow)
    return F.struct(
        F.sum(F.col(value).cast("double")).over(frame).alias("total"),
        F.count(value).over(frame).alias("values"),
    )
