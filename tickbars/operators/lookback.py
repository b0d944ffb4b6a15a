"""Row windows that reach a few rows back, whole or split so that no key fills one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickbars.operators.names import free
from tickbars.operators.order import sorted_parts


# Split groups by balanced ranges instead of stretches of time.
BY_RANGE = "range"


def with_lookback(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    depth: int,
    columns: dict[str, Column],
    split: int | str | None = None,
) -> DataFrame:
    """Add ``columns``, aggregates over the current and up to ``depth`` earlier rows of a key.

    ``order`` starts with a timestamp. ``split`` says how the rows of a key are spread:

    - None: not at all. This suits tables that are bounded per key, as bars are by the
      time span.
    - A number of seconds: a group is one key in one stretch of time. It should hold many
      more rows than ``depth`` and still fit a task.
    - ``"range"``: a group is one key in one of the like-sized parts of the sorted table,
      which is written first. No key and no burst in time can then fill a task.

    Each group also gets the ``depth`` rows that precede it, so that every frame is whole.
    """
    if split is None or not depth:
        return _add(df, [key], order, depth, columns)

    chunk, place, carry = free(df, "_chunk", "_place", "_carried")
    if split == BY_RANGE:
        rows = sorted_parts(df, [key, *order], names=(chunk, place)).drop(place)
    else:
        stretch = F.call_function("div", F.unix_seconds(order[0]), F.lit(split))
        rows = df.withColumn(chunk, stretch)
    # Both what is summed and what is carried come from this one exchange, so the input
    # is read once.
    rows = rows.repartition(key, chunk)
    carried = _rows_before_chunks(rows, key, order, depth, chunk).repartition(key, chunk)
    both = rows.withColumn(carry, F.lit(False)).unionByName(
        carried.withColumn(carry, F.lit(True))
    )
    added = _add(both, [key, chunk], order, depth, columns)
    return added.filter(~F.col(carry)).drop(carry, chunk)


def _add(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    depth: int,
    columns: dict[str, Column],
) -> DataFrame:
    frame = W.partitionBy(*group).orderBy(*order).rowsBetween(-depth, 0)
    return df.select("*", *[c.over(frame).alias(name) for name, c in columns.items()])


def _rows_before_chunks(
    rows: DataFrame, key: str, order: Sequence[str], depth: int, chunk: str
) -> DataFrame:
    """The ``depth`` rows before each chunk, with that chunk as theirs.

    They are among the last ``depth`` rows of some earlier chunk. Chunks are cut to those
    where they lie, and only what is left is put together per key.
    """
    back, near, following = free(rows, "_back", "_near", "_next")
    newest_first = W.partitionBy(key, chunk).orderBy(*[F.col(c).desc() for c in order])
    tails = (
        rows.withColumn(back, F.row_number().over(newest_first))
        .filter(F.col(back) <= depth)
        .drop(back)
    )
    # A tail row precedes the chunks that start within the next ``depth`` tail rows.
    ahead = W.partitionBy(key).orderBy(*order).rowsBetween(1, depth)
    return (
        tails.withColumn(near, F.collect_set(chunk).over(ahead))
        .withColumn(following, F.explode(F.array_except(near, F.array(chunk))))
        .drop(near, chunk)
        .withColumnRenamed(following, chunk)
    )
