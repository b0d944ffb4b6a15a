"""Reads of served entries by id, and ordered output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OLDEST = "-"
NEWEST = "+"


def entry_range(
    entries: DataFrame,
    ticker: str | None = None,
    min_id: int | str = OLDEST,
    max_id: int | str = NEWEST,
    count: int | None = None,
    *,
    id_column: str = "entry_id",
) -> DataFrame:
    """Entries with ``min_id <= id <= max_id``, oldest first, ``-`` and ``+`` being open."""
    if ticker is not None:
        entries = entries.filter(F.col("ticker") == ticker)
    if min_id != OLDEST:
        entries = entries.filter(F.col(id_column) >= int(min_id))
    if max_id != NEWEST:
        entries = entries.filter(F.col(id_column) <= int(max_id))
    ordered = entries.orderBy(id_column)
    return ordered if count is None else ordered.limit(count)


def in_time(df: DataFrame, time: str = "timestamp") -> DataFrame:
    """Oldest first; rows without a time come last."""
    return df.orderBy(F.col(time).asc_nulls_last())
