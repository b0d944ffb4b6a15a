"""Change of a bar against the one before it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.operators.lookback import with_lookback


def price_change(
    bars: DataFrame,
    key: str = "ticker",
    time: str = "window_end",
    close: str = "close_price",
    split: int | str | None = None,
) -> DataFrame:
    """Add ``change`` and ``percent_change`` to every bar; both are 0.0 for a first bar.

    ``split`` spreads the rows of a key, for tables that are not bounded per key.
    """
    # Over the bar and the one before: that one's close, and whether there is one.
    pairs = with_lookback(
        bars,
        key,
        [time],
        1,
        {"_previous": F.first(close), "_rows": F.count(F.lit(1))},
        split,
    )
    first, previous = F.col("_rows") == 1, F.col("_previous")
    change = F.col(close) - previous
    percent = F.when(first | (previous == 0), 0.0).otherwise(change / previous * 100)
    return pairs.select(
        *bars.columns,
        F.when(first, 0.0).otherwise(change).alias("change"),
        percent.alias("percent_change"),
    )
