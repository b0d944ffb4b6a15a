"""Rolling mean over the last rows of a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.operators.latest import latest_n
from tickbars.operators.lookback import with_lookback
from tickbars.operators.metric import MARKET_TOPIC, Metric
from tickbars.operators.wide import with_wide_mean
from tickbars.schemas import INDICATOR


#: From so many rows on, a frame is not summed for every row.
WIDE = 200


class RollingMean(Metric):
    """Mean of ``value`` over the current and up to ``periods - 1`` earlier rows of a key.

    Over bars a plain window will do: a key has one bar per time window, so its size is
    bounded by the time span. Over ticks or any table where a key can be hot, ``split``
    spreads its rows, as ``with_lookback`` describes. ``ties`` are bigint columns that
    order rows of equal time and come with the result. Frames of ``WIDE`` rows and more
    are made of block sums, as ``with_wide_mean`` describes; any ``split`` then spreads
    them by blocks. As a stream it is written by
    ``streaming.means.MeanTable``, which gives the same rows.
    """

    def __init__(
        self,
        periods: int = 9,
        *,
        key: str = "ticker",
        time: str = "window_end",
        value: str = "close_price",
        ties: Sequence[str] = (),
        split: int | str | None = None,
        source_table: str = MARKET_TOPIC,
        target_table: str | None = None,
    ):
        self.periods = periods
        self.key = key
        self.time = time
        self.value = value
        self.ties = list(ties)
        self.split = split
        super().__init__(source_table, target_table)

    @property
    def schema(self) -> T.StructType:
        ticker, time, value = INDICATOR.fields
        ties = [T.StructField(name, T.LongType()) for name in self.ties]
        return T.StructType([ticker, time, *ties, value])

    @property
    def name(self) -> str:
        return f"{self.source_table}_EMA_{self.periods}"

    def batch(self, source: DataFrame) -> DataFrame:
        # Nothing but these columns goes through the shuffle.
        rows = source.select(self.key, self.time, self.value, *self.ties)
        order = [self.time, *self.ties]
        if self.periods >= WIDE:
            hot = self.split is not None
            means = with_wide_mean(
                rows, self.key, order, self.periods, self.value, "ema_value", hot=hot
            )
        else:
            mean = {"ema_value": F.avg(self.value)}
            means = with_lookback(rows, self.key, order, self.periods - 1, mean, self.split)
        return means.select(
            F.col(self.key).alias("ticker"),
            F.col(self.time).alias("snapshot_time"),
            *self.ties,
            "ema_value",
        )

    def latest(self, source: DataFrame) -> DataFrame:
        """The newest mean of each key, from the ``periods`` rows that it is made of."""
        order = [self.time, *self.ties]
        means = self.batch(latest_n(source, [self.key], order, self.periods))
        return latest_n(means, ["ticker"], ["snapshot_time", *self.ties], 1)
