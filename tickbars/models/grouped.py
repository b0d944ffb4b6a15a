"""A linear regression for every ticker, all of them in one pass over the bars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbars.models.base import Model
from tickbars.models.linear import FEATURES, LABEL
from tickbars.session import store

#: A feature whose own part of its variance is less than this tells nothing of its own.
LEAST_SHARE = 1e-10


class GroupedLinearModel(Model):
    """Least squares per value of ``key``, by grouped moments and one solution per group.

    The rows are aggregated once, natively: means, variances and covariances per key, one
    row per task and key in the shuffle. Gaussian elimination then solves every key's
    normal equations as column expressions over that row. Features that are constant in a
    group, or a mix of those before them, get no weight there, as with one row of a key.

    Rows with a null or non-finite feature or label, or no key, take no part in the fit;
    rows with such a feature, or of a key that was not fitted, get no prediction.
    """

    def __init__(
        self,
        tickers: Sequence[str] = (),
        topic: str = "OHLC_5M",
        *,
        key: str = "ticker",
        features: Sequence[str] = tuple(FEATURES),
        label: str = LABEL,
    ):
        super().__init__("GroupedLinearModel", topic, tickers)
        self.key = key
        self.features = list(features)
        self.label = label
        #: ``key``, ``rows``, ``intercept`` and one weight per feature, once fitted.
        self.coefficients: DataFrame | None = None

    @property
    def fitted(self) -> bool:
        return self.coefficients is not None

    def fit(self, df: DataFrame) -> DataFrame:
        self.coefficients = store(self._solved(self._moments(df)), "grouped-model")
        return self.coefficients

    def predict(self, df: DataFrame) -> DataFrame:
        if self.coefficients is None:
            raise ValueError("fit the model before predicting")
        clash = "_model"
        while clash in df.columns:
            clash += "_"
        model = self.coefficients.select(
            F.col(self.key), F.struct("intercept", *self._weights()).alias(clash)
        )
        prediction = F.col(f"{clash}.intercept")
        for feature, weight in zip(self.features, self._weights(), strict=True):
            prediction = prediction + F.col(f"{clash}.{weight}") * F.col(feature)
        usable = df.filter(_finite(self.features))
        return usable.join(model, self.key).select(*df.columns, prediction.alias("prediction"))

    def _weights(self) -> list[str]:
        return [f"weight_{name}" for name in self.features]

    def _moments(self, df: DataFrame) -> DataFrame:
        """One row per key: rows, means m_i and covariances c_i_j; the label comes last."""
        names = [*self.features, self.label]
        columns = {f"x_{i}": F.col(c).cast("double") for i, c in enumerate(names)}
        rows = df.filter(_finite(names) & F.col(self.key).isNotNull()).select(
            self.key, *[c.alias(name) for name, c in columns.items()]
        )
        pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
        return rows.groupBy(self.key).agg(
            F.count("*").alias("rows"),
            *[F.avg(x).alias(f"m_{i}") for i, x in enumerate(columns)],
            *[F.covar_pop(f"x_{i}", f"x_{j}").alias(f"c_{i}_{j}") for i, j in pairs[:-1]],
        )

    def _solved(self, moments: DataFrame) -> DataFrame:
        """Eliminate one feature after the other, then solve from the last backwards.

        Every step is a projection of its own, so that a step's results are columns for
        the next and expressions stay short.
        """
        n = len(self.features)
        left = moments
        for i in range(n):
            left = left.withColumn(f"v_{i}", F.col(f"c_{i}_{i}"))
        for k in range(n):
            own = F.col(f"c_{k}_{k}")
            pivot = F.when(own > LEAST_SHARE * F.col(f"v_{k}"), own)
            left = left.withColumns(
                {f"f_{k}_{j}": _or_zero(F.col(f"c_{k}_{j}") / pivot) for j in range(k + 1, n + 1)}
            )
            left = left.withColumns(
                {
                    f"c_{i}_{j}": F.col(f"c_{i}_{j}") - F.col(f"f_{k}_{i}") * F.col(f"c_{k}_{j}")
                    for i in range(k + 1, n)
                    for j in range(i, n + 1)
                }
            )
        for k in reversed(range(n)):
            weight = F.col(f"f_{k}_{n}")
            for j in range(k + 1, n):
                weight = weight - F.col(f"f_{k}_{j}") * F.col(f"w_{j}")
            left = left.withColumn(f"w_{k}", weight)
        intercept = F.col(f"m_{n}")
        for k in range(n):
            intercept = intercept - F.col(f"w_{k}") * F.col(f"m_{k}")
        return left.select(
            self.key,
            "rows",
            intercept.alias("intercept"),
            *[F.col(f"w_{k}").alias(name) for k, name in enumerate(self._weights())],
        )


def _or_zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0.0))


def _finite(names: Sequence[str]) -> Column:
    found = F.lit(True)
    for name in names:
        value = F.col(name).cast("double")
        found = found & value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    return found
