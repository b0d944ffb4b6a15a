"""Linear regression of a bar's close on its other values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame

from tickbars.models.base import Model

FEATURES = ["open_price", "high_price", "low_price", "volume"]
LABEL = "close_price"


class LinearBarModel(Model):
    """Close from open, high, low and volume, with the library's default settings.

    With so few features the fit is one distributed pass that sums moments, so it grows
    with the rows and holds nothing of them.
    """

    def __init__(self, tickers: Sequence[str] = (), topic: str = "OHLC_5M"):
        super().__init__("LinearBarModel", topic, tickers)

    def fit(self, df: DataFrame) -> PipelineModel:
        # Rows with an invalid feature are left out, in training and in prediction.
        assembler = VectorAssembler(
            inputCols=FEATURES, outputCol="features", handleInvalid="skip"
        )
        regression = LinearRegression(featuresCol="features", labelCol=LABEL)
        self.pipeline = Pipeline(stages=[assembler, regression]).fit(df.dropna())
        return self.pipeline
