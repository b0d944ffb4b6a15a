"""What a model is: a name, a topic, its tickers, and fit and predict."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame


class Model(ABC):
    """Subclass this to add a model to the training job.

    It is trained on the rows of ``tickers`` in ``topic``; without tickers, on all.
    """

    def __init__(self, name: str, topic: str, tickers: Sequence[str] = ()):
        self.name = name
        self.topic = topic
        self.tickers = list(tickers)
        self.pipeline: PipelineModel | None = None

    @property
    def fitted(self) -> bool:
        return self.pipeline is not None

    @abstractmethod
    def fit(self, df: DataFrame) -> PipelineModel:
        """Train on ``df`` and keep the result as ``pipeline``."""

    def predict(self, df: DataFrame) -> DataFrame:
        """``df`` with predictions of the fitted model."""
        if self.pipeline is None:
            raise ValueError("fit the model before predicting")
        return self.pipeline.transform(df)
