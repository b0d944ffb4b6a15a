"""What a metric is: a name, a source and a target table, and a query in two forms."""

from __future__ import annotations

from abc import ABC, abstractmethod

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

MARKET_TOPIC = "market"


class Metric(ABC):
    """Subclass this to add a metric over finished tables.

    ``schema`` has the columns of the target table, so that a stream can read it before
    it has files.
    """

    schema: StructType

    def __init__(self, source_table: str = MARKET_TOPIC, target_table: str | None = None):
        self.source_table = source_table
        self.target_table = self.name if target_table is None else target_table

    @property
    @abstractmethod
    def name(self) -> str:
        """Logical name, also the name of the target table unless one is given."""

    @abstractmethod
    def batch(self, source: DataFrame) -> DataFrame:
        """The metric over a finished table."""


class StreamedMetric(Metric):
    """A metric that is one streaming query; ``batch`` and ``stream`` give the same rows."""

    @abstractmethod
    def stream(self, source: DataFrame) -> DataFrame:
        """The metric over a streaming DataFrame, in append mode."""
