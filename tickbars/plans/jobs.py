"""Batch jobs: training on topics, and publishing ticks in time order."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.models.base import Model
from tickbars.operators.messages import decode, for_tickers
from tickbars.operators.order import with_position
from tickbars.schemas import topic_schema
from tickbars.session import store


@dataclass(frozen=True)
class Outcome:
    """What became of a model: predictions for the rows it was trained on, or why not."""

    model: Model
    predictions: DataFrame | None = None
    reason: str = ""

    @property
    def trained(self) -> bool:
        return self.predictions is not None


def train_job(
    read_topic: Callable[[str], DataFrame],
    models: Sequence[Model],
    topics: Sequence[str] = (),
    schemas_dir: Path | str | None = None,
) -> list[Outcome]:
    """Train each model on its topic; one outcome per model of ``topics``, or of all.

    ``read_topic`` gives a topic's messages with a ``value`` column. It is asked once a
    topic, and what it parses to is stored, so that a model predicts for the very rows it
    was fitted on though the topic goes on. No model's failure stops the others.
    """
    loaded: dict[str, DataFrame | str] = {}
    outcomes = []
    for model in models:
        if topics and model.topic not in topics:
            continue
        if model.topic not in loaded:
            loaded[model.topic] = _load(model.topic, read_topic, schemas_dir)
        outcomes.append(_train(model, loaded[model.topic]))
    return outcomes


def _load(
    topic: str, read_topic: Callable[[str], DataFrame], schemas_dir: Path | str | None
) -> DataFrame | str:
    """The topic's rows, or the reason why there are none."""
    schema = topic_schema(topic, schemas_dir)
    if schema is None:
        return f"no schema for topic {topic}"
    try:
        rows = store(decode(read_topic(topic), schema), f"topic-{topic}")
    except Exception as error:
        return f"topic {topic} could not be read: {error}"
    return f"topic {topic} has no rows" if rows.isEmpty() else rows


def _train(model: Model, rows: DataFrame | str) -> Outcome:
    if isinstance(rows, str):
        return Outcome(model, reason=rows)
    own = for_tickers(rows, model.tickers)
    try:
        if own.isEmpty():
            return Outcome(model, reason=f"no rows of {model.tickers} in {model.topic}")
        model.fit(own)
        return Outcome(model, model.predict(own))
    except Exception as error:
        return Outcome(model, reason=f"{model.name} failed: {error}")


#: Offsets leave this many bits for the places within a slice.
SLICE_BITS = 40


def publish_job(
    slices: Iterable[DataFrame], write: Callable[[DataFrame, int], None]
) -> None:
    """Publish ticks slice by slice, in order of time.

    ``slices`` are ticks of successive stretches of time, such as one date each; ``write``
    gets each with its number and a column ``offset``, the place of every row in the whole
    publication: later slices have greater ones, and within a slice they follow time,
    ticker and arrival. A slice is range-partitioned by time, so a ticker that has most of
    its rows fills as many tasks as any other part of it. Tasks write side by side, so the
    order in which rows land is not theirs: readers order by the offset, or by time.
    """
    for number, ticks in enumerate(slices):
        placed = with_position(ticks, name="offset")
        write(placed.withColumn("offset", F.lit(number << SLICE_BITS) + F.col("offset")), number)
