"""Ordinal regression on graded ratings: cumulative links over hashed text features.

A document's grade is 0 (toxic), 1 (low quality) or 2 (good). One weight per hashed
feature is shared by all grades: ``P(grade >= j) = 1 / (1 + exp(threshold_j - score))``.

Features are sets: lower-cased words, runs of punctuation, and steps of a few shares
(capitals, punctuation, digits, repeated words) and of the length. Every document is
scored over its whole text. The fit alone uses a bounded sample of labelled documents.

Null text is empty and is scored by its length step alone. Labels with a null are no
labels; of several labels of one document the worst holds. With no labels every
document is kept with the top grade. Rows are scored one by one, so null or repeated
ids and extra columns change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.llm.tables import store
from tickbars.llm.textbytes import (
    ALPHANUMERIC,
    NOT_SPACE,
    U64,
    mix,
    slices,
    words,
)

GRADES = 3
_PUNCTUATION = NOT_SPACE & ~ALPHANUMERIC
_CAPITAL = np.zeros(256, dtype=bool)
_CAPITAL[0x41:0x5B] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[0x30:0x3A] = True


@dataclass(frozen=True)
class QualitySettings:
    """``sample`` labelled documents at most are used for the fit; the rest is scoring.

    ``bits``: size of the hash space. ``least_chi_square``: a feature gets a weight if
    its counts by grade differ at least so much from those of all sampled documents;
    rare words that tell nothing stay out. ``ridge``: strength of the L2 penalty.
    """

    sample: int = 30_000
    bits: int = 26
    least_chi_square: float = 18.0
    ridge: float = 1e-5
    steps: int = 300


@dataclass(frozen=True)
class QualityModel:
    """Sorted features, their weights, and the ordered thresholds."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray
    bits: int

    def scores(self, rows: np.ndarray, features: np.ndarray, n: int) -> np.ndarray:
        if not len(self.features):
            return np.zeros(n)
        at = np.searchsorted(self.features, features)
        at[at == len(self.features)] = 0
        known = self.features[at] == features
        return np.bincount(rows[known], self.weights[at[known]], minlength=n)

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2) per row."""
        z = np.clip(self.thresholds[None, :] - scores[:, None], -700, 700)
        return 1 / (1 + np.exp(z))


def grades(labels: DataFrame) -> DataFrame:
    """doc_id, grade: the worst that a document's labels give."""
    return (
        labels.where("doc_id is not null and quality is not null and toxic is not null")
        .select(
            "doc_id",
            F.when(F.col("toxic") > 0, 0)
            .when(F.col("quality") > 0, 2)
            .otherwise(1)
            .alias("grade"),
        )
        .groupBy("doc_id")
        .agg(F.min("grade").alias("grade"))
    )


def fit_quality(
    documents: DataFrame, labels: DataFrame, settings: QualitySettings = QualitySettings()
) -> QualityModel:
    """Fit on the ``settings.sample`` labelled documents whose hashed ids come first.

    Texts stay where they are: features are hashed there, counted by grade with a grouped
    sum, and only the numbers of those that tell grades apart go to the one task that
    fits. Rows equal in id and text count once.
    """
    seen = store(_features(_rated(documents, labels, settings), settings), "quality-features")
    names = np.sort(_telling(seen, settings).toPandas().feature.to_numpy(dtype=np.int64))
    # As the sample bounds the features that may be in it, this does not grow with the
    # documents.
    shared = documents.sparkSession.sparkContext.broadcast(names)
    fitted = store(
        seen.mapInArrow(
            lambda batches: _told(batches, shared.value),
            "key long, grade int, places array<int>",
        )
        .coalesce(1)
        .mapInArrow(
            lambda batches: _fit(batches, shared.value, settings),
            "feature long, weight double",
        ),
        "quality-model",
    ).toPandas()
    bounds = fitted[fitted.feature < 0].sort_values("feature", ascending=False)
    table = fitted[fitted.feature >= 0].sort_values("feature")
    return QualityModel(
        table.feature.to_numpy(),
        table.weight.to_numpy(),
        bounds.weight.to_numpy() if len(bounds) else np.full(GRADES - 1, -np.inf),
        settings.bits,
    )


def _rated(documents: DataFrame, labels: DataFrame, settings: QualitySettings) -> DataFrame:
    """(key, text, grade) of the sample: ``settings.sample`` different rows at most."""
    order = F.xxhash64(F.lit(17), "doc_id")
    chosen = grades(labels).orderBy(order, "doc_id").limit(settings.sample)
    rated = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    key = F.xxhash64(F.lit(17), "doc_id", "text").alias("key")
    rows = rated.select(key, "text", "grade")
    # Ids only; no more rows than ids, unless ids repeat.
    if rated.select("doc_id").count() > settings.sample:
        least = rows.select("key").distinct().orderBy("key").limit(settings.sample)
        rows = rows.where(F.col("key") <= least.agg(F.max("key")).first()[0])
    return rows


def _features(rated: DataFrame, settings: QualitySettings) -> DataFrame:
    """(key, grade, features): the hashed features of every different row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in slices(batch.column("text")):
                rows, features = hashed_features(data, offsets, settings.bits)
                bounds = np.searchsorted(rows, np.arange(high - low + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(low, high - low) for c in ("key", "grade")),
                        pa.ListArray.from_arrays(
                            pa.array(bounds, pa.int32()), pa.array(features, pa.int32())
                        ),
                    ],
                    names=["key", "grade", "features"],
                )

    return rated.mapInArrow(
        run, "key long, grade int, features array<int>"
    ).dropDuplicates(["key"])


def _telling(seen: DataFrame, settings: QualitySettings) -> DataFrame:
    """(feature): those whose counts by grade are far enough from independence."""
    # Three counts.
    totals = {r.grade: r["count"] for r in seen.groupBy("grade").count().collect()}
    by_grade = [F.count_if(F.col("grade") == k).alias(f"seen_{k}") for k in range(GRADES)]
    counted = seen.select("grade", F.explode("features").alias("feature"))
    counted = counted.groupBy("feature").agg(F.count("*").alias("seen"), *by_grade)
    distance = F.lit(0.0)
    for grade, n in sorted(totals.items()):
        share = n / sum(totals.values())
        if share < 1:
            expected = F.col("seen") * F.lit(share)
            distance = distance + F.pow(F.col(f"seen_{grade}") - expected, 2) / expected
    return counted.where(distance >= settings.least_chi_square).select("feature")


def grade_documents(
    documents: DataFrame, model: QualityModel, *, least_good: float = 0.3
) -> DataFrame:
    """Every row with its id, grade probabilities and whether it is kept.

    Kept are documents with ``P(grade >= 2)`` of at least ``least_good``.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType(
        [
            T.StructField("doc_id", documents.schema["doc_id"].dataType),
            T.StructField("score", T.DoubleType()),
            T.StructField("expected_grade", T.DoubleType()),
            T.StructField("p_not_toxic", T.DoubleType()),
            T.StructField("p_good", T.DoubleType()),
            T.StructField("kept", T.BooleanType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score, tails = _graded(batch.column("text"), shared.value)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(score),
                    pa.array(tails.sum(axis=1)),
                    pa.array(tails[:, 0]),
                    pa.array(tails[:, 1]),
                    pa.array(tails[:, 1] >= least_good),
                ],
                names=schema.names,
            )

    return documents.select("doc_id", "text").mapInArrow(run, schema)


def keep_good(
    documents: DataFrame, model: QualityModel, *, least_good: float = 0.3
) -> DataFrame:
    """The rows of ``documents`` that the model keeps, with all their columns."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    text = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, tails = _graded(batch.column(text), shared.value)
            yield batch.filter(pa.array(tails[:, 1] >= least_good))

    return documents.mapInArrow(run, documents.schema)


def _graded(column: pa.Array, model: QualityModel) -> tuple[np.ndarray, np.ndarray]:
    score = np.zeros(len(column))
    for low, high, data, offsets in slices(column):
        rows, features = hashed_features(data, offsets, model.bits)
        score[low:high] = model.scores(rows, features, high - low)
    return score, model.tails(score)


def hashed_features(
    data: np.ndarray, offsets: np.ndarray, bits: int
) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) without repeats, sorted by row."""
    n = len(offsets) - 1
    text = words(data, offsets, ALPHANUMERIC)
    marks = words(data, offsets, _PUNCTUATION)
    keys = [_keys(text.row, text.hash, bits), _keys(marks.row, mix(marks.hash + U64(1)), bits)]
    distinct = np.unique(keys[0])
    sizes = np.maximum(np.diff(offsets), 1)
    n_words = np.diff(text.bounds)
    different = np.bincount((distinct >> bits).astype(np.int64), minlength=n)
    shares = [
        _count(_CAPITAL[data], offsets) / sizes,
        _count(_PUNCTUATION[data], offsets) / sizes,
        _count(_DIGIT[data], offsets) / sizes,
        np.diff(marks.bounds) / np.maximum(n_words, 1),
        # Long texts repeat words by nature; the root makes lengths comparable.
        different / np.maximum(n_words, 1) ** 0.75,
        np.log2(n_words + 1) / 20,
    ]
    rows = np.arange(n)
    for k, share in enumerate(shares):
        step = np.minimum(share * 20, 40).astype(U64)
        keys.append(_keys(rows, mix(U64(1000 + k) * U64(1 << 32) + step), bits))
    whole = np.unique(np.concatenate([distinct, *keys[1:]]))
    return whole >> bits, whole & ((1 << bits) - 1)


def _keys(rows: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    return (rows.astype(np.int64) << bits) | (hashes >> U64(64 - bits)).astype(np.int64)


def _count(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _told(
    batches: Iterator[pa.RecordBatch], names: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """Rows with the places among ``names`` of those of their features that are there."""
    for batch in batches:
        features = batch.column("features")
        values = features.flatten().to_numpy().astype(np.int64)
        rows = np.repeat(np.arange(len(features)), np.diff(features.offsets.to_numpy()))
        at = np.searchsorted(names, values)
        at[at == len(names)] = 0
        known = names[at] == values if len(names) else np.zeros(len(values), dtype=bool)
        bounds = np.searchsorted(rows[known], np.arange(len(features) + 1))
        places = pa.ListArray.from_arrays(
            pa.array(bounds, pa.int32()), pa.array(at[known], pa.int32())
        )
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("grade"), places],
            names=["key", "grade", "places"],
        )


def _fit(
    batches: Iterator[pa.RecordBatch], names: np.ndarray, settings: QualitySettings
) -> Iterator[pa.RecordBatch]:
    """Features with weights; the thresholds come as features -1 and -2."""
    keys, grades_, sizes, places = [], [], [], []
    for batch in batches:
        lists = batch.column("places")
        keys.append(batch.column("key").to_numpy())
        grades_.append(batch.column("grade").to_numpy().astype(np.int64))
        sizes.append(np.diff(lists.offsets.to_numpy()))
        places.append(lists.flatten().to_numpy())
    fitted = {"feature": [], "weight": []}
    if keys and sum(map(len, keys)):
        # Sums go in the order of keys, whichever task's rows came first.
        order = np.argsort(np.concatenate(keys), kind="stable")
        rank = np.empty(len(order), dtype=np.int32)
        rank[order] = np.arange(len(order))
        rows = np.repeat(rank, np.concatenate(sizes))
        columns = np.concatenate(places)
        by_row = np.argsort(rows, kind="stable")
        weights, bounds = fit_ordinal(
            rows[by_row],
            columns[by_row],
            np.concatenate(grades_)[order],
            len(names),
            settings,
        )
        fitted = {
            "feature": np.concatenate([names, [-1, -2]]),
            "weight": np.concatenate([weights, bounds]),
        }
    table = pd.DataFrame(fitted).astype({"feature": "int64", "weight": "float64"})
    yield pa.RecordBatch.from_pandas(table, preserve_index=False)


def fit_ordinal(
    rows: np.ndarray,
    columns: np.ndarray,
    grade: np.ndarray,
    width: int,
    settings: QualitySettings,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by Adam on the whole sample; classes weigh by the root of
    their rarity, so that a rare grade still moves the weights."""
    n = len(grade)
    seen = np.bincount(grade, minlength=GRADES)
    share = np.sqrt(n / np.maximum(seen, 1))[grade]
    share = share / share.sum()
    x = np.concatenate([np.zeros(width), [-2.0, 1.0]])
    mean, square = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, settings.steps + 1):
        score = np.bincount(rows, x[columns], minlength=n)
        low, gap = x[width], np.exp(x[width + 1])
        at = 1 / (1 + np.exp(np.clip(np.array([[low], [low + gap]]) - score, -50, 50)))
        p = np.stack([1 - at[0], at[0] - at[1], at[1]]) + 1e-9
        slope = at * (1 - at)
        # d P(grade) / d score, and by each threshold.
        by_score = np.stack([-slope[0], slope[0] - slope[1], slope[1]])
        pull = -share / p[grade, np.arange(n)]
        lead = pull * by_score[grade, np.arange(n)]
        first = pull * (grade == 0) * slope[0] - pull * (grade == 1) * slope[0]
        second = pull * (grade == 1) * slope[1] - pull * (grade == 2) * slope[1]
        gradient = np.concatenate(
            [
                np.bincount(columns, lead[rows], minlength=width)
                + settings.ridge * x[:width],
                [first.sum() + second.sum(), second.sum() * gap],
            ]
        )
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        rate = 0.1 * min(1, 3 * (1 - step / (settings.steps + 1)))
        x = x - rate * (mean / (1 - 0.9**step)) / (
            np.sqrt(square / (1 - 0.99**step)) + 1e-6
        )
    return x[:width], np.array([x[width], x[width] + np.exp(x[width + 1])])
