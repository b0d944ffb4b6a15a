"""Hard negatives of labelled vectors: unlike labels, scores just below the positives'.

Vectors are scaled to whole numbers, and scores are whole inner products. Each vector is
stored with one-bit codes of its rotated form: the signs, the alignment with them, and
then the same of what is left, a few times over. An anchor is rotated too and cut into
bit planes, so that populations counted over code and plane give its product with each
code. That estimate has a certain interval: what the codes leave of a vector is at right
angles to the last one, so by Cauchy and Schwarz its product with the anchor is at most
the product of the two parts' lengths; the planes' rounding adds a known error. Rows
whose interval misses what is looked for go, all others are scored in whole numbers, so
results are exact.

Every anchor meets every row, in blocks: anchors are broadcast in passes of bounded size,
rows are read where they lie, and a task keeps the best few of each anchor. Only those
are shuffled. Rows read grow with the passes, and nothing else does.

Rows with a null id, label or vector, or a null or non-finite component take no part,
nor do vectors whose scaled length is ``MOST_LENGTH`` or more, for their scores would not
fit. Vectors of different lengths don't meet. Rows that repeat an id are rows of their
own: an anchor's other rows are all but itself. Equal scores go by the smaller id, so
ties of rows with equal ids give the same result either way. Vectors without components
score 0. Other columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickbars.llm.tables import store

#: Scaled vectors are shorter than this, so that 100 times a score fits 64 bits.
MOST_LENGTH = 2.0**27
_WORD = 64
_LEAST = np.iinfo(np.int64).min
_BLOCK = ("key", "vec_id", "label", "length", "whole", "code", "align")


@dataclass(frozen=True)
class NegativeSettings:
    """``every``: ids divisible by it are anchors. ``low`` and ``high``: percent of a
    positive's score between which its negatives score. ``scale``: vectors are floored
    after multiplication by it. ``codes``: one-bit codes of a vector. ``planes``: bits of
    an anchor's components. ``pass_bytes``: of anchors broadcast at once, about."""

    every: int = 50
    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    scale: float = 256.0
    codes: int = 4
    planes: int = 6
    pass_bytes: int = 16 << 20
    anchor_block: int = 128
    row_block: int = 2_048


def hard_negatives(
    embeddings: DataFrame, settings: NegativeSettings = NegativeSettings()
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    rows = store(coded(embeddings, settings), "negative-codes")
    anchors = store(
        rows.where(F.col("vec_id") % settings.every == 0).select(*_BLOCK[:5]),
        "negative-anchors",
    )
    size = anchors.agg(F.sum(F.col("length") * 8 + 64)).first()[0] or 0
    passes = max(1, -(-size // settings.pass_bytes))
    parts = []
    for k in range(passes):
        mine = anchors.where(F.pmod(F.xxhash64("key"), F.lit(passes)) == k)
        parts.append(_mined(rows, mine, settings))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionAll(part)
    return found


def coded(embeddings: DataFrame, settings: NegativeSettings) -> DataFrame:
    """key, vec_id, label, length, whole, code, align of the rows that take part."""
    rows = embeddings.select(
        F.monotonically_increasing_id().alias("key"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    ).where("vec_id is not null and label is not null and vector is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            lengths = np.diff(lists.offsets.to_numpy())
            for length in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == length)
                flat = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
                values = np.asarray(flat, dtype=np.float64).reshape(len(at), length)
                with np.errstate(all="ignore"):
                    whole = np.floor(settings.scale * values)
                    fits = np.sqrt((whole * whole).sum(axis=1)) < MOST_LENGTH
                at, whole = at[fits], whole[fits].astype(np.int64)
                code, align = one_bit_codes(rotated(whole), settings.codes)
                chosen = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(chosen.column(c) for c in ("key", "vec_id", "label")),
                        pa.array(np.full(len(at), length, dtype=np.int32)),
                        *(_binary(x) for x in (whole, code, align)),
                    ],
                    names=list(_BLOCK),
                )

    return rows.mapInArrow(
        run,
        "key long, vec_id long, label long, length int, whole binary, code binary, "
        "align binary",
    )


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([x.tobytes() for x in rows], pa.binary())


def _matrix(column: pa.Array, kind, width: int) -> np.ndarray:
    values = np.frombuffer(b"".join(column.to_pylist()), dtype=kind)
    return values.reshape(len(column), width)


@cache
def rotation(size: int) -> np.ndarray:
    """A random rotation that is the same in every task but for rounding."""
    normal = np.random.default_rng(size).normal(size=(size, size))
    return np.linalg.qr(normal)[0]


def rotated(whole: np.ndarray) -> np.ndarray:
    """Vectors of whole numbers, filled up to whole words of bits and rotated."""
    size = max(1, -(-whole.shape[1] // _WORD)) * _WORD
    filled = np.zeros((len(whole), size))
    filled[:, : whole.shape[1]] = whole
    return filled @ rotation(size)


def one_bit_codes(rows: np.ndarray, codes: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, code, word) of sign bits; (row, codes + 1): each code's alignment, and the
    length of what all of them leave."""
    n, size = rows.shape
    words = np.zeros((n, codes, size // _WORD), dtype=np.uint64)
    align = np.zeros((n, codes + 1))
    rest = rows
    for k in range(codes):
        sign = rest >= 0
        words[:, k] = np.packbits(sign, axis=1, bitorder="little").view(np.uint64)
        unit = np.where(sign, 1.0, -1.0) / np.sqrt(size)
        align[:, k] = (rest * unit).sum(axis=1)
        rest = rest - align[:, k, None] * unit
    align[:, codes] = np.linalg.norm(rest, axis=1)
    return words, align


class Anchors:
    """Anchors of one length, as bit planes of their rotated components."""

    def __init__(self, table: pa.Table, length: int, settings: NegativeSettings) -> None:
        self.key, self.label = (table[c].to_numpy() for c in ("key", "label"))
        self.whole = _matrix(table["whole"], np.int64, length)
        values = rotated(self.whole)
        size = values.shape[1]
        low, high = values.min(axis=1, initial=np.inf), values.max(axis=1, initial=-np.inf)
        step = np.maximum((high - low) / ((1 << settings.planes) - 1), 1e-300)
        steps = np.rint((values - low[:, None]) / step[:, None]).astype(np.int64)
        self.planes = np.stack(
            [
                np.packbits((steps >> j) & 1 == 1, axis=1, bitorder="little").view(np.uint64)
                for j in range(settings.planes)
            ],
            axis=1,
        )
        self.low, self.step, self.sums = low, step, steps.sum(axis=1)
        rounding = np.abs(low[:, None] + steps * step[:, None] - values).sum(axis=1)
        self.error = rounding / np.sqrt(size)
        self.norm = np.linalg.norm(values, axis=1)

    def intervals(
        self, at: slice, code: np.ndarray, align: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """(low, high) by anchor and row: the bounds of their scores."""
        size = code.shape[2] * _WORD
        low, step = self.low[at, None], self.step[at, None]
        middle = np.zeros((len(low), len(code)))
        product = middle
        for k in range(code.shape[1]):
            ones = np.bitwise_count(code[:, k]).sum(axis=1, dtype=np.int64)
            seen = np.zeros(middle.shape, dtype=np.int32)
            for j in range(self.planes.shape[1]):
                for w in range(code.shape[2]):
                    met = np.bitwise_count(self.planes[at, j, w, None] & code[None, :, k, w])
                    seen += met.astype(np.int32) << j
            product = (
                low * (2 * ones - size) + step * (2 * seen - self.sums[at, None])
            ) / np.sqrt(size)
            middle = middle + align[None, :, k] * product
        # The rest of a row meets only the part of the anchor off the last code.
        error, norm = self.error[at, None], self.norm[at, None]
        along = np.maximum(np.abs(product) - error, 0)
        off = np.sqrt(np.maximum(norm**2 - along**2, 0))
        lengths = np.sqrt((align**2).sum(axis=1))
        wide = off * align[:, -1] + error * align[:, :-1].sum(axis=1)
        # Rounding of the doubles themselves.
        wide = wide + 1e-9 * norm * lengths + 1e-6
        return middle - wide, middle + wide

    def scores(self, anchor: np.ndarray, whole: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Whole inner products of pairs, in steps of bounded memory."""
        out = np.empty(len(anchor), dtype=np.int64)
        step = max(1, (1 << 21) // max(1, whole.shape[1]))
        for low in range(0, len(anchor), step):
            part = slice(low, low + step)
            np.einsum(
                "kd,kd->k", self.whole[anchor[part]], whole[row[part]], out=out[part]
            )
        return out


class Best:
    """The first ``k`` of (score descending, id ascending) of each of ``n`` groups."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.score = np.full((n, k), _LEAST)
        self.id = np.full((n, k), np.iinfo(np.int64).max)

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(group):
            return
        touched = np.unique(group)
        held = np.repeat(touched, self.k)
        group = np.concatenate([held, group])
        score = np.concatenate([self.score[touched].ravel(), score])
        ids = np.concatenate([self.id[touched].ravel(), ids])
        order = np.lexsort((ids, -(score + 1), group))
        group = group[order]
        rank = np.arange(len(group)) - np.searchsorted(group, group)
        first = order[rank < self.k]
        self.score[touched] = score[first].reshape(-1, self.k)
        self.id[touched] = ids[first].reshape(-1, self.k)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        group, slot = np.nonzero(self.score != _LEAST)
        return group, self.score[group, slot], self.id[group, slot]


def _blocks(
    batches: Iterator[pa.RecordBatch], settings: NegativeSettings
) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
    """(length, columns) of rows of one length, a block at most."""
    for batch in batches:
        lengths = batch.column("length").to_numpy()
        for length in np.unique(lengths).tolist():
            chosen = np.flatnonzero(lengths == length)
            width = max(1, -(-length // _WORD))
            for low in range(0, len(chosen), settings.row_block):
                part = batch.take(pa.array(chosen[low : low + settings.row_block]))
                codes = _matrix(part.column("code"), np.uint64, settings.codes * width)
                yield (
                    length,
                    {
                        **{c: part.column(c).to_numpy() for c in ("key", "vec_id", "label")},
                        "whole": _matrix(part.column("whole"), np.int64, length),
                        "code": codes.reshape(-1, settings.codes, width),
                        "align": _matrix(part.column("align"), float, settings.codes + 1),
                    },
                )


def _scan(
    rows: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
) -> DataFrame:
    """(anchor, positive, score, id): the best of every task."""
    return rows.mapInArrow(run, "anchor long, positive int, score long, id long")


def _emitted(anchor, positive, score, ids) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(anchor, pa.int64()),
            pa.array(positive, pa.int32()),
            pa.array(score, pa.int64()),
            pa.array(ids, pa.int64()),
        ],
        names=["anchor", "positive", "score", "id"],
    )


def _firsts(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of all tasks, with their rank; Spark cuts before the shuffle too."""
    order = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _mined(rows: DataFrame, anchors: DataFrame, settings: NegativeSettings) -> DataFrame:
    """The result for ``anchors``, which fit a broadcast."""
    context = rows.sparkSession.sparkContext
    # A pass of anchors, bounded by ``pass_bytes``.
    given = context.broadcast(anchors.drop("vec_id").toArrow())
    best = store(
        _firsts(_scan(rows, lambda x: _positives(x, given.value, settings)), settings.positives)
        .select(
            "anchor", F.col("rank").alias("positive"), F.col("score").alias("positive_score"),
            F.col("id").alias("positive_id"),
        ),
        "negative-positives",
    )
    # A few whole numbers per anchor of the pass.
    wanted = context.broadcast(best.drop("positive_id").toArrow())
    found = store(
        _firsts(
            _scan(rows, lambda x: _negatives(x, given.value, wanted.value, settings)),
            settings.negatives,
        ),
        "negatives",
    )
    return (
        found.join(best, ["anchor", "positive"])
        .join(anchors.select(F.col("key").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
        .select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )


def _by_length(table: pa.Table, settings: NegativeSettings) -> dict[int, Anchors]:
    table = table.sort_by([("label", "ascending"), ("key", "ascending")]).combine_chunks()
    lengths = table["length"].to_numpy()
    return {
        n: Anchors(table.take(np.flatnonzero(lengths == n)), n, settings)
        for n in np.unique(lengths).tolist()
    }


def _positives(
    batches: Iterator[pa.RecordBatch], table: pa.Table, settings: NegativeSettings
) -> Iterator[pa.RecordBatch]:
    """The best rows of the anchors' own labels among a task's rows."""
    anchors = _by_length(table, settings)
    best = {n: Best(len(a.key), settings.positives) for n, a in anchors.items()}
    for length, block in _blocks(batches, settings):
        if length not in anchors:
            continue
        own, kept = anchors[length], best[length]
        for label in np.unique(block["label"]).tolist():
            mine = block["label"] == label
            rows = {c: x[mine] for c, x in block.items()}
            first, end = np.searchsorted(own.label, [label, label + 1])
            for low in range(first, end, settings.anchor_block):
                at = slice(low, min(low + settings.anchor_block, end))
                _, high = own.intervals(at, rows["code"], rows["align"])
                # Scores under the worst of the best so far are of no use.
                open_ = high >= kept.score[at, -1:].astype(float)
                open_ &= own.key[at, None] != rows["key"][None, :]
                anchor, row = np.nonzero(open_)
                score = own.scores(anchor + low, rows["whole"], row)
                kept.add(anchor + low, score, rows["vec_id"][row])
    for length, own in anchors.items():
        group, score, ids = best[length].rows()
        yield _emitted(own.key[group], np.zeros_like(group), score, ids)


def _negatives(
    batches: Iterator[pa.RecordBatch],
    table: pa.Table,
    positives: pa.Table,
    settings: NegativeSettings,
) -> Iterator[pa.RecordBatch]:
    """The best rows of other labels within each positive's bounds, of a task's rows."""
    anchors = _by_length(table, settings)
    bounds = {n: _bounds(a.key, positives, settings) for n, a in anchors.items()}
    k = settings.positives
    best = {n: Best(len(a.key) * k, settings.negatives) for n, a in anchors.items()}
    for length, block in _blocks(batches, settings):
        if length not in anchors:
            continue
        own, kept = anchors[length], best[length]
        least, most = bounds[length]
        for start in range(0, len(own.key), settings.anchor_block):
            at = slice(start, start + settings.anchor_block)
            low, high = own.intervals(at, block["code"], block["align"])
            other = own.label[at, None] != block["label"][None, :]
            worst = kept.score[:, -1].reshape(-1, k)[at]
            asked = [
                other
                & (high >= np.maximum(least[at, j], worst[:, j])[:, None].astype(float))
                & (low <= most[at, j][:, None].astype(float))
                for j in range(k)
            ]
            anchor, row = np.nonzero(np.logical_or.reduce(asked))
            score = own.scores(anchor + start, block["whole"], row)
            for j in range(k):
                fits = (score >= least[anchor + start, j]) & (score <= most[anchor + start, j])
                kept.add(
                    (anchor[fits] + start) * k + j, score[fits], block["vec_id"][row[fits]]
                )
    for length, own in anchors.items():
        group, score, ids = best[length].rows()
        yield _emitted(own.key[group // k], group % k + 1, score, ids)


def _bounds(
    keys: np.ndarray, positives: pa.Table, settings: NegativeSettings
) -> tuple[np.ndarray, np.ndarray]:
    """Least and most score by anchor and positive; nothing fits where there is none."""
    least = np.ones((len(keys), settings.positives), dtype=np.int64)
    most = np.zeros_like(least)
    anchor, place, score = (
        positives[c].to_numpy() for c in ("anchor", "positive", "positive_score")
    )
    order = np.argsort(keys)
    at = np.searchsorted(keys, anchor, sorter=order)
    at[at == len(keys)] = 0
    at = order[at] if len(keys) else at
    known = keys[at] == anchor if len(keys) else np.zeros(len(anchor), dtype=bool)
    at, place, score = at[known], place[known] - 1, score[known]
    least[at, place] = -((-settings.low * score) // 100)
    most[at, place] = (settings.high * score) // 100
    return least, most


#: The same rows in SQL, over the labels and settings of the registered query.
ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS alike, b.vec_id AS other,
    CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score
  FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
), negatives AS (
  SELECT p.anchor_id, positive_id, other AS negative_id, positive_score,
    score AS negative_score,
    row_number() OVER (
      PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other
    ) AS rank
  FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT alike
    AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score,
  negative_score
FROM negatives WHERE rank <= 3
"""
