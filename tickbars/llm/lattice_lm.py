"""Document likelihood under a unigram model of subwords, over all segmentations.

The pieces are an existing vocabulary's. Their scores are relative frequencies: how often
the vocabulary's own segmentation of the training words uses each piece, over the whole
training part. A word's probability is the sum over all ways to cut it into pieces, by a
forward recursion in log space; characters without a piece fall back to byte pieces. A
document's is the product over its words and its end.

A word's probability is the same wherever it stands, so it is computed once a word. Slices
of documents of bounded size number their distinct words; the numbered words meet once in
a shuffle by word, and their counts and probabilities go back to the slices. No text is
shuffled. A frequent word has one row a slice.

Training documents are those whose id, as text, has a CRC-32 that 10 does not divide;
those with a null id are training documents too. Null and blank texts have the end alone.
Repeated rows and ids are documents of their own. An empty table gives an empty table.
Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.llm.tables import store
from tickbars.llm.textbytes import _LOWER, NOT_SPACE, slices, words

#: Bytes of text whose words are numbered together.
SLICE = 12 << 20
#: About as many words of a slice are packed or added up at once.
PART = 1 << 17
SMOOTHING = 0.5
_START = "▁"


def score_documents(documents: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per row."""
    sliced = store(_sliced(documents), "lm-slices")
    numbered = (
        sliced.where("words is not null")
        .select("slice", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "w"))
        .select("slice", "place", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    )
    counted = store(
        numbered.selectExpr(
            "slice",
            "place",
            "word",
            "sum(n) over (partition by word) as c",
            "row_number() over (partition by word order by slice) = 1 as first",
        ),
        "lm-words",
    )
    distinct = counted.where("first and c > 0")
    ends = sliced.where("words is null and not held_out").count()
    totals = distinct.agg(F.count("*"), F.sum("c")).first()
    n_train = (totals[1] or 0) + ends
    n_distinct = totals[0] + (ends > 0)
    scores = _piece_scores(distinct, vocabulary, ends)
    valued = _word_scores(counted, vocabulary, scores)
    return _summed(
        sliced.where("words is null"), valued, n_train, n_distinct, ends, scores[-1]
    )


def _sliced(documents: DataFrame) -> DataFrame:
    """A row per document with its words' numbers, and a row per slice with its words."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))
    names = ["slice", "doc_id", "held_out", "n_words", "bag", "words", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for low, high, data, offsets in slices(batch.column("text"), SLICE):
                part = batch.slice(low, high - low)
                held_out = part.column("held_out").to_numpy(zero_copy_only=False)
                found = words(data, offsets, NOT_SPACE)
                start, end, bounds, hashes = found.start, found.end, found.bounds, found.hash
                del found
                _, first, local = np.unique(hashes, return_index=True, return_inverse=True)
                start, end = start[first], end[first]
                del hashes
                # Frequent words get low numbers, which take fewer bytes.
                order = np.argsort(-np.bincount(local, minlength=len(first)), kind="stable")
                rank = np.empty(len(order), dtype=np.int32)
                rank[order] = np.arange(len(order))
                local, start, end = rank[local], start[order], end[order]
                train = np.repeat(~held_out, np.diff(bounds))
                counts = np.bincount(local[train], minlength=len(first))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(high - low, number)),
                        part.column("doc_id"),
                        part.column("held_out"),
                        pa.array(np.diff(bounds)),
                        pa.array(_packed(local, bounds), pa.binary()),
                        pa.nulls(high - low, pa.list_(pa.string())),
                        pa.nulls(high - low, pa.list_(pa.int64())),
                    ],
                    names=names,
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number]),
                        pa.nulls(1, part.column("doc_id").type),
                        pa.nulls(1, pa.bool_()),
                        pa.nulls(1, pa.int64()),
                        pa.nulls(1, pa.binary()),
                        _as_list(_cut(data, start, end)),
                        _as_list(pa.array(counts)),
                    ],
                    names=names,
                )
                number += 1

    return documents.select("doc_id", held.alias("held_out"), "text").mapInArrow(
        run,
        f"slice long, doc_id {kind}, held_out boolean, n_words long, bag binary, "
        "words array<string>, counts array<long>",
    )


def _as_list(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _cut(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The strings ``data[start:end]`` in lower case."""
    sizes = end - start
    bounds = np.zeros(len(sizes) + 1, dtype=np.int32)
    np.cumsum(sizes, out=bounds[1:])
    found = np.empty(bounds[-1], dtype=np.uint8)
    for low, high in _parts(bounds):
        part = bounds[low : high + 1]
        at = np.arange(part[0], part[-1]) + np.repeat(
            start[low:high] - part[:-1], sizes[low:high]
        )
        found[part[0] : part[-1]] = _LOWER[data[at]]
    return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(bounds), pa.py_buffer(found))


def _parts(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first row, end row) of runs of rows that hold about ``PART`` items."""
    low, n = 0, len(bounds) - 1
    while low < n:
        high = int(np.searchsorted(bounds, bounds[low] + PART, side="right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high
        low = high


def _packed(numbers: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """Each row's numbers in ascending order, as steps of seven bits a byte."""
    found: list[bytes] = []
    for low, high in _parts(bounds):
        part = bounds[low : high + 1]
        found += _packed_part(numbers[part[0] : part[-1]].astype(np.int64), part - part[0])
    return found


def _packed_part(numbers: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((numbers, row))
    numbers = numbers[order]
    steps = numbers.copy()
    steps[1:] -= np.where(row[1:] == row[:-1], numbers[:-1], 0)
    width = 1 + sum((steps >> (7 * k)) > 0 for k in range(1, 5))
    ends = np.cumsum(width)
    data = np.zeros(ends[-1] if len(ends) else 0, dtype=np.uint8)
    for k in range(5):
        here = width > k
        more = (width[here] > k + 1).astype(np.int64) << 7
        data[(ends - width)[here] + k] = ((steps[here] >> (7 * k)) & 127) | more
    cuts = np.concatenate([[0], ends])[bounds]
    return [data[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _unpacked(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, number) from the bytes of all rows; ``rows`` has each byte's row."""
    last = data < 128
    item = np.concatenate([[0], np.cumsum(last)[:-1]]) if len(data) else np.zeros(0, int)
    first = np.concatenate([[0], np.flatnonzero(last)[:-1] + 1]) if len(data) else item
    place = np.arange(len(data)) - first[item] if len(data) else item
    steps = np.zeros(int(last.sum()), dtype=np.int64)
    np.add.at(steps, item, (data & 127).astype(np.int64) << (7 * place))
    row = rows[last]
    total = np.cumsum(steps)
    starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else row
    before = np.repeat(total[starts] - steps[starts], np.diff(np.append(starts, len(row))))
    return row, total - before


def _bag_sums(bags: list[bytes], values: tuple[np.ndarray, ...]) -> list[np.ndarray]:
    """Each bag's sums of the ``values`` of its numbers; bags are read some at a time."""
    sums = [np.zeros(len(bags)) for _ in values]
    for low, high in _parts(np.cumsum([0, *map(len, bags)])):
        part = bags[low:high]
        data = np.frombuffer(b"".join(part), dtype=np.uint8)
        row, number = _unpacked(data, np.repeat(np.arange(len(part)), [len(x) for x in part]))
        for total, value in zip(sums, values, strict=True):
            total[low:high] = np.bincount(row, value[number], minlength=len(part))
    return sums


class Lattice:
    """Forward sums over all segmentations of a word into scored pieces."""

    def __init__(self, pieces: list[str], scores: np.ndarray) -> None:
        self.score = dict(zip(pieces, scores.tolist(), strict=True))
        self.prefixes = {p[:k] for p in pieces for k in range(1, len(p) + 1)}

    def word(self, text: str) -> float:
        """log10 of the probability of ``text`` as a whole word."""
        text = _START + text
        n = len(text)
        score, prefixes = self.score, self.prefixes
        arriving: list[list[float]] = [[] for _ in range(n + 1)]
        arriving[0].append(0.0)
        exp, log = math.exp, math.log
        for i in range(n):
            here = arriving[i]
            if not here:
                continue
            if len(here) == 1:
                total = here[0]
            else:
                most = max(here)
                total = most + log(sum([exp(x - most) for x in here]))
            single = False
            for j in range(i + 1, n + 1):
                part = text[i:j]
                if part not in prefixes:
                    break
                value = score.get(part)
                if value is not None:
                    arriving[j].append(total + value)
                    single = single or j == i + 1
            if not single:
                arriving[i + 1].append(
                    total + sum([score[f"<0x{b:02X}>"] for b in text[i].encode()])
                )
        here = arriving[n]
        most = max(here)
        return (most + log(sum([exp(x - most) for x in here]))) / math.log(10)


@cache
def _processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def _piece_scores(distinct: DataFrame, vocabulary: str, ends: int) -> np.ndarray:
    """Natural logs of the pieces' shares of the training corpus; the end's comes last.

    Each task adds up its words and sends one row per piece: as many as the vocabulary.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = _processor(vocabulary)
        total = np.zeros(processor.get_piece_size())
        for batch in batches:
            counts = batch.column("c").to_numpy()
            for low in range(0, len(counts), 4096):
                found = processor.encode(
                    batch.column("word").slice(low, 4096).to_pylist(), num_threads=1
                )
                ids = np.concatenate([np.array(x, dtype=np.int64) for x in found])
                repeat = np.repeat(counts[low : low + 4096], [len(x) for x in found])
                total += np.bincount(ids, repeat, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(total[at])], names=["piece", "n"]
        )

    used = (
        distinct.select("word", "c")
        .mapInArrow(run, "piece long, n double")
        .groupBy("piece")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    total = np.zeros(_processor(vocabulary).get_piece_size() + 1)
    total[used.piece.to_numpy(dtype=np.int64)] = used.n.to_numpy()
    total[-1] = ends
    return np.log((total + SMOOTHING) / (total + SMOOTHING).sum())


def _word_scores(counted: DataFrame, vocabulary: str, scores: np.ndarray) -> DataFrame:
    """(slice, place, c, word_score); equal words follow each other in ``counted``."""
    shared = counted.sparkSession.sparkContext.broadcast(scores)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = _processor(vocabulary)
        pieces = [processor.id_to_piece(i) for i in range(processor.get_piece_size())]
        lattice = Lattice(pieces, shared.value[:-1])
        word, value = None, 0.0
        for batch in batches:
            values = []
            for text in batch.column("word").to_pylist():
                if text != word:
                    word, value = text, lattice.word(text)
                values.append(value)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("slice", "place", "c")), pa.array(values)],
                names=["slice", "place", "c", "word_score"],
            )

    return counted.select("slice", "place", "c", "word").mapInArrow(
        run, "slice long, place int, c long, word_score double"
    )


def _summed(
    rows: DataFrame,
    valued: DataFrame,
    n_train: int,
    n_distinct: int,
    ends: int,
    end_score: float,
) -> DataFrame:
    kind = rows.schema["doc_id"].dataType.simpleString()
    whole = n_train + 0.1 * (n_distinct + 1)
    end_base = math.log10((ends + 0.1) / whole)
    names = [
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score",
    ]

    def run(documents: pa.Table, values: pa.Table) -> pa.Table:
        documents, values = documents.combine_chunks(), values.combine_chunks()
        n = documents.num_rows
        place = values["place"].to_numpy()
        count = np.zeros(len(place), dtype=np.int64)
        score = np.zeros(len(place))
        count[place] = values["c"].to_numpy()
        score[place] = values["word_score"].to_numpy()
        base = np.log10((count + 0.1) / whole)
        known, base_sum, score_sum = _bag_sums(
            documents["bag"].to_pylist(), (count > 0, base, score)
        )
        n_words = documents["n_words"].to_numpy()
        return pa.table(
            [
                documents["doc_id"],
                documents["held_out"],
                pa.array(n_words + 1),
                pa.array(known.astype(np.int64) + int(ends > 0)),
                pa.array(np.full(n, n_train)),
                pa.array(base_sum + end_base),
                pa.array(score_sum + end_score / math.log(10)),
            ],
            names=names,
        )

    return (
        rows.select("slice", "doc_id", "held_out", "n_words", "bag")
        .groupBy("slice")
        .cogroup(valued.groupBy("slice"))
        .applyInArrow(
            run,
            f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, "
            "train_tokens long, base_score double, score double",
        )
    )
