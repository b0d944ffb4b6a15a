"""Token counts of whole texts, without keeping any ids.

Arrow batches go through in runs of rows of about equal bytes. Texts are split where no
token can cross: at ASCII white space, which the vocabulary drops, and inside words where
a letter meets a mark or either side is a digit. A run's distinct parts are encoded in
batches of bounded bytes and only their lengths are kept; a worker remembers those of
short parts. Parts are told apart by hashes of 64 bits. A document's count is the sum
over its parts, so a text of any length needs no more memory than its bytes.

The rules for splitting hold for the vocabulary with word ends that this module is for:
one that composes characters (NFC), lower-cases one by one, drops white space, takes
digits one by one and runs of letters or marks whole. Its special strings inside a text
are one token, as the library has it; no split falls into one.

Null and empty texts have no bytes and no tokens. Rows are counted one by one, so null
or repeated ids give rows of their own. Other columns are not read. An empty table gives
an empty table.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tickbars.llm.textbytes import NOT_SPACE, RollingHash, slices

LIMIT = 2048
#: A worker remembers the lengths of so many parts, and of as many before them.
REMEMBERED = 200_000
#: Longer parts, in bytes, are encoded each time.
LONGEST_REMEMBERED = 64
#: Bytes of the parts that the tokenizer gets in one call, about.
BATCH_BYTES = 1 << 18
_ASCII = NOT_SPACE & (np.arange(256) < 0x80)
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[0x30:0x3A] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
#: Marks but those of special strings.
_MARK = _ASCII & ~_DIGIT & ~_LETTER & (np.arange(256) > 0x20) & (np.arange(256) < 0x7F)
_MARK[[ord(c) for c in "<|>"]] = False


class LengthCounter:
    """Counts the tokens of a run of rows, part by part."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self._encode = tokenizer.encode_batch_fast
        self._known: dict[int, int] = {}
        self._before: dict[int, int] = {}

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Each row's number of tokens."""
        starts, ends = parts(data, offsets)
        if not len(starts):
            return np.zeros(len(offsets) - 1, dtype=np.int64)
        names = RollingHash(data).of(starts, ends)
        keys, first, place = np.unique(names, return_index=True, return_inverse=True)
        lengths = self._lengths(data, keys.tolist(), starts[first], ends[first])
        sums = np.concatenate([[0], np.cumsum(lengths[place])])
        return np.diff(sums[np.searchsorted(starts, offsets)])

    def _lengths(
        self, data: np.ndarray, keys: list[int], starts: np.ndarray, ends: np.ndarray
    ) -> np.ndarray:
        if len(self._known) > REMEMBERED:
            self._known, self._before = {}, self._known
        known, before = self._known, self._before
        found = [known.get(k, before.get(k, -1)) for k in keys]
        lengths = np.array(found, dtype=np.int64)
        new = np.flatnonzero(lengths < 0)
        sizes = ends[new] - starts[new]
        batch = np.cumsum(sizes) // BATCH_BYTES
        for low, high in _runs(batch):
            texts = [
                data[a:b].tobytes().decode()
                for a, b in zip(starts[new[low:high]], ends[new[low:high]], strict=True)
            ]
            made = self._encode(texts, add_special_tokens=False)
            lengths[new[low:high]] = [len(x) for x in made]
        for i in np.flatnonzero(ends - starts <= LONGEST_REMEMBERED).tolist():
            known[keys[i]] = int(lengths[i])
        return lengths


def parts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the parts of rows, in order and without white space."""
    inside = NOT_SPACE[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    if len(data):
        left, right = data[:-1], data[1:]
        cut[1:-1] |= inside[1:] != inside[:-1]
        digit = (_DIGIT[left] & _ASCII[right]) | (_ASCII[left] & _DIGIT[right])
        cut[1:-1] |= digit | (_LETTER[left] & _MARK[right])
    places = np.flatnonzero(cut)
    starts, ends = places[:-1], places[1:]
    word = inside[starts]
    return starts[word], ends[word]


def _runs(groups: np.ndarray) -> Iterator[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(groups, prepend=-1, append=-1))
    return zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)


@cache
def _counter(path: str) -> LengthCounter:
    """A worker's counter, which goes on from task to task."""
    return LengthCounter(path)


def token_counts(documents: DataFrame, tokenizer: str, *, limit: int = LIMIT) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit (more tokens than ``limit``)."""
    schema = T.StructType(
        [
            T.StructField("doc_id", documents.schema["doc_id"].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("over_limit", T.BooleanType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer)
        for batch in batches:
            for low, high, data, offsets in slices(batch.column("text")):
                n = counter.counts(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(low, high - low),
                        pa.array(np.diff(offsets)),
                        pa.array(n),
                        pa.array(n > limit),
                    ],
                    names=schema.names,
                )

    return documents.select("doc_id", "text").mapInArrow(run, schema)
