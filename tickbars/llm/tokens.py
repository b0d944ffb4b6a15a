"""Token ids of documents as Parquet files that allow selective reads.

Rows are range-partitioned by id, so files follow each other in ascending order, and a
file's rows are in order too. Ids are list columns, dictionary-encoded; row numbers and
places are delta-encoded. Row groups and pages are small and have indexes, so a reader
that asks for a range of ids, or for counts alone, skips the other pages and columns.

Null and empty texts have the end id alone. Null ids come first; rows that repeat an id
follow each other by text hash, and equal rows are written as often as they come. An
empty table gives an empty table. Very long texts are one row. Other columns are not
read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickbars.llm.textbytes import RollingHash, slices

END_ID = 2
#: A worker remembers the ids of so many chunks used last, and of as many before them.
REMEMBERED = 700_000
#: New chunks that are sorted apart from the others.
FRESH = 65_536
#: Longer chunks, in bytes, are encoded each time.
LONGEST_REMEMBERED = 64
#: Chunks that the tokenizer gets as one text.
JOINED = 512
FILE_OPTIONS = {
    "compression": "zstd",
    "parquet.writer.version": "v2",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.page.row.count.limit": "2000",
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#ids.list.element": "true",
}
#: Bytes that surely begin no white space when they follow a space: printing ASCII, and
#: the lead bytes of characters of which none is white space.
_SOLID = np.zeros(256, dtype=bool)
_SOLID[0x21:0x7F] = True
_SOLID[0xC3:0xE1] = True
_SOLID[0xE4:0xF5] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
#: ASCII marks but the apostrophe, which may start a token with letters in it, and those
#: of special tokens.
_MARK = _SOLID & ~_LETTER & (np.arange(256) < 0x80)
_MARK[0x30:0x3A] = False
_MARK[[ord(c) for c in "'<|>"]] = False
#: What stands before a chunk in a joined text, by how the chunk begins: nothing before a
#: space, a line before a letter, and a line with a letter before a mark.
_BEFORE = (b"", b"\n", b"\na")


def _runs(values: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``size`` values from each ``begin`` on, one run after the other."""
    before = np.cumsum(size) - size
    return values[np.arange(size.sum()) + np.repeat(begin - before, size)]


class _Chunks:
    """Ids of chunks by sorted hash, in arrays: some thirty bytes a chunk."""

    def __init__(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.begin = self.size = np.zeros(0, dtype=np.int64)
        self.values = np.zeros(0, dtype="<u4")

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``keys`` are here, and the places of those."""
        if not len(self.keys):
            return np.zeros(len(keys), dtype=bool), self.begin
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = self.keys[at] == keys
        return hit, at[hit]

    def add(
        self, keys: np.ndarray, begin: np.ndarray, size: np.ndarray, values: np.ndarray
    ) -> None:
        """``keys``, of which none is here, with the runs of ``values`` they have."""
        keys = np.concatenate([self.keys, keys])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.begin = np.concatenate([self.begin, begin + len(self.values)])[order]
        self.size = np.concatenate([self.size, size])[order]
        self.values = np.concatenate([self.values, values])


class ChunkEncoder:
    """Encodes texts chunk by chunk and remembers frequent chunks' ids.

    Byte-level pre-tokens have a space only in front, or in runs of white space, and marks
    and letters in different ones. So a text may be cut before a space that something
    else follows, between a letter and a mark, and between a line's end and a letter, and
    its parts encoded one by one. Most parts of a text are equal to others; each is
    encoded once. Chunks are told apart by hashes of 64 bits.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self._encode = tokenizer.encode_batch_fast
        # Byte-level tokens are written with one character a byte.
        size = tokenizer.get_vocab_size(with_added_tokens=True)
        self._widths = np.array([len(tokenizer.id_to_token(i) or "") for i in range(size)])
        self._fresh, self._known, self._before = _Chunks(), _Chunks(), _Chunks()

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All rows' ids one after the other, and each row's number of them."""
        n = len(offsets) - 1
        if not len(data):
            return np.zeros(0, dtype="<u4"), np.zeros(n, dtype=np.int64)
        start = np.zeros(len(data) + 1, dtype=bool)
        start[:-2] = (data[:-1] == 0x20) & _SOLID[data[1:]]
        # At a row's end, the next row's first byte follows; it cuts nothing.
        start[offsets[1:] - 1] = False
        start[1:-1] |= _LETTER[data[:-1]] & _MARK[data[1:]]
        # A single line's end: of several, all but the last are one token.
        ends_line = (data[1:-1] == 0x0A) & (data[:-2] > 0x20) & (data[:-2] < 0x7F)
        start[2:-1] |= ends_line & _LETTER[data[2:]]
        start[offsets] = True
        starts = np.flatnonzero(start[:-1])
        ends = np.append(starts[1:], len(data))
        names = RollingHash(data).of(starts, ends)
        keys, first, place = np.unique(names, return_index=True, return_inverse=True)
        values, begin, size = self._looked_up(data, keys, starts[first], ends[first])
        count = size[place]
        total = np.concatenate([[0], np.cumsum(count)])
        found = _runs(values, begin[place], count)
        return found, np.diff(total[np.searchsorted(starts, offsets)])

    def _looked_up(
        self, data: np.ndarray, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where in them each chunk's begin and how many it has."""
        if len(self._fresh.keys) > FRESH:
            fresh, self._fresh = self._fresh, _Chunks()
            if len(self._known.keys) > REMEMBERED:
                self._known, self._before = _Chunks(), self._known
            self._known.add(fresh.keys, fresh.begin, fresh.size, fresh.values)
        size = np.zeros(len(keys), dtype=np.int64)
        order, parts = [], []
        new = np.arange(len(keys))
        for table in (self._known, self._fresh, self._before):
            hit, at = table.find(keys[new])
            order.append(new[hit])
            size[new[hit]] = table.size[at]
            parts.append(_runs(table.values, table.begin[at], table.size[at]))
            new = new[~hit]
        again = order[-1]
        begins = data[starts[new]]
        spaced = (begins == 0x20) & (ends[new] - starts[new] > 1)
        spaced[spaced] = _SOLID[data[starts[new][spaced] + 1]]
        kinds = np.select([spaced, _LETTER[begins], _MARK[begins]], [0, 1, 2], 3)
        joined = np.flatnonzero(kinds < 3)
        for low in range(0, len(joined), JOINED):
            at = joined[low : low + JOINED]
            part = new[at]
            order.append(part)
            ids, size[part] = self._joined(data, starts[part], ends[part], kinds[at])
            parts.append(ids)
        single = new[kinds == 3]
        for i in single.tolist():
            (one,) = self._encode(
                [data[starts[i] : ends[i]].tobytes().decode()], add_special_tokens=False
            )
            size[i] = len(one.ids)
            parts.append(np.array(one.ids, dtype="<u4"))
        order = np.concatenate([*order, single])
        values = np.concatenate(parts)
        begin = np.empty(len(keys), dtype=np.int64)
        begin[order] = np.cumsum(size[order]) - size[order]
        # What was last used long ago is remembered anew, like what is new.
        fresh = np.concatenate([again, new])
        fresh = fresh[(ends - starts)[fresh] <= LONGEST_REMEMBERED]
        ids = _runs(values, begin[fresh], size[fresh])
        self._fresh.add(keys[fresh], np.cumsum(size[fresh]) - size[fresh], size[fresh], ids)
        return values, begin, size

    def _joined(
        self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kinds: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks that are encoded as one text, in which each starts a token, and
        each chunk's number of them. They are dealt out by the bytes they stand for."""
        gaps = np.array([len(x) for x in _BEFORE])[kinds]
        sizes = ends - starts
        last = np.cumsum(sizes + gaps)
        first = last - sizes
        text = np.full(last[-1], ord("a"), dtype=np.uint8)
        text[(first - gaps)[gaps > 0]] = 0x0A
        step = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        text[np.repeat(first, sizes) + step] = data[np.repeat(starts, sizes) + step]
        (one,) = self._encode([text.tobytes().decode()], add_special_tokens=False)
        ids = np.array(one.ids, dtype="<u4")
        reached = np.cumsum(self._widths[ids])
        low = np.searchsorted(reached, first, side="right")
        count = np.searchsorted(reached, last, side="left") + 1 - low
        return _runs(ids, low, count), count


@cache
def _encoder(path: str) -> ChunkEncoder:
    """A worker's encoder, which goes on from task to task."""
    return ChunkEncoder(path)


def encoded(documents: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """(shard, doc_id, place, n_tokens, ids) in ascending order of ids.

    ``shard`` numbers the partitions in order, ``place`` counts the ids before the row
    in its shard.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    ordered = (
        documents.select("doc_id", "text", F.xxhash64("text").alias("tie"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        shard, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            for low, high, data, offsets in slices(batch.column("text")):
                found, counts = encoder.ids(data, offsets)
                row = np.repeat(np.arange(high - low), counts)
                values = np.full(len(found) + high - low, end_id, dtype="<i4")
                values[np.arange(len(found)) + row] = found
                bounds = np.concatenate([[0], np.cumsum(counts + 1)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(high - low, shard, dtype=np.int32)),
                        batch.column("doc_id").slice(low, high - low),
                        pa.array(place + bounds[:-1]),
                        pa.array(counts + 1),
                        pa.ListArray.from_arrays(
                            pa.array(bounds, pa.int32()), pa.array(values)
                        ),
                    ],
                    names=["shard", "doc_id", "place", "n_tokens", "ids"],
                )
                place += int(bounds[-1])

    return ordered.mapInArrow(
        run, f"shard int, doc_id {kind}, place long, n_tokens long, ids array<int>"
    )


def write_tokens(
    documents: DataFrame, path: str, tokenizer: str, end_id: int = END_ID
) -> None:
    encoded(documents, tokenizer, end_id).write.options(**FILE_OPTIONS).parquet(path)


def read_tokens(
    spark: SparkSession, path: str, *, most_broadcast: int = 100_000
) -> DataFrame:
    """(doc_id, start, n_tokens, ids): ``start`` counts the ids of all rows before.

    The shards' totals come from two small columns; they are one row per file, and they
    are broadcast up to ``most_broadcast`` of them.
    """
    rows = spark.read.parquet(path)
    by_shard = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("shard")
        .agg(F.sum("n_tokens").alias("total"))
        .select("shard", F.coalesce(F.sum("total").over(by_shard), F.lit(0)).alias("before"))
    )
    few = rows.select("shard").distinct().count() <= most_broadcast
    return rows.join(F.broadcast(offsets) if few else offsets, "shard").select(
        "doc_id", (F.col("place") + F.col("before")).alias("start"), "n_tokens", "ids"
    )


def token_digest(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of rows with ids."""
    kind = tokens.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("ids")
            values = column.values.to_numpy()
            bounds = column.offsets.to_numpy()
            sums = [
                zlib.crc32(values[a:b].astype("<u4").tobytes())
                for a, b in zip(bounds[:-1], bounds[1:], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", "start", "n_tokens")),
                    pa.array(sums, pa.int64()),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long"
    )
