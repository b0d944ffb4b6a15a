"""Benchmark passages in documents, found by winnowed fingerprints.

Of each ``GUARANTEE`` consecutive words' k-gram hashes the least is a fingerprint, in
documents as in items, so a shared run of that many words shares one at the same place.
Document fingerprints that an item has too are extended to the windows around them, and
windows count when an item has the same. Items of fewer words, but not none, are one
window, looked up at every word. Words are lower-cased runs of ASCII letters, digits and
all that is not ASCII; hashes of words and windows have 64 bits.

Null and blank texts have no words and are never contaminated. Repeated rows and ids get
a row each, with the result of their text. An empty benchmark contaminates nothing. Items
may repeat; their ids count once, and null ids not at all. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickbars.llm.tables import store, unused
from tickbars.llm.textbytes import ALPHANUMERIC, U64, Words, mix, sliding_min, slices, words

WINDOW = 13
GRAM = 7
#: Bits of the lookup that every task holds, whatever the benchmark's size.
LOOKUP_BITS = 1 << 24
_GRAM_STEP = U64(0x2545F4914F6CDD1D)


def gram_hashes(hashes: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """The hash of ``length`` words from each of ``at``."""
    value = np.full(len(at), length, dtype=U64)
    for k in range(length):
        value = value * _GRAM_STEP + hashes[at + k]
    return mix(value)


def starts_of(found: Words, length: int) -> np.ndarray:
    """Words from which ``length`` words follow in the same row."""
    n_words = np.diff(found.bounds)
    place = np.arange(len(found.row)) - found.bounds[found.row]
    return np.flatnonzero(place + length <= n_words[found.row])


def fingerprints(found: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, hash) of the least k-gram of every run of ``window`` words, once each."""
    whole = starts_of(found, window)
    if not len(whole):
        return whole, np.zeros(0, dtype=U64)
    n = len(found.hash) - gram + 1
    grams = gram_hashes(found.hash, np.arange(n), gram)
    # The upper bits order the k-grams and the place settles ties, the same in any text.
    ranked = (grams >> U64(32) << U64(32)) | np.arange(n, dtype=U64)
    least = sliding_min(ranked, window - gram + 1)[whole]
    chosen = np.unique(least & U64(0xFFFFFFFF)).astype(np.int64)
    return chosen, grams[chosen]


def item_tables(items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(item_id, kind, length, hash): every window, and the fingerprints as kind 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in slices(batch.column("text")):
                found = words(data, offsets, ALPHANUMERIC)
                n_words = np.diff(found.bounds)
                ids = batch.column("item_id").slice(low, high - low)
                place, marks = fingerprints(found, window, gram)
                yield _item_rows(ids, found.row[place], 0, gram, marks)
                whole = starts_of(found, window)
                yield _item_rows(
                    ids, found.row[whole], 1, window, gram_hashes(found.hash, whole, window)
                )
                for length in range(1, window):
                    short = np.flatnonzero(n_words == length)
                    marks = gram_hashes(found.hash, found.bounds[short], length)
                    yield _item_rows(ids, short, 1, length, marks)

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", "text").mapInArrow(
        run, f"item_id {kind}, kind int, length int, hash long"
    ).distinct()


def _item_rows(
    ids: pa.Array, rows: np.ndarray, kind: int, length: int, marks: np.ndarray
) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            ids.take(pa.array(rows, pa.int64())),
            pa.array(np.full(len(rows), kind, dtype=np.int32)),
            pa.array(np.full(len(rows), length, dtype=np.int32)),
            pa.array(marks.view(np.int64)),
        ],
        names=["item_id", "kind", "length", "hash"],
    )


def contamination(
    documents: DataFrame, items: DataFrame, *, window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """Per row: doc_id, row_key, n_words, n_hit, n_items, items_sha256, contaminated."""
    known = store(item_tables(items, window, gram), "benchmark-windows")
    scanned = store(_scan(documents, known, window, gram), "benchmark-scan")
    spots = (
        scanned.where("windows is not null")
        .select("row_key", F.explode("windows").alias("w"))
        .select("row_key", "w.place", "w.length", "w.hash")
        .distinct()
    )
    windows = known.where("kind = 1")
    shared = store(
        spots.join(windows.select("length", "hash").distinct(), ["length", "hash"]),
        "benchmark-hits",
    )
    order = Window.partitionBy("row_key").orderBy("place", "length")
    end = F.col("place") + F.col("length")
    covered = (
        shared.withColumn(
            "before", F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
        )
        .groupBy("row_key")
        .agg(
            F.sum(
                F.greatest(
                    F.lit(0), end - F.greatest("place", F.coalesce("before", F.lit(0)))
                )
            ).alias("hit")
        )
    )
    named = (
        shared.select("row_key", "length", "hash")
        .distinct()
        .join(windows.where("item_id is not null"), ["length", "hash"])
        .select("row_key", F.col("item_id").cast("string").alias("item"))
        .distinct()
        .groupBy("row_key")
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
    )
    n_hit = F.coalesce("hit", F.lit(0)).cast("long")
    items_found = F.coalesce("items", F.array().cast("array<string>"))
    return (
        scanned.select("doc_id", "row_key", "n_words")
        .join(covered.join(named, "row_key", "left"), "row_key", "left")
        .select(
            "doc_id",
            "row_key",
            "n_words",
            n_hit.alias("n_hit"),
            F.size(items_found).cast("long").alias("n_items"),
            F.sha2(F.array_join(items_found, ",").cast("binary"), 256).alias("items_sha256"),
            ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
        )
    )


def keep_uncontaminated(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``documents`` that hold too little of any item to go."""
    key = unused(documents, "_row_key")
    gone = contamination(documents, items).where("contaminated").select(
        F.col("row_key").alias(key)
    )
    kept = documents.withColumn(key, _row_key()).join(gone.distinct(), key, "left_anti")
    return kept.select(*[F.col(f"`{c}`") for c in documents.columns])


def _row_key():
    return F.xxhash64("doc_id", F.coalesce("text", F.lit("")))


def lookup(known: DataFrame) -> np.ndarray:
    """Bits of all fingerprints and short windows, in at most ``LOOKUP_BITS / 32`` words."""
    at = F.pmod(F.col("hash"), F.lit(LOOKUP_BITS))
    bits = (
        known.where(f"kind = 0 or length < {WINDOW}")
        .groupBy(F.shiftright(at, 5).alias("word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, int(pmod(hash, {LOOKUP_BITS}) % 32))")).alias("bits"))
        .toPandas()
    )
    table = np.zeros(LOOKUP_BITS // 32, dtype=np.uint32)
    table[bits["word"].to_numpy(dtype=np.int64)] = bits["bits"].to_numpy(dtype=np.int64)
    return table


def _scan(documents: DataFrame, known: DataFrame, window: int, gram: int) -> DataFrame:
    """Every row with its number of words and the windows an item may have."""
    shared = documents.sparkSession.sparkContext.broadcast(lookup(known))
    short = sorted(
        r.length
        for r in known.where(f"kind = 1 and length < {window}").select("length").distinct().collect()
    )
    kind = documents.schema["doc_id"].dataType.simpleString()
    struct = pa.struct([("place", pa.int64()), ("length", pa.int32()), ("hash", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            for low, high, data, offsets in slices(batch.column("text")):
                found = words(data, offsets, ALPHANUMERIC)
                spots = [_long_windows(found, table, window, gram)]
                for length in short:
                    at = starts_of(found, length)
                    marks = gram_hashes(found.hash, at, length)
                    hit = _known(table, marks)
                    spots.append((at[hit], np.full(hit.sum(), length), marks[hit]))
                at, lengths, marks = (np.concatenate(x) for x in zip(*spots, strict=True))
                order = np.argsort(at, kind="stable")
                at, lengths, marks = at[order], lengths[order], marks[order]
                row = found.row[at]
                part = batch.slice(low, high - low)
                values = pa.StructArray.from_arrays(
                    [
                        pa.array(at - found.bounds[row]),
                        pa.array(lengths.astype(np.int32)),
                        pa.array(marks.view(np.int64)),
                    ],
                    fields=list(struct),
                )
                cuts = np.searchsorted(row, np.arange(high - low + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("row_key"),
                        pa.array(np.diff(found.bounds)),
                        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), values),
                    ],
                    names=["doc_id", "row_key", "n_words", "windows"],
                )

    return documents.select("doc_id", "text", _row_key().alias("row_key")).mapInArrow(
        run,
        f"doc_id {kind}, row_key long, n_words long, "
        "windows array<struct<place:long,length:int,hash:long>>",
    )


def _known(table: np.ndarray, marks: np.ndarray) -> np.ndarray:
    at = (marks & U64(LOOKUP_BITS - 1)).astype(np.int64)
    return (table[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1


def _long_windows(
    found: Words, table: np.ndarray, window: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows that hold a fingerprint the benchmark may have."""
    place, marks = fingerprints(found, window, gram)
    place = place[_known(table, marks)]
    first = np.unique((place[:, None] - np.arange(window - gram + 1)).ravel())
    first = first[first >= 0]
    first = first[np.isin(first, starts_of(found, window), assume_unique=True)]
    return first, np.full(len(first), window), gram_hashes(found.hash, first, window)
