"""Removal of byte strings that occurred before, by prefix doubling over anchored positions.

Prefix doubling ranks positions by the strings that start there, sorts pairs of a rank
and the rank some offset on, and so ranks strings twice as long, round by round, until a
position is unique or the strings are as long as the threshold. Here a rank is a hashed
name of the string, the least position with that name stands for it, and three rounds
reach the threshold:

1. Every string of ``THRESHOLD`` bytes is represented by an anchor, the ``GRAM`` bytes in
   it whose hash is least. Equal strings have equal anchors at equal places, so a few in
   a hundred positions stand for all. Anchors are sorted by name; unique ones are done.
2. Pairs of the anchor's name and that of the whole stretch of strings it represents are
   sorted. Of equal stretches all but the first are removed. The first ones are done if
   no other stretch has the anchor.
3. What remains, mostly edges of copied passages, is sorted by the names of its single
   strings of ``THRESHOLD`` bytes; all but the first of each are removed.

Tasks send one row for equal names they have seen, so a passage that a third of all
documents share is one row a task.

Null and short texts keep all bytes. Documents are ordered by id, null last; rows that
repeat an id by a hash of their text. Equal rows are copies, of which the first keeps
what is first. An empty table gives an empty table. Texts may be of any length: they are
read in pieces. Other columns are not read. Names are hashes: 48 bits
of an anchor, and for what is removed 112 of a stretch and 96 of a single string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.llm.bitmaps import bitmap, hits, places
from tickbars.llm.tables import store
from tickbars.llm.textbytes import U64, RollingHash, bytes_of, mix, slices, sliding_min

THRESHOLD = 100
GRAM = 48
#: Rows among which a task removes equal ones before it sends them.
FLUSH = 1 << 18
#: Bytes that a task hashes at once.
PIECE = 1 << 20
_STRETCH = U64(0x9FB21C651E98DF25)


def remove_repeats(documents: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    keyed = _Keyed(documents)
    first = store(_stretches(keyed, threshold), "repeat-stretches")
    second = store(_strings(keyed, first.where("kind = 2"), threshold), "repeat-strings")
    spans = (
        first.where("kind = 0")
        .select("doc_id", "tie", "start", "end")
        .unionByName(second)
    )
    cut = store(_applied(keyed, spans), "repeat-rows")
    return _with_copies(cut, threshold)


#: Stands for a null id, which comes last.
_NO_ID = np.iinfo(np.int64).max


class _Keyed:
    """Rows by id and ``tie``, which tells rows of one id apart and is 0 where ids don't
    repeat, as a bitmap of repeated ids says."""

    def __init__(self, documents: DataFrame) -> None:
        doc_id = F.coalesce(F.col("doc_id").cast("long"), F.lit(int(_NO_ID)))
        rows = documents.select(doc_id.alias("doc_id"), F.xxhash64("text").alias("tie"), "text")
        repeated = rows.groupBy("doc_id").count().where("count > 1").select("doc_id")
        self.repeated = self._shared(documents, bitmap(repeated, F.col("doc_id")))
        self.rows = rows.select("*", *places(F.col("doc_id")))

    @staticmethod
    def _shared(documents: DataFrame, bits: np.ndarray):
        return documents.sparkSession.sparkContext.broadcast(bits)

    def map(self, run, schema: str) -> DataFrame:
        """``run`` over (doc_id, tie, text) batches; one Python worker a task."""
        repeated = self.repeated

        def tied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column("doc_id").to_numpy()
                known = hits(repeated.value, batch) | (ids == _NO_ID)
                tie = np.where(known, batch.column("tie").to_numpy(), 0)
                columns = [batch.column("doc_id"), pa.array(tie), *batch.columns[2:]]
                yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

        return self.rows.mapInArrow(lambda batches: run(tied(batches)), schema)

    def having(self, table: DataFrame, run, schema: str, *, wanted: bool = True) -> DataFrame:
        """``run`` over the rows whose id ``table`` may have, or surely does not have."""
        bits = self._shared(table, bitmap(table, F.col("doc_id")))

        def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(hits(bits.value, batch) == wanted))

        return self.map(lambda batches: run(chosen(batches)), schema)


#: An anchor's name has 48 bits: two different ones of the same name are only compared
#: string by string, as two stretches of one anchor are.
_ANCHOR = U64(0xFFFFFFFFFFFF)


def packed(kind: np.ndarray | int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Kind, start and length in one number that sorts by start: what is moved is less."""
    return start << 32 | (end - start) << 2 | kind


def unpacked(spot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(kind, start, end) of ``packed``."""
    start = spot >> 32
    return spot & 3, start, start + ((spot & 0xFFFFFFFF) >> 2)


def pieces(column: pa.Array, threshold: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(first row, bytes, offsets, place of the bytes in their row) in bounded parts.

    A row beyond the bound comes in parts that overlap by all but a byte of a string, so
    each string is whole in exactly one.
    """
    for low, _, data, offsets in slices(column, PIECE):
        if len(data) <= 2 * PIECE:
            yield low, data, offsets, 0
            continue
        # Only a single row is longer than that.
        for start in range(0, max(len(data) - threshold + 1, 1), PIECE):
            part = data[start : start + PIECE + threshold - 1]
            yield low, part, np.array([0, len(part)]), start


def anchored(
    data: np.ndarray, offsets: np.ndarray, threshold: int, gram: int = GRAM
) -> dict[str, np.ndarray]:
    """Stretches of neighbouring strings with one anchor: row, start and last string's
    start in ``data``, the anchor's name and the stretch's."""
    gram = min(gram, threshold)
    whole = np.diff(offsets) >= threshold
    n = len(data) - threshold + 1
    valid = np.zeros(max(n, 0) + 1, dtype=np.int64)
    np.add.at(valid, offsets[:-1][whole], 1)
    np.add.at(valid, offsets[1:][whole] - threshold + 1, -1)
    valid = np.cumsum(valid)[: max(n, 0)] > 0
    rolling = RollingHash(data)
    names = rolling.every(gram)
    ranked = (names >> U64(32) << U64(32)) | np.arange(len(names), dtype=U64)
    anchor = (sliding_min(ranked, threshold - gram + 1) & U64(0xFFFFFFFF)).astype(np.int64)
    same = np.zeros(len(anchor), dtype=bool)
    same[1:] = (anchor[1:] == anchor[:-1]) & valid[1:] & valid[:-1]
    start = np.flatnonzero(valid & ~same)
    ends = np.zeros(len(anchor), dtype=bool)
    ends[:-1] = ~same[1:]
    ends[-1:] = True
    last = np.flatnonzero(valid & ends)
    at = anchor[start]
    stretch = rolling.of(start, last + threshold) + (at - start).astype(U64) * _STRETCH
    return {
        "row": np.searchsorted(offsets, start, side="right") - 1,
        "start": start,
        "last": last,
        "anchor": names[at] & _ANCHOR,
        "stretch": mix(stretch),
    }


class _Sender:
    """Gathers stretches of a task and gives rows without those it has seen before."""

    columns = ("anchor", "stretch", "doc_id", "tie", "spot")

    def __init__(self, threshold: int) -> None:
        self.threshold = threshold
        self.parts: list[dict[str, np.ndarray]] = []
        self.size = 0

    def add(self, found: dict[str, np.ndarray]) -> None:
        self.parts.append(found)
        self.size += len(found["start"])

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        x = {k: np.concatenate([p[k] for p in self.parts]) for k in self.parts[0]}
        self.parts, self.size = [], 0
        order = np.lexsort((x["start"], x["tie"], x["doc_id"], x["stretch"], x["anchor"]))
        x = {k: v[order] for k, v in x.items()}
        new_anchor = _changes(x["anchor"])
        new = new_anchor | _changes(x["stretch"])
        lead = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        # Equal rows of the table come with equal places, which repeat nothing.
        own = (
            (x["doc_id"] == x["doc_id"][lead])
            & (x["tie"] == x["tie"][lead])
            & (x["start"] == x["start"][lead])
        )
        group = np.cumsum(new_anchor) - 1
        many = (np.bincount(group, new) > 1)[group]
        x["end"] = x["last"] + self.threshold
        removed = {k: v[~own] for k, v in x.items()}
        yield self._rows(0, merged(removed))
        # Two stretches with one anchor: their strings must be compared one by one.
        # They pass by, and one row tells the anchor's other stretches.
        yield self._rows(2, {k: v[new & many] for k, v in x.items()})
        yield self._rows(1, {k: v[new & ~many] for k, v in x.items()})
        yield self._rows(3, {k: v[new_anchor & many] for k, v in x.items()})

    def _rows(self, kind: int, x: dict[str, np.ndarray]) -> pa.RecordBatch:
        n = len(x["start"])
        # Rows that only pass by are dealt evenly.
        route = x["anchor"]
        if kind in (0, 2):
            route = mix(x["start"].astype(U64) + x["anchor"]) & _ANCHOR
        stretch = x["stretch"] if kind in (1, 3) else np.zeros(n, dtype=U64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(route.view(np.int64)),
                pa.array(stretch.view(np.int64)),
                *(pa.array(x[k]) for k in ("doc_id", "tie")),
                pa.array(packed(kind, x["start"], x["end"])),
            ],
            names=list(self.columns),
        )


def _changes(values: np.ndarray) -> np.ndarray:
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    return new


def merged(x: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Spans that meet or overlap within a document as one."""
    if not len(x["start"]):
        return x
    order = np.lexsort((x["start"], x["tie"], x["doc_id"]))
    x = {k: v[order] for k, v in x.items()}
    same = ~(_changes(x["doc_id"]) | _changes(x["tie"]))
    # Spans here have a bounded length, so a running maximum within rows of like start.
    group = np.cumsum(~same)
    reach = x["end"] + group * (1 << 40)
    reach = np.maximum.accumulate(reach) - group * (1 << 40)
    new = np.ones(len(same), dtype=bool)
    new[1:] = ~same[1:] | (x["start"][1:] > reach[:-1])
    firsts = np.flatnonzero(new)
    out = {k: v[firsts] for k, v in x.items()}
    out["end"] = np.maximum.reduceat(x["end"], firsts)
    return out


def _stretches(keyed: _Keyed, threshold: int) -> DataFrame:
    """(kind, doc_id, tie, start, end): 0 a removed span, 2 strings to be compared."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = _Sender(threshold)
        for batch in batches:
            ids, ties = batch.column("doc_id").to_numpy(), batch.column("tie").to_numpy()
            for low, data, offsets, place in pieces(batch.column("text"), threshold):
                found = anchored(data, offsets, threshold)
                row = found.pop("row")
                found["doc_id"], found["tie"] = ids[low + row], ties[low + row]
                base = place - offsets[row]
                found["start"], found["last"] = found["start"] + base, found["last"] + base
                sender.add(found)
                if sender.size >= FLUSH:
                    yield from sender.flush()
        yield from sender.flush()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What the last row of the batch before was, and whether it still waits for
        # another stretch with its anchor.
        anchor = stretch = place = waiting = None
        for batch in batches:
            kind = unpacked(batch.column("spot").to_numpy())[0]
            passing = (kind == 0) | (kind == 2)
            yield _spans(batch, np.flatnonzero(passing), kind[passing])
            batch = batch.filter(pa.array(~passing))
            n = batch.num_rows
            if not n:
                continue
            a, s = batch.column("anchor").to_numpy(), batch.column("stretch").to_numpy()
            marker = kind[~passing] == 3
            new_anchor, new = _changes(a), _changes(a) | _changes(s)
            new_anchor[0] = a[0] != anchor
            new[0] = new_anchor[0] or s[0] != stretch
            group = np.cumsum(new_anchor)
            # Distinct stretches so far, counting what came in earlier batches, and
            # markers as two.
            seen = np.bincount(group, new | marker, minlength=group[-1] + 1)
            flagged = np.bincount(group, marker, minlength=group[-1] + 1) > 0
            if group[0] == 0:
                seen[0] += 1 if waiting is not None else 2
            many = ((seen > 1) | flagged)[group]
            lead = np.maximum.accumulate(np.where(new, np.arange(n), -1))
            # A marker stands at the place of one of the anchor's stretches.
            at = np.stack([batch.column(c).to_numpy() for c in ("doc_id", "tie", "spot")])
            at[2] >>= 2
            own = np.where(lead >= 0, (at == at[:, np.maximum(lead, 0)]).all(axis=0), False)
            if place is not None:
                own |= (lead < 0) & (at == place[:, None]).all(axis=0)
            removed = np.flatnonzero(~own & ~marker)
            yield _spans(batch, removed, np.zeros(len(removed)))
            if waiting is not None:
                if group[0] == 0 and many[0]:
                    yield waiting
                    waiting = None
                elif a[-1] != anchor:
                    waiting = None
            open_ = np.flatnonzero(new & ~marker & many)
            yield _spans(batch, open_, np.full(len(open_), 2))
            if lead[-1] >= 0:
                place = at[:, lead[-1]]
            if new_anchor.any():
                begun = np.flatnonzero(new_anchor)[-1]
                waiting = None
                if not many[-1]:
                    waiting = _spans(batch, np.array([begun]), np.array([2]))
            anchor, stretch = a[-1], s[-1]

    return (
        keyed.map(send, "anchor long, stretch long, doc_id long, tie long, spot long")
        .repartition("anchor")
        .sortWithinPartitions("anchor", "stretch", "doc_id", "tie", "spot")
        .mapInArrow(judge, "kind byte, doc_id long, tie long, start int, end int")
    )


def _spans(batch: pa.RecordBatch, rows: np.ndarray, kind: np.ndarray) -> pa.RecordBatch:
    chosen = batch.take(pa.array(rows, pa.int64()))
    _, start, end = unpacked(chosen.column("spot").to_numpy())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(kind.astype(np.int8)),
            *(chosen.column(c) for c in ("doc_id", "tie")),
            *(pa.array(x.astype(np.int32)) for x in (start, end)),
        ],
        names=["kind", "doc_id", "tie", "start", "end"],
    )


def _gathered(spans: DataFrame) -> DataFrame:
    return spans.groupBy("doc_id", "tie").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans")
    )


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.select(["doc_id", "tie", "text"])


def _span_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all rows' spans, and where each row's begin; null has none."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    flat = column.flatten()
    bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    start, end = (flat.field(k).to_numpy().astype(np.int64) for k in (0, 1))
    return start, end, bounds


def _strings(keyed: _Keyed, stretches: DataFrame, threshold: int) -> DataFrame:
    """(doc_id, tie, start, end) of strings in ``stretches`` that occurred before."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[dict[str, np.ndarray]] = []
        size = 0
        for batch in batches:
            ids, ties = batch.column("doc_id").to_numpy(), batch.column("tie").to_numpy()
            starts, ends, bounds = _span_arrays(batch.column("spans"))
            for low, data, offsets, place in pieces(batch.column("text"), threshold):
                high = low + len(offsets) - 1
                own = slice(bounds[low], bounds[high])
                row = np.repeat(np.arange(high - low), np.diff(bounds[low : high + 1]))
                first = np.maximum(starts[own] - place, 0)
                last = np.minimum(ends[own] - place, np.diff(offsets)[row])
                count = np.maximum(last - first - threshold + 1, 0)
                if not count.sum():
                    continue
                span = np.repeat(np.arange(len(count)), count)
                step = np.arange(len(span)) - np.repeat(np.cumsum(count) - count, count)
                row, inside = row[span], first[span] + step
                start = inside + offsets[row]
                rolling = RollingHash(data)
                parts.append(
                    {
                        # The doubled name: the first half's and, beside it, the whole's.
                        "left": rolling.of(start, start + threshold // 2) >> U64(32),
                        "name": rolling.of(start, start + threshold),
                        "doc_id": ids[low + row],
                        "tie": ties[low + row],
                        "start": inside + place,
                    }
                )
                size += len(start)
                if size >= FLUSH:
                    yield from _sent(parts, threshold)
                    parts, size = [], 0
        if parts:
            yield from _sent(parts, threshold)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            kind, start, end = unpacked(batch.column("spot").to_numpy())
            removed = kind == 0
            names = np.stack([batch.column(c).to_numpy() for c in ("name", "left")])
            at = np.stack([*(batch.column(c).to_numpy() for c in ("doc_id", "tie")), start])
            plain = np.flatnonzero(~removed)
            out = [np.flatnonzero(removed)]
            if len(plain):
                names, at = names[:, plain], at[:, plain]
                if last is not None:
                    names = np.concatenate([last[0], names], axis=1)
                    at = np.concatenate([last[1], at], axis=1)
                new = np.ones(names.shape[1], dtype=bool)
                new[1:] = (names[:, 1:] != names[:, :-1]).any(axis=0)
                lead = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
                later = (at != at[:, lead]).any(axis=0)
                last = names[:, lead[-1] :][:, :1], at[:, lead[-1] :][:, :1]
                out.append(plain[later[len(later) - len(plain) :]])
            found = np.concatenate(out)
            x = {c: batch.column(c).to_numpy()[found] for c in ("doc_id", "tie")}
            x = merged(x | {"start": start[found], "end": end[found]})
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array(x[c]) for c in ("doc_id", "tie")),
                    *(pa.array(x[c].astype(np.int32)) for c in ("start", "end")),
                ],
                names=["doc_id", "tie", "start", "end"],
            )

    gathered = _gathered(stretches)
    return (
        keyed.having(stretches.select("doc_id"), _texts, "doc_id long, tie long, text string")
        .join(gathered, ["doc_id", "tie"])
        .mapInArrow(send, "name long, left int, doc_id long, tie long, spot long")
        .repartition("name", "left")
        .sortWithinPartitions("name", "left", "doc_id", "tie", "spot")
        .mapInArrow(judge, "doc_id long, tie long, start int, end int")
    )


def _sent(parts: list[dict[str, np.ndarray]], threshold: int) -> Iterator[pa.RecordBatch]:
    """Strings without those that a task has seen, and these as removed spans."""
    x = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
    x["end"] = x["start"] + threshold
    order = np.lexsort((x["start"], x["tie"], x["doc_id"], x["left"], x["name"]))
    x = {k: v[order] for k, v in x.items()}
    new = _changes(x["name"]) | _changes(x["left"])
    lead = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    later = ~new & (
        (x["doc_id"] != x["doc_id"][lead])
        | (x["tie"] != x["tie"][lead])
        | (x["start"] != x["start"][lead])
    )
    yield _named(merged({k: v[later] for k, v in x.items()}), kind=0)
    yield _named({k: v[new] for k, v in x.items()}, kind=1)


def _named(x: dict[str, np.ndarray], *, kind: int) -> pa.RecordBatch:
    """Rows of removed spans (0) or of strings to compare (1)."""
    return pa.RecordBatch.from_arrays(
        [
            pa.array(x["name"].view(np.int64)),
            pa.array(x["left"].astype(np.uint32).view(np.int32)),
            pa.array(x["doc_id"]),
            pa.array(x["tie"]),
            pa.array(packed(kind, x["start"], x["end"])),
        ],
        names=["name", "left", "doc_id", "tie", "spot"],
    )


def _applied(keyed: _Keyed, spans: DataFrame) -> DataFrame:
    """What is left of every row; rows that surely have no span are not shuffled."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nothing = np.zeros(0, dtype=np.int64)
            bounds = np.zeros(batch.num_rows + 1, dtype=np.int64)
            yield _left(batch, nothing, nothing, bounds)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _left(batch, *_span_arrays(batch.column("spans")))

    schema = (
        "doc_id long, tie long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
    ids = spans.select("doc_id")
    some = keyed.having(ids, _texts, "doc_id long, tie long, text string")
    return (
        some.join(_gathered(spans), ["doc_id", "tie"], "left")
        .mapInArrow(cut, schema)
        .unionByName(keyed.having(ids, whole, schema, wanted=False))
    )


def _left(
    batch: pa.RecordBatch, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray
) -> pa.RecordBatch:
    data, offsets = bytes_of(batch.column("text"))
    rows = []
    for k in range(batch.num_rows):
        text = data[offsets[k] : offsets[k + 1]]
        own = slice(bounds[k], bounds[k + 1])
        digest, at, removed, n = hashlib.sha256(), 0, 0, 0
        for low, high in union(starts[own].tolist(), ends[own].tolist()):
            digest.update(text[at:low])
            removed, n, at = removed + high - low, n + 1, high
        digest.update(text[at:])
        rows.append((len(text), removed, n, digest.hexdigest()))
    columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"),
            batch.column("tie"),
            *(pa.array(x, pa.int64()) for x in columns[:3]),
            pa.array(columns[3], pa.string()),
        ],
        names=["doc_id", "tie", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    )


def union(starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    """Maximal runs covered by spans in order of their starts."""
    runs: list[tuple[int, int]] = []
    low = high = -1
    for start, end in zip(starts, ends, strict=True):
        if start > high:
            if high >= 0:
                runs.append((low, high))
            low, high = start, end
        elif end > high:
            high = end
    if high >= 0:
        runs.append((low, high))
    return runs


def _with_copies(cut: DataFrame, threshold: int) -> DataFrame:
    """Equal rows after the first lose all their bytes if a string fits in them."""
    columns = ["doc_id", "tie", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    gone = (F.col("copy") > 1) & (F.col("n_bytes") >= threshold)
    empty = hashlib.sha256(b"").hexdigest()
    return (
        cut.groupBy(*columns)
        .count()
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("count"))))
        .select(
            F.nullif("doc_id", F.lit(int(_NO_ID))).alias("doc_id"),
            "n_bytes",
            F.when(gone, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
            F.when(gone, F.lit(1).cast("long")).otherwise(F.col("n_spans")).alias("n_spans"),
            F.when(gone, F.lit(empty)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
        )
    )
