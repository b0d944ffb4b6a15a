"""How filters interact: what each removes in every order they may be applied in.

Every document gets a mask with one bit a failed filter. Masks are counted by part, with
the labelled documents among them, and each part's counts become one decision diagram: a
level a filter, a node for every different remainder, and at each node how many documents
reach it. Two neighbouring levels are swapped in place, so all orders follow from one
another by single swaps. The path of passed filters gives an order's steps: what fails
at a node is removed there, what passes is kept.

The filters on texts are few words (A), repeated words (B), capitals (C), marks (D) and
the exact copy of a text with a smaller id (E); ``audit_orders`` takes counts of any.

Null texts are empty and null parts are the empty string. A row without an id is nobody's
copy and none is its copy; rows that share the least id of a text are all no copies. A
document is good or toxic if any of its labels says so. Equal texts are told by 128-bit
digests, different words by 64-bit hashes. Copies are counted, not sent together: a text
of any frequency is one row a task. Other columns are not read; empty tables give an
empty table.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.llm.textbytes import NOT_SPACE, U64, mix, slices, words

FILTERS = "ABCDE"
LEAST_WORDS = 200
LEAST_DIFFERENT = 50
MOST_CAPITALS = 3
MARKS = "#$%&*|"
#: What a document counts as, in this order: itself, if labelled good, if labelled toxic.
COUNTS = ("total", "good", "toxic")

_CAPITAL = np.zeros(256, dtype=bool)
_CAPITAL[0x41:0x5B] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[ord(c) for c in MARKS]] = True
_FIRST = (np.arange(256) & 0xC0) != 0x80
_COPY = 1 << FILTERS.index("E")


def filter_audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part (``lang``), filter order and step: see ``audit_orders``."""
    return audit_orders(failure_counts(documents, labels), FILTERS)


def text_masks(documents: DataFrame, part: str = "lang") -> DataFrame:
    """Per row: doc_id, part, digest of the text, mask of A to D."""
    schema = T.StructType(
        [
            T.StructField("doc_id", documents.schema["doc_id"].dataType),
            T.StructField("part", T.StringType()),
            T.StructField("digest", T.BinaryType()),
            T.StructField("mask", T.IntegerType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in slices(batch.column("text")):
                digests = [
                    hashlib.blake2b(data[a:b], digest_size=16).digest()
                    for a, b in zip(offsets[:-1], offsets[1:], strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(low, high - low),
                        batch.column("part").slice(low, high - low),
                        pa.array(digests, pa.binary()),
                        pa.array(masks(data, offsets)),
                    ],
                    names=schema.names,
                )

    return documents.select(
        "doc_id", F.coalesce(part, F.lit("")).alias("part"), "text"
    ).mapInArrow(run, schema)


def masks(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits 0 to 3: the rows that fail A to D."""
    found = words(data, offsets, NOT_SPACE, lower=False)
    n_words = np.diff(found.bounds)
    keys = mix(found.hash ^ mix(found.row.astype(U64) + U64(1)))
    _, first = np.unique(keys, return_index=True)
    different = np.bincount(found.row[first], minlength=len(n_words))
    fails = [
        n_words < LEAST_WORDS,
        100 * different < LEAST_DIFFERENT * n_words,
        100 * _count(_CAPITAL[data], offsets) > MOST_CAPITALS * _count(_FIRST[data], offsets),
        _count(_MARK[data], offsets) > 0,
    ]
    return sum(x.astype(np.int32) << k for k, x in enumerate(fails))


def _count(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=sums[1:])
    return np.diff(sums[offsets])


def failure_counts(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, total, good, toxic) over all documents, copies (E) among the masks.

    A document's other bits depend on its text alone, so rows are grouped by text, part
    and labels, first with their ids and then without; only the least id of a group and
    how often it comes are kept to tell copies from the first.
    """
    labelled = labels.groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    by_id = text_masks(documents).groupBy("digest", "part", "mask", "doc_id").agg(
        F.count("*").alias("n")
    )
    named = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))
    by_text = (
        by_id.join(labelled, "doc_id", "left")
        .fillna(0, ["good", "toxic"])
        .groupBy("digest", "part", "mask", "good", "toxic")
        .agg(
            F.sum("n").alias("n"),
            F.min(named).alias("first"),
            F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"),
        )
    )
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    originals = F.col("unnamed") + F.when(
        F.col("first.doc_id") == F.col("least"), F.col("first.n")
    ).otherwise(0)
    return (
        by_text.withColumn("least", least)
        .withColumn("originals", originals)
        .select(
            "part",
            "good",
            "toxic",
            F.explode(
                F.array(
                    F.struct("mask", F.col("originals").alias("n")),
                    F.struct(
                        F.col("mask").bitwiseOR(F.lit(_COPY)).alias("mask"),
                        (F.col("n") - F.col("originals")).alias("n"),
                    ),
                )
            ).alias("counted"),
        )
        .groupBy("part", F.col("counted.mask").alias("mask"))
        .agg(
            F.sum("counted.n").alias("total"),
            F.sum(F.col("counted.n") * F.col("good")).alias("good"),
            F.sum(F.col("counted.n") * F.col("toxic")).alias("toxic"),
        )
    )


def audit_orders(counts: DataFrame, filters: Sequence[str]) -> DataFrame:
    """Per part, order of the filters and step, from (part, mask, total, good, toxic).

    Bit k of a mask is a failure of ``filters[k]``. kept, removed, redundant (failures of
    the step's filter that are gone already), unique_fails (failures of it alone),
    good_lost and toxic_lost (labelled ones removed), shapley (removed by the filter,
    summed over all orders). A part gives factorial(filters) orders, so these should be
    few; its counts are 2 ** filters rows at most.
    """
    names = [
        "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    ]

    def run(table: pa.Table) -> pa.Table:
        values = np.zeros((1 << len(filters), len(COUNTS)), dtype=np.int64)
        values[table["mask"].to_numpy()] = np.stack([table[c].to_numpy() for c in COUNTS], 1)
        orders, rows = audited(values)
        size = len(orders) * len(filters)
        told = ["".join(filters[k] for k in order) for order in orders for _ in order]
        return pa.table(
            {
                "part": pa.array([table["part"][0].as_py()] * size, pa.string()),
                "filter_order": pa.array(told),
                "step": pa.array(np.tile(np.arange(1, len(filters) + 1), len(orders)), pa.int32()),
                **{name: pa.array(rows[:, k]) for k, name in enumerate(names)},
            }
        )

    schema = "part string, filter_order string, step int"
    return counts.groupBy("part").applyInArrow(
        run, ", ".join([schema, *(f"{name} long" for name in names)])
    )


class Diagram:
    """A function from masks to counts as a decision diagram with a level a variable.

    Every path tests all variables in the order of the levels, and equal remainders are
    one node. A node's weight is the sum of the counts below it.
    """

    def __init__(self, values: np.ndarray) -> None:
        """``values``: counts by mask; the first level tests the lowest bit."""
        self.order = list(range(int(math.log2(len(values)))))
        self.weight: list[np.ndarray] = []
        self._children: list[tuple[int, int] | None] = []
        leaves: dict[tuple, int] = {}
        for value in values:
            key = tuple(value.tolist())
            if key not in leaves:
                leaves[key] = self._new(None, value)
        row = [leaves[tuple(value.tolist())] for value in values]
        # Levels from the last: the highest bit halves the row.
        self.levels: list[dict[tuple[int, int], int]] = []
        for _ in self.order:
            half = len(row) // 2
            level: dict[tuple[int, int], int] = {}
            row = [self._node(level, a, b) for a, b in zip(row[:half], row[half:], strict=True)]
            self.levels.insert(0, level)
        (self.root,) = row

    def _new(self, children: tuple[int, int] | None, weight: np.ndarray) -> int:
        self._children.append(children)
        self.weight.append(weight)
        return len(self.weight) - 1

    def _node(self, level: dict[tuple[int, int], int], passed: int, failed: int) -> int:
        if (passed, failed) not in level:
            weight = self.weight[passed] + self.weight[failed]
            level[passed, failed] = self._new((passed, failed), weight)
        return level[passed, failed]

    def swap(self, k: int) -> None:
        """Exchange the variables of levels ``k`` and ``k + 1``. Nodes of the upper level
        keep their functions and so their places; only what they point to is made anew."""
        upper: dict[tuple[int, int], int] = {}
        lower: dict[tuple[int, int], int] = {}
        for (passed, failed), node in self.levels[k].items():
            (pp, pf), (fp, ff) = self._children[passed], self._children[failed]
            children = (self._node(lower, pp, fp), self._node(lower, pf, ff))
            self._children[node] = children
            upper[children] = node
        self.levels[k], self.levels[k + 1] = upper, lower
        self.order[k], self.order[k + 1] = self.order[k + 1], self.order[k]

    def passes(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """(kept, removed) counts of each level on the path on which nothing fails."""
        node, steps = self.root, []
        for _ in self.order:
            passed, failed = self._children[node]
            steps.append((self.weight[passed], self.weight[failed]))
            node = passed
        return steps


def plain_changes(n: int) -> Iterator[int]:
    """Places k of the swaps of k and k + 1 that lead through all orders of ``n``."""
    if n < 2:
        return
    down = True
    inner = plain_changes(n - 1)
    while True:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        step = next(inner, None)
        if step is None:
            return
        # After a sweep down the last item is in front of the others.
        yield step + 1 if down else step
        down = not down


def audited(values: np.ndarray) -> tuple[list[tuple[int, ...]], np.ndarray]:
    """All orders of the filters, and a row of figures per order and step.

    ``values``: per mask the counts of documents, good ones and toxic ones. A filter that
    comes first removes all its failures, one that comes last those that are its alone.
    """
    diagram = Diagram(values)
    n = len(diagram.order)
    orders, rows = [], []
    fails, alone, shapley = np.zeros((3, n), dtype=np.int64)
    for k in [None, *plain_changes(n)]:
        if k is not None:
            diagram.swap(k)
        orders.append(tuple(diagram.order))
        steps = diagram.passes()
        fails[orders[-1][0]] = steps[0][1][0]
        alone[orders[-1][-1]] = steps[-1][1][0]
        for name, (kept, removed) in zip(orders[-1], steps, strict=True):
            shapley[name] += removed[0]
            rows.append((name, kept[0], *removed))
    name, kept, removed, good, toxic = np.array(rows, dtype=np.int64).T
    columns = [kept, removed, fails[name] - removed, alone[name], good, toxic, shapley[name]]
    return orders, np.stack(columns, axis=1)


#: The same rows in SQL.
ORACLE = r"""
WITH texts AS (
  SELECT doc_id, COALESCE(lang, '') AS part, COALESCE(text, '') AS body FROM documents
), split AS (
  SELECT doc_id, part, body, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS w FROM texts
), labelled AS (
  SELECT doc_id, MAX(CAST(quality = 1 AS INT)) AS good, MAX(CAST(toxic = 1 AS INT)) AS toxic
  FROM labels GROUP BY doc_id
), failed AS (
  SELECT part, COALESCE(good, 0) AS good, COALESCE(toxic, 0) AS toxic,
    CAST(len(w) < 200 AS INT)
    + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INT)
    + 4 * CAST(100 * len(regexp_replace(body, '[^A-Z]', '', 'g')) > 3 * len(body) AS INT)
    + 8 * CAST(regexp_matches(body, '[#$%&*|]') AS INT)
    + 16 * CAST(COALESCE(doc_id > MIN(doc_id) OVER (PARTITION BY body), FALSE) AS INT) AS mask
  FROM split LEFT JOIN labelled USING (doc_id)
), counted AS (
  SELECT part, mask, COUNT(*) AS n, SUM(good) AS good, SUM(toxic) AS toxic
  FROM failed GROUP BY part, mask
), letters(name, bit) AS (
  VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), orders AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS filter_order,
    [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5
), steps AS (
  SELECT filter_order, step, bits[step] AS bit,
    COALESCE(list_sum(bits[1:step - 1]), 0) AS before
  FROM orders, (SELECT UNNEST([1, 2, 3, 4, 5]) AS step)
), rows AS (
  SELECT part, filter_order, step, bit,
    SUM(CASE WHEN mask & (before + bit) = 0 THEN n ELSE 0 END) AS kept,
    SUM(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
    SUM(CASE WHEN mask & bit > 0 AND mask & before > 0 THEN n ELSE 0 END) AS redundant,
    SUM(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    SUM(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
    SUM(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM counted CROSS JOIN
    (SELECT filter_order, step, bit, CAST(before AS INT) AS before FROM steps)
  GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, CAST(step AS INT) AS step,
  CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(SUM(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM rows
"""
