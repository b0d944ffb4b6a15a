"""Mixing sources to target weights by pivotal dependent rounding.

A source's target over its size is the expected number of copies of each of its
documents. The whole part is taken outright. The fractions are rounded in pairs: words
move from one document of a pair to the other, in a direction drawn so that every
fraction keeps its expected value, until one of the two is 0 or 1. The pair's words stay
the same, so a source's total does. What one group leaves over, one document, meets the
others' in the next level of a tree; groups are formed by hashed rows, so a hot source
has many.

Sizes are counts of words. Documents without words (null, empty, blank) have size 0 and
are never taken. A null source is a source of its own, last in order. Repeated rows and
ids are documents of their own. An empty table gives an empty table. Draws come from
hashes of id and text, or of the row, so reruns agree. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickbars.llm.tables import store, unused, whole_row
from tickbars.llm.textbytes import NOT_SPACE, slices, word_bounds

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_COPIES = 2.0
#: Documents that are rounded one after the other in one group of the tree.
GROUP = 4096


def sized(documents: DataFrame, key: Column | None = None) -> DataFrame:
    """doc_id, source, row_key, size of every row; ``key`` is its id and text unless given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.zeros(batch.num_rows, dtype=np.int64)
            for low, high, data, offsets in slices(batch.column("text")):
                start, _ = word_bounds(data, offsets, 0, NOT_SPACE)
                size[low:high] = np.diff(np.searchsorted(start, offsets))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "source", "row_key")), pa.array(size)],
                names=["doc_id", "source", "row_key", "size"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select(
        "doc_id", "source", "text", (_row_key() if key is None else key).alias("row_key")
    ).mapInArrow(run, f"doc_id {kind}, source string, row_key long, size long")


def targets(
    rows: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST_COPIES,
) -> DataFrame:
    """source, n_source, source_size, target: one row per source of ``rows``.

    Targets share ``share`` times all words by weight and stop at ``most`` times their
    source's. With sources ordered by the rate at which they stop, those before some
    place stop, and the others split by weight what the stopped ones leave.
    """
    sizes = rows.groupBy("source").agg(
        F.count("*").alias("n_source"), F.sum("size").alias("source_size")
    )
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))
    stop = F.col("source_size") * most
    by_stop = Window.orderBy(F.col("stop") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    after = by_stop.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(0)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    left = F.sum("source_size").over(whole) * share - F.coalesce(
        F.sum("stop").over(before), F.lit(0.0)
    )
    return (
        sizes.withColumn("weight", weight)
        .withColumn("stop", stop)
        .withColumn("rate", left / F.sum("weight").over(after))
        # Stopping a source below its share raises the others', stopping one above it
        # lowers them: the right place to split the order is where the rate is largest.
        .withColumn("rate", F.max("rate").over(whole))
        .select(
            "source",
            "n_source",
            "source_size",
            F.least("stop", F.col("rate") * F.col("weight")).alias("target"),
        )
    )


def mixture(
    documents: DataFrame,
    *,
    split_last: bool = True,
    group: int = GROUP,
    key: Column | None = None,
) -> DataFrame:
    """Every row with doc_id, row_key, size, source_size, target, copies, taken.

    ``split_last``: of the one document that each source's tree leaves with a fraction,
    that part of its words is taken; else it is taken whole or not, by a draw.
    """
    rows = store(sized(documents, key), "mix-sizes")
    aims = store(targets(rows), "mix-targets")
    rate = F.when(
        F.col("source_size") > 0, F.col("target") / F.col("source_size")
    ).otherwise(F.lit(0.0))
    planned = (
        rows.join(F.broadcast(aims) if aims.count() <= 100_000 else aims,
                  rows.source.eqNullSafe(aims.source))
        .drop(aims.source)
        .withColumn("whole", F.floor(rate + 1e-12))
        .withColumn("part", F.greatest(rate - F.col("whole"), F.lit(0.0)))
    )
    idle = (F.col("size") == 0) | (F.col("part") <= 1e-12)
    settled = planned.where(idle).withColumn("part", F.lit(0.0))
    left = planned.where(~idle)
    done = [settled]
    most = (aims.agg(F.max("n_source")).first()[0] or 0)
    level = 0
    while True:
        groups = -(-most // group)
        final = groups <= 1
        out = store(_round(left, level, group, final, split_last), f"mix-level-{level}")
        done.append(out.where("not open").drop("open"))
        if final:
            break
        left, most, level = out.where("open").drop("open"), groups, level + 1
    columns = ["doc_id", "row_key", "size", "source_size", "target", "whole", "part"]
    table = done[0].select(columns)
    for other in done[1:]:
        table = table.unionByName(other.select(columns))
    copies = F.when(F.col("size") == 0, 0.0).otherwise(F.col("whole") + F.col("part"))
    return table.select(
        "doc_id",
        "row_key",
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        F.round(copies * F.col("size")).cast("long").alias("taken"),
    )


def mixed(documents: DataFrame) -> DataFrame:
    """``documents`` with each row as often as the mixture takes it.

    Rows that differ in any column, such as one text in two sources, are rows of their
    own; rows equal in all columns share their copies.
    """
    key, copies, copy = (unused(documents, c) for c in ("_row_key", "_copies", "_copy"))
    whole = whole_row(documents)
    taken = (
        mixture(documents, split_last=False, key=whole)
        .groupBy(F.col("row_key").alias(key))
        .agg(F.sum("copies").cast("int").alias(copies))
        .where(F.col(copies) > 0)
    )
    # One of equal rows stands for all.
    keyed = documents.withColumn(key, whole).dropDuplicates([key])
    columns = [F.col(f"`{c}`") for c in documents.columns]
    each = F.explode(F.sequence(F.lit(1), copies)).alias(copy)
    return keyed.join(taken, key).select(*columns, each).select(*columns)


def _row_key():
    return F.xxhash64("doc_id", F.coalesce("text", F.lit("")))


def _round(
    left: DataFrame, level: int, group: int, final: bool, split_last: bool
) -> DataFrame:
    """One level: every group's rows get 0 or 1, but for one that stays open."""
    seed = F.xxhash64(F.lit(level), "row_key")
    fan = F.ceil(F.col("n_source") / F.lit(float(group) ** (level + 1)))
    keyed = left.withColumn("bucket", F.pmod(seed, fan)).withColumn(
        "draw", F.pmod(F.xxhash64(F.lit(31), seed), F.lit(1 << 30)) / F.lit(float(1 << 30))
    )
    keyed = keyed.withColumn("open", F.lit(False))
    columns = keyed.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            # Rebuilt, so that what is held over has the same schema.
            batch = pa.RecordBatch.from_arrays(batch.columns, names=columns)
            table = batch if held is None else pa.concat_batches([held, batch])
            held = yield from _pivot(table)
        if held is not None:
            yield _closed(held, final, split_last)

    def _pivot(table: pa.RecordBatch):
        """Settle all rows but the last group's holder, which is returned."""
        names = table.column("source").to_pylist()
        bucket = table.column("bucket").to_pylist()
        size = table.column("size").to_pylist()
        draw = table.column("draw").to_pylist()
        part = table.column("part").to_pylist()
        holder, ends = 0, []
        for i in range(1, len(part)):
            if bucket[i] != bucket[holder] or names[i] != names[holder]:
                ends.append(holder)
                holder = i
                continue
            part[holder], part[i] = pivot(
                part[holder], part[i], size[holder], size[i], draw[i]
            )
            if part[holder] in (0.0, 1.0):
                holder = i
        at = {"part": pa.array(part, pa.float64())}
        table = pa.RecordBatch.from_arrays(
            [at.get(c, table.column(c)) for c in columns], names=columns
        )
        over = set(ends)
        rest = [i for i in range(len(part)) if i != holder and i not in over]
        if rest:
            yield table.take(pa.array(rest, pa.int64()))
        if ends:
            yield _closed(table.take(pa.array(ends, pa.int64())), final, split_last)
        return table.slice(holder, 1)

    def _closed(rows: pa.RecordBatch, last: bool, split: bool) -> pa.RecordBatch:
        """What a group leaves: open for the next level, or settled at the last."""
        part = rows.column("part").to_numpy()
        fraction = (part > 0) & (part < 1)
        opened = fraction & (not last)
        if last and not split:
            draws = rows.column("draw").to_numpy()
            part = np.where(fraction, (draws < part).astype(float), part)
        at = {"part": pa.array(part), "open": pa.array(opened)}
        return pa.RecordBatch.from_arrays(
            [at.get(c, rows.column(c)) for c in columns], names=columns
        )

    return (
        keyed.repartition("source", "bucket")
        .sortWithinPartitions("source", "bucket", seed, "size")
        .mapInArrow(run, keyed.schema)
        .drop("bucket", "draw")
    )


def pivot(p: float, q: float, p_size: int, q_size: int, draw: float) -> tuple[float, float]:
    """Move words between two fractions until one is 0 or 1; each keeps its mean."""
    ratio = p_size / q_size
    up, down = min(1 - p, q / ratio), min(p, (1 - q) / ratio)
    if draw * (up + down) < down:
        return _snap(p + up), _snap(q - up * ratio)
    return _snap(p - down), _snap(q + down * ratio)


def _snap(x: float) -> float:
    return 0.0 if x < 1e-9 else 1.0 if x > 1 - 1e-9 else x
