"""Near-duplicate texts: MinHash bands, odd sketches, full sets, connected components.

A document's set holds the hashes of its distinct word shingles. Documents with equal
sets are one class; the rest works on classes, so a group of copies of any size is one
row. MinHash samples are folded into parity bitmaps. Classes that share a band are
compared there by the population count of the XOR of their bitmaps, and what may be
linked is confirmed on the full sets of 64-bit hashes.

Null and blank texts have the empty set and link with nothing. Repeated rows and equal
sets are linked. A null id is never the least of a component that has another. Ids may
repeat: each row gets its set's component. An empty table gives an empty table. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickbars.llm.bitmaps import BITS, bitmap, hits, places
from tickbars.llm.components import components
from tickbars.llm.shingles import (
    Bucket,
    SketchSettings,
    band_keys,
    min_hashes,
    odd_sketches,
    set_keys,
    shingle_sets,
    whole_sketch,
)
from tickbars.llm.tables import store, unused, whole_row
from tickbars.llm.textbytes import U64, slices

#: About as many classes as one task compares; larger buckets of a band are dealt to blocks.
BUCKET_LIMIT = 20_000


def near_components(
    documents: DataFrame,
    settings: SketchSettings = SketchSettings(),
    *,
    bucket_limit: int = BUCKET_LIMIT,
) -> DataFrame:
    """Per row of ``documents``: doc_id, n_shingles, component_id, kept, row_key, group.

    ``row_key`` hashes id and text, for joins back to the rows. ``group`` tells components
    apart also where they hold the same id; rows without words have none.
    """
    signed = store(_signatures(documents, settings), "near-signatures")
    filled = signed.where("n_shingles > 0")
    classes = store(_classes(filled), "near-classes")
    linked = store(
        _components(documents, classes, settings, bucket_limit), "near-components"
    )
    grouped = (
        classes.join(linked, F.col("class") == F.col("id"), "left")
        .select(
            "key_1", "key_2", "doc_id", F.coalesce("component", "class").alias("component")
        )
    )
    least = grouped.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    ids = grouped.join(least, "component").select(
        "key_1", "key_2", "component_id", F.col("component").alias("group")
    )
    rows = signed.select("doc_id", "row_key", "n_shingles", "key_1", "key_2")
    linked = rows.where("n_shingles > 0").join(ids, ["key_1", "key_2"])
    alone = rows.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    return linked.unionByName(alone, allowMissingColumns=True).select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        "row_key",
        "group",
    )


def keep_first(documents: DataFrame, settings: SketchSettings = SketchSettings()) -> DataFrame:
    """The rows of ``documents`` with one left of each group of near copies.

    It is the row with the least id; of rows that repeat that id, the one with the least
    text hash. Rows equal in id and text count as one, that with the least hash of all
    columns. Rows without words stay.
    """
    chosen = near_components(documents, settings).where("kept")
    place = Window.partitionBy("group").orderBy("row_key")
    key, order = unused(documents, "_row_key"), unused(documents, "_order")
    first = (
        chosen.where("n_shingles > 0")
        .withColumn("_place", F.row_number().over(place))
        .where("_place = 1")
        .select(F.col("row_key").alias(key))
        .unionAll(
            chosen.where("n_shingles = 0").select(F.col("row_key").alias(key)).distinct()
        )
    )
    kept = documents.withColumns({key: _row_key(), order: whole_row(documents)}).join(
        first, key, "left_semi"
    )
    # Spark cuts to the first of equal rows in their task, then by key.
    number = F.row_number().over(Window.partitionBy(key).orderBy(order))
    kept = kept.withColumn(order, number).where(F.col(order) == 1)
    return kept.select(*[F.col(f"`{c}`") for c in documents.columns])


def _row_key():
    return F.xxhash64("doc_id", F.coalesce("text", F.lit("")))


def _signatures(documents: DataFrame, settings: SketchSettings) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in slices(batch.column("text")):
                n = high - low
                values, bounds = shingle_sets(data, offsets, settings.shingle)
                first, second = set_keys(values, bounds)
                sizes = np.diff(bounds)
                filled = np.flatnonzero(sizes)
                least = min_hashes(values, bounds, settings.samples)
                bands, sketches = [None] * n, [None] * n
                whole: list[bytes | None] = [None] * n
                keys = band_keys(least, settings).view(np.int64)
                odd = odd_sketches(least, settings.sketch_words)
                for k, row in enumerate(filled):
                    bands[row], sketches[row] = keys[k], odd[k].tobytes()
                    whole[row] = whole_sketch(values[bounds[row] : bounds[row + 1]])
                part = batch.slice(low, n)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("row_key"),
                        pa.array(sizes),
                        pa.array(first.view(np.int64)),
                        pa.array(second.view(np.int64)),
                        pa.array(bands, pa.list_(pa.int64())),
                        pa.array(sketches, pa.binary()),
                        pa.array(whole, pa.binary()),
                    ],
                    names=[
                        "doc_id", "row_key", "n_shingles", "key_1", "key_2",
                        "bands", "sampled", "whole",
                    ],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text", _row_key().alias("row_key")).mapInArrow(
        run,
        f"doc_id {kind}, row_key long, n_shingles long, key_1 long, key_2 long, "
        "bands array<long>, sampled binary, whole binary",
    )


def _classes(signed: DataFrame) -> DataFrame:
    """One row per distinct set, numbered as it is written.

    The first aggregation moves fixed-width rows only; the sketches follow by row key.
    """
    least = signed.groupBy("key_1", "key_2").agg(
        F.min("doc_id").alias("doc_id"), F.min("row_key").alias("row_key")
    )
    own = signed.select(
        "key_1", "key_2", "row_key", "n_shingles", "bands", "sampled", "whole"
    )
    chosen = least.join(own, ["key_1", "key_2", "row_key"])
    repeated = signed.groupBy("row_key").count().where("count > 1").select("row_key")
    once = chosen.join(repeated, "row_key", "left_anti")
    again = chosen.join(repeated, "row_key", "left_semi").dropDuplicates(["key_1", "key_2"])
    return once.unionByName(again).withColumn("class", F.monotonically_increasing_id())


def _components(
    documents: DataFrame, classes: DataFrame, settings: SketchSettings, limit: int
) -> DataFrame:
    """(id, component) of the classes that are linked with others.

    Every bucket proposes a spanning forest of its pairs that may be linked. What the
    forests connect is a family; nothing outside it is linked with it, and little inside
    is not. The full sets of a family meet in one task, which compares them exactly.
    Families beyond ``limit`` are compared pair by pair in rounds instead.

    Buckets beyond ``limit`` do so in blocks, each together with the next. Copies of one
    text are one family then. Where a bucket still has several, or several components of
    exact links, ``_rest`` has all but its largest one meet every member.
    """
    members, hot = _buckets(classes, limit)
    pairs = store(_candidates(members, classes, settings), "near-pairs")
    families = store(components(pairs), "near-families")
    if hot is not None:
        rest = _rest(hot, families, limit)
        more = _candidates(rest, classes, settings)
        pairs = store(pairs.unionAll(more).distinct(), "near-pairs")
        families = store(components(pairs), "near-families")
        members = members.unionAll(rest)
    sets = store(_sets_of(documents, classes, families, settings), "near-sets")
    large = store(
        families.groupBy("component").count().where(f"count > {limit}").select("component"),
        "near-large",
    )
    found = _compared(sets.join(_small(large), "component", "left_anti"), settings)
    if large.isEmpty():
        return found
    own = families.join(large, "component").select(F.col("id").alias("class"))
    sets = sets.drop("component")
    inside = members.join(own, "class", "left_semi")
    links = _links(sets, inside, classes, pairs.join(own.toDF("a"), "a", "left_semi"), settings)
    joined = components(links)
    if hot is not None:
        joined = store(joined, "near-joined")
        rest = _rest(hot.join(own, "class", "left_semi"), joined, limit)
        pairs = store(_candidates(rest, classes, settings), "near-pairs")
        more = _links(sets, rest, classes, pairs, settings)
        joined = components(links.unionAll(more))
    return found.unionByName(joined)


def _compared(sets: DataFrame, settings: SketchSettings) -> DataFrame:
    """(id, component) by the exact links within each family of ``sets``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for family in _groups(batches, "component"):
            ids = family.column("class").to_numpy()
            column = family.column("members").combine_chunks()
            values, bounds = column.values.to_numpy().view(U64), column.offsets.to_numpy()
            own = [np.sort(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            nothing = np.zeros((len(ids), 1), dtype=U64)
            sizes = np.array([len(x) for x in own])
            bucket = Bucket(ids, sizes, nothing, [whole_sketch(x) for x in own], settings)
            least = bucket.components(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(ids[least])], names=["id", "component"]
            )

    return (
        sets.select("component", "class", "members")
        .repartition("component")
        .sortWithinPartitions("component", "class")
        .mapInArrow(run, "id long, component long")
    )


def _links(
    sets: DataFrame,
    members: DataFrame,
    classes: DataFrame,
    pairs: DataFrame,
    settings: SketchSettings,
) -> DataFrame:
    """(a, b) of linked classes; enough of them to join all that are connected.

    Buckets with a pair that proved not linked propose again without it, until nothing
    new comes.
    """
    judged = store(_confirmed(sets, pairs, settings), "near-judged")
    rounds = [judged]
    while not (failed := judged.where("not linked")).isEmpty():
        again = _with_failed(members, failed, rounds)
        pairs = _candidates(again, classes, settings)
        for known in rounds:
            pairs = pairs.join(known.select("a", "b"), ["a", "b"], "left_anti")
        judged = store(_confirmed(sets, store(pairs, "near-pairs"), settings), "near-judged")
        rounds.append(judged)
    links = rounds[0]
    for more in rounds[1:]:
        links = links.unionAll(more)
    return links.where("linked").select("a", "b")


def _with_failed(
    members: DataFrame, failed: DataFrame, rounds: list[DataFrame]
) -> DataFrame:
    """Members of the buckets that hold a failed pair, with what failed for each so far."""
    one = members.join(failed.select(F.col("a").alias("class"), "b"), "class")
    buckets = (
        one.select("bucket", F.col("b").alias("class"))
        .join(members, ["bucket", "class"], "left_semi")
        .select("bucket")
        .distinct()
    )
    ever = rounds[0]
    for more in rounds[1:]:
        ever = ever.unionAll(more)
    ever = ever.where("not linked")
    both = ever.select("a", "b").unionAll(ever.select(F.col("b"), F.col("a")))
    partners = both.groupBy(F.col("a").alias("class")).agg(
        F.collect_set("b").alias("failed")
    )
    return members.join(buckets, "bucket", "left_semi").join(partners, "class", "left")


def _buckets(classes: DataFrame, limit: int) -> tuple[DataFrame, DataFrame | None]:
    """(bucket, class) of buckets with two classes or more, one of equal ones, stored.

    Buckets beyond ``limit`` are dealt to blocks of about half of it, and each block meets
    the next; they are also given whole, with ``n`` members, if there are any.
    """
    bands = classes.select("class", F.explode("bands").alias("bucket"))
    sized = store(
        bands.groupBy("bucket")
        .agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("class").cast("decimal(38,0)")).alias("who"),
        )
        .where("n > 1")
        .groupBy("n", "who")
        .agg(F.min("bucket").alias("bucket"))
        .select("n", "bucket"),
        "near-buckets",
    )
    bands = _in_buckets(classes, sized)
    fit = bands.join(sized.where(f"n <= {limit}"), "bucket")
    fit = store(fit.select("bucket", "class"), "near-members")
    large = sized.where(f"n > {limit}")
    if large.isEmpty():
        return fit, None
    hot = store(bands.join(_small(large), "bucket"), "near-hot")
    blocks = _blocks("n", limit)
    at = _block(blocks)
    both = F.explode(F.array(at, F.pmod(at + 1, blocks)))
    ring = hot.select("bucket", "class", both.alias("at")).select(
        F.xxhash64("bucket", "at").alias("bucket"), "class"
    )
    return fit.unionByName(store(ring, "near-ring")), hot


#: Rows of a few numbers each that are broadcast at most.
MOST_BROADCAST = 100_000


def _small(table: DataFrame) -> DataFrame:
    """``table``, which is stored, to be broadcast if it has few rows. One row per bucket
    beyond the limit grows with the documents; then the join is a shuffle."""
    return F.broadcast(table) if table.count() <= MOST_BROADCAST else table


def _blocks(count: str, limit: int):
    """Number of blocks of about half of ``limit`` for ``count`` members."""
    return F.ceil(F.col(count) * 2 / F.lit(limit))


def _block(blocks):
    return F.pmod(F.xxhash64("class", "bucket"), blocks)


def _rest(hot: DataFrame, found: DataFrame, limit: int) -> DataFrame:
    """(bucket, class) of groups in which every two members of a bucket meet that need to.

    Those are the members outside the bucket's largest component in ``found``, each with
    all members; the largest one is connected already. Blocks of both meet, so that no
    group has many more than ``limit`` members, and a bucket in one component has none.
    """
    own = hot.select("bucket", "class").join(found, F.col("class") == F.col("id"), "left")
    own = own.select("bucket", "class", F.coalesce("component", "class").alias("component"))
    own = store(own, "near-hot")
    most = store(
        own.groupBy("bucket", "component")
        .agg(F.count("*").alias("n"))
        .groupBy("bucket")
        .agg(
            F.sum("n").alias("n"),
            F.max(F.struct("n", "component")).alias("most"),
        )
        .select(
            "bucket",
            "n",
            (F.col("n") - F.col("most.n")).alias("left"),
            F.col("most.component").alias("most"),
        )
        .where("left > 0"),
        "near-most",
    )
    own = own.join(_small(most), "bucket")
    # Blocks of all members down, blocks of the rest across.
    down, across = _blocks("n", limit), _blocks("left", limit)
    all_members = own.select(
        "bucket",
        "class",
        _block(down).alias("i"),
        F.explode(F.sequence(F.lit(0).cast("long"), across - 1)).alias("j"),
    )
    others = own.where("component <> most").select(
        "bucket",
        "class",
        F.explode(F.sequence(F.lit(0).cast("long"), down - 1)).alias("i"),
        _block(across).alias("j"),
    )
    groups = all_members.unionByName(others).select(
        F.xxhash64("bucket", "i", "j").alias("bucket"), "class"
    )
    return store(groups.distinct(), "near-rest")


def _in_buckets(classes: DataFrame, sized: DataFrame) -> DataFrame:
    """(class, bucket) of the bands that ``sized`` may have, by a bitmap of fixed size.

    Most bands are a class's own; they need no second shuffle. Bands are hashes, so their
    low bits serve as places.
    """
    bits = np.zeros(BITS // 32, dtype=np.uint32)
    words = (
        sized.select(F.pmod("bucket", F.lit(BITS)).alias("at"))
        .groupBy(F.shiftright("at", 5).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, int(at % 32)))").alias("bits"))
        .toPandas()
    )
    bits[words["word"].to_numpy(dtype=np.int64)] = words["bits"].to_numpy(dtype=np.int64)
    shared = classes.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("bands")
            bands = column.flatten().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), np.diff(column.offsets.to_numpy()))
            at = bands & (BITS - 1)
            hit = (shared.value[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(batch.column("class").to_numpy()[row[hit]]), pa.array(bands[hit])],
                names=["class", "bucket"],
            )

    return classes.select("class", "bands").mapInArrow(run, "class long, bucket long")


def _candidates(
    members: DataFrame, classes: DataFrame, settings: SketchSettings
) -> DataFrame:
    """(a, b) that the buckets propose; ``members`` may tell what failed."""
    tells = "failed" in members.columns
    rows = members.join(
        classes.select("class", "n_shingles", "sampled", "whole"), "class"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "bucket"):
            ids = group.column("class").to_numpy()
            bucket = Bucket(
                ids,
                group.column("n_shingles").to_numpy(),
                np.frombuffer(
                    b"".join(group.column("sampled").to_pylist()), dtype=U64
                ).reshape(len(ids), -1),
                group.column("whole").to_pylist(),
                settings,
            )
            failed = None
            if tells:
                failed = [set(x or ()) for x in group.column("failed").to_pylist()]
            if pairs := bucket.forest(failed):
                ends = ids[np.array(pairs)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ends.min(axis=1)), pa.array(ends.max(axis=1))],
                    names=["a", "b"],
                )

    return (
        rows.repartition("bucket")
        .sortWithinPartitions("bucket", "class")
        .mapInArrow(run, "a long, b long")
        .distinct()
    )


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of rows with one key from batches sorted by it."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        if kept and kept[-1].column(key)[0].as_py() != keys[0]:
            yield pa.Table.from_batches(kept)
            kept = []
        start = 0
        for cut in cuts:
            yield pa.Table.from_batches([*kept, batch.slice(start, cut - start)])
            kept, start = [], cut
        kept.append(batch.slice(start))
    if kept:
        yield pa.Table.from_batches(kept)


def _sets_of(
    documents: DataFrame, classes: DataFrame, families: DataFrame, settings: SketchSettings
) -> DataFrame:
    """(class, n_shingles, members, component) of every class in ``families``.

    One document of each class is read into a set; a bitmap of fixed size tells the scan
    which. Sets are moved once here, by row key: a class has one, so copies of its row are
    where the join puts them, and the family comes with the class.
    """
    wanted = store(
        classes.select("class", "row_key", "n_shingles")
        .join(families, F.col("class") == F.col("id"))
        .select("class", "row_key", "n_shingles", "component"),
        "near-wanted",
    )
    found = _sets(documents, bitmap(wanted, F.col("row_key")), settings)
    return (
        found.join(wanted, "row_key")
        .dropDuplicates(["row_key", "class"])
        .select("class", "n_shingles", "members", "component")
    )


def _confirmed(sets: DataFrame, pairs: DataFrame, settings: SketchSettings) -> DataFrame:
    """``pairs`` with whether their full sets are linked."""
    left = sets.toDF("a", "n_a", "of_a")
    right = sets.toDF("b", "n_b", "of_b")
    shared = F.size(F.array_intersect("of_a", "of_b"))
    linked = shared * 100 >= settings.percent * (F.col("n_a") + F.col("n_b") - shared)
    return pairs.join(right, "b").join(left, "a").select("a", "b", linked.alias("linked"))


def _sets(documents: DataFrame, wanted: np.ndarray, settings: SketchSettings) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(hits(shared.value, batch)))
            for low, high, data, offsets in slices(batch.column("text")):
                values, bounds = shingle_sets(data, offsets, settings.shingle)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row_key").slice(low, high - low),
                        pa.ListArray.from_arrays(
                            pa.array(bounds, pa.int32()), pa.array(values.view(np.int64))
                        ),
                    ],
                    names=["row_key", "members"],
                )

    keyed = documents.select("text", _row_key().alias("row_key"))
    return keyed.select("text", "row_key", *places(F.col("row_key"))).mapInArrow(
        run, "row_key long, members array<long>"
    )
