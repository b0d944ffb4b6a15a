"""Near-duplicate vectors: small-world graphs by shard, verified links, components.

Vectors are dealt to shards of bounded size, each with its own graph. Every vector is a
query to every shard, in blocks; a shard's graph goes to as many tasks as there are
blocks. A query's beam widens while its last result is still a link. Each task audits its
beams twice and widens all of them until both audits pass: with queries made up to have
one link just at the bound, to rows drawn from the shard, so that there is something to
find also where links are few; and with some of its own queries, which are compared with
the whole shard. Queries for which the widest beam won't do, such as those
inside a large group of near copies, are compared with all rows of the shard instead.
Links are confirmed by the cosine in double precision.

Equal vectors are one row with a count, so a vector of any frequency is searched once.
Tasks send counts and stars of connected vectors, not links, of which a group of copies
has as many as its square.

Vectors that are null, empty, zero or hold null or non-finite components link with
nothing; so do vectors of different lengths. Repeated ids are rows of their own. A null
id is never the least of a component that has another. An empty table gives an empty
table. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.llm.components import components
from tickbars.llm.hnsw import Graph, GraphSettings
from tickbars.llm.tables import store


@dataclass(frozen=True)
class VectorSettings:
    """``shard``: rows of a graph at most, about. ``shards``: graphs at least.
    ``block``: queries of a task, about. ``audit``: made-up links of a task, and queries
    of it that are compared with the whole shard; ``recall`` of both kinds of links must
    be found. A vector is sent to every shard and a graph to every block, so both are as
    large as tasks allow."""

    cosine: float = 0.9
    shard: int = 32_768
    shards: int = 6
    block: int = 16_384
    beam: int = 16
    widest: int = 256
    audit: int = 96
    recall: float = 0.99
    graph: GraphSettings = GraphSettings(build_beam=48)


def vector_components(
    embeddings: DataFrame, settings: VectorSettings = VectorSettings()
) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    vectors = embeddings.select(
        "vec_id", F.col("embedding").cast("array<double>").alias("vector")
    )
    fit = (
        F.coalesce(F.size("vector") > 0, F.lit(False))
        & F.coalesce(
            F.forall(
                "vector",
                lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
            ),
            F.lit(False),
        )
        & F.coalesce(F.exists("vector", lambda x: x != 0), F.lit(False))
    )
    # -0.0 and 0.0 are one value; their bits must be, too.
    vectors = vectors.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    good = vectors.where(fit)
    classes = store(
        good.groupBy("vector")
        .agg(F.min("vec_id").alias("least"), F.count("*").alias("weight"))
        .withColumn("class", F.monotonically_increasing_id()),
        "vector-classes",
    )
    sent = store(_searched(classes, settings), "vector-links")
    joined = components(sent.where("links is null").select(F.col("class").alias("a"), "b"))
    counts = sent.where("links is not null").groupBy("class").agg(F.sum("links").alias("links"))
    grouped = (
        classes.join(joined, F.col("class") == F.col("id"), "left")
        .withColumn("component", F.coalesce("component", "class"))
        .select("class", "vector", "least", "weight", "component")
    )
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    known = grouped.join(least, "component").join(counts, "class", "left")
    linked = good.join(known.drop("class", "component", "least"), "vector").select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        "component_id",
    )
    alone = vectors.where(~fit).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )


def _searched(classes: DataFrame, settings: VectorSettings) -> DataFrame:
    """(class, links, b): links of the class in one shard, or a class ``b`` it is
    connected with there."""
    n = classes.count()
    shards = max(settings.shards, -(-n // settings.shard))
    blocks = max(1, -(-n // settings.block))
    place = F.xxhash64("class")
    rows = classes.select(
        "class",
        "weight",
        "vector",
        F.size("vector").alias("length"),
        F.pmod(place, F.lit(shards)).alias("shard"),
        F.pmod(F.xxhash64(F.lit(3), "class"), F.lit(blocks)).alias("block"),
    )
    graphs = store(
        rows.groupBy("length", "shard").applyInArrow(
            lambda table: _graph(table, settings),
            "length int, shard long, ids binary, weights binary, vectors binary, "
            "sizes array<int>, layers array<binary>",
        ),
        "vector-graphs",
    )
    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    indexed = graphs.withColumn("block", everywhere)
    # One row per graph; each has thousands of vectors.
    spots = graphs.select("length", F.col("shard").alias("to"))
    queries = (
        rows.select("length", "block", "class", "vector")
        .join(F.broadcast(spots) if shards <= 100_000 else spots, "length")
        .select("length", F.col("to").alias("shard"), "block", "class", "vector")
    )
    by = ("length", "shard", "block")
    return (
        indexed.groupBy(*by)
        .cogroup(queries.groupBy(*by))
        .applyInArrow(
            lambda graph, asked: _links(graph, asked, settings),
            "class long, links long, b long",
        )
    )


def _matrix(column: pa.ChunkedArray, length: int) -> np.ndarray:
    flat = pa.chunked_array([c.flatten() for c in column.chunks], pa.float64())
    rows = flat.to_numpy().reshape(-1, length)
    # Scaled first, so that the squares of very large or small components are finite.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _graph(table: pa.Table, settings: VectorSettings) -> pa.Table:
    """One row: the shard's vectors in hashed order and its graph's layers."""
    table = table.sort_by([("block", "ascending"), ("class", "ascending")])
    length = table["length"][0].as_py()
    vectors = _matrix(table["vector"], length)
    order = np.random.default_rng(len(vectors)).permutation(len(vectors))
    vectors = vectors[order]
    graph = Graph(vectors, settings.graph)
    return pa.table(
        {
            "length": pa.array([length], pa.int32()),
            "shard": table["shard"][:1],
            "ids": [table["class"].to_numpy()[order].tobytes()],
            "weights": [table["weight"].to_numpy()[order].tobytes()],
            "vectors": [vectors.tobytes()],
            "sizes": pa.array([graph.sizes], pa.list_(pa.int32())),
            "layers": [[x.tobytes() for x in graph.layers]],
        }
    )


def _links(graph: pa.Table, asked: pa.Table, settings: VectorSettings) -> pa.Table:
    empty = {"class": pa.array([], pa.int64())}
    if not graph.num_rows or not asked.num_rows:
        return pa.table({c: empty["class"] for c in ("class", "links", "b")})
    length = graph["length"][0].as_py()
    ids = np.frombuffer(graph["ids"][0].as_py(), dtype=np.int64)
    weights = np.frombuffer(graph["weights"][0].as_py(), dtype=np.int64)
    vectors = np.frombuffer(graph["vectors"][0].as_py(), dtype=np.float64).reshape(-1, length)
    sizes = graph["sizes"][0].as_py()
    index = Graph.restored(
        vectors,
        sizes,
        [
            np.frombuffer(x, dtype=np.int32).reshape(size, -1)
            for x, size in zip(graph["layers"][0].as_py(), sizes, strict=True)
        ],
        settings.graph,
    )
    queries = _matrix(asked["vector"], length)
    own = asked["class"].to_numpy()
    query, row = _found(index, vectors, queries, settings)
    other = own[query] != ids[row]
    query, row = query[other], row[other]
    links = np.bincount(query, weights[row], minlength=len(own)).astype(np.int64)
    a, b = stars(own[query], ids[row])
    some = np.flatnonzero(links)
    return pa.table(
        {
            "class": np.concatenate([own[some], a]),
            "links": pa.concat_arrays([pa.array(links[some]), pa.nulls(len(a), pa.int64())]),
            "b": pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(b)]),
        }
    )


def _found(
    index: Graph, vectors: np.ndarray, queries: np.ndarray, settings: VectorSettings
) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) of all links that the beams reach, the audit passed."""
    audited = np.arange(len(queries))[:: max(1, len(queries) // settings.audit)]
    true = _compared(index, vectors, queries, audited, settings)
    wanted = set(zip(*(x.tolist() for x in true), strict=True))
    beam = audited_beam(index, vectors, settings)
    while beam <= settings.widest:
        found = _widened(index, vectors, queries, beam, settings)
        have = set(zip(*(x.tolist() for x in found), strict=True)) & wanted
        if len(have) >= settings.recall * len(wanted):
            return found
        beam *= 2
    return _compared(index, vectors, queries, np.arange(len(queries)), settings)


def audited_beam(index: Graph, vectors: np.ndarray, settings: VectorSettings) -> int:
    """The least beam that finds made-up links; more than ``widest`` if none does.

    A link's query is a drawn row, turned away from it by the angle of the bound in a
    random direction. Where near copies of the row fill the beam, it counts as found: such
    a beam is widened anyway.
    """
    rng = np.random.default_rng(len(vectors))
    rows = rng.choice(len(vectors), min(settings.audit, len(vectors)), replace=False)
    own = vectors[rows]
    away = rng.normal(size=own.shape)
    away -= (away * own).sum(axis=1, keepdims=True) * own
    lengths = np.linalg.norm(away, axis=1, keepdims=True)
    # In one dimension there is no way to turn.
    away = np.divide(away, lengths, out=np.zeros_like(away), where=lengths > 1e-9)
    queries = settings.cosine * own + np.sqrt(1 - settings.cosine**2) * away
    beam = settings.beam
    while beam <= settings.widest:
        found, like = index.search(queries, beam)
        hit = (found == rows[:, None]).any(axis=1) | (like[:, -1] >= settings.cosine - 1e-5)
        if hit.mean() >= settings.recall:
            return beam
        beam *= 2
    return beam


def _widened(
    index: Graph, vectors: np.ndarray, queries: np.ndarray, beam: int, settings: VectorSettings
) -> tuple[np.ndarray, np.ndarray]:
    """Links of every query; a beam that holds nothing but links is widened."""
    low = settings.cosine - 1e-5
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    open_ = np.arange(len(queries))
    while len(open_) and beam <= settings.widest:
        wider = []
        # Beams of all sizes fill as much memory.
        step = max(16, settings.graph.block * settings.beam // beam)
        for start in range(0, len(open_), step):
            part = open_[start : start + step]
            rows, like = index.search(queries[part], beam)
            full = (like[:, -1] >= low) & (beam < len(vectors))
            wider.append(part[full])
            at, slot = np.nonzero((like >= low) & (rows >= 0) & ~full[:, None])
            pairs.append(
                _confirmed(vectors, queries, at, rows[at, slot], part, settings.cosine)
            )
        open_ = np.concatenate(wider)
        beam *= 4
    pairs.append(_compared(index, vectors, queries, open_, settings))
    return tuple(np.concatenate(x) for x in zip(*pairs, strict=True))


def _compared(
    index: Graph,
    vectors: np.ndarray,
    queries: np.ndarray,
    chosen: np.ndarray,
    settings: VectorSettings,
) -> tuple[np.ndarray, np.ndarray]:
    """Links of the ``chosen`` queries with all rows, in blocks of bounded size."""
    pairs = [(chosen[:0], chosen[:0])]
    for low in range(0, len(chosen), 256):
        part = chosen[low : low + 256]
        like = queries[part].astype(np.float32) @ index.vectors.T
        at, row = np.nonzero(like >= settings.cosine - 1e-5)
        pairs.append(_confirmed(vectors, queries, at, row, part, settings.cosine))
    return tuple(np.concatenate(x) for x in zip(*pairs, strict=True))


def _confirmed(
    vectors: np.ndarray,
    queries: np.ndarray,
    at: np.ndarray,
    rows: np.ndarray,
    part: np.ndarray,
    cosine: float,
) -> tuple[np.ndarray, np.ndarray]:
    keep = []
    for low in range(0, len(at), 65_536):
        q, r = part[at[low : low + 65_536]], rows[low : low + 65_536]
        keep.append(np.einsum("kd,kd->k", queries[q], vectors[r]) >= cosine)
    true = np.concatenate(keep) if keep else np.zeros(0, dtype=bool)
    return part[at[true]], rows[true]


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (x, least id of its group) for the groups that the links (a, b) connect."""
    names, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = place[: len(a)], place[len(a) :]
    label = np.arange(len(names))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(names)))
    return names[moved], names[label[moved]]
