"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.llm.tables import store


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b): the least id it reaches.

    Each round hooks the larger neighbours of every node to its least neighbour, then the
    smaller ones. A star's hub aggregates in the map tasks, so it fills none. Every round
    is a written table; a lost executor costs a round at most.
    """
    edges = store(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v")
        .distinct(),
        "component-links",
    )
    before = None
    while True:
        edges = store(_small_star(_large_star(edges)), "component-links")
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == before or not now[0]:
            break
        before = now
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(
        roots
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.where("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where("u <> v")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return (
        down.join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionAll(least.select("u", F.col("m").alias("v")))
        .where("u <> v")
        .distinct()
    )
