"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabeval.llm.frames import written


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a vertex is tied to the least of the vertex and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A vertex and its smaller neighbours are tied to the least of them. Edges point from larger to smaller."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest vertex reachable, for every vertex of the (hub, node) links.

    Each round is a few joins on vertices and writes its edges to the shared folder; about log n rounds are needed.
    Minima are taken before the shuffle, so a vertex of high degree costs one row per task.
    """
    edges = links.select(F.greatest("hub", "node").alias("u"), F.least("hub", "node").alias("v")).where("u != v").distinct()
    edges = written(edges, "edges")
    mark = _mark(edges)
    while mark[0]:
        edges = written(_small_star(written(_large_star(edges), "large")), "small")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
