"""Centroid clustering of integer vectors with JVM-native expressions only.

Centroids are a few short arrays and stand in the plan as literals. Distances are ``aggregate`` over ``zip_with``, the cluster is
the least struct of distance and number, and the new centroids come from sums of columns, which are added up map-side.
All numbers are whole, so every result is exact and independent of the order of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabeval.llm.frames import written

SCALE = 1024
LARGEST = 1 << 27  # of a whole component: 64 squared differences of such numbers still are a long


def whole_vectors(rows: DataFrame, key: str, vector: str, size: int, scale: int = SCALE) -> DataFrame:
    """(key, v): the usable vectors in whole numbers, floor(scale * x) of the component as a double."""
    given = rows.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").cast("array<double>").alias("x"))
    usable = (F.size("x") == size) & F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    too_large = F.exists("x", lambda x: F.abs(x) * scale >= LARGEST)
    refused = F.raise_error(F.lit(f"a component times {scale} is {LARGEST} or more: distances would not fit a long"))
    whole = F.when(too_large, refused.cast("array<bigint>")).otherwise(F.transform("x", lambda x: F.floor(x * scale)))
    return given.where(F.coalesce(usable, F.lit(False))).select("key", whole.alias("v"))


def starts(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The vectors with the k smallest hashes of ``seed:key``; of repeated keys the smaller vector, null keys last."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")), 256)
    return [r["v"] for r in vectors.select(hashed.alias("h"), "v").orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()]


def literal(values: Sequence[int]) -> Column:
    """An array of whole numbers as one literal; as text it is one call to the JVM however long it is."""
    return F.expr(f"array({', '.join(f'{x}L' for x in values)})")


def nearest(v: Column, centroids: Sequence[Sequence[int]]) -> Column:
    """(distance, cluster): squared Euclidean distance to the nearest centroid, ties to the smaller number."""
    options = []
    for number, centroid in enumerate(centroids):
        squares = F.zip_with(v, literal(centroid), lambda a, b: (a - b) * (a - b))
        distance = F.aggregate(squares, F.lit(0).cast("bigint"), lambda total, x: total + x)
        options.append(F.struct(distance.alias("distance"), F.lit(number).alias("cluster")))
    return F.array_min(F.array(*options))


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Every centroid that has vectors becomes the floor of their mean in each component; the others stay."""
    size = len(centroids[0])
    placed = vectors.select(nearest(F.col("v"), centroids)["cluster"].alias("cluster"), "v")
    sums = placed.groupBy("cluster").agg(F.expr("count(1) AS n"), *[F.expr(f"sum(get(v, {j})) AS v{j}") for j in range(size)])
    out = [list(c) for c in centroids]
    for row in sums.collect():  # one row a centroid
        out[row["cluster"]] = [row[f"v{j}"] // row["n"] for j in range(size)]
    return out


def cluster(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", size: int = 64, k: int = 8, rounds: int = 10, seed: int = 3, scale: int = SCALE) -> DataFrame:
    """(key, cluster, distance, cluster_inertia, inertia, centroid), one row per usable vector.

    The whole vectors are written once and read in every round; a round sends one row of sums per task and cluster.

    Defined cases: vectors that are null, have another number of components or hold null or non-finite ones give no row; repeated
    rows count as often as they occur; null keys are clustered but start a cluster only if there are too few others; fewer than k
    vectors start fewer clusters, none give no rows; a cluster that loses all its vectors keeps its centroid.
    A component of 2^27 or more after scaling is refused with an error, as is a sum beyond a long. Other columns
    are not looked at.
    """
    vectors = written(whole_vectors(rows, key, vector, size, scale), "vectors")
    kind = dict(rows.dtypes)[key]
    centroids = starts(vectors, k, seed)
    if not centroids:
        return rows.sparkSession.createDataFrame([], f"`{key}` {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    for _ in range(rounds):
        before, centroids = centroids, moved(vectors, centroids)
        if centroids == before:  # nothing moves any more
            break
    near = nearest(F.col("v"), centroids)
    placed = written(vectors.select("key", near.alias("near")).select("key", "near.cluster", "near.distance"), "placed")
    spread = {r["cluster"]: r["inertia"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}

    def of_cluster(values: Sequence, column: str = "cluster") -> Column:
        return F.get(F.array(*values), F.col(column))

    each = of_cluster([F.lit(spread.get(i)).cast("bigint") for i in range(len(centroids))])
    centre = of_cluster([literal(c) for c in centroids])
    return placed.select(
        F.col("key").alias(key), "cluster", "distance", each.alias("cluster_inertia"),
        F.lit(sum(spread.values())).cast("bigint").alias("inertia"), centre.alias("centroid"),
    )


def digest(centroid: Column) -> Column:
    """SHA-256 of the components as decimal integers joined by commas."""
    return F.sha2(F.array_join(centroid.cast("array<string>"), ","), 256)
