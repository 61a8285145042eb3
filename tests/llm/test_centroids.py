import hashlib
import math

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tabeval.llm import centroids

SCHEMA = "vec_id bigint, embedding array<float>, cluster string, v int, key int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "c", 1, 2) for i, v in rows], SCHEMA)


def brute(rows, size, k, rounds=10, seed=3, scale=1024):
    """The same by loops over whole numbers, as a bag of (key, cluster, distance, cluster inertia, inertia, centroid)."""
    kept = [
        (key, tuple(math.floor(scale * float(np.float32(x))) for x in v))
        for key, v in rows
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)
    ]
    middle = [list(v) for _, v in sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))[:k]]

    def place(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(middle))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(place(v)[1], []).append(v)
        for i, group in groups.items():
            middle[i] = [sum(column) // len(group) for column in zip(*group)]
    placed = [(key, *place(v)) for key, v in kept]
    spread = {}
    for _, distance, i in placed:
        spread[i] = spread.get(i, 0) + distance
    return sorted(((key, i, distance, spread[i], sum(spread.values()), tuple(middle[i])) for key, distance, i in placed), key=repr)


def clustered(df, **more):
    return sorted(((r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], tuple(r["centroid"])) for r in centroids.cluster(df, **more).collect()), key=repr)


def test_clusters_agree_with_loops_and_unusable_rows_go(spark):
    rng = np.random.default_rng(1)
    rows = [(i, list(rng.normal(size=4) + 3 * (i % 5))) for i in range(300)]
    rows += rows[:7] + [(None, [1.0, 2.0, 3.0, 4.0])]
    odd = [(900, None), (901, []), (902, [1.0, 2.0, 3.0]), (903, [1.0, None, 2.0, 3.0]), (904, [float("nan"), 1, 1, 1]), (905, [float("-inf"), 1, 1, 1])]
    assert clustered(frame(spark, rows + odd), size=4, k=8, rounds=10) == brute(rows + odd, 4, 8)


def test_ties_empty_clusters_and_few_rows(spark):
    twins = [(i, [1.0, -1.0]) for i in range(40)]  # all start centroids are equal: the first takes every row
    got = clustered(frame(spark, twins), size=2)
    assert got == brute(twins, 2, 8) and {r[1] for r in got} == {0}
    between = [(1, [0.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0])]
    for rounds in (0, 1, 10):
        assert clustered(frame(spark, between), size=2, k=2, rounds=rounds) == brute(between, 2, 2, rounds)
    assert clustered(frame(spark, between[:1]), size=2) == [(1, 0, 0, 0, 0, (0, 0))]
    none = centroids.cluster(frame(spark, [(1, None)]), size=2)
    assert none.collect() == [] and none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    assert centroids.cluster(frame(spark, []), size=2).collect() == []


def test_negative_means_are_floored(spark):
    rows = [(1, [-1 / 1024]), (2, [-2 / 1024])]
    got = clustered(frame(spark, rows), size=1, k=1)
    assert [r[5] for r in got] == [(-2,), (-2,)] and got == brute(rows, 1, 1)


def test_components_too_large_for_a_long_are_refused(spark):
    with pytest.raises(PySparkException, match="would not fit"):
        centroids.cluster(frame(spark, [(1, [3e38, 0.0])]), size=2)


def test_digest(spark):
    row = spark.range(1).select(centroids.digest(F.array(F.lit(-3), F.lit(0), F.lit(12)).cast("array<bigint>")).alias("d")).first()
    assert row["d"] == hashlib.sha256(b"-3,0,12").hexdigest()


def test_a_round_sends_one_row_of_sums_per_task_and_cluster(spark):
    vectors = frame(spark, [(i, [float(i), 1.0]) for i in range(50)]).select(F.col("vec_id").alias("key"), F.transform("embedding", lambda x: F.floor(x)).alias("v"))
    placed = vectors.select(centroids.nearest(F.col("v"), [[0, 0], [40, 0]])["cluster"].alias("cluster"), F.get("v", F.lit(0)).alias("a"))
    plan = placed.groupBy("cluster").agg(F.sum("a"))._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "Python" not in plan
