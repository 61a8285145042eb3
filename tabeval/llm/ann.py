"""Approximate nearest neighbours with a forest of random-projection trees.

Trees are fitted on a bounded sample: every inner node halves its points by the plane between two of them. All rows are
indexed by their leaf in every tree. A query walks all trees through one shared priority queue, always going on with
the branch with the least sum of squared heights over the planes that were crossed, until the leaves it has seen hold the wanted share
of the rows. Leaf rows are then compared exactly.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabeval.llm.frames import arrow_map, picked, written

TREES = 8
LEAF = 24  # sampled rows in a leaf, at most
SAMPLE = 20_000  # rows the trees are fitted on, at most
SHARE = 1.25  # rows a query looks at over all trees, repeats included, as a share of all rows
GROUP_ROWS = 16_384  # indexed rows compared in one group
GROUP_QUERIES = 20_000  # queries compared in one group, at most about
CELLS = 4_000_000  # numbers in one block of differences


@dataclass
class Tree:
    """Nodes in arrays: plane and offset, children (negative: minus one minus the leaf), share of rows per leaf."""

    planes: np.ndarray
    offsets: np.ndarray
    children: np.ndarray
    weights: np.ndarray

    def leaves(self, points: np.ndarray) -> np.ndarray:
        at = np.zeros(len(points), dtype=np.int64) if len(self.planes) else np.full(len(points), -1)
        while (moving := np.flatnonzero(at >= 0)).size:
            node = at[moving]
            side = np.einsum("ij,ij->i", points[moving], self.planes[node]) > self.offsets[node]
            at[moving] = self.children[node, side.astype(np.int64)]
        return -1 - at


def two_means(points: np.ndarray, rounds: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """Two centres, from the first two points on."""
    a, b = points[0], points[1]
    for _ in range(rounds):
        side = points @ (a - b) > (a @ a - b @ b) / 2
        if side.all() or not side.any():
            break
        a, b = points[side].mean(axis=0), points[~side].mean(axis=0)
    return a, b


def grow(points: np.ndarray, leaf: int, rng: np.random.Generator) -> Tree:
    planes, offsets, children, weights = [], [], [], []

    def split(rows: np.ndarray) -> int:
        for _ in range(8 if len(rows) > leaf else 0):
            a, b = two_means(points[rng.choice(rows, min(len(rows), 512), replace=False)])
            norm = np.linalg.norm(a - b)
            if norm == 0:
                continue
            plane = (a - b) / norm
            height = points[rows] @ plane
            cut = float(np.median(height))
            side = height > cut
            if side.any() and not side.all():
                node = len(planes)
                planes.append(plane)
                offsets.append(cut)
                children.append([0, 0])
                children[node] = [split(rows[~side]), split(rows[side])]
                return node
        weights.append(len(rows) / len(points))
        return -len(weights)

    split(np.arange(len(points)))
    size = points.shape[1]
    return Tree(np.array(planes).reshape(-1, size), np.array(offsets), np.array(children, dtype=np.int64).reshape(-1, 2), np.array(weights))


def search(trees: list[Tree], point: np.ndarray, share: float) -> list[tuple[int, int]]:
    """(tree, leaf) in the order of the shared queue until the leaves hold ``share`` of the rows."""
    queue = [(0.0, t, 0 if len(tree.planes) else -1) for t, tree in enumerate(trees)]
    heapq.heapify(queue)
    heights = [tree.planes @ point - tree.offsets for tree in trees]
    found, held = [], 0.0
    while queue and held < share:
        far, t, node = heapq.heappop(queue)
        tree = trees[t]
        while node >= 0:
            height = heights[t][node]
            near = int(height > 0)
            heapq.heappush(queue, (far + height * height, t, int(tree.children[node, 1 - near])))
            node = int(tree.children[node, near])
        found.append((t, -1 - node))
        held += tree.weights[-1 - node]
    return found


def usable_vectors(frame: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, v) of rows with a key and a vector that has numbers only, all finite, not all zero, and the commonest length."""
    rows = picked(frame, vec_id=key, v=vector).select("vec_id", F.col("v").cast("array<double>").alias("v"))
    fine = (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(fine)
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    # -0.0 and 0.0 are the same vector
    return rows.where(F.size("v") == (common["n"] if common else 0)).select("vec_id", F.transform("v", lambda x: x + F.lit(0.0)).alias("v"))


def _compare(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """For each query of a group its k nearest rows of the group, over the leaves that the query visits."""
    empty = pd.DataFrame({"query": [], "vid": [], "score": []}).astype({"query": "int64", "vid": "int64", "score": "float64"})
    if not len(queries) or not len(rows):
        return empty
    points = np.frombuffer(b"".join(rows["v"]), dtype=np.float64).reshape(len(rows), -1)
    targets = np.frombuffer(b"".join(queries["v"]), dtype=np.float64).reshape(len(queries), -1)
    vids, qids = rows["vid"].to_numpy(), queries["query"].to_numpy()
    by_leaf = rows.groupby(["tree", "leaf"]).indices
    parts = []
    for place, asked in queries.groupby(["tree", "leaf"]).indices.items():
        held = by_leaf.get(place)
        if held is None:
            continue
        held = held[np.argsort(vids[held], kind="stable")]
        step = max(1, CELLS // (len(held) * points.shape[1]))
        for at in range(0, len(asked), step):
            some = asked[at : at + step]
            gaps = np.sqrt(((targets[some][:, None, :] - points[held][None, :, :]) ** 2).sum(axis=2))
            near = np.argsort(gaps, axis=1, kind="stable")[:, :k]
            parts.append((np.repeat(qids[some], near.shape[1]), vids[held][near].ravel(), np.take_along_axis(gaps, near, axis=1).ravel()))
    if not parts:
        return empty
    found = pd.DataFrame(dict(zip(("query", "vid", "score"), (np.concatenate(c) for c in zip(*parts))))).drop_duplicates(["query", "vid"])
    return found.sort_values(["query", "score", "vid"]).groupby("query").head(k)


def nearest(frame: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 10, trees: int = TREES, share: float = SHARE, sample: int = SAMPLE, seed: int = 5) -> DataFrame:
    """The k nearest rows of ``frame`` for every row of ``queries``: (query_id, rank, vec_id, score).

    Score is the Euclidean distance in double precision; ties go to the smaller key; a query's own key is left out. Approximate: a row can
    be missed, what is returned is exact. Defined cases: null keys and vectors that are null, empty, zero or hold null or
    non-finite numbers take no part, nor do vectors of another length than the commonest; fewer than k candidates give
    all of them; equal vectors are searched and compared once, and of each only the k + 1 smallest keys can be among
    anyone's nearest; repeated rows count once; an empty table gives no rows.
    """
    spark = frame.sparkSession
    rows = usable_vectors(frame, key, vector).distinct()
    asked = usable_vectors(queries, key, vector).distinct()
    firsts = rows.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("r") <= k + 1)
    distinct = written(firsts.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).withColumn("vid", F.col("ids")[0]), "vectors")
    wanted = written(asked.groupBy("v").agg(F.min("vec_id").alias("query")), "queries")
    n, asked_n = distinct.count(), wanted.count()

    draw = F.pmod(F.xxhash64("vid", F.lit(seed)), F.lit(1 << 30))
    bound = int(min(1.0, 1.2 * sample / max(1, n)) * (1 << 30))
    seen = distinct.where(draw < bound).orderBy(draw, "vid").limit(sample).select("v").collect()  # bounded by ``sample``
    rng = np.random.default_rng(seed)
    points = np.array([r["v"] for r in seen], dtype=np.float64)
    shared = spark.sparkContext.broadcast([grow(points, LEAF, rng) for _ in range(trees)] if len(points) else [])

    def vectors(column: pa.Array) -> np.ndarray:
        return column.values.to_numpy().reshape(len(column), -1) if len(column) else np.zeros((0, 0))

    def place(batch: pa.RecordBatch) -> Iterator[dict]:
        held = vectors(batch.column("v").take(pa.array(range(len(batch)))))
        for t, tree in enumerate(shared.value if len(batch) else ()):
            yield {"tree": [t] * len(batch), "leaf": pa.array(tree.leaves(held)), "vid": batch.column("vid"), "v": [x.tobytes() for x in held]}

    def visit(batch: pa.RecordBatch) -> Iterator[dict]:
        held = vectors(batch.column("v").take(pa.array(range(len(batch)))))
        for query, point in zip(batch.column("query").to_pylist(), held):
            path = search(shared.value, point, share)
            yield {"tree": [t for t, _ in path], "leaf": [l for _, l in path], "query": [query] * len(path), "v": [point.tobytes()] * len(path)}

    subs = max(1, -(-n * LEAF // (max(1, len(points)) * GROUP_ROWS)))  # pieces of a leaf, where leaves are large
    chunks = max(1, -(-asked_n // GROUP_QUERIES))
    groups = max(8, -(-n * trees // GROUP_ROWS))
    group = F.pmod(F.xxhash64("tree", "leaf", "sub"), F.lit(groups)).alias("group")
    index = arrow_map(distinct.select("vid", "v"), place, "tree int, leaf bigint, vid bigint, v binary")
    index = index.withColumn("sub", F.pmod(F.xxhash64("vid"), F.lit(subs))).select("tree", "leaf", "vid", "v", group, F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)).cast("array<bigint>")).alias("chunk"))
    visits = arrow_map(wanted.select("query", "v"), visit, "tree int, leaf bigint, query bigint, v binary")
    visits = visits.withColumn("sub", F.explode(F.sequence(F.lit(0), F.lit(subs - 1)).cast("array<bigint>")))
    visits = visits.select("tree", "leaf", "query", "v", group, F.pmod(F.xxhash64("query"), F.lit(chunks)).alias("chunk")).distinct()
    pairs = visits.groupBy("group", "chunk").cogroup(index.groupBy("group", "chunk")).applyInPandas(lambda q, r: _compare(q, r, k + 1), "query bigint, vid bigint, score double")

    best = pairs.distinct().withColumn("r", F.row_number().over(Window.partitionBy("query").orderBy("score", "vid"))).where(F.col("r") <= k + 1)
    ids = best.join(distinct.select("vid", "ids"), "vid").select("query", "score", F.explode("ids").alias("vec_id"))
    near = ids.withColumn("r", F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id"))).where(F.col("r") <= k + 1).drop("r")
    owners = asked.join(wanted, "v").select(F.col("vec_id").alias("query_id"), "query")
    mine = owners.join(near, "query").where("query_id != vec_id")
    ranked = mine.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
