"""Exact nearest neighbours through a pivot index, and an approximate search by random projections.

Every training row lies in the cell of its nearest pivot, at a known distance from it. By the triangle inequality a query
is no nearer to any row of a cell than its own distance to the pivot lies outside the cell's range of distances, and no
nearer than half-way considerations between two pivots allow. So a query first visits the cells around it until they hold k rows,
and then only the cells that may hold a row nearer than the k-th one found.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabeval.operators.ranks import first_per_group
from tabeval.session import scratch_path

CELL_ROWS = 1_000  # rows a cell should hold; more where the pivots do not suffice
MAX_PIVOTS = 2_048  # they go to the driver and to every task
SAMPLE_PER_PIVOT = 4
REFINEMENTS = 4  # rounds that move pivots to the middle of their part of the sample
BLOCK_ROWS = 5_000  # rows of either side that meet in one task
VISIT_ROWS = 4_096  # rows of queries and cells that are written at a time
ROUNDING = 1e-6  # of the length of the vectors: what rounding may add to a distance taken from products


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """All distances between two sets of rows, by products."""
    squares = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2.0 * (x @ y.T)
    return np.sqrt(np.maximum(squares, 0.0))


def nearest_rows(queries: np.ndarray, points: np.ndarray, keys: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the positions and exact squared distances of its k nearest points, ties by key."""
    found = []
    norms = (points * points).sum(axis=1)
    for start in range(0, len(queries), 256):
        part = queries[start : start + 256]
        rough = (part * part).sum(axis=1)[:, None] + norms[None, :] - 2.0 * (part @ points.T)
        kth = np.partition(rough, min(k, len(points)) - 1, axis=1)[:, min(k, len(points)) - 1]
        # the fast distances carry rounding errors: keep whatever could be among the k nearest, then measure exactly
        slack = 1e-9 * (1.0 + np.abs(rough).max(axis=1))
        for row, query in enumerate(part):
            near = np.nonzero(rough[row] <= kth[row] + slack[row])[0]
            exact = ((points[near] - query) ** 2).sum(axis=1)
            order = np.lexsort((keys[near], exact))[:k]
            found.append((near[order], exact[order]))
    return found


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Pivots that cover a sample: each next one is the row farthest from those before, then all move to the middle of their rows."""
    count = min(count, len(sample))
    chosen = [0]
    gap = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < count:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    pivots = sample[chosen].copy()
    for _ in range(REFINEMENTS):
        cell = _distances(sample, pivots).argmin(axis=1)
        for c in np.unique(cell):
            pivots[c] = sample[cell == c].mean(axis=0)
    return pivots


@dataclass
class Pivots:
    """The pivots, and of each cell the number of its rows and the least and greatest distance to its pivot."""

    points: np.ndarray
    counts: np.ndarray
    nearest: np.ndarray
    farthest: np.ndarray

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distances to the pivots, and below which distance of a query no row of a cell can lie."""
        gap = _distances(queries, self.points)
        reach = np.sqrt((queries * queries).sum(axis=1) + (self.points * self.points).sum(axis=1).max())
        ring = np.maximum(gap - self.farthest[None, :], self.nearest[None, :] - gap)
        apart = _distances(self.points, self.points)[gap.argmin(axis=1)]
        # rows of a cell are nearer to its pivot than to the query's: they lie beyond the plane between the two
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = np.where(apart > 0, (gap**2 - gap.min(axis=1)[:, None] ** 2) / (2 * apart), 0.0)
        low = np.maximum(np.maximum(ring, plane), 0.0) - ROUNDING * reach[:, None]
        low[:, self.counts == 0] = np.inf
        return gap, low

    def first_cells(self, queries: np.ndarray, k: int) -> list[np.ndarray]:
        """The cells around each query, the nearest pivot first, until they hold k rows."""
        gap, _ = self.bounds(queries)
        gap[:, self.counts == 0] = np.inf
        order = np.argsort(gap, axis=1, kind="stable")
        enough = (np.cumsum(self.counts[order], axis=1) < k).sum(axis=1) + 1
        some = int((self.counts > 0).sum())
        return [row[: min(n, some)] for row, n in zip(order, enough)]

    def further_cells(self, queries: np.ndarray, limits: np.ndarray, k: int) -> list[np.ndarray]:
        """The other cells that may hold a row at a distance of at most ``limits``."""
        _, low = self.bounds(queries)
        return [np.setdiff1d(np.flatnonzero(bound <= limit), first) for bound, limit, first in zip(low, limits, self.first_cells(queries, k))]


@dataclass
class NeighbourIndex:
    """Training rows (neighbour, p, label, cell) as a written table, and the pivots of their cells."""

    rows: DataFrame
    pivots: Pivots
    block_rows: int = BLOCK_ROWS
    visits: list[DataFrame] | None = None  # (key, q, cell) of the last search: what was compared with what

    def search(self, test: DataFrame, key: str, features: str, k: int = 5) -> DataFrame:
        """(key, neighbour, distance, label) of the k nearest rows of every query, ties to the smaller neighbour.

        ``key`` identifies a query; queries without a vector find nothing.
        """
        spark = test.sparkSession
        queries = test.where(F.col(features).isNotNull()).select(F.col(key).alias("key"), F.col(features).cast("array<double>").alias("q"))
        kind = dict(queries.dtypes)["key"]
        if not self.pivots.counts.sum():
            return self._found(spark, kind).withColumnRenamed("key", key)
        first = self._write(self._visit(queries, k, None), "visits")
        self.visits = [first]
        best = self._compare(first, kind, k)
        if (self.pivots.counts > 0).sum() > 1:
            best = self._write(best, "nearest")
            reached = best.groupBy("key").agg(F.when(F.count(F.lit(1)) == k, F.max("distance")).alias("limit"))
            further = self._write(self._visit(queries.join(reached, "key", "left"), k, "limit"), "visits")
            self.visits.append(further)
            best = best.unionByName(self._compare(further, kind, k))
        return first_per_group(best, ["key"], [F.col("distance"), F.col("neighbour")], k).withColumnRenamed("key", key)

    def _write(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(df.sparkSession, name)
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def _schema(self, kind: str) -> str:
        kinds = dict(self.rows.dtypes)
        return f"key {kind}, neighbour {kinds['neighbour']}, distance double, label {kinds['label']}"

    def _found(self, spark, kind: str) -> DataFrame:
        return spark.createDataFrame([], self._schema(kind))

    def _visit(self, queries: DataFrame, k: int, limit: str | None) -> DataFrame:
        """A row for every query and cell it visits."""
        pivots = self.pivots

        def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for start in range(0, len(batch), 1024):
                    part = batch.iloc[start : start + 1024]
                    q = np.stack(part["q"].to_numpy()).astype(float)
                    found = pivots.first_cells(q, k) if limit is None else pivots.further_cells(q, part[limit].fillna(np.inf).to_numpy(dtype=float), k)
                    places = np.repeat(np.arange(len(part)), [len(f) for f in found])
                    visited = np.concatenate(found).astype("int32")
                    # a query may visit most cells, and every visit carries its vector
                    for first in range(0, len(places), VISIT_ROWS):
                        some = places[first : first + VISIT_ROWS]
                        yield pd.DataFrame({
                            "key": part["key"].to_numpy()[some], "q": part["q"].to_numpy()[some], "cell": visited[first : first + VISIT_ROWS],
                        })

        kind = dict(queries.dtypes)["key"]
        return queries.mapInPandas(cells, f"key {kind}, q array<double>, cell int")

    def _compare(self, visits: DataFrame, kind: str, k: int) -> DataFrame:
        """The k nearest of the rows of the visited cells, per query and task.

        A cell's rows are cut into slices and its queries into chunks of bounded size; only a cell with very many queries is copied.
        """
        asked = dict(visits.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect())  # at most a row per pivot
        slices = [max(1, math.ceil(n / self.block_rows)) for n in self.pivots.counts.tolist()]
        chunks = [math.ceil(asked.get(c, 0) / self.block_rows) for c in range(len(slices))]

        def per_cell(values: list[int]) -> Column:
            return F.get(F.array(*[F.lit(v) for v in values]), F.col("cell"))

        def every(n: Column) -> Column:
            return F.explode(F.sequence(F.lit(0), n - 1))

        def one(key: str, n: Column) -> Column:
            return F.pmod(F.xxhash64(key), n).cast("int")

        left = visits.withColumn("slice", every(per_cell(slices))).withColumn("chunk", one("key", per_cell(chunks)))
        right = self.rows.where(per_cell(chunks) > 0).withColumn("slice", one("neighbour", per_cell(slices)))
        right = right.withColumn("chunk", every(per_cell(chunks)))

        def compare(queries: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
            out = {"key": [], "neighbour": [], "distance": [], "label": []}
            if len(queries) and len(points):
                ids, labels = points["neighbour"].to_numpy(), points["label"].to_numpy()
                results = nearest_rows(np.stack(queries["q"].to_numpy()), np.stack(points["p"].to_numpy()), ids, k)
                for query, (near, distances) in zip(queries["key"], results):
                    out["key"] += [query] * len(near)
                    out["neighbour"] += list(ids[near])
                    out["distance"] += list(np.sqrt(distances))
                    out["label"] += list(labels[near])
            return pd.DataFrame(out)

        by = ["cell", "slice", "chunk"]
        return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(compare, self._schema(kind))


def build_index(
    train: DataFrame, key: str, features: str, label: str, cell_rows: int = CELL_ROWS, max_pivots: int = MAX_PIVOTS, block_rows: int = BLOCK_ROWS
) -> NeighbourIndex:
    """An index of the training rows that have a vector. Pivots come from a sample of bounded size, the rows with the smallest hashes of their keys."""
    rows = train.where(F.col(features).isNotNull()).select(
        F.col(key).alias("neighbour"), F.col(features).cast("array<double>").alias("p"), F.col(label).alias("label")
    )
    wanted = min(max_pivots, max(1, math.ceil(rows.count() / cell_rows)))
    drawn = rows.select("p", F.xxhash64("neighbour").alias("h")).orderBy("h", "p").limit(SAMPLE_PER_PIVOT * wanted).collect()
    sample = np.array([r["p"] for r in drawn], dtype=float)
    pivots = choose_pivots(sample, wanted) if len(sample) else np.zeros((0, 1))

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cell, gap = np.zeros(len(batch), dtype="int32"), np.zeros(len(batch))
            for start in range(0, len(batch), 1024):
                x = np.stack(batch["p"].iloc[start : start + 1024].to_numpy()).astype(float)
                part = _distances(x, pivots).argmin(axis=1)
                cell[start : start + 1024] = part
                gap[start : start + 1024] = np.sqrt(((x - pivots[part]) ** 2).sum(axis=1))
            yield batch.assign(cell=cell, gap=gap)

    kinds = dict(rows.dtypes)
    path = scratch_path(train.sparkSession, "cells")
    schema = f"neighbour {kinds['neighbour']}, p array<double>, label {kinds['label']}, cell int, gap double"
    rows.mapInPandas(placed, schema).write.parquet(path)
    cells = train.sparkSession.read.schema(schema).parquet(path)
    counts, near, far = np.zeros(len(pivots), dtype=np.int64), np.full(len(pivots), np.inf), np.zeros(len(pivots))
    for r in cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("gap").alias("low"), F.max("gap").alias("high")).collect():
        counts[r["cell"]], near[r["cell"]], far[r["cell"]] = r["n"], r["low"], r["high"]
    return NeighbourIndex(cells.drop("gap"), Pivots(pivots, counts, near, far), block_rows)


def nearest_neighbours(train: DataFrame, test: DataFrame, key: str, features: str, label: str, k: int = 5, block_rows: int = BLOCK_ROWS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """The exact k nearest training rows of every test row: (key, neighbour, distance, label)."""
    return build_index(train, key, features, label, cell_rows, block_rows=block_rows).search(test, key, features, k)


def votes(found: DataFrame, key: str) -> DataFrame:
    """The label most of a query's neighbours have, the smaller label on a tie, and its share of the votes."""
    counted = found.groupBy(key, "label").agg(F.count(F.lit(1)).alias("votes"))
    ballot = F.struct(F.col("votes"), (-F.col("label")).alias("minus"))
    return counted.groupBy(key).agg(F.max(ballot).alias("top"), F.sum("votes").alias("n")).select(
        key, (-F.col("top.minus")).alias("predicted"), (F.col("top.votes") / F.col("n")).alias("share")
    )


def knn_classify(train: DataFrame, test: DataFrame, key: str, features: str, label: str, k: int = 5, block_rows: int = BLOCK_ROWS) -> DataFrame:
    return votes(nearest_neighbours(train, test, key, features, label, k, block_rows), key)


def approximate_neighbours(
    train: DataFrame, test: DataFrame, key: str, features: str, label: str, k: int, radius: float, bucket_length: float, tables: int = 4, seed: int = 0
) -> DataFrame:
    """Up to k near rows within ``radius`` that share a bucket of some random projection with the query; some may be missed."""

    def vectors(df: DataFrame, *more: Column) -> DataFrame:
        return df.where(F.col(features).isNotNull()).select(F.col(key), *more, array_to_vector(F.col(features).cast("array<double>")).alias("vector"))

    hashing = BucketedRandomProjectionLSH(inputCol="vector", outputCol="hashes", bucketLength=bucket_length, numHashTables=tables, seed=seed)
    rows = vectors(train, F.col(label).alias("label"))
    pairs = hashing.fit(rows).approxSimilarityJoin(vectors(test), rows, radius, "distance")
    near = pairs.select(F.col(f"datasetA.{key}").alias(key), F.col(f"datasetB.{key}").alias("neighbour"), "distance", F.col("datasetB.label").alias("label"))
    return first_per_group(near, [key], [F.col("distance"), F.col("neighbour")], k)


class NeighboursModel(Model):
    """Class shares among the k nearest training rows, as probabilities."""

    def __init__(self, index: NeighbourIndex, k: int, classes: int):
        super().__init__()
        self.index, self.k, self.classes = index, k, classes

    def _transform(self, dataset: DataFrame) -> DataFrame:
        path = scratch_path(dataset.sparkSession, "queries")
        dataset.withColumn("_query", F.monotonically_increasing_id()).write.parquet(path)  # a query keeps its number
        rows = dataset.sparkSession.read.parquet(path)
        queries = rows.select("_query", vector_to_array("features").alias("_vector"))
        found = self.index.search(queries, "_query", "_vector", self.k)
        share = [F.count_if(F.col("label") == c) / F.count(F.lit(1)) for c in range(self.classes)]
        shares = found.groupBy("_query").agg(F.array(*share).alias("_shares"))
        top = (F.array_position("_shares", F.array_max("_shares")) - 1).cast("double")
        voted = shares.select("_query", array_to_vector("_shares").alias("rawPrediction"), array_to_vector("_shares").alias("probability"), top.alias("prediction"))
        return rows.join(voted, "_query").drop("_query")


class NeighboursClassifier(Estimator):
    """Nearest neighbours as an estimator over ``features`` and label codes ``y``, for pipelines and searches."""

    def __init__(self, k: int = 5, classes: int = 2, features: str = "features", label: str = "y"):
        super().__init__()
        self.k, self.classes, self.features, self.label = k, classes, features, label

    def _fit(self, dataset: DataFrame) -> NeighboursModel:
        path = scratch_path(dataset.sparkSession, "neighbours")
        rows = dataset.select(F.monotonically_increasing_id().alias("_row"), vector_to_array(self.features).alias("_vector"), F.col(self.label).cast("int").alias("_label"))
        rows.write.parquet(path)
        return NeighboursModel(build_index(dataset.sparkSession.read.parquet(path), "_row", "_vector", "_label"), self.k, self.classes)
