"""Every method on every dataset and split within every time budget, as a table of cells with their state.

A cell is a (dataset, method, split, budget_s). Cells run in waves; a wave is one job that writes the predictions and the state of its
cells together, so either all of it counts or none. What has ended is found by reading the table: a second call runs the
cells that are missing in it and no other.
"""

from __future__ import annotations

import json
import math
import random
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabeval.operators import metrics, models
from tabeval.operators.benchmark import result_table
from tabeval.operators.neighbours import nearest_rows
from tabeval.session import scratch_path

CELL = ["dataset", "method", "split", "budget_s"]
DONE, LATE, FAILED = "done", "late", "failed"  # a late cell has predictions, but took longer than its budget
WAVE_CELLS = 10_000
CV_FOLDS, MAX_EVALS = 5, 50

STATE_SCHEMA = "state string, message string, tried int, params string, time_s double, n_train bigint, n_test bigint"
PREDICTION_SCHEMA = "place bigint, y int, probs array<double>"


# ---- models that fit in one task ------------------------------------------------------------------------


def _one_hot_targets(y: np.ndarray, classes: int) -> np.ndarray:
    return np.eye(classes)[y]


def ridge(x: np.ndarray, y: np.ndarray, test: np.ndarray, classes: int, alpha: float = 1.0) -> np.ndarray:
    """Ridge regression on the one-hot labels, as probabilities."""
    mean, std = x.mean(axis=0), x.std(axis=0) + 1e-6
    a = np.hstack([(x - mean) / std, np.ones((len(x), 1))])
    w = np.linalg.solve(a.T @ a + alpha * np.eye(a.shape[1]), a.T @ _one_hot_targets(y, classes))
    scores = np.hstack([(test - mean) / std, np.ones((len(test), 1))]) @ w
    raised = np.exp(scores - scores.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def knn(x: np.ndarray, y: np.ndarray, test: np.ndarray, classes: int, n_neighbors: int = 5) -> np.ndarray:
    low, width = x.min(axis=0), np.ptp(x, axis=0)
    width[width == 0] = 1.0
    results = nearest_rows((test - low) / width, (x - low) / width, np.arange(len(x)), n_neighbors)
    return np.stack([_one_hot_targets(y[near], classes).mean(axis=0) for near, _ in results])


def prior(x: np.ndarray, y: np.ndarray, test: np.ndarray, classes: int) -> np.ndarray:
    return np.tile(_one_hot_targets(y, classes).mean(axis=0), (len(test), 1))


@dataclass
class SmallModel:
    """Probabilities of test rows from arrays, and where to search for parameters."""

    fit: Callable[..., np.ndarray]
    space: dict[str, Callable[[random.Random], object]] = field(default_factory=dict)


SMALL_MODELS = {
    "ridge": SmallModel(ridge, {"alpha": lambda r: r.choice([0.1, 1.0, 10.0])}),
    "knn": SmallModel(knn, {"n_neighbors": lambda r: r.randrange(1, 16)}),
    "prior": SmallModel(prior),
}


def _accuracy(model: SmallModel, params: dict, x: np.ndarray, y: np.ndarray, classes: int) -> float:
    """Cross-validated share of right answers; folds go by place."""
    folds = min(CV_FOLDS, len(x))
    part = np.arange(len(x)) % folds
    if folds < 2:
        return 0.0
    hits = [(model.fit(x[part != f], y[part != f], x[part == f], classes, **params).argmax(axis=1) == y[part == f]).sum() for f in range(folds)]
    return float(sum(hits)) / len(x)


def fit_in_budget(
    model: SmallModel, x: np.ndarray, y: np.ndarray, test: np.ndarray, classes: int, budget_s: float, seed: int = 0,
    max_evals: int = MAX_EVALS, clock: Callable[[], float] = time.monotonic,
) -> tuple[np.ndarray, dict, int]:
    """Probabilities, parameters and the number of sampled sets: the search stops when the budget is used up.

    The default parameters are kept unless a sampled set scores better.
    """
    started, rng = clock(), random.Random(seed)
    best: dict = {}
    tried = 0
    if model.space and budget_s > 0:
        top = _accuracy(model, {}, x, y, classes)
        while tried < max_evals and clock() - started < budget_s:
            params = {name: draw(rng) for name, draw in model.space.items()}
            score = _accuracy(model, params, x, y, classes)
            tried += 1
            if score > top:
                best, top = params, score
    return model.fit(x, y, test, classes, **best), best, tried


# ---- the table of cells ---------------------------------------------------------------------------------


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a table at ``path`` was written to its end: only then has its folder the success marker."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def _waves(spark: SparkSession, path: str) -> list[str]:
    """Folders of the waves that were written to their end."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    inside = [f"{path.rstrip('/')}/{entry.getPath().getName()}" for entry in system.listStatus(folder) if entry.getPath().getName().startswith("wave=")]
    return sorted(wave for wave in inside if finished(spark, wave))


@dataclass
class Sweep:
    """The written cells under ``path``; ``ran`` is the number of cells that the last call ran."""

    spark: SparkSession
    path: str
    key: str = "string"  # type of a dataset's name
    ran: int = 0

    def _read(self, kind: str) -> DataFrame:
        columns = f"dataset {self.key}, method string, split int, budget_s double"
        schema = f"{columns}, {PREDICTION_SCHEMA}, {STATE_SCHEMA}, wave string, kind string"
        waves = _waves(self.spark, self.path)
        rows = self.spark.read.schema(schema).option("basePath", self.path).parquet(*waves) if waves else self.spark.createDataFrame([], schema)
        return rows.where(F.col("kind") == kind)

    def cells(self) -> DataFrame:
        """(dataset, method, split, budget_s, state, message, tried, params, time_s, n_train, n_test)."""
        return self._read("cell").drop("wave", "kind", "place", "y", "probs")

    def predictions(self) -> DataFrame:
        """(dataset, method, split, budget_s, place, y, probs, time_s), to be scored by the metrics."""
        return self._read("prediction").select(*CELL, "place", "y", "probs", "time_s")

    def scores(self, names: Sequence[str]) -> DataFrame:
        """Long table (dataset, method, split, budget_s, metric, value)."""
        return metrics.evaluate(self.predictions(), names, CELL)

    def report(self, names: Sequence[str], budget_s: float, split: int) -> DataFrame:
        """The long result table of one budget and split: mean score, rank and wins of each method and metric."""
        here = (F.col("budget_s") == budget_s) & (F.col("split") == split)
        scores = self.scores(names).where(here)
        times = self.cells().where(here).select("dataset", "method", F.col("time_s").alias("value"))
        methods = sorted(r["method"] for r in times.select("method").distinct().collect())
        parts = {name: scores.where(F.col("metric") == name).select("dataset", "method", "value") for name in names}
        return result_table(parts, times, methods, budget_s, split)

    def open(self, wanted: DataFrame) -> DataFrame:
        """The wanted cells that are not in the table yet."""
        return wanted.join(self.cells().select(*CELL), CELL, "left_anti")

    def append(self, rows: DataFrame) -> None:
        """Write one wave: predictions and states together."""
        rows.write.partitionBy("kind").parquet(f"{self.path.rstrip('/')}/wave={uuid.uuid4().hex}")


def _options(values: Sequence, kind: str):
    return F.explode(F.array(*[F.lit(v).cast(kind) for v in values]))


def sweep_small(
    windows: DataFrame, dataset: str, path: str, methods: Sequence[str] | None = None, budgets: Sequence[float] = (1.0,), seed: int = 0, wave_cells: int = WAVE_CELLS
) -> Sweep:
    """Every method on the window of every dataset and split, within every budget.

    ``windows`` has features, y, split, place and part; a window is bounded (WINDOW_ROWS), so one task runs one
    cell. A method that fails on a dataset is noted with its message; it is not tried again.
    """
    spark = windows.sparkSession
    known = dict(SMALL_MODELS)  # what is registered now, also by the caller, goes along with the tasks
    methods = list(known) if methods is None else list(methods)
    kind = dict(windows.dtypes)[dataset]
    done = Sweep(spark, path, kind)
    rows = windows.select(F.col(dataset).alias("dataset"), F.col("split").cast("int").alias("split"), "place", "part", "features", "y")
    wanted = rows.select("dataset", "split").distinct().withColumn("method", _options(methods, "string")).withColumn("budget_s", _options(budgets, "double"))
    to_run = done.open(wanted).select(*CELL)
    kept = scratch_path(spark, "open-cells")
    to_run.write.parquet(kept)
    to_run = spark.read.schema(to_run.schema).parquet(kept)
    done.ran = to_run.count()
    waves = math.ceil(done.ran / wave_cells)
    schema = f"dataset {kind}, method string, split int, budget_s double, {PREDICTION_SCHEMA}, {STATE_SCHEMA}, kind string"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        train, test = pdf[pdf["part"] == "train"].sort_values("place"), pdf[pdf["part"] == "test"].sort_values("place")
        labels = {c: i for i, c in enumerate(sorted(pdf["y"].unique()))}
        cell = {c: pdf[c].iloc[0] for c in CELL}
        facts = {"n_train": len(train), "n_test": len(test)}
        started = time.monotonic()
        try:
            probs, params, tried = fit_in_budget(
                known[cell["method"]], np.stack(train["features"].to_numpy()).astype(float), train["y"].map(labels).to_numpy(),
                np.stack(test["features"].to_numpy()).astype(float), len(labels), cell["budget_s"], seed,
            )
        except Exception as error:  # a cell that fails is an outcome of the sweep
            message = f"{type(error).__name__}: {str(error)[:200]}"
            return _framed([cell | facts | {"kind": "cell", "state": FAILED, "message": message, "time_s": time.monotonic() - started}])
        seconds = time.monotonic() - started
        state = {"kind": "cell", "state": LATE if 0 < cell["budget_s"] < seconds else DONE, "tried": tried, "params": json.dumps(params, sort_keys=True), "time_s": seconds}
        told = [
            cell | {"kind": "prediction", "place": place, "y": labels[y], "probs": p.tolist(), "time_s": seconds}
            for place, y, p in zip(test["place"].tolist(), test["y"].tolist(), np.asarray(probs, dtype=float))
        ]
        return _framed([cell | facts | state, *told])

    names = [part.split()[0] for part in (*CELL, "place", "y", "probs", "state", "message", "tried", "params", "time_s", "n_train", "n_test", "kind")]

    def _framed(records: list[dict]) -> pd.DataFrame:
        return pd.DataFrame({name: pd.Series([r.get(name) for r in records], dtype=object) for name in names})

    number = F.pmod(F.xxhash64(*CELL), F.lit(max(waves, 1)))
    for wave in range(waves):
        part = rows.join(to_run.where(number == wave), ["dataset", "split"])
        done.append(part.groupBy(*CELL).applyInPandas(run, schema))
    return done


def sweep_large_cells(
    datasets: dict[str, tuple[DataFrame, DataFrame]], methods: dict[str, dict], numeric: Sequence[str], path: str, categorical: Sequence[str] = (),
    budgets: Sequence[float | None] = (None,), split: int = 1, max_evals: int = 1000,
) -> Sweep:
    """Every distributed model on every large dataset (train, test), within every budget.

    With a budget, parameters are searched at random until it is used up; without one (None, written as 0) the given parameters are fitted.
    A model is a job of its own and a wave of its own; one that fails is noted with its message.
    """
    spark = next(iter(datasets.values()))[0].sparkSession
    done = Sweep(spark, path)
    wanted = [(name, method, split, float(budget or 0.0)) for name in datasets for method in methods for budget in budgets]
    frame = spark.createDataFrame(wanted, "dataset string, method string, split int, budget_s double")
    missing = {tuple(r) for r in done.open(frame).select(*CELL).collect()}
    for cell in wanted:  # in the order of the call
        if cell not in missing:
            continue
        name, method, _, budget = cell
        train, test = datasets[name]
        started = time.monotonic()
        keys = {c: F.lit(v) for c, v in zip(CELL, cell)}
        state: dict = {"n_train": train.count(), "n_test": test.count(), "tried": 0, "params": json.dumps(methods[method], sort_keys=True, default=str)}
        predictions = None
        try:
            if budget and models.MODELS[method].space:
                score = MulticlassClassificationEvaluator(labelCol=models.LABEL, metricName="accuracy")
                found = models.random_search(method, train, numeric, score, categorical, budget_s=budget, max_evals=max_evals)
                scored = found.model.transform(test).select(*test.columns, "prediction", models.probabilities(found.model.transform(test)).alias("probs"))
                state |= {"tried": found.tried, "params": json.dumps(found.params, sort_keys=True)}
            else:
                scored = models.fit_predict(train, test, method, numeric, categorical, **methods[method])
            kept = scratch_path(spark, "scored")
            scored.select(F.col("y").cast("int").alias("y"), F.col("probs").cast("array<double>").alias("probs")).write.parquet(kept)
            seconds = time.monotonic() - started
            state |= {"state": LATE if budget and seconds > budget else DONE, "time_s": seconds}
            predictions = spark.read.parquet(kept).withColumns(keys | {"place": F.monotonically_increasing_id(), "time_s": F.lit(seconds), "kind": F.lit("prediction")})
        except Exception as error:  # a model that fails is an outcome of the sweep
            state |= {"state": FAILED, "message": f"{type(error).__name__}: {str(error)[:200]}", "time_s": time.monotonic() - started}
        row = spark.range(1).select(*[v.alias(c) for c, v in keys.items()], *[F.lit(state.get(n)).cast(k).alias(n) for n, k in _fields(STATE_SCHEMA)], F.lit("cell").alias("kind"))
        whole = row if predictions is None else row.unionByName(predictions, allowMissingColumns=True)
        for column, kind in _fields(PREDICTION_SCHEMA):
            if column not in whole.columns:
                whole = whole.withColumn(column, F.lit(None).cast(kind))
        done.append(whole)
        done.ran += 1
    return done


def _fields(schema: str) -> Iterator[tuple[str, str]]:
    for part in schema.split(", "):
        name, kind = part.split(" ", 1)
        yield name, kind


# ---- short forms ----------------------------------------------------------------------------------------


def sweep_windows(windows: DataFrame, dataset: str, methods: Sequence[str] | None = None, budgets: Sequence[float] = (0.0,)) -> DataFrame:
    """The predictions of a sweep of its own, with the dataset under its old name."""
    path = scratch_path(windows.sparkSession, "sweep")
    return sweep_small(windows, dataset, path, methods, budgets).predictions().withColumnRenamed("dataset", dataset)


def sweep_large(
    datasets: dict[str, tuple[DataFrame, DataFrame]], methods: dict[str, dict], numeric: Sequence[str], path: str, categorical: Sequence[str] = ()
) -> tuple[DataFrame | None, list[tuple[str, str, str]]]:
    """Predictions (y, probs, predicted, dataset, method, time_s) of the given models without a search, and what failed."""
    done = sweep_large_cells(datasets, methods, numeric, path, categorical)
    mine = F.col("dataset").isin(*datasets) & F.col("method").isin(*methods)
    failed = [tuple(r) for r in done.cells().where(mine & (F.col("state") == FAILED)).select("dataset", "method", "message").collect()]
    rows = done.predictions().where(mine)
    if rows.isEmpty():
        return None, failed
    return models.predict(rows).select("y", "probs", "predicted", "dataset", "method", "time_s"), failed
