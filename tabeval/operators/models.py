"""Training, tuning and applying models as Spark jobs. Neighbours are in ``neighbours``, sweeps in ``sweep``."""

from __future__ import annotations

import math
import random
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from inspect import signature

from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml import classification as mlc
from pyspark.ml import regression as mlr
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator
from pyspark.ml.feature import Imputer, MinMaxScaler, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabeval.functions.probs import argmax, softmax
from tabeval.operators import logit
from tabeval.operators.neighbours import NeighboursClassifier
from tabeval.operators.preprocess import unshift_outputs
from tabeval.operators.trees import Binned
from tabeval.session import scratch_path

FEATURES, LABEL = "features", "y"


@dataclass
class ModelSpec:
    """An estimator by name: how to build it, what to do with its inputs, and where to search."""

    build: Callable[..., Estimator]
    impute: bool = True
    one_hot: bool = True
    scale: bool = True
    space: dict[str, Callable[[random.Random], object]] = field(default_factory=dict)


def _penalty(penalty: str | None, c: float, n_rows: int) -> dict[str, float]:
    """A penalty name and an inverse strength C as MLlib's mixing and regularization."""
    return {
        "regParam": 0.0 if penalty in (None, "none") else 1.0 / (c * max(n_rows, 1)),
        "elasticNetParam": 1.0 if penalty == "l1" else 0.0,
    }


def logistic(n_rows: int = 1, penalty: str = "l2", C: float = 1.0, max_iter: int = 100, fit_intercept: bool = True) -> Estimator:
    return mlc.LogisticRegression(
        featuresCol=FEATURES, labelCol=LABEL, maxIter=max_iter, fitIntercept=fit_intercept, tol=1e-4,
        **_penalty(penalty, C, n_rows),
    )


def random_forest(n_rows: int = 1, n_estimators: int = 100, max_depth: int = 10, min_samples_split: int = 2, max_features: str = "sqrt", seed: int = 0) -> Estimator:
    return Binned(mlc.RandomForestClassifier(
        featuresCol=FEATURES, labelCol=LABEL, numTrees=n_estimators, maxDepth=min(max_depth, 30),
        minInstancesPerNode=max(1, min_samples_split // 2), featureSubsetStrategy=max_features, seed=seed,
    ), FEATURES, LABEL)


def gradient_boosting(n_rows: int = 1, n_estimators: int = 100, max_depth: int = 1, learning_rate: float = 1.0, classes: int = 2) -> Estimator:
    boosted = mlc.GBTClassifier(
        featuresCol=FEATURES, labelCol=LABEL, maxIter=n_estimators, maxDepth=max_depth, stepSize=learning_rate, seed=0
    )
    return Binned(boosted if classes <= 2 else mlc.OneVsRest(classifier=boosted, featuresCol=FEATURES, labelCol=LABEL), FEATURES, LABEL)


def linear_svm(n_rows: int = 1, C: float = 1.0, max_iter: int = 100, classes: int = 2) -> Estimator:
    machine = mlc.LinearSVC(featuresCol=FEATURES, labelCol=LABEL, maxIter=max_iter, regParam=1.0 / (C * max(n_rows, 1)))
    return machine if classes <= 2 else mlc.OneVsRest(classifier=machine, featuresCol=FEATURES, labelCol=LABEL)


def ridge(n_rows: int = 1, label_std: float = 1.0, alpha: float = 1.0, fit_intercept: bool = True) -> Estimator:
    """Least squares with the squared norm of the weights, times alpha, added to the squared errors.

    MLlib averages the errors over the rows and divides the penalty by the label's deviation.
    """
    return mlr.LinearRegression(
        featuresCol=FEATURES, labelCol=LABEL, regParam=alpha * label_std / max(n_rows, 1), elasticNetParam=0.0,
        fitIntercept=fit_intercept, standardization=False, solver="normal",
    )


def perceptron(n_rows: int = 1, layers: Sequence[int] = (10, 16, 2), max_iter: int = 100) -> Estimator:
    return mlc.MultilayerPerceptronClassifier(featuresCol=FEATURES, labelCol=LABEL, layers=list(layers), maxIter=max_iter, seed=0)


def neighbours(n_rows: int = 1, n_neighbors: int = 5, classes: int = 2) -> Estimator:
    return NeighboursClassifier(k=n_neighbors, classes=classes, features=FEATURES, label=LABEL)


def _log_uniform(low: float, high: float) -> Callable[[random.Random], float]:
    return lambda r: math.exp(r.uniform(low, high))


# name -> model; the search ranges are fixed values, users may add models of their own
MODELS: dict[str, ModelSpec] = {
    "logistic": ModelSpec(
        logistic,
        space={
            "penalty": lambda r: r.choice(["l1", "l2", "none"]),
            "max_iter": lambda r: r.randrange(50, 500),
            "fit_intercept": lambda r: r.choice([True, False]),
            "C": _log_uniform(-5, math.log(5.0)),
        },
    ),
    "random_forest": ModelSpec(
        random_forest, one_hot=False, scale=False,
        space={
            "n_estimators": lambda r: r.randrange(20, 200),
            "max_features": lambda r: r.choice(["auto", "sqrt"]),
            "max_depth": lambda r: r.randrange(1, 45),
            "min_samples_split": lambda r: r.choice([5, 10]),
        },
    ),
    "gradient_boosting": ModelSpec(gradient_boosting),
    "svm": ModelSpec(linear_svm, space={"C": lambda r: r.choice([0.1, 1, 10, 100])}),
    "ridge": ModelSpec(ridge, space={"alpha": lambda r: r.choice([0.1, 1.0, 10.0]), "fit_intercept": lambda r: r.choice([True, False])}),
    "perceptron": ModelSpec(perceptron),
    "neighbours": ModelSpec(neighbours, space={"n_neighbors": lambda r: r.randrange(1, 16)}),
}


def preparation(numeric: Sequence[str], categorical: Sequence[str], spec: ModelSpec) -> list:
    """Pipeline stages in front of a model: mean imputation, one-hot with unknowns kept apart, min-max scaling."""
    stages: list = []
    inputs = list(numeric)
    if spec.impute and numeric:
        inputs = [f"{c}_filled" for c in numeric]
        stages.append(Imputer(inputCols=list(numeric), outputCols=inputs, strategy="mean"))
    for c in categorical:
        stages.append(StringIndexer(inputCol=c, outputCol=f"{c}_index", handleInvalid="keep"))
        if spec.one_hot:
            stages.append(OneHotEncoder(inputCol=f"{c}_index", outputCol=f"{c}_hot", handleInvalid="keep"))
        inputs.append(f"{c}_hot" if spec.one_hot else f"{c}_index")
    raw = "assembled" if spec.scale else FEATURES
    stages.append(VectorAssembler(inputCols=inputs, outputCol=raw, handleInvalid="keep"))
    if spec.scale:
        stages.append(MinMaxScaler(inputCol=raw, outputCol=FEATURES))
    return stages


def train_facts(train: DataFrame, label: str = LABEL, classes: bool = False) -> dict[str, float]:
    """What models ask for: the number of training rows, the deviation of the label and, where the label is a code, how many
    ``classes`` the codes stand for."""
    row = train.agg(F.count(F.lit(1)).alias("n_rows"), F.stddev_pop(label).alias("label_std"), F.max(label).alias("top")).first()
    facts = {"n_rows": row["n_rows"], "label_std": row["label_std"] or 1.0}
    return facts | ({"classes": max(2, int(row["top"] or 0) + 1)} if classes else {})


def _asks_for_classes(name: str) -> bool:
    return "classes" in signature(MODELS[name].build).parameters


def pipeline(name: str, numeric: Sequence[str], categorical: Sequence[str] = (), facts: dict | None = None, **params) -> Pipeline:
    """Preparation and model; ``facts`` are passed on as far as the model asks for them."""
    spec = MODELS[name]
    asked = {k: v for k, v in (facts or {}).items() if k in signature(spec.build).parameters}
    return Pipeline(stages=[*preparation(numeric, categorical, spec), spec.build(**{**asked, **params})])


def probabilities(scored: DataFrame) -> Column:
    """Class probabilities of a scored table; margins and votes without probabilities become a softmax of the scores."""
    if "probability" in scored.columns:
        return vector_to_array("probability")
    return softmax(vector_to_array("rawPrediction"))


def fit_predict(train: DataFrame, test: DataFrame, name: str, numeric: Sequence[str], categorical: Sequence[str] = (), **params) -> DataFrame:
    """Test rows with ``probs`` and the predicted class."""
    fitted = pipeline(name, numeric, categorical, train_facts(train, classes=_asks_for_classes(name)), **params).fit(train)
    scored = fitted.transform(test)
    return scored.select(*test.columns, probabilities(scored).alias("probs"), F.col("prediction").cast("int").alias("predicted"))


def ridge_classify(train: DataFrame, test: DataFrame, numeric: Sequence[str], label: str = LABEL, alpha: float = 1.0) -> DataFrame:
    """Binary ridge classifier: regression on -1 / 1, decided by the sign."""
    signed = train.withColumn(LABEL, F.col(label) * 2.0 - 1.0)
    scored = pipeline("ridge", numeric, (), train_facts(signed), alpha=alpha).fit(signed).transform(test)
    decision = F.col("prediction")
    return scored.select(*test.columns, decision.alias("decision"), (decision > 0).cast("int").alias("predicted"))


@dataclass
class SearchResult:
    model: Model
    params: dict
    default_score: float
    best_score: float
    tried: int
    fit_seconds: float
    scores: list[tuple[dict, float | None]] = field(default_factory=list)  # every set with its score, the default one first


def _with_folds(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], folds: int, seed: int = 0, fold_column: str = ""
) -> DataFrame:
    number = F.col(fold_column) if fold_column else F.pmod(F.xxhash64(*numeric, *categorical, LABEL, F.lit(seed)), F.lit(folds))
    return train.select(*numeric, *categorical, LABEL, number.cast("int").alias("_fold"))


def prepared_folds(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], spec: ModelSpec, folds: int, seed: int = 0, fold_column: str = ""
) -> list[tuple[DataFrame, DataFrame]]:
    """For each fold the other rows and its own, prepared by what was fitted on the other rows; written once."""
    rows = _with_folds(train, numeric, categorical, folds, seed, fold_column)
    path = scratch_path(train.sparkSession, "folds")

    def prepare(fold: int) -> tuple[DataFrame, DataFrame]:
        fitted = Pipeline(stages=preparation(numeric, categorical, spec)).fit(rows.where(F.col("_fold") != fold))
        fitted.transform(rows).select(FEATURES, LABEL, (F.col("_fold") == fold).alias("held_out")).write.parquet(f"{path}/{fold}")
        ready = train.sparkSession.read.parquet(f"{path}/{fold}")
        return ready.where("not held_out"), ready.where("held_out")

    return [prepare(fold) for fold in range(folds)]


def _side_by_side(data: logit.Table, spec: ModelSpec, asked: dict, batch: Sequence[dict], folds: int, evaluator: Evaluator) -> list[float | None]:
    """The score of each set, a mean over the folds; all are fitted in the same passes over the rows."""
    settings: dict[int, Estimator] = {}
    for i, params in enumerate(batch):
        try:
            settings[i] = spec.build(**{**asked, **params})
        except Exception:
            continue
    fits = logit.fit_all(data, [(fold, setting) for setting in settings.values() for fold in range(folds)])
    if type(evaluator) is BinaryClassificationEvaluator and evaluator.getMetricName() == "areaUnderROC" and not evaluator.isSet("weightCol"):
        values = logit.areas(data, fits)
    else:
        values = [evaluator.evaluate(logit.LogitModel(data, fit).transform(data.rows.where(F.col("_fold") == fit.fold))) for fit in fits]
    scores: list[float | None] = [None] * len(batch)
    for place, i in enumerate(settings):
        own = values[place * folds : (place + 1) * folds]
        scores[i] = None if None in own else sum(own) / folds
    return scores


def random_search(
    name: str, train: DataFrame, numeric: Sequence[str], evaluator: Evaluator, categorical: Sequence[str] = (),
    budget_s: float = 60.0, max_evals: int = 1000, folds: int = 5, seed: int = 0, parallelism: int = 4, fold_column: str = "",
) -> SearchResult:
    """Random hyper-parameters under a time budget, scored by cross-validation.

    The default parameters are kept unless a sampled set scores better; the winner is fitted once more on
    all training rows. Inputs are prepared once per fold; a set refits the model alone. ``parallelism`` fits go side by side,
    and the clock is checked between batches. A set that cannot be fitted does not count. Logistic regressions of two classes on few
    inputs are fitted together: every pass over the rows serves all folds and the sets of a batch (``logit``).
    """
    rng = random.Random(seed)
    started = time.monotonic()
    spec, facts = MODELS[name], train_facts(train, classes=_asks_for_classes(name))
    asked = {k: v for k, v in facts.items() if k in signature(spec.build).parameters}
    data = None
    if spec.build is logistic:
        data = logit.table(_with_folds(train, numeric, categorical, folds, seed, fold_column), numeric, categorical, folds)
    parts = prepared_folds(train, numeric, categorical, spec, folds, seed, fold_column) if data is None else []

    def score(params: dict) -> float | None:
        try:
            return sum(evaluator.evaluate(spec.build(**{**asked, **params}).fit(rows).transform(held)) for rows, held in parts) / folds
        except Exception:
            return None

    def scores(batch: list[dict]) -> list[float | None]:
        return list(pool.map(score, batch)) if data is None else _side_by_side(data, spec, asked, batch, folds, evaluator)

    def sample(count: int) -> list[dict]:
        return [{key: draw(rng) for key, draw in spec.space.items()} for _ in range(count)]

    sampled = max_evals if spec.space else 0
    with ThreadPoolExecutor(parallelism) as pool:
        batch = [{}, *sample(min(parallelism - 1, sampled))]
        tried = len(batch) - 1
        found = list(zip(batch, scores(batch)))
        while tried < sampled and time.monotonic() - started < budget_s:
            batch = sample(min(parallelism, sampled - tried))
            tried += len(batch)
            found += zip(batch, scores(batch))
    scored = [(params, value) for params, value in found if value is not None]
    if not scored:
        raise ValueError(f"{name} cannot be fitted with any parameters")
    sign = 1.0 if evaluator.isLargerBetter() else -1.0
    best_params, best = max(scored, key=lambda x: sign * x[1])  # the first of equals, so the default stays on a tie
    fit_started = time.monotonic()
    if data is None:
        model = pipeline(name, numeric, categorical, facts, **best_params).fit(train)
    else:
        model = logit.LogitModel(data, logit.fit_all(data, [(logit.NO_FOLD, spec.build(**{**asked, **best_params}))])[0])
    default = found[0][1] if found[0][1] is not None else float("nan")
    return SearchResult(model, best_params, default, best, tried, time.monotonic() - fit_started, found)


# ---- ensembles ----------------------------------------------------------------------------------------

TEMPERATURE = 0.8  # fixed value


def ensemble(members: DataFrame, key: str, scores: str, shift: str, classes: int, temperature: float = TEMPERATURE, average_logits: bool = True) -> DataFrame:
    """Class probabilities of an ensemble: turn every member's scores back to the common class order, average
    them (or their softmax), and end with probabilities."""
    logits = F.transform(unshift_outputs(F.col(scores), F.col(shift)), lambda x: x / F.lit(float(temperature)))
    each = logits if average_logits else softmax(logits)
    rows = members.select(key, each.alias("_s"))
    means = rows.groupBy(key).agg(*[F.avg(F.get("_s", F.lit(i))).alias(f"_{i}") for i in range(classes)])
    mean = F.array(*[F.col(f"_{i}") for i in range(classes)])
    return means.select(key, (softmax(mean) if average_logits else mean).alias("probs"))


def predict(df: DataFrame, probs: str = "probs", classes: Sequence | None = None) -> DataFrame:
    """The most probable class and its probability; ``classes`` maps positions to labels."""
    place = argmax(F.col(probs))
    winner = place if classes is None else F.get(F.array(*[F.lit(c) for c in classes]), place)
    return df.withColumns({"predicted": winner, "winning_probability": F.array_max(probs)})
