"""L2, L3: forests and boosted trees fitted on counted bins.

MLlib's trees see an input only as one of ``maxBins`` bins, so rows with equal bins and label are one row with a weight. The bins are cut
once over all rows, the rows are counted per combination of bins, and the rounds and levels of a fit run over the combinations, whose number the
bins bound, instead of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from math import exp, factorial

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabeval.functions.probs import argmax
from tabeval.session import scratch_path

MAX_BINS = 32  # MLlib's default
LEAST_SAVING = 2  # rows a combination must stand for on average; else the rows themselves are fitted
SIDE_BY_SIDE = 4  # trees of a forest that are fitted at a time
BINNED = "_binned"


class Bins:
    """Where each continuous input is cut; categories stay as they are."""

    def __init__(self, cuts: dict[int, list[float]], nominal: dict[int, dict], width: int):
        self.cuts, self.nominal, self.width = cuts, nominal, width

    def put(self, df: DataFrame) -> DataFrame:
        """Columns ``_f0`` ... become numbers of bins ``_b0`` ... ."""
        edges = [[-float("inf"), *self.cuts[i], float("inf")] for i in self.cuts]
        cut = Bucketizer(splitsArray=edges, inputCols=[f"_f{i}" for i in self.cuts], outputCols=[f"_b{i}" for i in self.cuts], handleInvalid="keep")
        out = cut.transform(df) if self.cuts else df
        return out.withColumns({f"_b{i}": F.col(f"_f{i}") for i in self.nominal}).drop(*[f"_f{i}" for i in range(self.width)])

    def assemble(self, df: DataFrame) -> DataFrame:
        named = df.withColumns({f"_b{i}": F.col(f"_b{i}").alias(f"_b{i}", metadata={"ml_attr": self._attribute(i)}) for i in range(self.width)})
        return VectorAssembler(inputCols=[f"_b{i}" for i in range(self.width)], outputCol=BINNED, handleInvalid="keep").transform(named).drop(*[f"_b{i}" for i in range(self.width)])

    def _attribute(self, i: int) -> dict:
        return {k: v for k, v in self.nominal[i].items() if k != "idx"} if i in self.nominal else {"type": "numeric"}


def _flat(df: DataFrame, features: str, width: int, *others: str) -> DataFrame:
    return df.withColumn("_a", vector_to_array(features)).select(*others, *[F.col("_a")[i].alias(f"_f{i}") for i in range(width)])


def _cuts(flat: DataFrame, inputs: Sequence[int]) -> dict[int, list[float]]:
    """Half-way between the values of an input with few of them, else at its quantiles; over all rows."""
    if not inputs:
        return {}
    clean = {i: F.when(~F.isnan(f"_f{i}"), F.col(f"_f{i}")) for i in inputs}
    about = flat.agg(*[F.approx_count_distinct(clean[i]).alias(str(i)) for i in inputs]).first()
    few = [i for i in inputs if about[str(i)] <= 2 * MAX_BINS]
    sets = flat.agg(*[F.collect_set(clean[i]).alias(str(i)) for i in few]).first() if few else {}
    out = {}
    for i in few:
        values = sorted(sets[str(i)])
        if len(values) <= MAX_BINS:
            out[i] = [(a + b) / 2 for a, b in zip(values, values[1:])]
    many = [i for i in inputs if i not in out]
    if many:
        found = flat.approxQuantile([f"_f{i}" for i in many], [k / MAX_BINS for k in range(1, MAX_BINS)], 0.001)
        out |= {i: sorted(set(values)) for i, values in zip(many, found)}
    return {i: out[i] or [0.0] for i in inputs}  # an input with one value may be cut anywhere


def _poisson(u: str) -> Column:
    """How often a bootstrap takes a row, from a uniform number: Poisson with mean 1, as MLlib draws it."""
    shares = [exp(-1.0) / factorial(k) for k in range(17)]
    out = F.lit(float(len(shares)))
    for k in reversed(range(len(shares))):
        out = F.when(F.col(u) < sum(shares[: k + 1]), float(k)).otherwise(out)
    return out


class BinnedModel(Model):
    """A model, or the mean of the trees of a forest, behind the bins."""

    def __init__(self, bins: Bins, models: list[Model], features: str, classes: int | None):
        super().__init__()
        self.bins, self.models, self.features, self.classes = bins, models, features, classes

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rows = self.bins.put(_flat(dataset, self.features, self.bins.width, *dataset.columns))
        if self.classes is None:
            return self.models[0].transform(self.bins.assemble(rows)).drop(BINNED)
        # every combination of bins is asked once of all trees
        keys = [f"_b{i}" for i in range(self.bins.width)]
        asked = self.bins.assemble(rows.select(*keys).distinct().withColumns({f"_k{i}": F.col(key) for i, key in enumerate(keys)}))
        for i, tree in enumerate(self.models):
            asked = tree.setProbabilityCol(f"_p{i}").setRawPredictionCol("").setPredictionCol("").transform(asked)
        path = scratch_path(dataset.sparkSession, "votes")
        asked.select(*[f"_k{i}" for i in range(len(keys))], *[vector_to_array(f"_p{i}").alias(f"_p{i}") for i in range(len(self.models))]).write.parquet(path)
        told = dataset.sparkSession.read.parquet(path)
        votes = [sum((F.coalesce(F.get(f"_p{i}", F.lit(c)), F.lit(0.0)) for i in range(len(self.models))), F.lit(0.0)) for c in range(self.classes)]
        told = told.select(*[F.col(f"_k{i}") for i in range(len(keys))], F.array(*votes).alias("_votes"))
        found = rows.join(told, [F.col(key) == F.col(f"_k{i}") for i, key in enumerate(keys)])
        return found.withColumns({
            "rawPrediction": array_to_vector("_votes"),
            "probability": array_to_vector(F.transform("_votes", lambda v: v / len(self.models))),
            "prediction": argmax(F.col("_votes")).cast("double"),
        }).drop("_votes", *keys, *told.columns)


class Binned(Estimator):
    """Fits MLlib's forest, boosted trees or one-versus-rest of them on counted bins.

    A tree of a forest gets the sum of its rows' own Poisson draws as the weight of a combination, which is what MLlib's bootstrap gives it row by
    row. Where combinations hardly save rows, the estimator is fitted on the rows as it is.
    """

    def __init__(self, estimator: Estimator, features: str = "features", label: str = "y"):
        super().__init__()
        self.estimator, self.features, self.label = estimator, features, label

    def _fit(self, dataset: DataFrame) -> Model:
        first = dataset.select(F.size(vector_to_array(self.features))).first()
        if first is None:
            return self.estimator.fit(dataset)
        spark, width = dataset.sparkSession, first[0]
        attributes = dataset.schema[self.features].metadata.get("ml_attr", {}).get("attrs", {}).get("nominal", [])
        nominal = {a["idx"]: a | {"type": "nominal"} for a in attributes}
        path = scratch_path(spark, "bins")
        _flat(dataset.withColumn("_y", F.col(self.label).cast("double")), self.features, width, "_y").write.parquet(f"{path}/rows")
        flat = spark.read.parquet(f"{path}/rows")
        bins = Bins(_cuts(flat, [i for i in range(width) if i not in nominal]), nominal, width)
        keys = ["_y", *[f"_b{i}" for i in range(width)]]
        size = bins.put(flat).agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(F.xxhash64(*keys)).alias("groups")).first()
        if size["groups"] * LEAST_SAVING > size["rows"]:
            return self.estimator.fit(dataset)
        forest = isinstance(self.estimator, RandomForestClassifier)
        n_trees = self.estimator.getNumTrees() if forest else 0
        drawn = flat.select("*", *[F.rand(self.estimator.getSeed() * 100_003 + i).alias(f"_u{i}") for i in range(n_trees)])
        weights = [F.count(F.lit(1)).cast("double").alias("_n"), *[F.sum(_poisson(f"_u{i}")).alias(f"_w{i}") for i in range(n_trees)]]
        bins.put(drawn).groupBy(*keys).agg(*weights).write.parquet(f"{path}/groups")
        groups = bins.assemble(spark.read.parquet(f"{path}/groups")).withColumnRenamed("_y", self.label)
        if not forest:
            fitted = self.estimator.copy().setFeaturesCol(BINNED).setWeightCol("_n").fit(groups)
            return BinnedModel(bins, [fitted], self.features, None)
        trees = self._trees(groups, n_trees)
        return BinnedModel(bins, trees, self.features, max(tree.numClasses for tree in trees))

    def _trees(self, groups: DataFrame, n_trees: int) -> list[Model]:
        whole = groups.agg(*[F.sum(f"_w{i}").alias(f"_w{i}") for i in range(n_trees)]).first()
        subset, least = self.estimator.getFeatureSubsetStrategy(), self.estimator.getMinInstancesPerNode()
        single = {"numTrees": 1, "bootstrap": False, "minInstancesPerNode": 1, "featureSubsetStrategy": "sqrt" if subset == "auto" and n_trees > 1 else subset}

        def grow(i: int) -> Model:
            # a node needs as many rows as before; a combination stands for several
            share = (least - 0.5) / whole[f"_w{i}"] if least > 1 else 0.0
            tree = self.estimator.copy().setParams(**single, featuresCol=BINNED, weightCol=f"_w{i}", seed=self.estimator.getSeed() + i, minWeightFractionPerNode=min(share, 0.499))
            return tree.fit(groups.where(F.col(f"_w{i}") > 0))

        with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
            return list(pool.map(grow, range(n_trees)))
