import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabeval.functions.tails import f_tail
from tabeval.operators import benchmark, metrics

rng = np.random.default_rng(3)


def auc(y, s):
    wins = [(a > b) + 0.5 * (a == b) for a, b in itertools.product(s[y == 1], s[y == 0])]
    return float(np.mean(wins)) if wins else None


@pytest.fixture(scope="module")
def binary(spark):
    rows = [("d", "m", i % 2, int(rng.random() < 0.4), float(np.round(rng.random(), 1))) for i in range(400)]
    rows += [("one class", "m", 0, 1, 0.3), ("one class", "m", 0, 1, 0.8)]
    return spark.createDataFrame([(*r[:4], [1 - r[4], r[4]]) for r in rows], "dataset string, method string, split int, y int, probs array<double>")


@pytest.mark.parametrize("limit", [None, 0])
def test_auroc_against_all_pairs(binary, limit):
    rows = binary.collect()
    for got in metrics.auroc_binary(binary, plain_limit=limit).collect():
        mine = [r for r in rows if (r["dataset"], r["split"]) == (got["dataset"], got["split"])]
        expected = auc(np.array([r["y"] for r in mine]), np.array([r["probs"][1] for r in mine]))
        assert got["value"] == (None if expected is None else pytest.approx(expected))


@pytest.mark.parametrize("limit", [None, 0])
def test_one_vs_one_against_all_pairs(spark, limit):
    y = rng.integers(0, 3, 150)
    p = np.round(rng.dirichlet([1, 1, 1], 150), 2)
    preds = spark.createDataFrame([("d", int(a), [float(x) for x in b]) for a, b in zip(y, p)], "dataset string, y int, probs array<double>")
    areas = []
    for a, b in itertools.permutations(range(3), 2):
        both = (y == a) | (y == b)
        areas.append(auc((y[both] == a).astype(int), p[both, a]))
    assert metrics.auroc_ovo(preds, 3, ["dataset"], plain_limit=limit).first()["value"] == pytest.approx(np.mean(areas))
    assert metrics.auroc_ovo(preds.where("y < 2"), 3, ["dataset"]).first()["value"] is None


def test_binary_accuracy_uses_the_threshold(spark):
    preds = spark.createDataFrame([("d", 0, [0.5, 0.5]), ("d", 1, [0.4, 0.6]), ("d", 1, [0.9, 0.1])], "dataset string, y int, probs array<double>")
    assert metrics.accuracy(preds, ["dataset"]).first()["value"] == pytest.approx(2 / 3)
    assert metrics.balanced_accuracy(preds, ["dataset"]).first()["value"] == pytest.approx(0.75)


def test_cross_entropy_modes(spark):
    probs = [[0.7, 0.2, 0.1], [0.1, 0.8, 0.1], [0.0, 0.0, 1.0]]
    preds = spark.createDataFrame([("d", i, p) for i, p in enumerate(probs)], "dataset string, y int, probs array<double>")
    twice = np.mean([np.log(np.exp(p).sum()) - p[i] for i, p in enumerate(probs)])
    assert metrics.cross_entropy(preds, ["dataset"]).first()["value"] == pytest.approx(twice)
    assert metrics.cross_entropy(preds, ["dataset"], "logloss").first()["value"] == pytest.approx(-np.mean(np.log([0.7, 0.8, 1.0])))
    sure = spark.createDataFrame([("d", 0, [0.0, 1.0]), ("d", 1, [0.0, 1.0])], "dataset string, y int, probs array<double>")
    assert metrics.cross_entropy(sure, ["dataset"]).first()["value"] == pytest.approx(50.0)


def test_paired_signed_rank_of_a_known_sample(spark):
    x = [1.83, 0.50, 1.62, 2.48, 1.68, 1.88, 1.55, 3.06, 1.30]
    y = [0.878, 0.647, 0.598, 2.05, 1.06, 1.29, 1.06, 3.14, 1.29]
    df = spark.createDataFrame([("a", a, b) for a, b in zip(x, y)], "g string, x double, y double")
    for limit in (None, 0):
        rows = {r["alternative"]: r for r in benchmark.signed_rank_test(df, ["g"], "x", "y", digits=9, plain_limit=limit).collect()}
        assert rows["greater"]["v"] == 40 and rows["greater"]["p_value"] == pytest.approx(0.01953, abs=1e-5)
        assert rows["two.sided"]["p_value"] == pytest.approx(0.03906, abs=1e-5)


def test_rank_sum_of_a_known_sample(spark):
    x = [0.80, 0.83, 1.89, 1.04, 1.45, 1.38, 1.91, 1.64, 0.73, 1.46]
    y = [1.15, 0.88, 0.90, 0.74, 1.21]
    df = spark.createDataFrame([("x", v) for v in x] + [("y", v) for v in y], "side string, v double")
    rows = {r["alternative"]: r for r in benchmark.rank_sum_test(df, [], F.col("side") == "x", "v").collect()}
    assert rows["greater"]["w"] == 35 and rows["greater"]["p_value"] == pytest.approx(0.1272, abs=1e-4)


def test_signed_rank_with_zeros_and_ties_uses_the_normal_tail(spark):
    df = spark.createDataFrame([("a", float(d), 0.0) for d in (1, 1, 2, -2, 0, 3, 3)], "g string, x double, y double")
    row = benchmark.signed_rank_test(df, [], "x", "y").where("alternative = 'two.sided'").first()
    assert row["n"] == 6 and row["zeros"] == 1 and row["v"] == pytest.approx(17.5)
    assert 0 < row["p_value"] < 1


def test_f_tail():
    assert f_tail(4.0, 1, 10) == pytest.approx(0.0734, abs=1e-4)
    assert f_tail(0.0, 1, 10) == 1.0


def test_sequential_variance_against_least_squares(spark):
    x = rng.normal(size=(200, 3))
    y = x @ [1.0, 0.5, 0.0] + rng.normal(size=200)
    df = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], "a double, b double, c double, y double")
    rows = {r["factor"]: r for r in benchmark.sequential_variance(df, ["a", "b", "c"], "y").collect()}

    def residual(k):
        design = np.hstack([np.ones((200, 1)), x[:, :k]])
        return float(((y - design @ np.linalg.lstsq(design, y, rcond=None)[0]) ** 2).sum())

    for i, name in enumerate("abc"):
        assert rows[name]["sum_sq"] == pytest.approx(residual(i) - residual(i + 1), rel=1e-6)
    assert rows["Residuals"]["sum_sq"] == pytest.approx(residual(3)) and rows["Residuals"]["df"] == 196
    assert rows["a"]["p_value"] < 1e-6 < rows["c"]["p_value"]


def test_ranks_share_ties_and_a_shared_top_is_no_win(spark):
    cells = spark.createDataFrame([("d", "a", 0.9001), ("d", "b", 0.9002), ("d", "c", 0.1)], "dataset string, method string, value double")
    ranked = {r["method"]: r["rank"] for r in benchmark.ranks(cells).collect()}
    assert ranked == {"a": 1.5, "b": 1.5, "c": 3.0}
    assert {r["method"]: r["wins"] for r in benchmark.ranks_and_wins(benchmark.ranks(cells)).collect()} == {"a": 0, "b": 0, "c": 0}


def test_missing_scores_get_the_sentinel(spark):
    cells = spark.createDataFrame([("d", "a", 0.5)], "dataset string, method string, value double")
    filled, better = benchmark.fill_missing(cells, "roc", ["a", "b"])
    assert {r["method"]: r["value"] for r in filled.collect()} == {"a": 0.5, "b": -1.0} and better
    assert benchmark.fill_missing(cells, "cross_entropy", ["a", "b"])[0].where("method = 'b'").first()["value"] == 100.0
    assert not benchmark.fill_missing(cells, "time", ["a"])[1]


def test_sampled_split_sizes_are_exact(spark):
    from tabeval.operators.analytics import split_groups, split_rows, split_sizes

    assert split_sizes(1009, {"train": 0.8, "valid": 0.1, "test": 0.1}) == {"train": 809, "valid": 100, "test": 100}
    counts = {r["split"]: r["count"] for r in split_rows(spark.range(1009), "id").groupBy("split").count().collect()}
    assert counts == {"train": 809, "valid": 100, "test": 100}
    random.seed(1)
    rows = spark.createDataFrame([(random.choice([0, *range(50)]), i) for i in range(900)], "g int, i int")
    by_group = split_groups(rows, "g").groupBy("g").agg(F.count_distinct("split").alias("n"))
    assert by_group.where("n > 1").count() == 0


def test_two_classes_need_not_be_neighbours(spark):
    rows = [("gap", 0), ("gap", 2), ("gap", 2), ("three", 0), ("three", 1), ("three", 2), ("one", 5)]
    df = spark.createDataFrame(rows, "g string, y int")
    got = {r["g"]: r["many"] for r in df.groupBy("g").agg(metrics._many_classes().alias("many")).collect()}
    assert got == {"gap": False, "three": True, "one": False}


def test_simple_metrics_share_one_pass(binary):
    both = metrics.evaluate(binary, ["acc", "cross_entropy", "brier"])
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert both.count() == 9


def test_registry_takes_the_auroc_by_the_number_of_classes(spark):
    rng = np.random.default_rng(6)
    rows = []
    for name, k in (("two", 2), ("three", 3), ("five", 5)):
        for _ in range(80):
            p = rng.dirichlet(np.ones(k))
            rows.append((name, int(rng.choice(k, p=p)), [float(v) for v in p]))
    preds = spark.createDataFrame(rows, "dataset string, y int, probs array<double>")
    got = {r["dataset"]: r["value"] for r in metrics.evaluate(preds, ["roc"], ["dataset"]).collect()}
    for name, k in (("two", 2), ("three", 3), ("five", 5)):
        own = preds.where(F.col("dataset") == name)
        alone = metrics.auroc(own, ["dataset"], k).first()["value"]
        assert got[name] == pytest.approx(alone) and 0.5 < got[name] <= 1
    three = preds.where("dataset = 'three'")
    assert metrics.auroc_binary(three, ["dataset"]).first()["value"] is None
    assert metrics.average_precision(three, ["dataset"], mode="score").first()["value"] is None


def test_means_do_not_hang_on_the_order_of_addition(spark):
    values = [98.27, 85.27, 12.85, 33.6, 71.71, 70.7, 92.77, 42.37]  # their mean is 63.4425; added in this order, 63.442499999999995
    odd = {"tiny": [1e-30, 3e-30], "huge": [1e300, 3e300], "nan": [1.0, float("nan")], "holed": [0.1, None, 0.3], "none": [None, None]}
    rows = [("u", "a", v) for v in values] + [("u", "b", 63.443)] + [("odd", m, v) for m, vs in odd.items() for v in vs]
    cells = benchmark.per_dataset(spark.createDataFrame(rows, "dataset string, method string, value double").coalesce(1))
    got = {(r["dataset"], r["method"]): r["value"] for r in cells.collect()}
    assert got["u", "a"] == 63.4425 and got["odd", "tiny"] == 2e-30 and got["odd", "huge"] == 2e300
    assert np.isnan(got["odd", "nan"]) and got["odd", "holed"] == 0.2 and got["odd", "none"] is None
    first = cells.where("dataset = 'u'")
    assert {r["method"]: r["rank"] for r in benchmark.ranks(first).collect()} == {"a": 1.5, "b": 1.5}
    assert all(r["is_best"] for r in benchmark.best_flags(first).collect())
