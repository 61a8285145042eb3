import hashlib
import itertools
import random

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from tabeval.operators import logit, metrics, models, neighbours, preprocess, ranks, splits, sweep, trees

rng = np.random.default_rng(11)


@pytest.fixture(scope="module")
def points(spark):
    rows = []
    for i in range(240):
        y = i % 3
        rows.append((i, [float(v) for v in rng.normal(loc=y, scale=0.7, size=4)], y))
    rows += [(1000 + i, rows[i][1], rows[i][2]) for i in range(10)]  # copies, so that distances tie
    return spark.createDataFrame(rows, "id bigint, f array<double>, y int").cache()


@pytest.mark.parametrize(("block_rows", "cell_rows"), [(7, 5000), (64, 5000), (5000, 5000), (7, 9), (5000, 30)])
def test_nearest_neighbours_against_all_distances(points, block_rows, cell_rows):
    train, test = points.where("id % 4 != 0"), points.where("id % 4 = 0")
    known = [(r["id"], np.array(r["f"])) for r in train.collect()]
    found = neighbours.nearest_neighbours(train, test, "id", "f", "y", 5, block_rows, cell_rows).collect()
    for row in test.collect():
        order = sorted((float(((p - np.array(row["f"])) ** 2).sum()), i) for i, p in known)[:5]
        mine = sorted(r["neighbour"] for r in found if r["id"] == row["id"])
        assert mine == sorted(i for _, i in order)


def compared(index):
    """Pairs of rows that the last search of an index measured."""
    return sum(int(index.pivots.counts[r["cell"]]) for visits in index.visits for r in visits.select("cell").collect())


def test_clustered_points_are_compared_with_few_others(spark):
    middles = rng.normal(scale=40, size=(40, 6))
    rows = [(i, [float(v) for v in middles[i % 40] + rng.normal(size=6)], i % 40) for i in range(2000)]
    df = spark.createDataFrame(rows, "id bigint, f array<double>, y int")
    train, test = df.where("id >= 400"), df.where("id < 400")
    index = neighbours.build_index(train, "id", "f", "y", cell_rows=40)
    found = {}
    for r in index.search(test, "id", "f", 5).collect():
        found.setdefault(r["id"], []).append((r["distance"], r["neighbour"]))
    x = np.array([r[1] for r in rows])
    for i in range(400):
        gaps = np.sqrt(((x[400:] - x[i]) ** 2).sum(axis=1))
        assert [n for _, n in sorted(found[i])] == [int(j) + 400 for j in np.argsort(gaps, kind="stable")[:5]]
    assert compared(index) < 0.08 * 400 * 1600  # all pairs are 640,000
    assert all(r["visits"] < 10 for r in index.visits[0].unionByName(index.visits[1]).groupBy("key").agg(F.count("cell").alias("visits")).collect())


def test_neighbours_with_few_equal_or_missing_rows(spark):
    schema = "id bigint, f array<double>, y int"
    same = spark.createDataFrame([(i, [1.0, 2.0], 0) for i in range(30)], schema)
    index = neighbours.build_index(same, "id", "f", "y", cell_rows=5, block_rows=4)
    got = index.search(spark.createDataFrame([(7, [1.0, 2.0], 0), (8, None, 0)], schema), "id", "f", 3)
    assert sorted((r["id"], r["neighbour"], r["distance"]) for r in got.collect()) == [(7, 0, 0.0), (7, 1, 0.0), (7, 2, 0.0)]
    few = spark.createDataFrame([(1, [0.0], 4), (2, [5.0], 4), (3, None, 1)], schema)
    assert neighbours.nearest_neighbours(few, few, "id", "f", "y", 9).count() == 4
    none = spark.createDataFrame([], schema)
    assert neighbours.nearest_neighbours(none, few, "id", "f", "y").collect() == []
    assert neighbours.nearest_neighbours(few, none, "id", "f", "y").collect() == []


def test_bounds_never_exclude_a_row(spark):
    x = rng.normal(size=(300, 3))
    pivots = neighbours.choose_pivots(x[:80], 12)
    cell = neighbours._distances(x, pivots).argmin(axis=1)
    gap = np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1))
    counts = np.bincount(cell, minlength=12)
    near = np.array([gap[cell == c].min() if counts[c] else np.inf for c in range(12)])
    far = np.array([gap[cell == c].max() if counts[c] else 0.0 for c in range(12)])
    queries = rng.normal(size=(50, 3)) * 2
    _, low = neighbours.Pivots(pivots, counts, near, far).bounds(queries)
    for q, bound in zip(queries, low):
        assert (np.sqrt(((x - q) ** 2).sum(axis=1)) >= bound[cell]).all()


def test_approximate_neighbours_are_near(points):
    train, test = points.where("id % 4 != 0"), points.where("id % 4 = 0")
    exact = {(r["id"], r["neighbour"]) for r in neighbours.nearest_neighbours(train, test, "id", "f", "y", 3).collect()}
    rough = neighbours.approximate_neighbours(train, test, "id", "f", "y", 3, radius=10.0, bucket_length=4.0, tables=8).collect()
    assert len({(r["id"], r["neighbour"]) for r in rough} & exact) >= 0.9 * len(exact)


def test_knn_vote(points):
    got = neighbours.knn_classify(points, points, "id", "f", "y", 5).join(points, "id")
    assert got.agg(F.avg((F.col("predicted") == F.col("y")).cast("int"))).first()[0] > 0.8


def window_start(seed, n, window):
    return int(hashlib.md5(f"{seed}:{n}".encode()).hexdigest()[:8], 16) % (n - window + 1) if n > window else 0


def test_window_and_labels_against_a_loop(spark):
    random.seed(2)
    data = [(d, i, random.choice(["x", "y", "z"]) if d != "hard" else ("x" if i else "y")) for d, n in (("big", 2600), ("small", 60), ("hard", 40)) for i in range(n)]
    df = spark.createDataFrame(data, "d string, i int, y string")
    rows = splits.valid_split(df, "d", "i", "y", position=1000).collect()

    def expected(name):
        ys = [y for d, _, y in data if d == name]
        n = min(len(ys), 2000)
        train = n // 2 if 2000 > n else 1000
        for seed in range(13, 21):
            start = window_start(seed, len(ys), 2 * train)
            part = ys[start : start + 2 * train]
            if set(part[:train]) == set(part[train:]) == set(ys):
                return start, train
        return None

    for name in ("big", "small"):
        start, train = expected(name)
        mine = sorted((r["i"], r["place"], r["part"]) for r in rows if r["d"] == name)
        assert mine == [(start + k, k, "train" if k < train else "test") for k in range(2 * train)]
    assert expected("hard") is None and not [r for r in rows if r["d"] == "hard"]


def test_window_of_a_regression_target_is_the_first_start(spark):
    df = spark.range(3000).select(F.lit("d").alias("d"), "id", (F.col("id") * 1.5).alias("y"))
    rows = splits.valid_split(df, "d", "id", "y", 100, regression=True).collect()
    start = window_start(13, 3000, 200)
    assert sorted((r["id"], r["place"], r["part"]) for r in rows) == [(start + k, k, "train" if k < 100 else "test") for k in range(200)]


def test_window_does_not_depend_on_the_plan(spark, monkeypatch):
    df = spark.range(3000).select(F.lit("d").alias("d"), "id", (F.col("id") * 7 % 5).alias("y"))
    plain = {tuple(r) for r in splits.valid_split(df, "d", "id", "y", 100, split=2).collect()}
    monkeypatch.setattr(ranks, "PLAIN_GROUP_ROWS", 500)
    assert plain == {tuple(r) for r in splits.valid_split(df, "d", "id", "y", 100, split=2).collect()} and len(plain) == 200


def test_factorize_counts_by_first_appearance(spark):
    df = spark.createDataFrame([(0, "b"), (1, None), (2, "a"), (3, "b"), (4, "c")], "i int, t string")
    assert [r["y"] for r in splits.factorize(df, "t", "i").orderBy("i").collect()] == [0, -1, 1, 0, 2]


def test_balanced_classes_alternate(spark):
    df = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(40)], "i int, y int")
    rows = splits.balanced_binary(df, "y", ["i"]).orderBy("place").collect()
    assert [r["y"] for r in rows] == [0, 1] * 10 and [r["place"] for r in rows] == list(range(20))


def test_stratified_folds_are_even(spark):
    df = spark.createDataFrame([(i, "r" if i % 10 == 0 else "s") for i in range(100)], "i int, y string")
    counts = splits.stratified_kfold(df, "i", "y").groupBy("y", "fold").count().collect()
    assert {(r["y"], r["count"]) for r in counts} == {("r", 2), ("s", 18)}


def yeo_johnson(x, lam):
    out = np.empty_like(x)
    up = x >= 0
    out[up] = np.log1p(x[up]) if abs(lam) < 1e-12 else ((x[up] + 1) ** lam - 1) / lam
    out[~up] = -np.log1p(-x[~up]) if abs(lam - 2) < 1e-12 else -((1 - x[~up]) ** (2 - lam) - 1) / (2 - lam)
    return out


def test_power_transform_finds_the_likeliest_exponent(spark):
    x = np.concatenate([rng.lognormal(1.0, 0.6, 300), rng.normal(-1, 0.5, 60)])
    df = spark.createDataFrame([(float(v), 1.0) for v in x], "x double, flat double")

    def likelihood(lam):
        return -len(x) / 2 * np.log(yeo_johnson(x, lam).var()) + (lam - 1) * (np.sign(x) * np.log1p(np.abs(x))).sum()

    lams = np.linspace(-3, 5, 80001)
    best = lams[np.argmax([likelihood(v) for v in lams[::40]]) * 40]
    fitted = preprocess.fit_power(df, ["x", "flat"])
    assert fitted["x"][0] == pytest.approx(best, abs=5e-3)
    assert "flat" not in fitted  # a column that cannot be fitted is left as it is
    done = preprocess.power_transform(df, ["x", "flat"]).agg(F.avg("x"), F.stddev_pop("x"), F.max("flat")).first()
    assert done[0] == pytest.approx(0, abs=1e-9) and done[1] == pytest.approx(1) and done[2] == 1.0


def test_power_transform_leaves_the_first_bracket(spark):
    x = (1 + np.linspace(1, 400, 400) / 400.0) ** (1 / 20) - 1  # (1 + x)^20 is uniform

    def likelihood(lam):
        return -len(x) / 2 * np.log(yeo_johnson(x, lam).var()) + (lam - 1) * np.log1p(x).sum()

    fitted = preprocess.fit_power(spark.createDataFrame([(float(v),) for v in x], "x double"), ["x"])
    lams = np.linspace(5, 60, 11001)
    best = lams[np.argmax([likelihood(v) for v in lams])]
    assert best > 8 and fitted["x"][0] == pytest.approx(best, abs=2e-2)


def test_quantile_normal_is_monotone_and_normal(spark):
    x = rng.exponential(size=2000)
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double")
    out = preprocess.quantile_normal(df.withColumn("old", F.col("x")), "x").where("x is not null").orderBy("old").collect()
    values = np.array([r["x"] for r in out])
    assert (np.diff(values) >= 0).all() and abs(np.median(values)) < 0.05 and abs(values[200:-200].std() - 0.66) < 0.1


def test_soft_clip_against_numpy(spark):
    x = np.concatenate([rng.normal(size=500), [60.0, -45.0]])
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "i int, x double")
    mean, std = x.mean(), x.std(ddof=1)
    kept = x[(x <= mean + 4 * std) & (x >= mean - 4 * std)]
    low, high = kept.mean() - 4 * kept.std(ddof=1), kept.mean() + 4 * kept.std(ddof=1)
    up = np.maximum(-np.log1p(np.abs(x)) + low, x)
    expected = np.minimum(np.log1p(np.abs(up)) + high, up)
    got = [r["x"] for r in preprocess.soft_clip(df, ["x"]).orderBy("i").collect()]
    assert np.allclose(got, expected)


def test_rank_transform_both_ways(spark):
    rows = [(g, float(v)) for g, v in itertools.product("ab", [3, 1, 2, 2, 2, 9])]
    df = spark.createDataFrame(rows, "g string, v double")
    plain = sorted(map(tuple, preprocess.rank_transform(df, "v", ["g"]).collect()))
    assert plain == sorted(map(tuple, preprocess.rank_transform(df, "v", ["g"], plain_limit=0).collect()))
    assert ("a", 2.0, 4) in plain and ("a", 9.0, 6) in plain


def test_fit_uses_training_rows_only(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 10.0), (1, 20.0), (1, None), (0, float("nan"))], "part int, x double")
    train = F.col("part") == 0
    assert [r["x"] for r in preprocess.min_max(df, ["x"], train).collect()] == [0.0, 1.0, 2.0, None, None]
    assert [r["x"] for r in preprocess.impute_mean(df, ["x"], train).collect()] == [0.0, 10.0, 20.0, 5.0, 5.0]
    hot = spark.createDataFrame([(0, "a"), (0, "b"), (1, "c")], "part int, k string")
    assert [tuple(r) for r in preprocess.one_hot(hot, "k", F.col("part") == 0).collect()] == [(0, 1.0, 0.0), (0, 0.0, 1.0), (1, 0.0, 0.0)]


def test_subsample_keeps_the_order(spark):
    df = spark.createDataFrame([([float(i) for i in range(30)],)], "f array<double>")
    got = df.select(preprocess.subsample_features(F.col("f"), 30, 10, seed=4)).first()[0]
    assert got == sorted(got) and len(got) == 10


def test_shift_and_back(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0],)], "f array<double>")
    assert df.select(preprocess.shift_features(F.col("f"), 1, 6)).first()[0] == [2.0, 3.0, 4.0, 1.0, 0.0, 0.0]
    assert df.select(preprocess.unshift_outputs(F.col("f"), 2)).first()[0] == [3.0, 4.0, 1.0, 2.0]


@pytest.fixture(scope="module")
def table(spark):
    rows = []
    for i in range(300):
        a, b = rng.normal(size=2)
        rows.append((i, float(a) if i % 17 else None, float(b), "u" if i % 3 else "v", int(a + 0.5 * b > 0)))
    return spark.createDataFrame(rows, "id int, a double, b double, c string, y int").coalesce(1).cache()


def accuracy(df):
    return df.agg(F.avg((F.col("predicted") == F.col("y")).cast("int"))).first()[0]


def test_named_models_learn(table):
    train, test = table.where("id % 5 != 0"), table.where("id % 5 = 0")
    for name, params in (
        ("logistic", {"max_iter": 10}), ("random_forest", {"n_estimators": 5, "max_depth": 4}),
        ("gradient_boosting", {"n_estimators": 4}), ("svm", {"max_iter": 10}), ("neighbours", {}),
    ):
        scored = models.fit_predict(train, test, name, ["a", "b"], ["c"], **params)
        assert accuracy(scored) > 0.8, name
        assert scored.where(F.abs(F.col("probs")[0] + F.col("probs")[1] - 1) > 1e-9).count() == 0
    assert accuracy(models.ridge_classify(train, test, ["a", "b"])) > 0.8


def test_models_by_name_take_three_classes(spark):
    """The number of classes is looked up, the caller need not name it."""
    rows = [(float(v[0]), float(v[1]), i % 3) for i in range(180) for v in [rng.normal(loc=3 * (i % 3), size=2)]]
    df = spark.createDataFrame(rows, "a double, b double, y int").coalesce(1).cache()
    for name, params in (("gradient_boosting", {"n_estimators": 2}), ("svm", {"max_iter": 10}), ("neighbours", {"n_neighbors": 3}), ("random_forest", {"n_estimators": 3})):
        scored = models.fit_predict(df, df, name, ["a", "b"], **params)
        assert {r["n"] for r in scored.select(F.size("probs").alias("n")).collect()} == {3}, name
        assert accuracy(scored) > 0.6, name


def test_inputs_are_prepared_once_per_fold(table, monkeypatch):
    area = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="rawPrediction")
    calls = []
    prepare = models.preparation
    monkeypatch.setattr(models, "preparation", lambda *args: calls.append(args) or prepare(*args))
    found = models.random_search("neighbours", table, ["a", "b"], area, ["c"], max_evals=3, folds=2, parallelism=2)
    assert found.tried == 3 and len(calls) == 3  # two folds and the last fit
    assert found.best_score == max(score for _, score in found.scores) and all(1 <= p["n_neighbors"] <= 15 for p, _ in found.scores[1:])


def test_random_search_keeps_the_default_unless_beaten(table, monkeypatch):
    area = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="rawPrediction")
    monkeypatch.setitem(models.MODELS["logistic"].space, "max_iter", lambda r: 5)
    monkeypatch.setitem(models.MODELS, "ridge_without_space", models.ModelSpec(models.ridge))
    found = models.random_search("logistic", table, ["a", "b"], area, max_evals=1, folds=2, parallelism=2)
    assert found.tried == 1 and found.best_score >= found.default_score
    assert (found.params == {}) == (found.best_score == found.default_score)
    none = models.random_search("ridge_without_space", table, ["a", "b"], RegressionEvaluator(labelCol="y"), folds=2)
    assert none.tried == 0 and none.params == {}


def test_sweep_skips_a_failing_model(table, tmp_path):
    done, failed = sweep.sweep_large(
        {"t": (table, table)}, {"logistic": {"max_iter": 5}, "perceptron": {"layers": (9, 2)}}, ["a", "b"], str(tmp_path)
    )
    assert [f[:2] for f in failed] == [("t", "perceptron")] and done.count() == 300
    again, failed = sweep.sweep_large({"t": (table, table)}, {"logistic": {"max_iter": 5}}, ["a", "b"], str(tmp_path))
    assert failed == [] and sorted(again.collect()) == sorted(done.collect())  # what has ended is left out, not lost


def test_small_sweep(spark):
    rows = [("d", 1, i, [float(rng.normal(i % 2)), float(rng.normal())], i % 2 + 5, "train" if i < 60 else "test") for i in range(100)]
    rows += [("flat", 1, i, [0.0, 0.0], i % 2, "train" if i < 6 else "test") for i in range(10)]
    windows = spark.createDataFrame(rows, "dataset string, split int, place bigint, features array<double>, y int, part string")
    out = sweep.sweep_windows(windows, "dataset")
    assert {tuple(r) for r in out.groupBy("dataset", "method").count().collect()} == {
        (d, m, 40 if d == "d" else 4) for d in ("d", "flat") for m in ("ridge", "knn", "prior")
    }
    assert out.where(F.abs(F.aggregate("probs", F.lit(0.0), lambda a, x: a + x) - 1) > 1e-9).count() == 0


@pytest.fixture
def small_windows(spark):
    rows = [(d, s, i, [float(rng.normal(3 * (i % 2))), float(rng.normal())], i % 2 + 5, "train" if i < 60 else "test") for d in "de" for s in (1, 2) for i in range(100)]
    return spark.createDataFrame(rows, "dataset string, split int, place bigint, features array<double>, y int, part string")


def test_a_second_sweep_runs_only_what_is_missing(small_windows, tmp_path, monkeypatch):
    path = str(tmp_path / "cells")
    first = sweep.sweep_small(small_windows, "dataset", path, ["prior", "ridge"], [0.0], wave_cells=3)
    assert first.ran == 8 and len(sweep._waves(first.spark, path)) == 3
    before = sorted(map(str, first.predictions().collect()))
    assert sweep.sweep_small(small_windows, "dataset", path, ["prior", "ridge"], [0.0]).ran == 0
    more = sweep.sweep_small(small_windows, "dataset", path, ["prior", "knn"], [0.0, 0.2])
    assert more.ran == 12  # knn twice, prior with the new budget
    assert sorted(map(str, more.predictions().where("method in ('prior', 'ridge') and budget_s = 0").collect())) == before
    assert more.cells().count() == 20 and more.predictions().count() == 20 * 40
    # a wave that was not written to its end does not count
    (tmp_path / "cells" / "wave=broken").mkdir()
    assert more.cells().count() == 20


def test_failing_cells_are_noted_and_budgets_stop_the_search(small_windows, tmp_path, monkeypatch):
    def broken(x, y, test, classes):
        raise RuntimeError("no model")

    monkeypatch.setitem(sweep.SMALL_MODELS, "broken", sweep.SmallModel(broken))
    done = sweep.sweep_small(small_windows, "dataset", str(tmp_path / "cells"), ["broken", "knn"], [0.0, 0.3])
    cells = {(r["method"], r["budget_s"]): r for r in done.cells().where("dataset = 'd' and split = 1").collect()}
    assert cells["broken", 0.0]["state"] == "failed" and "no model" in cells["broken", 0.3]["message"]
    assert cells["knn", 0.0]["tried"] == 0 and 0 < cells["knn", 0.3]["tried"] <= sweep.MAX_EVALS
    report = done.report(["acc", "roc"], 0.0, 1).collect()
    assert {(r["method"], r["metric"]) for r in report} == {("knn", "acc"), ("knn", "roc")}  # a failed method has no score
    assert metrics.accuracy(done.predictions(), ["dataset", "method"]).where("value > 0.8").count() == 2


def test_the_clock_ends_a_search():
    ticks = iter(range(100))
    calls = []
    model = sweep.SmallModel(lambda x, y, test, classes, p=0: calls.append(p) or np.tile([0.5, 0.5], (len(test), 1)), {"p": lambda r: r.randrange(9)})
    x, y = np.zeros((10, 1)), np.arange(10) % 2
    _, best, tried = sweep.fit_in_budget(model, x, y, x, 2, budget_s=4, clock=lambda: next(ticks))
    assert tried == 3 and best == {}  # no set beats the default


def test_large_sweep_keeps_a_state_per_cell(table, tmp_path):
    cells = dict(datasets={"t": (table, table)}, methods={"logistic": {"max_iter": 5}, "perceptron": {"layers": (9, 2)}}, numeric=["a", "b"], path=str(tmp_path / "large"))
    done = sweep.sweep_large_cells(**cells, budgets=(None, 1.0), max_evals=1)
    assert done.ran == 4 and sweep.sweep_large_cells(**cells, budgets=(None, 1.0)).ran == 0
    states = {(r["method"], r["budget_s"]): r["state"] for r in done.cells().collect()}
    assert states["perceptron", 0.0] == states["perceptron", 1.0] == "failed" and states["logistic", 0.0] == "done"
    assert done.predictions().groupBy("budget_s").count().collect() and done.scores(["acc"]).count() == 2


def test_sparse_categories_of_any_number(spark):
    df = spark.range(120_000).select((F.col("id") % 100_000).alias("k"), F.col("id"))
    hot = preprocess.one_hot_sparse(df, "k", F.col("id") < 99_000)
    row = hot.where("id in (5, 98999, 99500)").orderBy("id").collect()
    assert [(v.size, v.indices.tolist()) for v in (r["k_hot"] for r in row)] == [(99_000, [5]), (99_000, [98_999]), (99_000, [])]
    odd = spark.createDataFrame([("b",), (None,), ("a",)], "c string")
    assert sorted(r["c_hot"].indices.tolist() for r in preprocess.one_hot_sparse(odd, "c").collect()) == [[], [0], [1]]
    assert [r["c_hot"].size for r in preprocess.one_hot_sparse(odd, "c", F.lit(False)).collect()] == [1, 1, 1]


def test_power_fit_copies_no_row(spark, monkeypatch):
    df = spark.range(50).select(*[(F.col("id") * (i + 1) / 7.0).alias(f"c{i}") for i in range(3)])
    whole = preprocess.fit_power(df, ["c0", "c1", "c2"])
    monkeypatch.setattr(preprocess, "MAX_AGGREGATES", 4)  # the same in many small aggregations
    parts = preprocess.fit_power(df, ["c0", "c1", "c2"])
    assert set(whole) == set(parts) == {"c0", "c1", "c2"} and all(whole[c] == pytest.approx(parts[c]) for c in whole)


def test_ensemble_turns_the_members_back(spark):
    scores = [2.0, 0.5, -1.0]
    members = [(1, s, scores[-s:] + scores[:-s] if s else scores) for s in range(3)]
    df = spark.createDataFrame(members, "k int, s int, v array<double>")
    expected = np.exp(np.array(scores) / 0.8)
    for average in (True, False):
        got = models.ensemble(df, "k", "v", "s", 3, average_logits=average).first()["probs"]
        assert np.allclose(got, expected / expected.sum())


def test_suitable_tables(spark):
    df = spark.createDataFrame([(1, 2.0, "p", "q"), (2, 3.0, "r", "q")], "a int, b double, t string, one string")
    assert splits.suitable(df, ["a", "b", "t"], "t") == ["a", "b"]
    assert splits.suitable(df, ["a", "t"], "t") is None and splits.suitable(df, ["a", "b"], "one") is None
    assert splits.suitable(df, ["a", "zzz"], "t") is None and splits.suitable(df, ["a", "b"], "a") is None


def test_ridge_penalty_against_the_closed_form(table):
    from pyspark.ml.feature import VectorAssembler

    rows = table.dropna().withColumn("y", F.col("b") * 3 + F.col("y") + 1)
    x, y = (np.array([r[c] for r in rows.collect()]) for c in ("a", "y"))
    train = VectorAssembler(inputCols=["a"], outputCol="features").transform(rows)
    for alpha in (0.0, 1.0, 500.0):
        fitted = models.ridge(**models.train_facts(rows), alpha=alpha).fit(train)
        expected = ((x - x.mean()) * (y - y.mean())).sum() / (((x - x.mean()) ** 2).sum() + alpha)
        assert fitted.coefficients[0] == pytest.approx(expected, rel=1e-9)


def test_a_continuous_label_has_no_classes(spark):
    rows = spark.createDataFrame([(1.0, 7.5), (2.0, 90001.25)], "a double, y double")
    facts = models.train_facts(rows)
    assert facts["n_rows"] == 2 and "classes" not in facts
    assert models.train_facts(rows.selectExpr("a", "int(a) AS y"), classes=True)["classes"] == 3


def test_visits_are_written_a_bounded_number_at_a_time():
    import pandas as pd

    class Queries:
        dtypes = [("key", "bigint"), ("q", "array<double>")]

        def mapInPandas(self, fn, schema):
            return fn

    rng = np.random.default_rng(5)
    points = rng.normal(size=(60, 4))
    index = neighbours.NeighbourIndex(None, neighbours.Pivots(points, np.ones(60, dtype=int), np.zeros(60), np.ones(60)))
    queries = pd.DataFrame({"key": range(700), "q": list(rng.normal(size=(700, 4)))})
    frames = list(index._visit(Queries(), 50, None)(iter([queries])))
    assert max(map(len, frames)) <= neighbours.VISIT_ROWS
    whole = pd.concat(frames)
    assert len(whole) == 700 * 50 and not whole.duplicated(["key", "cell"]).any()
    assert all((q == queries["q"][key]).all() for key, q in zip(whole["key"], whole["q"]))


def test_logistic_search_reads_the_rows_once_a_step_for_all_folds_and_sets(table, monkeypatch):
    """The sets and folds of a search share every pass; scores are those of MLlib's fits, the area is exact whatever the ranges."""
    area = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="rawPrediction", numBins=0)
    spec, passes, sums = models.MODELS["logistic"], [], logit._sums
    for key, values in {"penalty": ["l1", "l2", "none"], "C": [0.05, 0.02, 1.0], "fit_intercept": [True, False, True]}.items():
        monkeypatch.setitem(spec.space, key, lambda r, left=iter(values): next(left))
    monkeypatch.setattr(logit, "_sums", lambda data, fits: passes.append(len(fits)) or sums(data, fits))
    monkeypatch.setattr(logit, "RANGE_ROWS", 20)
    found = models.random_search("logistic", table, ["a", "b"], area, ["c"], max_evals=3, folds=2)
    assert found.tried == 3 and max(passes) == 8 and len(passes) < 40
    parts = models.prepared_folds(table, ["a", "b"], ["c"], spec, 2)
    for params, score in found.scores:
        settings = models.logistic(300, **params).setTol(1e-10)
        assert score == pytest.approx(np.mean([area.evaluate(settings.fit(rows).transform(held)) for rows, held in parts]), abs=2e-4)
    settings = models.logistic(300, **found.params).setTol(1e-10)
    rows = models.Pipeline(stages=[*models.preparation(["a", "b"], ["c"], spec), settings]).fit(table).transform(table)
    p = {r["id"]: r["probability"][1] for r in rows.collect()}
    mine = found.model.transform(table).collect()
    assert max(abs(p[r["id"]] - r["probability"][1]) for r in mine) < 1e-3 and all(r["prediction"] == (r["probability"][1] > 0.5) for r in mine)


def test_trees_are_fitted_on_counted_bins(spark):
    """The rounds of a fit see combinations of bins; the answers are those of MLlib on the rows."""
    rows = [(i % 7 * 1.0, i % 3 * 1.0 if i % 11 else None, "uv"[i % 2], int((i % 7) + 2 * (i % 3) > 4)) for i in range(1200)]
    df = spark.createDataFrame(rows, "a double, b double, c string, y int").coalesce(2).cache()
    plain = models.Pipeline(stages=[*models.preparation(["a", "b"], ["c"], models.MODELS["gradient_boosting"]), models.mlc.GBTClassifier(featuresCol="features", labelCol="y", maxIter=6, maxDepth=1, stepSize=1.0, seed=0)])
    stage = models.pipeline("gradient_boosting", ["a", "b"], ["c"], n_estimators=6).fit(df)
    assert isinstance(stage.stages[-1], trees.BinnedModel)
    got, expected = ([r["probability"][1] for r in m.transform(df).select("probability").collect()] for m in (stage, plain.fit(df)))
    assert got == pytest.approx(expected, abs=1e-6)


def test_a_forest_on_counted_bins(spark):
    rows = [(i % 7 * 1.0, i % 3 * 1.0 if i % 11 else None, "uv"[i % 2], int((i % 7) + 2 * (i % 3) > 4)) for i in range(1200)]
    df = spark.createDataFrame(rows, "a double, b double, c string, y int").coalesce(2).cache()
    fitted = models.pipeline("random_forest", ["a", "b"], ["c"], n_estimators=5, max_features="auto", min_samples_split=10).fit(df)
    assert isinstance(fitted.stages[-1], trees.BinnedModel) and len({m.toDebugString for m in fitted.stages[-1].models}) > 1
    out = fitted.transform(df).collect()
    assert len(out) == 1200 and np.mean([r["prediction"] == r["y"] for r in out]) > 0.9
    assert all(abs(sum(r["probability"]) - 1) < 1e-9 and abs(sum(r["rawPrediction"]) - 5) < 1e-9 for r in out)
    drawn = spark.range(200_000).select(F.rand(3).alias("u")).select(trees._poisson("u").alias("n")).agg(F.avg("n"), F.var_pop("n")).first()
    assert tuple(drawn) == pytest.approx((1.0, 1.0), abs=0.02)
