"""L1-L11, M4 over the driver tables; training and test rows are told apart by an ordinary column."""

from functools import reduce

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tabeval.operators import metrics, models, neighbours, sweep
from tabeval.operators.benchmark import ranks, ranks_and_wins
from tabeval.operators.splits import kfold, to_dataset, valid_split
from tabeval.plans.j_splits import window_sql
from tabeval.plans.registry import Tables, query
from tabeval.session import scratch_path

WIDTH = 64


def vectors(t: Tables):
    """Embeddings with one column per component."""
    wide = t.embeddings.select("vec_id", F.col("label").alias("y"), *[F.col("embedding")[i].cast("double").alias(f"x{i}") for i in range(WIDTH)])
    return one_fold_out(wide)


def one_fold_out(rows):
    """Four of five folds to train on, the fifth to test on."""
    folded = kfold(rows, "vec_id")
    return folded.where("fold <> 0").drop("fold"), folded.where("fold = 0").drop("fold")


FOLD_SQL = "(SELECT *, ('0x' || substr(md5(vec_id::VARCHAR || '42'), 1, 8))::BIGINT % 5 AS fold FROM embeddings)"


def lines(t: Tables):
    """Line items: is the item returned? Two numeric inputs have holes, one input is categorical."""
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
        F.when(F.col("l_tax") > 0.01, F.col("l_tax")).alias("l_tax"), "l_linestatus",
        (F.col("l_quantity") + 40 * F.col("l_discount") * F.col("l_linenumber") > 35).cast("int").alias("y"),
    )
    return rows.where(F.col("l_linenumber") <= 5), rows.where(F.col("l_linenumber") > 5)


NUMERIC = ["l_quantity", "l_extendedprice", "l_tax", "l_linenumber"]


MARGIN = 0.1  # by which a model that learns something beats the most frequent class here


def _facts(predictions, name):
    """What holds for a classifier of two classes that learns: one answer a row, shares that sum to 1, and more right answers than the
    most frequent class has. ``majority`` is the share of that class."""
    right = F.avg((F.col("predicted") == F.col("y")).cast("int"))
    majority = F.greatest(F.avg("y"), 1 - F.avg("y"))
    sound = F.bool_and(F.abs(F.aggregate("probs", F.lit(0.0), lambda total, p: total + p) - 1) < 1e-9)
    return predictions.agg(
        F.lit(name).alias("method"), F.count(F.lit(1)).alias("n"), F.round(majority, 6).alias("majority"), sound.alias("sums_to_one"), (right > majority + MARGIN).alias("beats_majority")
    )


def _facts_sql(name: str) -> str:
    return f"""SELECT '{name}' AS method, count(*) AS n, round(greatest(avg(y), 1 - avg(y)), 6) AS majority, true AS sums_to_one, true AS beats_majority
        FROM (SELECT CASE WHEN l_quantity + 40 * l_discount * l_linenumber > 35 THEN 1 ELSE 0 END AS y FROM lineitem WHERE l_linenumber > 5)"""


@query("l01_logistic_regression")
def logistic_regression(t: Tables):
    train, test = vectors(t)
    scored = models.fit_predict(train, test, "logistic", [f"x{i}" for i in range(WIDTH)])
    return scored.select("vec_id", "y", "predicted", F.round(F.array_max("probs"), 4).alias("probability"))


@query(
    "l01_logistic_optimum",
    f"SELECT label AS class, count(*) AS n, true AS is_optimal FROM {FOLD_SQL} WHERE fold <> 0 GROUP BY 1",
)
def logistic_optimum(t: Tables):
    """At the optimum the mean probability of every class is its share of the training rows: the gradient of the free intercepts is zero."""
    train, _ = vectors(t)
    scored = models.fit_predict(train, train, "logistic", [f"x{i}" for i in range(WIDTH)])
    total = scored.count()
    means = scored.select("vec_id", F.posexplode("probs").alias("class", "p")).groupBy("class").agg(F.avg("p").alias("mean"))
    counts = scored.groupBy(F.col("y").alias("class")).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(means, "class").select("class", "n", (F.abs(F.col("mean") - F.col("n") / total) < 0.005).alias("is_optimal"))


@query("l02_random_forest", _facts_sql("random_forest"))
def random_forest(t: Tables):
    train, test = lines(t)
    return _facts(models.fit_predict(train, test, "random_forest", NUMERIC, ["l_linestatus"], n_estimators=20), "random_forest")


@query("l03_gradient_boosting", _facts_sql("gradient_boosting"))
def gradient_boosting(t: Tables):
    train, test = lines(t)
    return _facts(models.fit_predict(train, test, "gradient_boosting", NUMERIC, ["l_linestatus"]), "gradient_boosting")


@query("l04_linear_svm", _facts_sql("svm"))
def linear_svm(t: Tables):
    train, test = lines(t)
    return _facts(models.fit_predict(train, test, "svm", NUMERIC, ["l_linestatus"]), "svm")


@query(
    "l05_nearest_neighbours",
    f"""SELECT vec_id, predicted, round(votes / 5, 6) AS share FROM (
         SELECT vec_id, label AS predicted, count(*) AS votes,
           row_number() OVER (PARTITION BY vec_id ORDER BY count(*) DESC, label) AS place FROM (
           SELECT q.vec_id, p.label, row_number() OVER (PARTITION BY q.vec_id ORDER BY
                    list_sum(list_transform(list_zip(q.embedding, p.embedding), lambda z: (z[1]::DOUBLE - z[2]::DOUBLE) ** 2)), p.vec_id) AS rn
           FROM {FOLD_SQL} q JOIN {FOLD_SQL} p ON q.fold = 0 AND p.fold <> 0) WHERE rn <= 5 GROUP BY 1, 2) WHERE place = 1""",
)
def nearest_neighbours(t: Tables):
    train, test = one_fold_out(t.embeddings)
    found = neighbours.knn_classify(train, test, "vec_id", "embedding", "label", k=5)
    return found.withColumn("share", F.round("share", 6))


@query(
    "l06_ridge_regression",
    """SELECT l_orderkey, l_partkey, round(my + w * (l_quantity - mx), 3) AS prediction FROM lineitem, (
         SELECT avg(l_quantity) AS mx, avg(l_extendedprice) AS my,
           covar_pop(l_extendedprice, l_quantity) * count(*) / (var_pop(l_quantity) * count(*) + 1) AS w FROM lineitem WHERE l_linenumber <= 5)
       WHERE l_linenumber > 5""",
)
def ridge_regression(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", F.col("l_extendedprice").alias("y"))
    train, test = rows.where(F.col("l_linenumber") <= 5), rows.where(F.col("l_linenumber") > 5)
    stages = models.preparation(["l_quantity"], [], models.ModelSpec(models.ridge, scale=False))
    fitted = models.Pipeline(stages=[*stages, models.ridge(**models.train_facts(train), alpha=1.0)]).fit(train)
    return fitted.transform(test).select("l_orderkey", "l_partkey", F.round("prediction", 3).alias("prediction"))


@query("l06_ridge_classifier", _facts_sql("ridge"))
def ridge_classifier(t: Tables):
    train, test = lines(t)
    scored = models.ridge_classify(train, test, NUMERIC)
    share = F.when(F.col("decision") > 0, 1.0).otherwise(0.0)  # decided by the sign
    return _facts(scored.withColumn("probs", F.array(1 - share, share)), "ridge")


@query(
    "l07_perceptron",
    f"""SELECT vec_id, label AS y, 10 AS classes, true AS sums_to_one, true AS predicts_the_most_probable FROM {FOLD_SQL} WHERE fold = 0""",
)
def perceptron(t: Tables):
    """An answer for every held-out vector: a share for each class, and the most probable class. These labels cannot be learned."""
    train, test = vectors(t)
    scored = models.fit_predict(train, test, "perceptron", [f"x{i}" for i in range(WIDTH)], layers=[WIDTH, 16, 10])
    total = F.aggregate("probs", F.lit(0.0), lambda whole, p: whole + p)
    top = F.get("probs", F.col("predicted")) == F.array_max("probs")
    return scored.select("vec_id", "y", F.size("probs").alias("classes"), (F.abs(total - 1) < 1e-9).alias("sums_to_one"), top.alias("predicts_the_most_probable"))


FOLDS_SQL = """(SELECT *, ('0x' || substr(md5(l_orderkey::VARCHAR || '42'), 1, 8))::BIGINT % 5 AS fold FROM lineitem WHERE l_linenumber <= 5)"""


@query(
    "l08_random_search",
    f"""SELECT 'logistic' AS method, 2 AS tried, sum(n)::BIGINT AS n_rows, min(n) AS least_fold, max(n) AS largest_fold,
          true AS chosen_is_best, true AS default_kept_unless_beaten, true AS every_set_in_space FROM (SELECT fold, count(*) AS n FROM {FOLDS_SQL} GROUP BY fold)""",
)
def random_search(t: Tables):
    """What holds for every search: the chosen set scores best of all tried, and the default one stays on a tie. Folds come with the rows."""
    train = kfold(lines(t)[0], "l_orderkey")
    size = train.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n"), F.min("n"), F.max("n")).first()
    area = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="rawPrediction", metricName="areaUnderROC")
    found = models.random_search("logistic", train, NUMERIC, area, ["l_linestatus"], max_evals=2, folds=5, fold_column="fold")
    known = [score for _, score in found.scores if score is not None]
    kept = (found.params == {}) == (found.best_score == found.default_score)
    drawn = all(set(params) == {"penalty", "max_iter", "fit_intercept", "C"} for params, _ in found.scores[1:])
    row = ("logistic", found.tried, *size, found.best_score == max(known), kept, drawn)
    names = "method string, tried int, n_rows bigint, least_fold bigint, largest_fold bigint, chosen_is_best boolean"
    return t.spark.createDataFrame([row], names + ", default_kept_unless_beaten boolean, every_set_in_space boolean")


MEMBERS = 3
LOGIT_SQL = "(SELECT vec_id, label, list_transform(embedding[1:10], lambda x: exp(x::DOUBLE / 0.8)) AS e FROM embeddings)"


def ensemble_probs(t: Tables):
    """Three members whose scores are rotated by 0, 1 and 2 classes, as their labels were."""
    logits = F.slice("embedding", 1, 10).cast("array<double>")
    # a member trained on labels moved up by s gives the score of class c at place c + s
    rotated = F.when(F.col("shift") == 0, logits).otherwise(
        F.concat(F.slice(logits, F.lit(11) - F.col("shift"), F.col("shift")), F.slice(logits, F.lit(1), F.lit(10) - F.col("shift")))
    )
    members = t.embeddings.withColumn("shift", F.explode(F.array(*[F.lit(i) for i in range(MEMBERS)])))
    members = members.select("vec_id", "shift", rotated.alias("scores"))
    return models.ensemble(members, "vec_id", "scores", "shift", 10)


@query("l09_ensemble", f"SELECT vec_id, k, round(e[k + 1] / list_sum(e), 6) AS p FROM {LOGIT_SQL}, (SELECT unnest(range(10))::INTEGER AS k)")
def ensemble(t: Tables):
    return ensemble_probs(t).select("vec_id", F.posexplode("probs").alias("k", "p")).withColumn("p", F.round("p", 6))


@query(
    "l10_predict",
    f"SELECT vec_id, 'class ' || (list_position(e, list_max(e)) - 1) AS predicted, round(list_max(e) / list_sum(e), 6) AS winning_probability FROM {LOGIT_SQL}",
)
def predict(t: Tables):
    found = models.predict(ensemble_probs(t), classes=[f"class {i}" for i in range(10)])
    return found.select("vec_id", "predicted", F.round("winning_probability", 6).alias("winning_probability"))


SPLITS, BUDGETS = (1, 2), (0.0, 0.5)


def order_windows(t: Tables):
    """Orders of each priority are a small dataset: the status from price, customer and month."""
    months = t.orders.withColumn("month", F.month("o_orderdate"))
    data = to_dataset(months, ["o_totalprice", "o_custkey", "month"], "o_orderstatus", "o_orderkey", keep=["o_orderpriority"])
    parts = [valid_split(data, "o_orderpriority", "o_orderkey", "y", 1000, split).withColumn("split", F.lit(split)) for split in SPLITS]
    return reduce(lambda a, b: a.unionByName(b), parts)


def order_sweep(t: Tables, methods=None, budgets=BUDGETS):
    return sweep.sweep_small(order_windows(t), "o_orderpriority", scratch_path(t.spark, "sweep"), methods, budgets)


def _order_windows_sql(split: int) -> str:
    order = "o_orderkey" if split == 1 else f"md5(o_orderkey::VARCHAR || '{split}'), o_orderkey"
    return f"SELECT *, {split} AS split FROM " + window_sql("orders", "o_orderpriority", order, "o_orderstatus", 1000, "o_orderkey, o_orderstatus")


ORDER_WINDOWS_SQL = "(" + " UNION ALL ".join(_order_windows_sql(split) for split in SPLITS) + ")"
CELLS_SQL = ", ".join(f"('{m}', {b}::DOUBLE)" for m in sweep.SMALL_MODELS for b in BUDGETS)


@query(
    "l11_sweep",
    f"""SELECT o_orderpriority AS dataset, method, split, budget_s, true AS has_ended, count_if(part = 'train')::BIGINT AS n_train, count_if(part = 'test')::BIGINT AS n_test,
          count_if(part = 'test')::BIGINT AS n_predictions, 0::BIGINT AS ran_again FROM {ORDER_WINDOWS_SQL}, (VALUES {CELLS_SQL}) v(method, budget_s) GROUP BY ALL""",
)
def order_sweep_cells(t: Tables):
    """Every cell has ended with a prediction for every test row, and a second call runs none."""
    windows, path = order_windows(t), scratch_path(t.spark, "sweep")
    done = sweep.sweep_small(windows, "o_orderpriority", path, budgets=BUDGETS)
    again = sweep.sweep_small(windows, "o_orderpriority", path, budgets=BUDGETS)
    told = done.predictions().groupBy(*sweep.CELL).agg(F.count(F.lit(1)).alias("n_predictions"))
    ended = F.col("state").isin(sweep.DONE, sweep.LATE).alias("has_ended")
    return done.cells().join(told, sweep.CELL, "left").select(*sweep.CELL, ended, "n_train", "n_test", "n_predictions", F.lit(again.ran).cast("bigint").alias("ran_again"))


@query(
    "l11_sweep_prior",
    f"""WITH w AS (SELECT * FROM {ORDER_WINDOWS_SQL}
        ), code AS (
          SELECT o_orderstatus, row_number() OVER (ORDER BY min(o_orderkey)) AS code FROM orders GROUP BY 1
        ), freq AS (
          SELECT o_orderpriority, split, o_orderstatus, code, n / sum(n) OVER (PARTITION BY o_orderpriority, split) AS p FROM (
            SELECT o_orderpriority, split, o_orderstatus, code, count(*) AS n FROM w JOIN code USING (o_orderstatus) WHERE part = 'train' GROUP BY ALL)
        ), model AS (
          SELECT o_orderpriority, split, ln(sum(exp(p))) AS norm, arg_max(o_orderstatus, p * 1000000 - code) AS guess, count(*) AS classes FROM freq GROUP BY ALL
        ), scored AS (
          SELECT o_orderpriority AS dataset, split, avg(CASE WHEN o_orderstatus = guess THEN 1.0 ELSE 0.0 END) AS acc, 1.0 / max(classes) AS balanced_acc, avg(norm - p) AS cross_entropy
          FROM w JOIN model USING (o_orderpriority, split) JOIN freq USING (o_orderpriority, split, o_orderstatus) WHERE part = 'test' GROUP BY ALL
        )
        SELECT dataset, 'prior' AS method, split, budget_s, metric, round(value, 6)::DOUBLE AS value
        FROM (UNPIVOT (SELECT dataset, split, acc::DOUBLE AS acc, balanced_acc::DOUBLE AS balanced_acc, cross_entropy::DOUBLE AS cross_entropy FROM scored)
              ON acc, balanced_acc, cross_entropy INTO NAME metric VALUE value), (VALUES (0.0::DOUBLE), (0.5::DOUBLE)) b(budget_s)""",
)
def order_sweep_prior(t: Tables):
    scores = order_sweep(t, ["prior"]).scores(["acc", "balanced_acc", "cross_entropy"])
    return scores.withColumn("value", F.round("value", 6))


@query("l11_sweep_ranks")
def sweep_ranks(t: Tables):
    """Ranks over datasets by accuracy, straight from the table of cells."""
    predictions = order_sweep(t, budgets=(0.0,)).predictions()
    return ranks_and_wins(ranks(metrics.accuracy(predictions, ["dataset", "method"])))


@query("m04_model_registry")
def model_registry(t: Tables):
    """Two named models on two large datasets, one model failing on purpose."""
    train, test = lines(t)
    datasets = {s: (train.where(F.col("l_linestatus") == s), test.where(F.col("l_linestatus") == s)) for s in ("F", "O")}
    wanted = {"logistic": {"max_iter": 20}, "perceptron": {"layers": (2, 2)}}
    done, failed = sweep.sweep_large(datasets, wanted, NUMERIC, scratch_path(t.spark, "sweep"))
    hit = (F.col("predicted") == F.col("y")).cast("int")
    noted = t.spark.createDataFrame([(d, m, None) for d, m, _ in failed], "dataset string, method string, accuracy double")
    return noted.unionByName(done.groupBy("dataset", "method").agg(F.round(F.avg(hit), 4).alias("accuracy")))
