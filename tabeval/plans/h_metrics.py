"""H1-H12, M3 over the driver tables.

Binary predictions: line items (dataset = line status, split = line number, two score formulas as methods).
Multiclass predictions: embeddings (softmax of the first ten components against the label).
"""

from pyspark.sql import functions as F

from tabeval.functions.probs import above, softmax
from tabeval.operators import metrics
from tabeval.plans.registry import Tables, query

BINARY_SQL = """(SELECT l_linestatus AS dataset, method, l_linenumber AS split, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
      CASE method WHEN 'discount' THEN l_discount * 9 + 0.05 ELSE l_tax * 6 + l_discount * 5 END AS p
    FROM lineitem, (VALUES ('discount'), ('mixed')) m(method))"""


def binary(t: Tables):
    scored = F.array(
        F.struct(F.lit("discount").alias("method"), (F.col("l_discount") * 9 + 0.05).alias("p")),
        F.struct(F.lit("mixed").alias("method"), (F.col("l_tax") * 6 + F.col("l_discount") * 5).alias("p")),
    )
    rows = t.lineitem.select(
        F.col("l_linestatus").alias("dataset"), F.col("l_linenumber").alias("split"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"), F.inline(scored),
    )
    return rows.withColumn("probs", F.array(1 - F.col("p"), "p"))


MULTI_SQL = """(SELECT vec_id, y, list_transform(e, lambda x: x / list_sum(e)) AS probs FROM (
      SELECT vec_id, label AS y, list_transform(embedding[1:10], lambda x: exp(x::DOUBLE)) AS e FROM embeddings))"""
LONG_SQL = f"""(SELECT vec_id, y, k, probs[k + 1] AS p FROM {MULTI_SQL}, (SELECT unnest(range(10)) AS k))"""


def multi(t: Tables):
    scores = F.slice("embedding", 1, 10).cast("array<double>")
    return t.embeddings.select(
        F.lit("embeddings").alias("dataset"), F.lit("softmax").alias("method"), F.lit(1).alias("split"),
        "vec_id", F.col("label").alias("y"), softmax(scores).alias("probs"),
    )


def rounded(df, digits=6):
    return df.withColumn("value", F.round("value", digits))


KEYS = "dataset, method, split"


@query("h01_accuracy_binary", f"SELECT {KEYS}, round(avg(CASE WHEN (p > 0.5) = (y = 1) THEN 1 ELSE 0 END), 6) AS value FROM {BINARY_SQL} GROUP BY ALL")
def accuracy_binary(t: Tables):
    return rounded(metrics.accuracy(binary(t)))


@query(
    "h01_accuracy_multiclass",
    f"SELECT 'embeddings' AS dataset, round(avg(CASE WHEN list_position(probs, list_max(probs)) - 1 = y THEN 1 ELSE 0 END), 6) AS value FROM {MULTI_SQL}",
)
def accuracy_multiclass(t: Tables):
    return rounded(metrics.accuracy(multi(t), ["dataset"]))


@query(
    "h02_balanced_accuracy",
    f"""SELECT {KEYS}, round(avg(recall), 6) AS value FROM (
          SELECT {KEYS}, y, avg(CASE WHEN (p > 0.5) = (y = 1) THEN 1 ELSE 0 END) AS recall FROM {BINARY_SQL} GROUP BY ALL) GROUP BY ALL""",
)
def balanced_accuracy(t: Tables):
    return rounded(metrics.balanced_accuracy(binary(t)))


@query(
    "h03_auroc_binary",
    f"""SELECT {KEYS}, round((sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * sum(1 - y)), 6) AS value FROM (
          SELECT *, rank() OVER (PARTITION BY {KEYS} ORDER BY p) + (count(*) OVER (PARTITION BY {KEYS}, p) - 1) / 2 AS r
          FROM {BINARY_SQL}) GROUP BY ALL""",
)
def auroc_binary(t: Tables):
    return rounded(metrics.auroc_binary(binary(t)))


@query(
    "h04_auroc_one_vs_one",
    f"""SELECT 'embeddings' AS dataset, round(avg(area), 6) AS value FROM (
          SELECT a, b, (sum(CASE WHEN y = a THEN r END) - count(*) FILTER (WHERE y = a) * (count(*) FILTER (WHERE y = a) + 1) / 2)
                 / (count(*) FILTER (WHERE y = a) * count(*) FILTER (WHERE y = b)) AS area FROM (
            SELECT l.k AS a, o.b, l.y, rank() OVER (PARTITION BY l.k, o.b ORDER BY l.p)
                   + (count(*) OVER (PARTITION BY l.k, o.b, l.p) - 1) / 2 AS r
            FROM (SELECT vec_id, y, k, p FROM {LONG_SQL}) l JOIN (SELECT unnest(range(10)) AS b) o ON o.b <> l.k AND l.y IN (l.k, o.b)) GROUP BY a, b)""",
)
def auroc_one_vs_one(t: Tables):
    return rounded(metrics.auroc_ovo(multi(t), 10, ["dataset"]))


@query(
    "h05_cross_entropy_binary",
    f"""SELECT {KEYS}, round(-avg(CASE WHEN y = 1 THEN greatest(CASE WHEN p > 0 THEN ln(p) ELSE -100 END, -100)
          ELSE greatest(CASE WHEN 1 - p > 0 THEN ln(1 - p) ELSE -100 END, -100) END), 6) AS value FROM {BINARY_SQL} GROUP BY ALL""",
)
def cross_entropy_binary(t: Tables):
    return rounded(metrics.cross_entropy(binary(t)))


@query(
    "h05_cross_entropy_multiclass",
    f"""SELECT 'embeddings' AS dataset, round(avg(ln(list_sum(list_transform(probs, lambda x: exp(x)))) - probs[y + 1]), 6) AS value FROM {MULTI_SQL}""",
)
def cross_entropy_multiclass(t: Tables):
    return rounded(metrics.cross_entropy(multi(t), ["dataset"]))


@query("h05_log_loss_multiclass", f"SELECT 'embeddings' AS dataset, round(-avg(ln(probs[y + 1])), 6) AS value FROM {MULTI_SQL}")
def log_loss_multiclass(t: Tables):
    return rounded(metrics.cross_entropy(multi(t), ["dataset"], mode="logloss"))


@query(
    "h06_brier",
    f"""SELECT 'embeddings' AS dataset, round(avg(d), 6) AS value FROM (
          SELECT vec_id, sum((p - CASE WHEN k = y THEN 1 ELSE 0 END) ** 2) AS d FROM {LONG_SQL} GROUP BY vec_id)""",
)
def brier(t: Tables):
    return rounded(metrics.brier(multi(t), ["dataset"]))


@query(
    "h07_calibration_error",
    f"""SELECT {KEYS}, round(sum(abs(hits - confidence)) / sum(n), 6) AS value FROM (
          SELECT {KEYS}, ceil(c * 15) AS bin, count(*) AS n, sum(c) AS confidence, sum(hit) AS hits FROM (
            SELECT {KEYS}, greatest(1 - p, p) AS c, CASE WHEN (CASE WHEN 1 - p >= p THEN 0 ELSE 1 END) = y THEN 1 ELSE 0 END AS hit
            FROM {BINARY_SQL}) GROUP BY ALL) GROUP BY ALL""",
)
def calibration_error(t: Tables):
    return rounded(metrics.calibration_error(binary(t)))


@query(
    "h08_average_precision_thresholded",
    f"""SELECT {KEYS}, round(recall * coalesce(precision, 0) + (1 - recall) * pos / n, 6) AS value FROM (
          SELECT {KEYS}, count(*) AS n, sum(y) AS pos, sum(CASE WHEN p > 0.5 THEN y ELSE 0 END) / sum(y) AS recall,
            sum(CASE WHEN p > 0.5 THEN y END) / count(CASE WHEN p > 0.5 THEN 1 END) AS precision FROM {BINARY_SQL} GROUP BY ALL)""",
)
def average_precision_thresholded(t: Tables):
    return rounded(metrics.average_precision(binary(t)))


@query(
    "h08_average_precision_scores",
    f"""SELECT {KEYS}, round(sum(pos * cum_pos / cum_n) / max(all_pos), 6) AS value FROM (
          SELECT {KEYS}, p, pos, sum(pos) OVER (PARTITION BY {KEYS} ORDER BY p DESC) AS cum_pos,
            sum(n) OVER (PARTITION BY {KEYS} ORDER BY p DESC) AS cum_n, sum(pos) OVER (PARTITION BY {KEYS}) AS all_pos
          FROM (SELECT {KEYS}, p, sum(y) AS pos, count(*) AS n FROM {BINARY_SQL} GROUP BY ALL)) GROUP BY {KEYS}""",
)
def average_precision_scores(t: Tables):
    return rounded(metrics.average_precision(binary(t), mode="score"))


REGRESSION_SQL = """(SELECT l_returnflag AS dataset, 'linear' AS method, l_linenumber AS split, l_extendedprice AS target,
                      l_quantity * 1500 + 1000 AS pred FROM lineitem)"""


def regression(t: Tables):
    return t.lineitem.select(
        F.col("l_returnflag").alias("dataset"), F.lit("linear").alias("method"), F.col("l_linenumber").alias("split"),
        F.col("l_extendedprice").alias("target"), (F.col("l_quantity") * 1500 + 1000).alias("pred"),
    )


@query(
    "h09_regression_errors",
    f"""SELECT {KEYS}, metric, round(value, 2) AS value FROM (
          SELECT {KEYS}, avg((target - pred) ** 2) AS mse, sqrt(avg((target - pred) ** 2)) AS rmse, avg(abs(target - pred)) AS mae
          FROM {REGRESSION_SQL} GROUP BY ALL) UNPIVOT (value FOR metric IN (mse, rmse, mae))""",
)
def regression_errors(t: Tables):
    return rounded(metrics.evaluate(regression(t), ["mse", "rmse", "mae"]), 2)


@query(
    "h10_r2_proper",
    f"SELECT {KEYS}, round(1 - avg((target - pred) ** 2) / var_pop(target), 6) AS value FROM {REGRESSION_SQL} GROUP BY ALL",
)
def r2_proper(t: Tables):
    return rounded(metrics.r2(regression(t), mode="proper"))


@query(
    "h10_r2_reference",
    f"SELECT {KEYS}, round(avg((target - pred) ** 2) / var_pop(pred) - 1, 6) AS value FROM {REGRESSION_SQL} GROUP BY ALL",
)
def r2_reference(t: Tables):
    return rounded(metrics.r2(regression(t)))


@query(
    "h11_pseudo_metrics",
    """SELECT event_type AS method, round(sum(value), 2) AS sum_time, round(avg(value), 6) AS mean_time,
         count(DISTINCT user_id) AS sum_count FROM events GROUP BY 1""",
)
def pseudo_metrics(t: Tables):
    runs = t.events.select(F.col("event_type").alias("method"), F.col("user_id").alias("dataset"), "value")
    table = metrics.pseudo_metrics(runs, ["method"], "value")
    return table.withColumns({"sum_time": F.round("sum_time", 2), "mean_time": F.round("mean_time", 6)})


@query(
    "h12_score_accuracy",
    """SELECT l_linenumber, round(avg(CASE WHEN (l_discount - 0.045 > 0) = (l_returnflag = 'R') THEN 1 ELSE 0 END), 6) AS logit_accuracy,
         round(avg(CASE WHEN (l_discount * 10 > 0.5) = (l_returnflag = 'R') THEN 1 ELSE 0 END), 6) AS probability_accuracy
       FROM lineitem GROUP BY 1""",
)
def score_accuracy(t: Tables):
    rows = t.lineitem.select(
        "l_linenumber", F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"),
        (F.col("l_discount") - 0.045).alias("logit"), (F.col("l_discount") * 10).alias("p"),
    )
    sides = [
        metrics.score_accuracy(rows, score, "y", ["l_linenumber"], logits).select("l_linenumber", F.round("value", 6).alias(name))
        for score, logits, name in (("logit", True, "logit_accuracy"), ("p", False, "probability_accuracy"))
    ]
    return sides[0].join(sides[1], "l_linenumber")


@query("h12_threshold", "SELECT l_orderkey, l_linenumber, CASE WHEN l_discount * 10 > 0.5 THEN 1 ELSE 0 END AS decision FROM lineitem")
def threshold(t: Tables):
    return t.lineitem.select("l_orderkey", "l_linenumber", above(F.col("l_discount") * 10).alias("decision"))


@query(
    "m03_metric_registry",
    f"""SELECT {KEYS}, 'acc' AS metric, round(avg(CASE WHEN (p > 0.5) = (y = 1) THEN 1 ELSE 0 END), 6) AS value FROM {BINARY_SQL} GROUP BY ALL
        UNION ALL SELECT {KEYS}, 'brier', round(avg(2 * (p - y) ** 2), 6) FROM {BINARY_SQL} GROUP BY ALL
        UNION ALL SELECT {KEYS}, 'balanced_acc', round(avg(recall), 6) FROM (
          SELECT {KEYS}, y, avg(CASE WHEN (p > 0.5) = (y = 1) THEN 1 ELSE 0 END) AS recall FROM {BINARY_SQL} GROUP BY ALL) GROUP BY ALL
        UNION ALL SELECT {KEYS}, 'mean_score', round(avg(p), 6) FROM {BINARY_SQL} GROUP BY ALL""",
)
def metric_registry(t: Tables):
    own = {"mean_score": lambda: F.avg(metrics.p_of(1))}
    return rounded(metrics.evaluate(binary(t), ["acc", "brier", "balanced_acc", "mean_score"], own=own))
