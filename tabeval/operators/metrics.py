"""Classification and regression metrics over long prediction tables.

Predictions have the columns ``y`` (class from 0) and ``probs`` (array by class); regression has ``target``
and ``pred``. Every metric is grouped by the given keys, and an undefined value is null for its group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabeval.functions.probs import above, argmax, total
from tabeval.operators.ranks import attach, cumulative_by_value

GROUP = ("dataset", "method", "split")


def p_of(cls: int | Column) -> Column:
    """Probability of a class, null when the array is shorter."""
    return F.get("probs", F.lit(cls) if isinstance(cls, int) else cls)


def _is_hit() -> tuple[Column, Column]:
    """Whether a row is right when its group is binary (p1 above one half) and when it has more classes."""
    return (p_of(1) > 0.5).cast("int") == F.col("y"), argmax(F.col("probs")) == F.col("y")


def _by_class(preds: DataFrame, group: Sequence[str]) -> DataFrame:
    """Counts by group and true class; the small table that threshold metrics need."""
    binary, many = _is_hit()
    return preds.groupBy(*group, "y").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(binary).alias("hits_binary"),
        F.count_if(many).alias("hits_many"),
        F.count_if(p_of(1) > 0.5).alias("called"),
    )


def _many_classes() -> Column:
    """Whether a group has more than two classes, as an aggregate that needs no distinct count.

    (y - min) * (max - y) adds up to zero exactly when every y is the smallest or the largest one.
    """
    y = F.col("y").cast("bigint")
    low, high = F.min(y), F.max(y)
    return (low + high) * F.sum(y) - F.sum(y * y) - F.count(y) * low * high > 0


def _grouped(preds: DataFrame, group: Sequence[str], value: Column) -> DataFrame:
    return preds.groupBy(*group).agg(value.alias("value"))


def accuracy_value() -> Column:
    binary, many = _is_hit()
    return F.when(_many_classes(), F.avg(many.cast("int"))).otherwise(F.avg(F.coalesce(binary, F.lit(False)).cast("int")))


def accuracy(preds: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """More than two classes: the most probable class; two classes: p1 above one half."""
    return _grouped(preds, group, accuracy_value())


def balanced_accuracy(preds: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """Mean recall over the classes."""
    recall = lambda hits: F.avg(F.col(hits) / F.col("n"))
    value = F.when(F.count(F.lit(1)) > 2, recall("hits_many")).otherwise(recall("hits_binary"))
    return _by_class(preds, group).groupBy(*group).agg(value.alias("value"))


def auroc_binary(preds: DataFrame, group: Sequence[str] = GROUP, plain_limit: int | None = None) -> DataFrame:
    """Share of (positive, negative) pairs in the right order, ties counting one half.

    Null for a group of one class only, or with a class other than 0 and 1.
    """
    scored = preds.select(*group, p_of(1).alias("score"), "y")
    sums = {"pos": F.col("y").cast("bigint"), "neg": (1 - F.col("y")).cast("bigint"), "odd": (~F.col("y").isin(0, 1)).cast("bigint")}
    running = cumulative_by_value(scored, group, "score", sums, plain_limit)
    won = F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2))
    pairs = F.max("pos_total").cast("double") * F.max("neg_total")
    return running.groupBy(*group).agg(F.when(F.max("odd_total") == 0, F.try_divide(won, pairs)).alias("value"))


def auroc_ovo(preds: DataFrame, n_classes: int, group: Sequence[str] = GROUP, plain_limit: int | None = None) -> DataFrame:
    """Mean over ordered class pairs (a, b) of the AUROC of p_a on the rows of a and b; null if a class is missing.

    Each row is scored once per class, not once per pair: the running count of every class below a score
    is carried along, so all opponents of a class come out of one order.
    """
    classes = range(n_classes)
    scored = preds.select(*group, "y", F.posexplode("probs").alias("a", "score"))
    sums = {f"c{k}": (F.col("y") == k).cast("bigint") for k in classes}
    running = cumulative_by_value(scored, [*group, "a"], "score", sums, plain_limit)
    own = F.get(F.array(*[F.col(f"c{k}") for k in classes]), F.col("a"))
    won = [F.sum(own * (F.col(f"c{k}_below") + F.col(f"c{k}") / 2)).alias(f"won{k}") for k in classes]
    per_class = running.groupBy(*group, "a").agg(*won, *[F.max(f"c{k}_total").alias(f"n{k}") for k in classes])
    own_total = F.get(F.array(*[F.col(f"n{k}") for k in classes]), F.col("a")).cast("double")
    areas = [F.when(F.col("a") != k, F.try_divide(F.col(f"won{k}"), own_total * F.col(f"n{k}"))) for k in classes]
    complete = reduce(lambda x, y: x & y, [F.col(f"n{k}") > 0 for k in classes])
    summed = reduce(lambda x, y: x + y, [F.coalesce(area, F.lit(0.0)) for area in areas])
    marked = per_class.select(*group, F.when(complete, summed).alias("area"))
    mean = F.sum("area") / (n_classes * (n_classes - 1))
    return marked.groupBy(*group).agg(F.when(F.count("area") == n_classes, mean).alias("value"))


def auroc(preds: DataFrame, group: Sequence[str] = GROUP, n_classes: int | None = None) -> DataFrame:
    """One-vs-one for groups with more than two classes, binary for the others.

    Without ``n_classes`` every group is taken by the length of its ``probs``; the lengths are few and are looked up first.
    """
    if n_classes is not None:
        return auroc_binary(preds, group) if n_classes <= 2 else auroc_ovo(preds, n_classes, group)
    group = list(group)
    # an empty or missing array scores nothing, but its group still has a row
    kinds = preds.groupBy(*group).agg(F.coalesce(F.max(F.size("probs")), F.lit(0)).alias("_size"), _many_classes().alias("_many"))
    sizes = [r["_size"] for r in kinds.where("_many and _size > 2").select("_size").distinct().collect()]
    values = auroc_binary(preds, group)
    out = attach(kinds, values, group, "left").withColumn("value", F.when(~F.col("_many"), F.col("value")))
    for size in sizes:
        wide = attach(preds, kinds.where(F.col("_many") & (F.col("_size") == size)).select(*group), group)
        areas = auroc_ovo(wide, size, group).withColumnRenamed("value", "_area")
        out = attach(out, areas, group, "left").withColumn("value", F.coalesce("_area", "value")).drop("_area")
    return out.select(*group, "value")


def cross_entropy_value(mode: str = "reference") -> Column:
    ln = lambda p: F.greatest(F.when(p > 0, F.ln(p)).otherwise(F.lit(-100.0)), F.lit(-100.0))
    p1 = p_of(1)
    binary = -F.avg(F.when(F.col("y") == 1, ln(p1)).otherwise(ln(1 - p1)))
    own = p_of(F.col("y"))
    if mode == "reference":
        many = F.avg(F.ln(total(F.transform("probs", F.exp))) - own)
    else:
        many = -F.avg(ln(own))
    return F.when(_many_classes(), many).otherwise(binary)


def cross_entropy(preds: DataFrame, group: Sequence[str] = GROUP, mode: str = "reference") -> DataFrame:
    """Binary: log loss with the logarithm clamped at -100. More classes: ``logloss`` is the proper loss,
    ``reference`` takes the probabilities for logits and so applies softmax a second time."""
    return _grouped(preds, group, cross_entropy_value(mode))


def brier_value() -> Column:
    return F.avg(total(F.transform("probs", lambda p, k: F.pow(p - F.when(k == F.col("y"), 1.0).otherwise(0.0), 2))))


def brier(preds: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """Mean over rows of the squared distance to the one-hot truth."""
    return _grouped(preds, group, brier_value())


def calibration_error(preds: DataFrame, group: Sequence[str] = GROUP, bins: int = 15) -> DataFrame:
    """Expected gap between confidence and accuracy over equal-width, right-closed confidence bins."""
    confidence = F.array_max("probs")
    hit = (argmax(F.col("probs")) == F.col("y")).cast("int")
    per_bin = (
        preds.select(*group, confidence.alias("confidence"), hit.alias("hit"))
        .withColumn("bin", F.ceil(F.col("confidence") * bins))
        .groupBy(*group, "bin")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("confidence").alias("confidence"), F.sum("hit").alias("hits"))
    )
    gap = F.sum(F.abs(F.col("hits") - F.col("confidence"))) / F.sum("n")
    return per_bin.groupBy(*group).agg(gap.alias("value"))


def average_precision(preds: DataFrame, group: Sequence[str] = GROUP, mode: str = "reference", plain_limit: int | None = None) -> DataFrame:
    """Binary average precision of the thresholded prediction (``reference``) or of the score (``score``)."""
    if mode == "score":
        scored = preds.select(*group, (-p_of(1)).alias("score"), "y")
        odd = (~F.col("y").isin(0, 1)).cast("bigint")  # a third class has no average precision
        running = cumulative_by_value(scored, group, "score", {"n": F.lit(1), "pos": F.col("y").cast("bigint"), "odd": odd}, plain_limit)
        upto = (F.col("pos_below") + F.col("pos")) / (F.col("n_below") + F.col("n"))
        gained = F.sum(F.col("pos") * upto)
        value = F.try_divide(gained, F.max("pos_total").cast("double"))
        return running.groupBy(*group).agg(F.when(F.max("odd_total") == 0, value).alias("value"))
    counts = _by_class(preds, group).groupBy(*group).agg(
        F.count(F.lit(1)).alias("classes"),
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("pos"),
        F.sum("called").alias("called"),
        F.sum(F.when(F.col("y") == 1, F.col("called")).otherwise(0)).alias("found"),
    )
    recall = F.try_divide(F.col("found").cast("double"), F.col("pos"))
    precision = F.coalesce(F.try_divide(F.col("found").cast("double"), F.col("called")), F.lit(0.0))
    value = recall * precision + (1 - recall) * F.col("pos") / F.col("n")
    return counts.select(*group, F.when(F.col("classes") <= 2, value).alias("value"))


def _error() -> Column:
    return F.col("target") - F.col("pred")


def mse_value() -> Column:
    return F.avg(_error() * _error())


def rmse_value() -> Column:
    return F.sqrt(mse_value())


def mae_value() -> Column:
    return F.avg(F.abs(_error()))


def r2_value(mode: str = "reference") -> Column:
    score = 1 - F.try_divide(mse_value(), F.var_pop("pred" if mode == "reference" else "target"))
    return -score if mode == "reference" else score


def r2(preds: DataFrame, group: Sequence[str] = GROUP, mode: str = "reference") -> DataFrame:
    """``proper`` is 1 - residual / total; ``reference`` swaps target and prediction and negates the result."""
    return _grouped(preds, group, r2_value(mode))


def pseudo_metrics(runs: DataFrame, group: Sequence[str], seconds: str) -> DataFrame:
    """Time and dataset count, handled like metrics."""
    return runs.groupBy(*group).agg(
        F.sum(seconds).alias("sum_time"), F.avg(seconds).alias("mean_time"), F.count_distinct("dataset").alias("sum_count")
    )


def score_accuracy(df: DataFrame, score: str, target: str, group: Sequence[str], logits: bool) -> DataFrame:
    """Accuracy of raw scores: logits above 0 or probabilities above one half."""
    return df.groupBy(*group).agg(F.avg((above(F.col(score), logits) == F.col(target)).cast("int")).alias("value"))


# name -> aggregate expression over the predictions of a group; all of them come out of one pass
COLUMN_METRICS: dict[str, Callable[[], Column]] = {
    "acc": accuracy_value,
    "cross_entropy": cross_entropy_value,
    "brier": brier_value,
    "rmse": rmse_value,
    "mse": mse_value,
    "mae": mae_value,
    "r2": r2_value,
}

# name -> function(predictions, group) for metrics that need an order or two steps
TABLE_METRICS: dict[str, Callable[[DataFrame, Sequence[str]], DataFrame]] = {
    "roc": auroc,
    "balanced_acc": balanced_accuracy,
    "ece": calibration_error,
    "average_precision": average_precision,
}


def evaluate(
    preds: DataFrame, names: Sequence[str], group: Sequence[str] = GROUP,
    own: dict[str, Callable[[], Column]] | None = None,
) -> DataFrame:
    """Long table (group, metric, value) of the named metrics; ``own`` adds metrics of the caller."""
    expressions = COLUMN_METRICS | (own or {})
    simple = [name for name in names if name in expressions]
    frames = []
    if simple:
        wide = preds.groupBy(*group).agg(*[expressions[name]().alias(name) for name in simple])
        frames.append(wide.unpivot(list(group), simple, "metric", "value"))
    for name in names:
        if name not in expressions:
            frames.append(TABLE_METRICS[name](preds, group).select(*group, F.lit(name).alias("metric"), "value"))
    return reduce(DataFrame.unionByName, frames)
