"""Aggregating scores of many methods on many datasets - matrices, ranks, wins and tests.

Scores are long tables (dataset, method, [split,] value). After the first aggregation there is one row per
dataset and method, so a window over one dataset holds as many rows as there are methods.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabeval.functions.tails import f_tail, rank_sum_p, signed_rank_p
from tabeval.operators.ranks import cumulative_by_value, exact_quantiles, first_per_group

RANK_DIGITS = 3  # fixed value: scores are compared after rounding


def _add_up(aggregator: str):
    return F.avg if aggregator == "mean" else F.sum


def score_rollup(scores: DataFrame, aggregator: str = "mean") -> DataFrame:
    """Scores (method, position, dataset, split, value) rolled up over splits, datasets and positions.

    Levels: ``dataset_position`` over splits, ``position`` over datasets, ``dataset`` over positions, and
    ``overall`` over the position values. Missing values are left out.
    """
    add = _add_up(aggregator)
    cells = scores.groupBy("method", "position", "dataset").agg(add("value").alias("value"))
    positions = cells.groupBy("method", "position").agg(add("value").alias("value"))
    datasets = cells.groupBy("method", "dataset").agg(add("value").alias("value"))
    overall = positions.groupBy("method").agg(add("value").alias("value"))
    levels = {"dataset_position": cells, "position": positions, "dataset": datasets, "overall": overall}
    frames = [df.withColumn("level", F.lit(name)) for name, df in levels.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def metric_matrix(scores: DataFrame, methods: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """Datasets by methods with mean and sample deviation over splits; of repeated rows the first in ``order`` counts."""
    if order is not None:
        scores = first_per_group(scores, ["dataset", "method", "split"], order, 1)
    return (
        scores.groupBy("dataset")
        .pivot("method", list(methods))
        .agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    )


EXACT_SUM = "decimal(38,18)"


def _exact_mean(value: str) -> Column:
    """The mean of the decimal numbers as written, whatever the order of addition; the plain mean if one has no such decimal.

    A plain mean changes in its last digit with the order in which tasks add, and so does what it is rounded to.
    """
    number = F.col(value).try_cast(EXACT_SUM)
    mean = F.try_divide(F.try_sum(number), F.count(number)).cast("double")
    kept = F.bool_and(F.coalesce(number.cast("double") == F.col(value), F.col(value).isNull()))
    return F.coalesce(F.when(kept, mean), F.avg(value))


def per_dataset(scores: DataFrame) -> DataFrame:
    """One value per dataset and method: the mean over splits."""
    return scores.groupBy("dataset", "method").agg(_exact_mean("value").alias("value"))


def mask_slow_methods(cells: DataFrame, times: DataFrame, budget_s: float) -> DataFrame:
    """Null out a method everywhere when its mean time is above twice the budget."""
    mean_time = times.groupBy("method").agg(F.avg("value").alias("_mean_time"))
    slow = F.coalesce(F.col("_mean_time") > 2 * budget_s, F.lit(False))
    return cells.join(mean_time, "method", "left").select(
        "dataset", "method", F.when(~slow, F.col("value")).alias("value")
    )


# fixed values: what stands for a missing score, and whether more is better
SENTINELS = {"cross_entropy": (100.0, False), "time": (None, False)}
DEFAULT_SENTINEL = (-1.0, True)


def fill_missing(cells: DataFrame, metric: str, methods: Sequence[str]) -> tuple[DataFrame, bool]:
    """A cell for every dataset and method, missing ones with the metric's sentinel, and the metric's direction."""
    sentinel, higher_is_better = SENTINELS.get(metric, DEFAULT_SENTINEL)
    wide = cells.groupBy("dataset").agg(*[F.max(F.when(F.col("method") == m, F.col("value"))).alias(m) for m in methods])
    full = wide.unpivot(["dataset"], list(methods), "method", "value")
    if sentinel is not None:
        full = full.withColumn("value", F.coalesce("value", F.lit(sentinel)))
    return full, higher_is_better


def ranks(cells: DataFrame, higher_is_better: bool = True, digits: int = RANK_DIGITS) -> DataFrame:
    """Rank of each method within its dataset after rounding; ties share their mean rank."""
    rounded = cells.withColumn("_rounded", F.round("value", digits))
    key = F.col("_rounded").desc_nulls_last() if higher_is_better else F.col("_rounded").asc_nulls_last()
    place = F.rank().over(Window.partitionBy("dataset").orderBy(key))
    peers = F.count(F.lit(1)).over(Window.partitionBy("dataset", "_rounded"))
    return rounded.withColumn("rank", place + (peers - 1) / 2.0).drop("_rounded")


def ranks_and_wins(ranked: DataFrame) -> DataFrame:
    """Mean rank and wins per method; a shared first place is not a win."""
    return ranked.groupBy("method").agg(F.avg("rank").alias("mean_rank"), F.count_if(F.col("rank") == 1).alias("wins"))


def win_tie_loss(cells: DataFrame, reference: str, higher_is_better: bool = True) -> DataFrame:
    """How often each method beats, equals or loses to the reference method on the same dataset."""
    theirs = cells.where(F.col("method") == reference).select("dataset", F.col("value").alias("_ref"))
    gap = (F.col("value") - F.col("_ref")) * (1 if higher_is_better else -1)
    counted = (F.col("method") != reference) & gap.isNotNull()
    return (
        cells.join(theirs, "dataset")
        .groupBy("method")
        .agg(
            F.count_if(counted & (gap > 0)).alias("wins"),
            F.count_if(counted & (gap == 0)).alias("ties"),
            F.count_if(counted & (gap < 0)).alias("losses"),
        )
    )


def result_table(metrics: dict[str, DataFrame], times: DataFrame, methods: Sequence[str], budget_s: float, split: int) -> DataFrame:
    """Long results: mean score, mean rank and wins of each method and metric, beside its real mean time."""
    real = times.groupBy("method").agg(F.avg("value").alias("real_time"))
    frames = []
    for metric, cells in metrics.items():
        means = cells.groupBy("method").agg(F.avg("value").alias("default"))
        filled, better = fill_missing(mask_slow_methods(cells, times, budget_s), metric, methods)
        table = means.join(ranks_and_wins(ranks(filled, better)), "method")
        wide = table.select(
            "method", "default", F.col("mean_rank").alias("rank_"), F.col("wins").cast("double").alias("wins_")
        )
        frames.append(wide.unpivot(["method"], ["default", "rank_", "wins_"], "ranking", "value").withColumn("metric", F.lit(metric)))
    whole = reduce(DataFrame.unionByName, frames).join(real, "method", "left")
    return whole.withColumns({"time": F.lit(float(budget_s)), "split_number": F.lit(split)})


def summary_table(cells: DataFrame, scores: DataFrame, times: DataFrame, methods: Sequence[str], reference: str) -> DataFrame:
    """Report rows by method: every dataset's score, then wins, win/tie/loss, mean, deviation, rank and time."""
    number = lambda c: F.format_string("%.3f", c)
    facts = ranks_and_wins(ranks(cells)).select(
        "method", F.col("wins").cast("string").alias("Wins"), number(F.col("mean_rank")).alias("Mean rank")
    )
    duels = win_tie_loss(cells, reference).select(
        "method", F.format_string("%d/%d/%d", "wins", "ties", "losses").alias("Win/T/L vs reference")
    )
    means = cells.groupBy("method").agg(number(F.avg("value")).alias("Mean"))
    spread = scores.groupBy("dataset", "method").agg(F.stddev_samp("value").alias("_std"))
    spread = spread.groupBy("method").agg(number(F.avg("_std")).alias("Mean std"))
    time = times.groupBy("method").agg(number(F.avg("value")).alias("Mean time (s)"))
    wide = reduce(lambda a, b: a.join(b, "method", "left"), [facts, duels, means, spread, time])
    rows = [c for c in wide.columns if c != "method"]
    long = wide.unpivot(["method"], rows, "row", "text")
    scores_long = cells.select("method", F.col("dataset").cast("string").alias("row"), number(F.col("value")).alias("text"))
    return scores_long.unionByName(long).groupBy("row").pivot("method", list(methods)).agg(F.max("text"))


def best_flags(cells: DataFrame, higher_is_better: bool = True, digits: int = RANK_DIGITS) -> DataFrame:
    """Marks the best rounded value of each dataset; several methods may share it."""
    pick = F.max if higher_is_better else F.min
    rounded = F.round("value", digits)
    best = pick(rounded).over(Window.partitionBy("dataset"))
    return cells.withColumn("is_best", F.coalesce(rounded == best, F.lit(False)))


def label_conflicts(preds: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Rows for which methods were given different labels."""
    return (
        preds.groupBy(*keys)
        .agg(F.min(label).alias("low"), F.max(label).alias("high"))
        .where(F.col("low") != F.col("high"))
    )


def result_dump(metrics: dict[str, DataFrame], methods: Sequence[str], profiles: DataFrame) -> DataFrame:
    """One row per dataset: a column per method and metric, and the dataset's profile."""
    frames = [cells.withColumn("_key", F.concat("method", F.lit("_" + name))) for name, cells in metrics.items()]
    keys = [f"{m}_{name}" for name in metrics for m in methods]
    wide = reduce(DataFrame.unionByName, frames).groupBy("dataset").pivot("_key", keys).agg(F.max("value"))
    return wide.join(profiles, "dataset", "left")


def difference_table(wide: DataFrame, a: str, b: str, by: Sequence[str]) -> DataFrame:
    """Mean, median and deviation of two columns and of their difference, per group."""
    long = wide.withColumn("diff", F.col(a) - F.col(b)).unpivot(list(by), [a, b, "diff"], "model", "value")
    keys = [*by, "model"]
    spread = long.groupBy(*keys).agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("stdv"))
    return spread.join(exact_quantiles(long, keys, "value", {"median": 0.5}), keys, "left")


def with_winner(wide: DataFrame, a: str, b: str) -> DataFrame:
    """Complete rows only, with whether ``a`` won and the name of the winner."""
    win = F.col(a) > F.col(b)
    return wide.dropna().withColumns({"win": win, "winner": F.when(win, a).otherwise(b)})


ALTERNATIVES = ("two.sided", "greater", "less")


def _with_alternatives(df: DataFrame) -> DataFrame:
    return df.withColumn("alternative", F.explode(F.array(*[F.lit(x) for x in ALTERNATIVES])))


def signed_rank_test(df: DataFrame, group: Sequence[str], x: str, y: str, digits: int | None = None, plain_limit: int | None = None) -> DataFrame:
    """Paired signed-rank test of x against y: rank sum V of the positive differences, z and p-values.

    Differences may be rounded first so that equal ones count as ties in spite of floating point.
    """
    gap = F.col(x) - F.col(y)
    gap = gap if digits is None else F.round(gap, digits)
    rows = df.select(*group, gap.alias("d")).where(F.col("d").isNotNull())
    sizes = rows.where(F.col("d") != 0).withColumn("size", F.abs("d"))
    sums = {"n": F.lit(1), "pos": (F.col("d") > 0).cast("bigint")}
    running = cumulative_by_value(sizes, group, "size", sums, plain_limit)
    n = F.max("n_total").cast("double")
    tested = running.groupBy(*group).agg(
        F.sum(F.col("pos") * (F.col("n_below") + (F.col("n") + 1) / 2)).alias("v"),
        F.max("n_total").alias("n"),
        (n * (n + 1) / 4).alias("mu"),
        F.sqrt(n * (n + 1) * (2 * n + 1) / 24 - F.sum(F.pow("n", F.lit(3)) - F.col("n")) / 48).alias("sigma"),
        (F.max("n") == 1).alias("no_ties"),
    )
    zeros = rows.groupBy(*group).agg(F.count_if(F.col("d") == 0).alias("zeros"))
    keys = list(group)
    tested = (tested.join(zeros, keys, "left") if keys else tested.withColumn("zeros", zeros.scalar())).withColumn(
        "z", F.try_divide(F.col("v") - F.col("mu"), F.col("sigma"))
    )
    clean = F.col("no_ties") & (F.col("zeros") == 0)
    p = signed_rank_p("v", "n", "mu", "sigma", clean, "alternative")
    return _with_alternatives(tested).withColumn("p_value", p).drop("mu", "sigma", "no_ties")


def rank_sum_test(df: DataFrame, group: Sequence[str], first: Column, value: str, plain_limit: int | None = None) -> DataFrame:
    """Unpaired rank-sum test of the rows where ``first`` holds against the others: W, z and p-values."""
    sums = {"x": first.cast("bigint"), "y": (~first).cast("bigint")}
    running = cumulative_by_value(df, group, value, sums, plain_limit)
    t = F.col("x") + F.col("y")
    m, n = F.max("x_total").cast("double"), F.max("y_total").cast("double")
    # ranks of the first group minus their smallest possible sum: pairs won, ties counting one half
    won = F.sum(F.col("x") * (F.col("y_below") + F.col("y") / 2))
    ties = F.sum(F.pow(t.cast("double"), F.lit(3)) - t)
    tested = running.groupBy(*group).agg(
        won.alias("w"),
        F.max("x_total").alias("n_x"),
        F.max("y_total").alias("n_y"),
        (m * n / 2).alias("mu"),
        F.sqrt(m * n / 12 * ((m + n + 1) - F.try_divide(ties, (m + n) * (m + n - 1)))).alias("sigma"),
        (F.max(t) == 1).alias("no_ties"),
    )
    tested = tested.withColumn("z", F.try_divide(F.col("w") - F.col("mu"), F.col("sigma")))
    p = rank_sum_p("w", "n_x", "n_y", "mu", "sigma", "no_ties", "alternative")
    return _with_alternatives(tested).withColumn("p_value", p).drop("mu", "sigma", "no_ties")


def one_way_variance(df: DataFrame, factor: str, y: str) -> DataFrame:
    """Sums of squares between and within the levels of one factor, and their F value."""
    levels = df.groupBy(factor).agg(
        F.count(y).alias("n"), F.avg(y).alias("mean"), (F.var_pop(y) * F.count(y)).alias("inside")
    )
    n, k = F.sum("n"), F.count(F.lit(1))
    # around the overall mean: a difference of two large sums would lose the digits that matter
    centre = levels.agg(F.sum(F.col("n") * F.col("mean")) / n).scalar()
    levels = levels.withColumn("gap", F.col("mean") - centre)
    between = F.sum(F.col("n") * F.col("gap") * F.col("gap"))
    facts = levels.agg((k - 1).alias("df_between"), (n - k).alias("df_within"), between.alias("ss_between"), F.sum("inside").alias("ss_within"))
    f = F.try_divide(F.col("ss_between") / F.col("df_between"), F.col("ss_within") / F.col("df_within"))
    return facts.withColumn("f_value", f)


def sequential_variance(df: DataFrame, factors: Sequence[str], y: str) -> DataFrame:
    """Sequential sums of squares of numeric factors: each factor after the ones before it.

    One pass collects the covariances of all factors and y; the rest is a triangular solve of that small matrix.
    """
    names = [*factors, y]
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in names]).dropna()
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    facts = rows.agg(
        F.count(F.lit(1)).alias("n"), *[F.covar_pop(names[i], names[j]).alias(f"c{i}_{j}") for i, j in pairs]
    ).first()
    n = facts["n"]
    moments = np.zeros((len(names), len(names)))
    for i, j in pairs:
        moments[i, j] = moments[j, i] = (facts[f"c{i}_{j}"] or 0.0) * n
    left = moments[-1, -1]
    table, used = [], []
    for place, factor in enumerate(factors):
        used.append(place)
        inner, outer = moments[np.ix_(used, used)], moments[used, -1]
        residual = moments[-1, -1] - outer @ np.linalg.lstsq(inner, outer, rcond=None)[0]
        table.append((factor, 1, max(left - residual, 0.0)))
        left = residual
    free = n - 1 - len(factors)
    scale = left / free if free > 0 else float("nan")
    out = []
    for factor, dof, ss in table:
        f = ss / dof / scale if scale > 0 else float("nan")
        out.append((factor, dof, float(ss), float(ss / dof), float(f), float(f_tail(f, dof, free))))
    out.append(("Residuals", int(free), float(left), float(scale), None, None))
    return df.sparkSession.createDataFrame(out, "factor string, df int, sum_sq double, mean_sq double, f_value double, p_value double")


FIVE_NUMBERS = {"low": 0.0, "p10": 0.1, "q1": 0.25, "median": 0.5, "q3": 0.75, "p90": 0.9, "high": 1.0}


def five_number_summary(df: DataFrame, group: Sequence[str], value: str, plain_limit: int | None = None) -> DataFrame:
    return exact_quantiles(df, group, value, FIVE_NUMBERS, plain_limit)


def trimmed(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Rows between the 10 % and 90 % quantile of their group."""
    limits = exact_quantiles(df, group, value, {"_low": 0.1, "_high": 0.9})
    return df.join(limits, list(group)).where(F.col(value).between(F.col("_low"), F.col("_high"))).drop("_low", "_high")


# fixed values: the metric that decides for each kind of problem
DECIDING_METRIC = {"regression": "r2", "binary": "roc_auc", "multiclass": "roc_auc"}


def leaderboard(scores: DataFrame) -> DataFrame:
    """The best method per dataset by the metric that fits its problem type."""
    table = F.create_map(*[F.lit(x) for pair in DECIDING_METRIC.items() for x in pair])
    fitting = scores.where(F.col("metric") == F.element_at(table, F.col("problem_type")))
    return first_per_group(fitting, ["dataset"], [F.col("value").desc_nulls_last(), F.col("method")], 1)


def budget_curves(
    results: DataFrame, minimum: dict[str, float], carry: Sequence[str], last: float, longer: float, collapse: str | None = None
) -> DataFrame:
    """Scores (method, time, real_time, value) over log10 of the time budget.

    Methods may have a minimum budget, methods in ``carry`` keep their ``last`` result at a ``longer``
    budget, and one method may be collapsed to its mean at time 1.
    """
    for method, low in minimum.items():
        results = results.where((F.col("method") != method) | (F.col("time") >= low))
    carried = results.where(F.col("method").isin(list(carry)) & (F.col("time") == last))
    carried = carried.withColumns({"time": F.lit(float(longer)), "real_time": F.lit(float(longer))})
    curve = results.unionByName(carried).groupBy("method", "time").agg(
        F.avg("value").alias("value"), F.avg("real_time").alias("real_time")
    )
    curve = curve.withColumns({"time_log": F.log10("time"), "real_time_log": F.log10("real_time")})
    if collapse is None:
        return curve
    mean = results.where(F.col("method") == collapse).agg(F.avg("value")).scalar()
    flat = F.col("method") == collapse
    return curve.withColumns(
        {"value": F.when(flat, mean).otherwise(F.col("value")), "real_time_log": F.when(flat, 0.0).otherwise(F.col("real_time_log"))}
    )
