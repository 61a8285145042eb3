"""Feature preprocessing, fitted on training rows and applied to all rows.

Each fit is one aggregation that returns one row of statistics, which become constants of the expressions
that transform the rows; the rows themselves are never shuffled.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tabeval.functions.fixed import MAX_FEATURES
from tabeval.functions.probs import pad, rotate
from tabeval.operators.ranks import attach, cumulative_by_value, exact_quantiles, may_sort_groups, with_ordinal
from tabeval.operators.splits import small

STD_OFFSET, CLIP = 0.000001, 100.0  # fixed values of the z-score


def _valid(column: str | Column) -> Column:
    """The value, with NaN turned to null."""
    value = (F.col(column) if isinstance(column, str) else column).cast("double")
    return F.when(~F.isnan(value), value)


def _train(df: DataFrame, train: Column | None) -> DataFrame:
    return df if train is None else df.where(train)


def _facts(df: DataFrame, aggregates: dict[str, Column]) -> dict[str, float | None]:
    """One aggregation, one row."""
    return df.agg(*[expr.alias(name) for name, expr in aggregates.items()]).first().asDict()


def _or_null(value: float | None) -> Column:
    return F.lit(value).cast("double")


def impute_mean(df: DataFrame, columns: Sequence[str], train: Column | None = None) -> DataFrame:
    means = _facts(_train(df, train), {c: F.avg(_valid(c)) for c in columns})
    return df.withColumns({c: F.coalesce(_valid(c), _or_null(means[c])) for c in columns})


MAX_WIDE_CATEGORIES = 1_000


def one_hot(df: DataFrame, column: str, train: Column | None = None) -> DataFrame:
    """A 0/1 column per category seen in training; an unknown category gives zeros, other columns pass through."""
    seen = _train(df, train).select(column).distinct().where(F.col(column).isNotNull()).orderBy(column)
    categories = [row[0] for row in seen.limit(MAX_WIDE_CATEGORIES + 1).collect()]
    if len(categories) > MAX_WIDE_CATEGORIES:
        raise ValueError(f"{column} has too many categories for one column each; use one_hot_sparse")
    flags = {f"{column}_{c}": F.coalesce((F.col(column) == c).cast("double"), F.lit(0.0)) for c in categories}
    return df.withColumns(flags).drop(column)


def one_hot_sparse(df: DataFrame, column: str, train: Column | None = None, name: str | None = None) -> DataFrame:
    """A sparse vector with a place per category seen in training, in the order of the categories; other columns pass through.

    Null and categories that were not seen give a vector without entries; a vector has one place at least. There may be any number
    of categories: they are a table of codes, which is broadcast only if it is small, and a row holds one entry whatever their number.
    """
    seen = _train(df, train).select(column).distinct().where(F.col(column).isNotNull())
    codes = small(with_ordinal(seen, [column], name="_code"))
    size = max(codes.count(), 1)
    name = name or f"{column}_hot"
    # the number of values stands in the column's metadata, so the encoder need not look for it; the code past the last is dropped
    known = {"ml_attr": {"type": "nominal", "num_vals": size + 1, "name": "_code"}}
    coded = df.join(codes, column, "left").withColumn("_code", F.coalesce("_code", F.lit(size)).cast("double"))
    coded = coded.withMetadata("_code", known)
    encoder = OneHotEncoder(inputCol="_code", outputCol=name, dropLast=True, handleInvalid="error")
    return encoder.fit(coded).transform(coded).select(*[F.col(f"`{c}`") for c in df.columns if c != column], name)


def min_max(df: DataFrame, columns: Sequence[str], train: Column | None = None) -> DataFrame:
    """Scale to 0..1 by the training range; a constant column becomes 0 on the training rows."""
    aggregates = {f"{c}_{name}": f(_valid(c)) for c in columns for name, f in (("low", F.min), ("high", F.max))}
    facts = _facts(_train(df, train), aggregates)

    def scaled(c: str) -> Column:
        low, high = facts[f"{c}_low"], facts[f"{c}_high"]
        width = 1.0 if low is None or high == low else high - low
        return (_valid(c) - _or_null(low)) / F.lit(width)

    return df.withColumns({c: scaled(c) for c in columns})


def z_score(df: DataFrame, columns: Sequence[str], train: Column | None = None) -> DataFrame:
    """(x - mean) / (std + offset), clipped; missing values are left out of the statistics."""
    aggregates = {f"{c}_{name}": f(_valid(c)) for c in columns for name, f in (("mean", F.avg), ("std", F.stddev_samp))}
    facts = _facts(_train(df, train), aggregates)

    def scaled(c: str) -> Column:
        z = (_valid(c) - _or_null(facts[f"{c}_mean"])) / (_or_null(facts[f"{c}_std"]) + F.lit(STD_OFFSET))
        return F.when(z.isNotNull(), F.greatest(F.least(z, F.lit(CLIP)), F.lit(-CLIP)))

    return df.withColumns({c: scaled(c) for c in columns})


def masked_stats(df: DataFrame, columns: Sequence[str], mask: Column | None = None, group: Sequence[str] = ()) -> DataFrame:
    """Mean and deviation of the valid (and unmasked) values, and the share of ignored ones; long by column."""
    kept = [F.when(mask, _valid(c)) if mask is not None else _valid(c) for c in columns]
    long = df.select(*group, *[k.alias(c) for k, c in zip(kept, columns)]).unpivot(list(group), list(columns), "col", "value")
    return long.groupBy(*group, "col").agg(
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        (1 - F.count("value") / F.count(F.lit(1))).alias("ignored_share"),
    )


def soft_clip(df: DataFrame, columns: Sequence[str], n_sigma: float = 4.0, train: Column | None = None) -> DataFrame:
    """Pull values outside mean +- n sigma (measured again without the outliers) in by a logarithm."""
    rows = _train(df, train)
    both = (("mean", F.avg), ("std", F.stddev_samp))
    rough = _facts(rows, {f"{c}_{name}": f(_valid(c)) for c in columns for name, f in both})

    def inside(c: str) -> Column:
        reach = _or_null(rough[f"{c}_std"]) * n_sigma
        middle = _or_null(rough[f"{c}_mean"])
        return F.when((_valid(c) <= middle + reach) & (_valid(c) >= middle - reach), _valid(c))

    fine = _facts(rows, {f"{c}_{name}": f(inside(c)) for c in columns for name, f in both})

    def clipped(c: str) -> Column:
        reach = _or_null(fine[f"{c}_std"]) * n_sigma
        middle = _or_null(fine[f"{c}_mean"])
        x = _valid(c)
        raised = F.when(x.isNotNull(), F.greatest(-F.ln(1 + F.abs(x)) + middle - reach, x))
        return F.when(x.isNotNull(), F.least(F.ln(1 + F.abs(raised)) + middle + reach, raised))

    return df.withColumns({c: clipped(c) for c in columns})


def rank_transform(df: DataFrame, value: str, group: Sequence[str] = (), name: str = "rank", plain_limit: int | None = None) -> DataFrame:
    """Number of rows of the group with a value at or below the row's own."""
    if may_sort_groups(df, group, plain_limit):
        upto = F.count(F.col(value)).over(Window.partitionBy(*group).orderBy(value))  # equal values are counted too
        return df.withColumn(name, F.when(F.col(value).isNotNull(), upto))
    counts = cumulative_by_value(df, group, value, plain_limit=plain_limit)
    counts = counts.select(*group, value, (F.col("n_below") + F.col("n")).alias(name))
    return attach(df, counts, [*group, value], "left")


def drop_constant(df: DataFrame, columns: Sequence[str], train: Column | None = None) -> DataFrame:
    """Without the features that have a single value on the training rows."""
    aggregates = {c: F.min(F.col(c)).eqNullSafe(F.max(F.col(c))) for c in columns}
    constant = _facts(_train(df, train), aggregates)
    return df.drop(*[c for c in columns if constant[c]])


def scale_by_used(value: Column, used: int | Column, maximum: int = MAX_FEATURES, square_root: bool = False) -> Column:
    share = (F.lit(used) if isinstance(used, int) else used) / F.lit(maximum)
    return value / (F.sqrt(share) if square_root else share)


def yeo_johnson(x: Column, lam: Column) -> Column:
    """The power transform that also takes negative values."""
    up = F.when(F.abs(lam) < 1e-12, F.ln(1 + x)).otherwise((F.pow(1 + x, lam) - 1) / lam)
    down = F.when(F.abs(lam - 2) < 1e-12, -F.ln(1 - x)).otherwise(-(F.pow(1 - x, 2 - lam) - 1) / (2 - lam))
    return F.when(x >= 0, up).otherwise(down)


FIRST_GRID = np.linspace(-3.0, 5.0, 9)
MOVES = 30  # rounds that look for the first bracket
STEPS = (0.2, 0.02, 0.002)  # of the five exponents around the best one, round by round


def _peak(lams: Sequence[float], scores: Sequence[float]) -> float:
    """Top of the parabola through the best point and its neighbours."""
    top = int(np.argmax(scores))
    if top in (0, len(lams) - 1):
        return float(lams[top])
    h = lams[top] - lams[top - 1]
    below, here, above = scores[top - 1 : top + 2]
    bend = below - 2 * here + above
    return float(lams[top] + (h * (below - above) / (2 * bend) if bend < 0 else 0.0))


def _first_peaks(measure, likelihood, columns: Sequence[str]) -> dict[str, float]:
    """About the best exponent of each column. While it is the last one tried, the search goes on twice as far out."""
    scored: dict[str, dict[float, float]] = {c: {} for c in columns}
    peaks: dict[str, float] = {}
    grids: dict[str, Sequence[float]] = {c: FIRST_GRID for c in columns}
    for _ in range(MOVES):
        again = {}
        for c, rows in measure(grids).items():
            scored[c] |= {r["lam"]: likelihood(r) for r in rows}
            lams = sorted(scored[c])
            if not lams:  # a column that cannot be fitted is left alone
                continue
            top = max(range(len(lams)), key=lambda i: scored[c][lams[i]])
            peaks[c] = lams[top]
            if len(lams) > 1 and top in (0, len(lams) - 1):
                if rows:  # further out nothing is finite otherwise
                    reach = lams[-1] - lams[0]
                    again[c] = lams[top] + (1 if top else -1) * np.linspace(reach / 8, reach, 8)
            elif len(lams) > 1 and lams[top + 1] - lams[top - 1] > 2.0 + 1e-9:
                again[c] = np.linspace(lams[top - 1], lams[top + 1], 9)
            elif len(lams) > 1:
                around = lams[top - 1 : top + 2]
                even = abs(around[0] + around[2] - 2 * around[1]) < 1e-9
                peaks[c] = _peak(around, [scored[c][v] for v in around]) if even else lams[top]
        if not again:
            break
        grids = again
    return peaks


MAX_AGGREGATES = 300  # expressions of one aggregation


def fit_power(df: DataFrame, columns: Sequence[str], train: Column | None = None) -> dict[str, tuple[float, float, float]]:
    """Exponent, mean and deviation per column, by maximum likelihood.

    Every round is one aggregation that scores a few exponents of all columns side by side, without copying a row; the
    next ones lie closer around the peak, and the last round measures the transformed columns.
    """
    names = [f"x{i}" for i in range(len(columns))]
    number = dict(zip(columns, names))
    rows = _train(df, train).select(*[_valid(c).alias(x) for c, x in number.items()])

    def measure(grids: dict[str, Sequence[float]]) -> dict[str, list]:
        asked = [(c, float(lam)) for c, grid in grids.items() for lam in grid]
        found: dict[str, list] = {c: [] for c in grids}
        for low in range(0, len(asked), MAX_AGGREGATES // 2):
            part = asked[low : low + MAX_AGGREGATES // 2]
            moments = []
            for i, (c, lam) in enumerate(part):
                t = yeo_johnson(F.col(number[c]), F.lit(lam))
                moments += [F.var_pop(t).alias(f"var{i}"), F.avg(t).alias(f"mean{i}")]
            for x in {number[c] for c, _ in part}:
                moments += [F.count(x).alias(f"n_{x}"), F.sum(F.signum(x) * F.ln(1 + F.abs(F.col(x)))).alias(f"jacobian_{x}")]
            row = rows.agg(*moments).first()
            for i, (c, lam) in enumerate(part):
                var, x = row[f"var{i}"], number[c]
                if var is not None and np.isfinite(var) and var > 0:
                    found[c].append({"lam": lam, "n": row[f"n_{x}"], "var": var, "mean": row[f"mean{i}"], "jacobian": row[f"jacobian_{x}"]})
        return {c: sorted(known, key=lambda r: r["lam"]) for c, known in found.items()}

    def likelihood(row) -> float:
        return float(-row["n"] / 2 * np.log(row["var"]) + (row["lam"] - 1) * row["jacobian"])

    peaks = _first_peaks(measure, likelihood, columns)
    if not peaks:
        return {}
    for step in STEPS:
        tried = measure({c: [peak + step * i for i in range(-2, 3)] for c, peak in peaks.items()})
        peaks = {c: _peak([r["lam"] for r in known], [likelihood(r) for r in known]) for c, known in tried.items() if known}
    grids = {c: [peak] for c, peak in peaks.items()}
    return {c: (r[0]["lam"], r[0]["mean"], float(np.sqrt(r[0]["var"]))) for c, r in measure(grids).items() if r}


def power_transform(df: DataFrame, columns: Sequence[str], train: Column | None = None) -> DataFrame:
    """Yeo-Johnson transform with fitted exponents, standardized."""
    fitted = fit_power(df, columns, train)
    return df.withColumns(
        {c: (yeo_johnson(_valid(c), F.lit(lam)) - F.lit(mean)) / F.lit(std) for c, (lam, mean, std) in fitted.items()}
    )


QUANTILE_KNOTS = 1_000  # fixed value
TAIL = 1e-7  # fixed value: probabilities are kept this far from 0 and 1


def quantile_normal(df: DataFrame, column: str, train: Column | None = None, knots: int = QUANTILE_KNOTS) -> DataFrame:
    """Map a column to a normal distribution through its quantiles; the knots are one bounded array."""
    rows = _train(df, train).where(_valid(column).isNotNull())
    n = min(knots, rows.count())
    if n < 2:
        return df
    places = np.linspace(0.0, 1.0, n)
    found = rows.agg(F.percentile_approx(_valid(column), [float(p) for p in places], 100_000)).first()[0]
    values = np.array(found, dtype=float)

    @F.pandas_udf(DoubleType())
    def to_normal(x: pd.Series) -> pd.Series:
        # from both sides, so that a value shared by many rows lands in the middle of its steps
        up = np.interp(x, values, places)
        down = -np.interp(-x, -values[::-1], -places[::-1])
        share = np.clip((up + down) / 2, TAIL, 1 - TAIL)
        normal = NormalDist()
        return pd.Series([None if np.isnan(s) else normal.inv_cdf(s) for s in share], dtype="float64")

    return df.withColumn(column, to_normal(_valid(column)))


UNIT_SPREAD = 2 * NormalDist().inv_cdf(0.75)  # distance of the quartiles of a standard normal


def robust_scale(df: DataFrame, columns: Sequence[str], train: Column | None = None) -> DataFrame:
    """(x - median) / quartile distance, scaled so that a normal column gets variance 1."""
    long = _train(df, train).select(*[_valid(c).alias(c) for c in columns]).unpivot([], list(columns), "col", "value")
    limits = exact_quantiles(long, ["col"], "value", {"q1": 0.25, "q2": 0.5, "q3": 0.75}).collect()  # a row per column
    facts = {r["col"]: r for r in limits}

    def scaled(c: str) -> Column:
        width = (facts[c]["q3"] - facts[c]["q1"]) / UNIT_SPREAD
        return (_valid(c) - F.lit(facts[c]["q2"])) / F.lit(width or 1.0)

    return df.withColumns({c: scaled(c) for c in columns if c in facts})


def subsample_features(features: Column, width: int, maximum: int = MAX_FEATURES, seed: int = 0) -> Column:
    """A fixed random choice of at most ``maximum`` features, in their old order."""
    if width <= maximum:
        return features
    chosen = sorted(random.Random(seed).sample(range(width), maximum))
    return F.transform(F.array(*[F.lit(i) for i in chosen]), lambda i: F.get(features, i))


def shift_features(features: Column, shift: int, width: int) -> Column:
    """Rotate the features, then fill up with zeros."""
    return pad(rotate(features, shift), width)


def shift_labels(label: Column, shift: int, classes: int) -> Column:
    return F.pmod(label + F.lit(shift), F.lit(classes))


def unshift_outputs(outputs: Column, shift: int) -> Column:
    """Class scores back in the order of the labels before they were shifted."""
    return rotate(outputs, shift)


FLOAT_MAX = 3.4028234663852886e38  # fixed value: largest single-precision number


def missing_codes(value: Column) -> tuple[Column, Column]:
    """The finite value (0 for NaN) and a code for what was there: NaN -1, +inf 1, -inf 2, otherwise 0."""
    value = F.coalesce(value.cast("double"), F.lit(float("nan")))
    up, down = value == float("inf"), value == -float("inf")
    code = F.when(F.isnan(value), -1).when(up, 1).when(down, 2).otherwise(0)
    filled = F.when(F.isnan(value), 0.0).when(up, FLOAT_MAX).when(down, -FLOAT_MAX).otherwise(value)
    return filled, code


def missing_as_class(column: str, mode: str = "own") -> Column:
    """Missing category as its own class -1, or as 0 (``reference``)."""
    return F.coalesce(F.col(column), F.lit(-1 if mode == "own" else 0))


def zero_missing(column: str) -> Column:
    return F.coalesce(_valid(column), F.lit(0.0))
