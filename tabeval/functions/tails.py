"""Tail probabilities that Spark has no function for; applied to one row per test."""

from __future__ import annotations

import math
from functools import lru_cache

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def normal_tail(z: float) -> float:
    """P(Z > z)."""
    return 0.5 * math.erfc(z / math.sqrt(2.0))


@lru_cache(maxsize=64)
def _signed_rank_counts(n: int) -> tuple[int, ...]:
    """How many subsets of 1..n have each rank sum."""
    counts = [1] + [0] * (n * (n + 1) // 2)
    for rank in range(1, n + 1):
        for s in range(len(counts) - 1, rank - 1, -1):
            counts[s] += counts[s - rank]
    return tuple(counts)


@lru_cache(maxsize=256)
def _rank_sum_counts(m: int, n: int) -> tuple[int, ...]:
    """How many arrangements of m and n values give each number of wins of the first group."""
    table = [[0] * (m * n + 1) for _ in range(m + 1)]
    table[0][0] = 1
    # choose m of the m + n ranks; a choice of the rank r as the i-th smallest adds r - i wins
    for rank in range(1, m + n + 1):
        for chosen in range(min(m, rank), 0, -1):
            wins = rank - chosen
            if wins > n:
                continue
            for s in range(m * n, wins - 1, -1):
                table[chosen][s] += table[chosen - 1][s - wins]
    return tuple(table[m])


def _from_counts(counts: tuple[int, ...], statistic: int, alternative: str) -> float:
    total = sum(counts)
    low, high = sum(counts[: statistic + 1]) / total, sum(counts[statistic:]) / total
    return {"less": low, "greater": high}.get(alternative, min(1.0, 2 * min(low, high)))


def _from_normal(distance: float, sigma: float, alternative: str) -> float | None:
    """Normal approximation with continuity correction."""
    if not sigma or math.isnan(sigma):
        return None
    if alternative == "greater":
        return normal_tail((distance - 0.5) / sigma)
    if alternative == "less":
        return normal_tail(-(distance + 0.5) / sigma)
    shift = math.copysign(0.5, distance) if distance else 0.0
    return min(1.0, 2 * normal_tail(abs((distance - shift) / sigma)))


EXACT_BELOW = 50  # fixed value: sample size from which the normal approximation is used


@F.pandas_udf(DoubleType())
def signed_rank_p(
    v: pd.Series, n: pd.Series, mu: pd.Series, sigma: pd.Series, clean: pd.Series, alternative: pd.Series
) -> pd.Series:
    """P-value of a signed-rank sum; exact for small samples without ties and zeros."""

    def one(v, n, mu, sigma, clean, alternative):
        if pd.isna(v) or not n:
            return None
        if clean and n < EXACT_BELOW:
            return _from_counts(_signed_rank_counts(int(n)), int(v), alternative)
        return _from_normal(v - mu, sigma, alternative)

    return pd.Series([one(*row) for row in zip(v, n, mu, sigma, clean, alternative)], dtype="float64")


@F.pandas_udf(DoubleType())
def rank_sum_p(
    w: pd.Series, m: pd.Series, n: pd.Series, mu: pd.Series, sigma: pd.Series, clean: pd.Series, alternative: pd.Series
) -> pd.Series:
    """P-value of a rank sum of two groups; exact for small groups without ties."""

    def one(w, m, n, mu, sigma, clean, alternative):
        if pd.isna(w) or not m or not n:
            return None
        if clean and m < EXACT_BELOW and n < EXACT_BELOW:
            return _from_counts(_rank_sum_counts(int(m), int(n)), int(w), alternative)
        return _from_normal(w - mu, sigma, alternative)

    return pd.Series([one(*row) for row in zip(w, m, n, mu, sigma, clean, alternative)], dtype="float64")


def f_tail(f: float, df1: float, df2: float) -> float:
    """P(F > f), by the continued fraction of the incomplete beta function."""
    if math.isnan(f):
        return float("nan")
    x, a, b = df2 / (df2 + df1 * f), df2 / 2.0, df1 / 2.0
    if x <= 0.0 or x >= 1.0:
        return 0.0 if x <= 0.0 else 1.0
    swap = x > (a + 1) / (a + b + 2)
    if swap:
        x, a, b = 1.0 - x, b, a
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    c, d = 1.0, 1.0 / (1.0 - (a + b) * x / (a + 1.0) or 1e-300)
    fraction = d
    for i in range(1, 500):
        even = i * (b - i) * x / ((a + 2 * i - 1) * (a + 2 * i))
        odd = -(a + i) * (a + b + i) * x / ((a + 2 * i) * (a + 2 * i + 1))
        for term in (even, odd):
            d = 1.0 / (1.0 + term * d or 1e-300)
            c = 1.0 + term / c or 1e-300
            fraction *= c * d
        if abs(c * d - 1.0) < 1e-14:
            break
    return 1.0 - front * fraction if swap else front * fraction
