"""Many binary logistic regressions over the same rows, fitted side by side.

A search fits every parameter set once per fold. Each fit needs only sums over its rows - loss, gradient and second derivatives - so one
pass over the rows, written once, gives a Newton step for all sets and folds together, and some ten passes fit them all. The target
is MLlib's: mean log loss plus a penalty on the weights of inputs divided by their deviation, the intercept free.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabeval.session import scratch_path

MAX_INPUTS = 64  # second derivatives are a square table per model
TOLERANCE = 1e-9  # of the target, relative; ends a fit
NO_FOLD = -1  # a model that is fitted on all rows
BLOCK_ROWS = 4_000
RANGE_ROWS = 400_000  # margins that are sorted together
MAX_RANGES = 4_000
SAMPLE_BLOCKS = 64  # from which ranges are cut
DEALT = pa.schema([("fit", pa.int32()), ("part", pa.int32()), ("z", pa.binary()), ("y", pa.binary())])
LABEL, FOLD = "y", "_fold"


@dataclass
class Scale:
    """What the rows outside one fold say of the numeric inputs: the value for holes, and the range that becomes 0 to 1."""

    fill: list[float]
    low: list[float]
    high: list[float]


@dataclass
class Table:
    """Rows with their fold, what was learned of them, and the same rows written once as blocks of numbers."""

    rows: DataFrame
    blocks: DataFrame
    numeric: list[str]
    categories: dict[str, list[str]]
    scales: dict[int, Scale]
    counts: dict[int, int]  # rows outside each fold

    @property
    def width(self) -> int:
        return len(self.numeric) + sum(map(len, self.categories.values()))


@dataclass
class Fit:
    """A model under way: weights of the scaled inputs, the intercept last."""

    fold: int
    penalty: float
    l1: bool
    intercept: bool
    max_iter: int
    weights: np.ndarray
    deviation: np.ndarray = field(default_factory=lambda: np.zeros(0))
    target: float = np.inf
    start: np.ndarray | None = None  # where the last accepted step began, and that step
    step: np.ndarray | None = None
    passes: int = 0
    done: bool = False


def _clean(c: str) -> Column:
    return F.when(~F.isnan(c), F.col(c))


def _outside(per_fold: dict[int, dict], fold: int) -> list[dict]:
    return [row for f, row in per_fold.items() if f != fold]


def _scale(rows: list[dict], numeric: Sequence[str]) -> Scale:
    out = Scale([], [], [])
    for i, c in enumerate(numeric):
        known = [row for row in rows if row[f"n{i}"]]
        if not known:
            raise ValueError(f"{c} has no value outside a fold")
        out.fill.append(sum(row[f"s{i}"] for row in known) / sum(row[f"n{i}"] for row in known))
        out.low.append(min(row[f"a{i}"] for row in known))
        out.high.append(max(row[f"b{i}"] for row in known))
    return out


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows as bytes: inputs, label and fold, so that a pass reads numbers and no rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            *inputs, y, own = [c.to_numpy(zero_copy_only=False) for c in batch.slice(start, BLOCK_ROWS).columns]
            cells = [np.stack(inputs, axis=0).astype(float).tobytes(), y.astype(np.int8).tobytes(), own.astype(np.int32).tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([cell], pa.binary()) for cell in cells], names=["x", "y", "own"])


def table(rows: DataFrame, numeric: Sequence[str], categorical: Sequence[str], folds: int) -> Table | None:
    """The rows (inputs, ``y``, ``_fold``) written once as blocks, and the scales of every fold from one aggregation; None where the
    labels are not 0 and 1, or the inputs are too many."""
    facts = [F.count(F.lit(1)).alias("rows"), F.bool_and(F.coalesce(F.col(LABEL).isin(0, 1), F.lit(False))).alias("binary")]
    for i, c in enumerate(numeric):
        facts += [F.count(_clean(c)).alias(f"n{i}"), F.sum(_clean(c)).alias(f"s{i}"), F.min(_clean(c)).alias(f"a{i}"), F.max(_clean(c)).alias(f"b{i}")]
    facts += [F.collect_set(F.col(c).cast("string")).alias(f"c{i}") for i, c in enumerate(categorical)]
    if categorical:
        most = rows.agg(*[F.approx_count_distinct(c).alias(c) for c in categorical]).first()
        if len(numeric) + sum(most) > MAX_INPUTS:
            return None
    per_fold = {row[FOLD]: row.asDict() for row in rows.groupBy(FOLD).agg(*facts).collect()}
    if not per_fold or len(numeric) > MAX_INPUTS or not all(row["binary"] for row in per_fold.values()):
        return None
    categories = {c: sorted({v for row in per_fold.values() for v in row[f"c{i}"]}) for i, c in enumerate(categorical)}
    wanted = [*range(folds), NO_FOLD]
    scales = {f: _scale(_outside(per_fold, f), numeric) for f in wanted}
    counts = {f: sum(row["rows"] for row in _outside(per_fold, f)) for f in wanted}
    hot = [F.coalesce(F.col(c).cast("string") == v, F.lit(False)).cast("double") for c, values in categories.items() for v in values]
    sent = rows.select(*[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(numeric)], *[h.alias(f"_hot{i}") for i, h in enumerate(hot)], LABEL, FOLD)
    path = scratch_path(rows.sparkSession, "blocks")
    sent.mapInArrow(_pack, "x binary, y binary, own binary").write.parquet(path)
    return Table(rows, rows.sparkSession.read.parquet(path), list(numeric), categories, scales, counts)


def _unpack(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for x, y, own in zip(*batch.columns):
            labels = np.frombuffer(y.as_py(), np.int8)
            yield np.frombuffer(x.as_py()).reshape(width, len(labels)), labels, np.frombuffer(own.as_py(), np.int32)


def _scaled(read: np.ndarray, scale: Scale) -> np.ndarray:
    """Inputs (one row of the array each) with holes filled and ranges from 0 to 1, and ones for the intercept."""
    x = np.ones((len(read) + 1, read.shape[1]))
    x[:-1] = read
    for j, (fill, low, high) in enumerate(zip(scale.fill, scale.low, scale.high)):
        x[j] = (np.where(np.isnan(read[j]), fill, read[j]) - low) / (high - low) if high > low else 0.5
    return x


def _by_fold(fits: Sequence[Fit]) -> dict[int, tuple[list[int], np.ndarray]]:
    places: dict[int, list[int]] = {}
    for k, fit in enumerate(fits):
        places.setdefault(fit.fold, []).append(k)
    return {f: (ks, np.stack([fits[k].weights for k in ks])) for f, ks in places.items()}


def _sums(data: Table, fits: Sequence[Fit]) -> list[np.ndarray]:
    """For each fit the loss, the gradient and the second derivatives at its weights, summed over the rows outside its fold."""
    width, scales, by_fold, n_fits = data.width, data.scales, _by_fold(fits), len(fits)
    size = width + 1
    length = 1 + size + size * size

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n_fits, length))
        for read, labels, own in _unpack(batches, width):
            for f, (ks, weights) in by_fold.items():
                counted = own != f
                x, y = _scaled(read[:, counted], scales[f]), labels[counted]
                z = weights @ x
                e = np.exp(-np.abs(z))
                p = np.where(z >= 0, 1.0, e) / (1.0 + e)
                total[ks, 0] += (np.log1p(e) + np.maximum(z, 0.0) - y * z).sum(axis=1)
                total[ks, 1 : 1 + size] += (p - y) @ x.T
                for k, second in zip(ks, p * (1.0 - p)):
                    total[k, 1 + size :] += ((x * second) @ x.T).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["slot", "value"])

    summed = data.blocks.mapInArrow(add, "slot bigint, value double").groupBy("slot").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(n_fits * length)
    for row in summed:
        out[row["slot"]] = row["value"]
    return list(out.reshape(n_fits, length))


def areas(data: Table, fits: Sequence[Fit]) -> list[float | None]:
    """For each fit the exact share of (positive, negative) pairs of its fold in the right order, ties counting one half.

    Margins travel as bytes to the range they lie in, and each range is sorted by itself. The cuts come from some blocks: they decide
    how even the ranges are, not the result. None where a fold has one class.
    """
    width, scales, by_fold = data.width, data.scales, _by_fold(fits)
    held = max(data.counts[NO_FOLD] - data.counts[fit.fold] for fit in fits)
    n_ranges = max(1, min(MAX_RANGES, -(-held // RANGE_ROWS)))

    def margins(blocks: Iterator[tuple]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for read, labels, own in blocks:
            for f, (ks, weights) in by_fold.items():
                mine = own == f
                for k, z in zip(ks, weights @ _scaled(read[:, mine], scales[f])):
                    yield k, z, labels[mine]

    cuts: list[np.ndarray] = [np.zeros(0)] * len(fits)
    if n_ranges > 1:
        share = min(1.0, 2 * SAMPLE_BLOCKS * BLOCK_ROWS / max(data.counts[NO_FOLD], 1))
        sample = data.blocks.sample(share, 0).limit(SAMPLE_BLOCKS).toArrow().to_batches()
        seen: dict[int, list[np.ndarray]] = {}
        for k, z, _ in margins(_unpack(iter(sample), width)):
            seen.setdefault(k, []).append(z)
        for k, parts in seen.items():
            whole = np.concatenate(parts)
            cuts[k] = np.unique(np.quantile(whole, np.arange(1, n_ranges) / n_ranges)) if len(whole) else cuts[k]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        waiting = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for k, parts in kept.items():
                z, y = (np.concatenate(side) for side in zip(*parts))
                part = np.searchsorted(cuts[k], z, side="left")
                order = np.argsort(part, kind="stable")
                z, y, part = z[order], y[order], part[order]
                edges = np.flatnonzero(np.diff(part, prepend=-1))
                rows = [(k, int(part[a]), z[a:b].tobytes(), y[a:b].tobytes()) for a, b in zip(edges, [*edges[1:], len(z)])]
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(("fit", "part", "z", "y"), row)) for row in rows], schema=DEALT)
            kept.clear()

        for k, z, y in margins(_unpack(batches, width)):
            kept.setdefault(k, []).append((z, y))
            waiting += len(z)
            if waiting >= RANGE_ROWS:
                yield from flush()
                waiting = 0
        yield from flush()

    def judge(key: tuple, dealt: pa.Table) -> pa.Table:
        z = np.concatenate([np.frombuffer(cell.as_py()) for cell in dealt["z"]])
        y = np.concatenate([np.frombuffer(cell.as_py(), np.int8) for cell in dealt["y"]])
        values, place = np.unique(z, return_inverse=True)
        pos, neg = (np.bincount(place[y == c], minlength=len(values)).astype(float) for c in (1, 0))
        won = float((pos * (np.cumsum(neg) - neg / 2)).sum())
        return pa.table({"fit": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int32()), "pos": [pos.sum()], "neg": [neg.sum()], "won": [won]})

    dealt = data.blocks.mapInArrow(deal, "fit int, part int, z binary, y binary")
    found = dealt.groupBy("fit", "part").applyInArrow(judge, "fit int, part int, pos double, neg double, won double").collect()
    out: list[float | None] = []
    for k in range(len(fits)):
        parts = sorted((r["part"], r["pos"], r["neg"], r["won"]) for r in found if r["fit"] == k)
        below = won = 0.0
        for _, pos, neg, inside in parts:
            won, below = won + inside + pos * below, below + neg
        pairs = below * sum(p[1] for p in parts)
        out.append(won / pairs if pairs else None)
    return out


def _lasso_step(weights: np.ndarray, gradient: np.ndarray, second: np.ndarray, penalties: np.ndarray) -> np.ndarray:
    """The step that minimises the quadratic model plus the sum of penalties times absolute weights, by coordinates."""
    step = np.zeros_like(weights)
    for _ in range(10_000):
        moved = 0.0
        for j in range(len(weights)):
            if second[j, j] <= 0:
                continue
            slope = gradient[j] + second[j] @ step
            free = weights[j] + step[j] - slope / second[j, j]
            new = np.sign(free) * max(abs(free) - penalties[j] / second[j, j], 0.0) - weights[j]
            moved, step[j] = max(moved, abs(new - step[j])), new
        if moved < 1e-12 * (1.0 + np.abs(weights + step).max()):
            break
    return step


def _advance(fit: Fit, sums: np.ndarray, n_rows: int) -> None:
    """Judge the last step by the sums at the present weights, and take the next one; half the last step if the target grew."""
    size = len(fit.weights)
    loss, gradient, second = sums[0] / n_rows, sums[1 : 1 + size] / n_rows, sums[1 + size :].reshape(size, size) / n_rows
    if not fit.passes:  # at weights of zero the second derivatives are a quarter of the moments
        mean, square = 4 * second[-1, :-1], 4 * np.diag(second)[:-1]
        variance = (square - mean**2) * n_rows / max(n_rows - 1, 1)
        fit.deviation = np.sqrt(np.where(variance > 1e-14, variance, 0.0))
    fit.passes += 1
    used = np.append(fit.deviation > 0, fit.intercept)
    scaled = np.append(fit.deviation, 0.0) * fit.weights
    cost = fit.penalty * (np.abs(scaled).sum() if fit.l1 else 0.5 * (scaled**2).sum())
    target = loss + cost
    if fit.step is None and not np.isfinite(target):
        raise ValueError("inputs of a logistic regression must be finite")
    if not np.isfinite(target) or target > fit.target + 1e-12 * abs(fit.target):
        fit.step = fit.step / 2
        fit.weights = fit.start + fit.step
        fit.done = fit.passes > fit.max_iter or np.abs(fit.step).max() < 1e-12
        if fit.done:
            fit.weights = fit.start
        return
    settled = fit.target - target <= TOLERANCE * abs(target)
    fit.target = target
    if settled or fit.passes > fit.max_iter:
        fit.done = True
        return
    strength = fit.penalty * np.append(fit.deviation, 0.0)
    step = np.zeros(size)
    inner = np.ix_(used, used)
    if fit.l1 and fit.penalty:
        step[used] = _lasso_step(fit.weights[used], gradient[used], second[inner], strength[used])
    else:
        pull = strength * np.append(fit.deviation, 0.0)
        hessian = second[inner] + np.diag(pull[used])
        step[used] = -np.linalg.pinv(hessian, rcond=1e-13, hermitian=True) @ (gradient + pull * fit.weights)[used]
    fit.start, fit.step, fit.weights = fit.weights, step, fit.weights + step


def fit_all(data: Table, wanted: Sequence[tuple[int, LogisticRegression]]) -> list[Fit]:
    """A fit for each fold and setting; every pass over the rows moves all that have not ended."""
    fits = [
        Fit(f, s.getRegParam(), s.getElasticNetParam() > 0, s.getFitIntercept(), s.getMaxIter(), np.zeros(data.width + 1))
        for f, s in wanted
    ]
    while moving := [fit for fit in fits if not fit.done]:
        for fit, sums in zip(moving, _sums(data, moving)):
            _advance(fit, sums, data.counts[fit.fold])
    return fits


def margin(data: Table, fit: Fit) -> Column:
    """The log odds of a row as an expression over the inputs as they were."""
    scale, terms = data.scales[fit.fold], [F.lit(float(fit.weights[-1]))]
    for j, c in enumerate(data.numeric):
        spread = scale.high[j] - scale.low[j]
        filled = F.coalesce(_clean(c), F.lit(scale.fill[j]))
        terms.append(((filled - scale.low[j]) / spread if spread else F.lit(0.5)) * float(fit.weights[j]))
    hot = [(c, v) for c, values in data.categories.items() for v in values]
    terms += [F.when(F.col(c).cast("string") == v, float(w)).otherwise(0.0) for (c, v), w in zip(hot, fit.weights[len(data.numeric) :])]
    return reduce(lambda a, b: a + b, terms)


class LogitModel(Model):
    """A fitted model over the inputs as they were, with the columns of MLlib's."""

    def __init__(self, data: Table, fit: Fit):
        super().__init__()
        self.data, self.fitted = data, fit

    def _transform(self, dataset: DataFrame) -> DataFrame:
        numbers = dataset.withColumns({f"_x{i}": F.col(c).cast("double") for i, c in enumerate(self.data.numeric)})
        renamed = replace(self.data, numeric=[f"_x{i}" for i in range(len(self.data.numeric))])
        scored = numbers.withColumn("_margin", margin(renamed, self.fitted))
        share = 1 / (1 + F.exp(-F.col("_margin")))
        return scored.withColumns({
            "rawPrediction": array_to_vector(F.array(-F.col("_margin"), F.col("_margin"))),
            "probability": array_to_vector(F.array(1 - share, share)),
            "prediction": (F.col("_margin") > 0).cast("double"),
        }).drop("_margin", *renamed.numeric)
