"""Column expressions over arrays of class probabilities or scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def softmax(scores: Column, temperature: float = 1.0) -> Column:
    """Exponentials of the scores, shifted by their maximum, that add up to 1."""
    top = F.array_max(scores)
    raised = F.transform(scores, lambda x: F.exp((x - top) / F.lit(float(temperature))))
    return F.transform(raised, lambda x: x / total(raised))


def argmax(values: Column) -> Column:
    """Index of the first largest entry, from 0."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def rotate(values: Column, shift: Column | int) -> Column:
    """Move the first ``shift`` entries to the end."""
    shift = F.lit(shift) if isinstance(shift, int) else shift
    return F.concat(F.slice(values, shift + 1, F.size(values) - shift), F.slice(values, F.lit(1), shift))


def pad(values: Column, width: int) -> Column:
    """Fill up with zeros to a fixed width."""
    missing = F.greatest(F.lit(width) - F.size(values), F.lit(0))
    return F.concat(values, F.array_repeat(F.lit(0.0), missing))


def above(score: Column, logits: bool = False) -> Column:
    """0/1 decision: a logit above 0, or a probability above one half."""
    return F.when(score > (0.0 if logits else 0.5), 1).otherwise(0)
