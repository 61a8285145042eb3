"""Tables as column-per-relation triples (col, row_id, val) and queries over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def columns_by_rows(df: DataFrame, row_id: str, columns: Sequence[str]) -> DataFrame:
    """The product of the column names and the row ids. Names are few and known, so no join is needed."""
    return df.select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("col"), F.col(row_id).alias("row_id"))


def to_sixnf(df: DataFrame, row_id: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One triple per cell; a missing cell keeps its triple, with a null value and ``missing`` set."""
    columns = list(columns or [c for c in df.columns if c != row_id])
    texts = df.select(F.col(row_id).alias("row_id"), *[F.col(c).cast("string").alias(c) for c in columns])
    cells = texts.unpivot(["row_id"], columns, "col", "val")
    return cells.select("col", "row_id", "val", F.col("val").isNull().alias("missing"))


def from_sixnf(triples: DataFrame, types: dict[str, str]) -> DataFrame:
    """The wide table again: one row per row id, columns cast to their types."""
    wide = triples.groupBy("row_id").pivot("col", list(types)).agg(F.first("val", ignorenulls=True))
    return wide.select("row_id", *[F.col(c).try_cast(kind).alias(c) for c, kind in types.items()])


def relation(triples: DataFrame, column: str, row: str = "row_id", value: str = "val") -> DataFrame:
    """The binary relation of one column; missing cells are not in it."""
    present = (F.col("col") == column) & F.col("val").isNotNull()
    return triples.where(present).select(F.col("row_id").alias(row), F.col("val").alias(value))


def rows_where(triples: DataFrame, column: str, condition: Column) -> DataFrame:
    """All cells of the rows whose named column satisfies a condition on ``val``."""
    rows = triples.where((F.col("col") == column) & condition).select("row_id")
    return triples.join(rows, "row_id", "left_semi")


def join_on_value(left: DataFrame, right: DataFrame, value: str) -> DataFrame:
    """Two column relations that share a variable: their rows with equal values."""
    return left.join(right, value)


def exists(df: DataFrame, kept: Sequence[str]) -> DataFrame:
    """Variables that are not kept are projected out; what remains is a set."""
    return df.select(*kept).distinct()
