"""Small helpers the operators share: written intermediate tables, Arrow maps and column picking."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabeval.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and safe from lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the names the operator uses; other columns cannot clash with its own.

    A column is matched by its exact spelling; an untyped null column is taken as text.
    """
    kinds = dict(df.dtypes)
    out = []
    for alias, name in columns.items():
        column = F.col(f"`{name}`")
        out.append((column.cast("string") if kinds[name] == "void" else column).alias(alias))
    return df.select(*out)


def arrow_map(df: DataFrame, step: Callable[[pa.RecordBatch], Iterable[dict[str, pa.Array | list]]], schema: str) -> DataFrame:
    """Apply ``step`` to every Arrow batch; it yields columns, each a list or an Arrow array."""
    fields = T._parse_datatype_string(schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns in step(batch):
                yield as_batch(columns, arrow)

    return df.mapInArrow(run, fields)


def carried(docs: DataFrame, key: str, text: str, columns: list[str], more: dict, step: Callable, schema: str) -> tuple:
    """Arguments of arrow_map for a step over (doc_id, text, ...) that hands on all columns of ``docs`` as struct ``row``.

    Key and text are read out of the struct, so the text crosses to Python once.
    """
    frame = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[c.alias(n) for n, c in more.items()])
    extra = list(more)

    def whole(batch: pa.RecordBatch) -> Iterator[dict]:
        row = batch.column("row")
        named = {"doc_id": row.field(key), "text": row.field(text)} | {n: batch.column(n) for n in extra}
        view = pa.RecordBatch.from_arrays([named[c] for c in columns], names=columns)
        for out in step(view):
            yield out | {"row": row}

    return frame, whole, f"{schema}, row {frame.schema['row'].dataType.simpleString()}"


def as_batch(columns: dict, arrow: pa.Schema) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) and c.type == f.type else c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for f, c in ((f, columns[f.name]) for f in arrow)]
    return pa.RecordBatch.from_arrays(arrays, schema=arrow)


def list_array(parts: list, kind: pa.DataType) -> pa.ListArray:
    """A list column from numpy arrays, None for a null list."""
    import numpy as np

    sizes = np.array([0 if p is None else len(p) for p in parts], dtype=np.int64)
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum(sizes, out=offsets[1:])
    full = [p for p in parts if p is not None and len(p)]
    values = pa.array(np.concatenate(full) if full else np.zeros(0, dtype=np.int64), kind)
    mask = pa.array([p is None for p in parts], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=mask)
