"""Dataset catalogs, table descriptions, profiles and suitability filters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabeval.functions.fixed import MAX_CLASSES, MAX_FEATURES, MIN_SAMPLES, SPARK_TO_SQL_TYPES
from tabeval.operators.ranks import cumulative_by_value, first_per_group

INDEX_COLUMNS = ("Unnamed: 0", "_c0", "")


def drop_index_column(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in INDEX_COLUMNS])


def union_catalogs(catalogs: Sequence[DataFrame], order: str, limit: int | None = None) -> DataFrame:
    """Catalogs one behind the other, each in ``order``; ``limit`` keeps the first rows only."""
    numbered = [drop_index_column(c).withColumn("_source", F.lit(i)) for i, c in enumerate(catalogs)]
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)
    whole = whole.orderBy("_source", order)
    return (whole if limit is None else whole.limit(limit)).drop("_source")


def filter_catalog(
    df: DataFrame, quality: str, min_quality: float, size: str | None = None, size_range: tuple | None = None
) -> DataFrame:
    kept = df.where(F.col(quality) > min_quality)
    return kept if size is None else kept.where(F.col(size).between(*size_range))


def size_ranges(df: DataFrame, size: str, max_rows: int, plain_limit: int | None = None) -> DataFrame:
    """Consecutive ranges of ``size`` with at most ``max_rows`` rows each.

    Equal sizes stay together: each range starts within a step of max_rows / 2 rows, so only a single
    size shared by more than half a range can pass the limit; such a range is flagged.
    """
    step = max(1, max_rows // 2)
    running = cumulative_by_value(df, [], size, plain_limit=plain_limit)
    return (
        running.withColumn("range_no", F.floor(F.col("n_below") / step).cast("bigint"))
        .groupBy("range_no")
        .agg(F.min(size).alias("low"), F.max(size).alias("high"), F.sum("n").alias("n_rows"))
        .withColumn("over_limit", F.col("n_rows") > max_rows)
    )


def sql_type_of(spark_type: str) -> str:
    kind = "FLOAT" if spark_type.startswith("decimal") else SPARK_TO_SQL_TYPES.get(spark_type)
    if kind is None:
        raise ValueError(f"no SQL type for {spark_type}")
    return kind


def schema_rows(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """One row per column of every table; only metadata is read."""
    rows = [
        (name, place, column, sql_type_of(kind))
        for name, df in tables.items()
        for place, (column, kind) in enumerate(df.dtypes)
    ]
    return spark.createDataFrame(rows, "table_name string, ordinal int, column_name string, sql_type string")


def ddl_text(schema: DataFrame) -> DataFrame:
    """The CREATE TABLE text of each table; a table has as many rows here as it has columns."""
    line = F.concat(F.lit("\n    "), "column_name", F.lit("  "), "sql_type")
    lines = F.array_sort(F.collect_list(F.struct("ordinal", line.alias("line"))))
    body = F.array_join(F.transform(lines, lambda x: x["line"]), ",")
    return schema.groupBy("table_name").agg(
        F.concat(F.lit("CREATE TABLE "), F.first("table_name"), F.lit("("), body, F.lit("\n);")).alias("ddl")
    )


def first_row_json(df: DataFrame, order: str) -> DataFrame:
    """The first row of a table as JSON; nulls stay visible."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.agg(F.min_by(row, order).alias("_row")).select(
        F.to_json("_row", {"ignoreNullFields": "false"}).alias("first_row")
    )


def describe_tables(spark: SparkSession, tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """CREATE TABLE text and first row of every table; the value is (table, ordering column)."""
    ddl = ddl_text(schema_rows(spark, {name: df for name, (df, _) in tables.items()}))
    rows = [first_row_json(df, order).withColumn("table_name", F.lit(name)) for name, (df, order) in tables.items()]
    return ddl.join(reduce(DataFrame.unionByName, rows), "table_name")


def map_types(df: DataFrame, source_type: str, mapping: dict[str, str], name: str = "engine_type") -> DataFrame:
    """Translate type names; a type without a translation stops the job."""
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    missing = F.raise_error(F.concat(F.lit("no mapping for type "), F.col(source_type)))
    return df.withColumn(name, F.coalesce(F.try_element_at(table, F.col(source_type)), missing))


def profile(df: DataFrame, inputs: Sequence[str], target: str, group: Sequence[str] = ()) -> DataFrame:
    """Number of inputs, rows and target classes, and whether anything is missing."""
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in df.columns])
    return df.groupBy(*group).agg(
        F.lit(len(inputs)).alias("number_of_input_columns"),
        F.count(F.lit(1)).alias("number_of_rows"),
        F.coalesce(F.bool_or(any_null), F.lit(False)).alias("missingness"),
        F.count_distinct(target).alias("number_of_classes"),
    )


def meta_filter(df: DataFrame, ranges: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """Keep rows whose columns are present and inside their (low, high); None leaves an end open."""
    for column, (low, high) in ranges.items():
        df = df.where(F.col(column).isNotNull())
        if low is not None:
            df = df.where(F.col(column) >= low)
        if high is not None:
            df = df.where(F.col(column) <= high)
    return df


def dedupe_keep_first(df: DataFrame, subset: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per combination, the first in ``order``; each map task already drops the others."""
    return first_per_group(df, subset, order, 1)


def composed_key(columns: Sequence[str]) -> Column:
    """One text for a report; rows are told apart by the columns themselves."""
    return F.concat_ws("_", *[F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in columns])


def exclude_overlap(df: DataFrame, other: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows whose columns also occur together in the other table; a null equals a null, and nothing else does."""
    keys = other.select(*[F.col(c).alias(f"_other_{c}") for c in columns])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_other_{c}")) for c in columns])
    return df.join(keys, same, "left_anti")


def exclude_patterns(df: DataFrame, name: str, patterns: Sequence[str], key: str, ids: Sequence) -> DataFrame:
    for pattern in patterns:
        df = df.where(~F.col(name).contains(pattern))
    return df.where(~F.col(key).isin(list(ids)))


def ratio_filter(df: DataFrame, part: str, whole: str, above: float, quality: str | None = None) -> DataFrame:
    """Keep rows with part / whole above the threshold and, if given, a quality other than 1."""
    kept = df.where(F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double")) > above)
    return kept if quality is None else kept.where(F.col(quality).isNull() | (F.col(quality) != 1))


def report_columns(df: DataFrame, mapping: dict[str, str], counts: Sequence[str]) -> DataFrame:
    """Select and rename; missing counts become 0 and counts become integers."""
    return df.select(
        *[
            (F.coalesce(F.col(old), F.lit(0)).cast("bigint") if old in counts else F.col(old)).alias(new)
            for old, new in mapping.items()
        ]
    )


def cap_dataset(
    df: DataFrame,
    order: str,
    features: str,
    label: str,
    max_rows: int,
    max_features: int = MAX_FEATURES,
    max_classes: int = MAX_CLASSES,
    min_rows: int = MIN_SAMPLES,
) -> DataFrame:
    """Cut a dataset to the model limits and say which limits were hit; too small a dataset gives no rows."""
    head = df.orderBy(order).limit(max_rows)
    facts = head.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(label).alias("classes"), F.max(F.size(features)).alias("width")
    ).first()
    if facts["n_rows"] < min_rows:
        head = head.where(F.lit(False))
    if facts["classes"] > max_classes:
        past = head.select(label).distinct().orderBy(label).offset(max_classes).limit(1)
        head = head.where(F.col(label) < past.first()[0])
    return head.withColumn(features, F.slice(features, 1, max_features)).withColumns(
        {
            "samples_capped": F.lit(facts["n_rows"] == max_rows),
            "feats_capped": F.lit((facts["width"] or 0) > max_features),
            "classes_capped": F.lit(facts["classes"] > max_classes),
        }
    )


def cap_suffix(samples: Column, feats: Column, classes: Column) -> Column:
    """`` [sfc]`` with the letters of the limits that were hit, or nothing."""
    letters = F.concat(*[F.when(flag, F.lit(x)).otherwise("") for flag, x in ((samples, "s"), (feats, "f"), (classes, "c"))])
    return F.when(letters == "", "").otherwise(F.concat(F.lit(" ["), letters, F.lit("]")))


def in_suite(df: DataFrame, suite: DataFrame, key: str, suite_key: str) -> DataFrame:
    return df.join(suite.select(F.col(suite_key).alias(key)), key, "left_semi")


def enrich(meta: DataFrame, qualities: DataFrame, key: str, required: Sequence[str], positive: str) -> DataFrame:
    """Rows that have all required fields (and a positive count) with the extra qualities beside them."""
    for column in required:
        meta = meta.where(F.col(column).isNotNull())
    return meta.where(F.col(positive) > 0).join(qualities, key, "left")


def subset_by_profile(
    df: DataFrame, dataset: str, label: str, categorical: str | None = None, min_rows: int = 0, max_classes: int | None = None
) -> DataFrame:
    """Datasets without categorical features (if that column is given) and of the wanted size and classes."""
    facts = [F.count(F.lit(1)).alias("n_rows"), F.count_distinct(label).alias("classes")]
    if categorical:
        facts.append(F.max(F.size(categorical)).alias("n_categorical"))
    kept = df.groupBy(dataset).agg(*facts).where(F.col("n_rows") >= min_rows)
    if categorical:
        kept = kept.where(F.col("n_categorical") == 0)
    return kept if max_classes is None else kept.where(F.col("classes") <= max_classes)


