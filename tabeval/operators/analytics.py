"""Workload analytics - SQL components, accuracy tables, samples, splits, funnels and curves."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabeval.functions.fixed import COMPARISON, CORRECT, EMPTY, ERROR, FAILED, KEYWORD_LABELS, KEYWORDS, KEYWORDS_SHORT, VALID
from tabeval.functions.text import classify_sql
from tabeval.operators.ranks import below_cut, first_per_group, hash_counts, hash_cuts, stable_hash

TOTAL = "Total"


def classified(df: DataFrame, sql: str, mode: str = "words") -> DataFrame:
    """One row per query and SQL component it uses; a query without any component gives no row."""
    kept = [c for c in df.columns if c != sql]
    return df.select(*kept, F.explode(classify_sql(F.col(sql), mode)).alias("type"))


def component_names(df: DataFrame, mode: str = "words") -> DataFrame:
    words = KEYWORDS if mode == "words" else KEYWORDS_SHORT
    return df.sparkSession.createDataFrame([(KEYWORD_LABELS.get(w, w),) for w in words], "type string")


def _percent(count: str, name: str) -> Column:
    return (F.try_divide(F.col(name).cast("double"), F.col(count)) * 100).alias(f"pct_{name}")


def _outcome_counts(outcome: str, outcomes: dict[str, str]) -> list[Column]:
    return [F.count_if(F.col(outcome) == value).alias(name) for name, value in outcomes.items()]


def outcome_by_component(df: DataFrame, sql: str, outcome: str, outcomes: dict[str, str], mode: str = "words") -> DataFrame:
    """Count and outcome counts of every SQL component, also of components that never occur."""
    slim = classified(df.select(sql, outcome), sql, mode)
    counts = slim.groupBy("type").agg(F.count(F.lit(1)).alias("sql_count"), *_outcome_counts(outcome, outcomes))
    whole = F.broadcast(component_names(df, mode)).join(counts, "type", "left")  # a fixed list of 20 names
    return whole.select("type", *[F.coalesce(c, F.lit(0)).alias(c) for c in ["sql_count", *outcomes]])


def total_row(df: DataFrame, outcome: str, outcomes: dict[str, str]) -> DataFrame:
    """The same counts over queries instead of components."""
    return df.agg(F.count(F.lit(1)).alias("sql_count"), *_outcome_counts(outcome, outcomes)).select(
        F.lit(TOTAL).alias("type"), "*"
    )


def with_percentages(table: DataFrame, outcomes: Sequence[str]) -> DataFrame:
    return table.select("*", *[_percent("sql_count", name) for name in outcomes])


VALIDITY = {"valid": VALID, "empty": EMPTY, "error": ERROR}
ACCURACY = {"correct": CORRECT}
TRANSLATION = {"correct": CORRECT, "error": FAILED, "different": COMPARISON}


def component_validity(queries: DataFrame, sql: str, status: str, total: bool = False) -> DataFrame:
    """Count, valid, empty and error shares by SQL component, most frequent first, with a total row on demand."""
    table = outcome_by_component(queries, sql, status, VALIDITY)
    if total:
        table = total_row(queries, status, VALIDITY).unionByName(table)
    return with_percentages(table, list(VALIDITY)).orderBy(F.desc(F.col("type") == TOTAL), F.desc("sql_count"), "type")


def component_accuracy(pairs: DataFrame, sql: str, verdict: str) -> DataFrame:
    table = outcome_by_component(pairs, sql, verdict, ACCURACY)
    return with_percentages(table, list(ACCURACY)).orderBy(F.desc("sql_count"), "type")


def component_translation(pairs: DataFrame, sql: str, verdict: str, examples: DataFrame, example_sql: str) -> DataFrame:
    """Translation outcomes by component beside the number of examples that use it, with a total row."""
    table = outcome_by_component(pairs, sql, verdict, TRANSLATION)
    shown = classified(examples.select(example_sql), example_sql).groupBy("type").agg(F.count(F.lit(1)).alias("examples"))
    table = table.join(shown, "type", "full_outer").withColumn("examples", F.coalesce("examples", F.lit(0)))
    total = total_row(pairs, verdict, TRANSLATION).withColumn("examples", examples.agg(F.count(F.lit(1))).scalar())
    return with_percentages(total.unionByName(table), list(TRANSLATION)).orderBy(F.desc(F.col("type") == TOTAL), F.desc("sql_count"), "type")


def explode_aligned(df: DataFrame, columns: Sequence[str], place: str = "place") -> DataFrame:
    """One row per position of parallel arrays; rows in which any of the arrays is null are skipped."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    kept = [c for c in df.columns if c not in columns]
    zipped = df.where(present).select(*kept, F.posexplode(F.arrays_zip(*columns)).alias(place, "_item"))
    return zipped.select(*kept, place, *[F.col(f"_item.{c}").alias(c) for c in columns])


def corpus_stats(queries: DataFrame, ref: Sequence[str], status: str, verdict: str) -> DataFrame:
    """Queries, valid queries, translations, correct ones, and datasets with any valid or any correct one."""
    per_ref = queries.groupBy(*ref).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(status) == VALID).alias("valid"),
        F.count(verdict).alias("translated"),
        F.count_if(F.col(verdict) == CORRECT).alias("correct"),
    )
    return per_ref.agg(
        F.sum("n").alias("n_queries"),
        F.sum("valid").alias("n_valid"),
        F.sum("translated").alias("n_translated"),
        F.sum("correct").alias("n_correct"),
        F.count_if(F.col("valid") > 0).alias("datasets_any_valid"),
        F.count_if(F.col("correct") > 0).alias("datasets_any_correct"),
    )


def categorize(pairs: DataFrame, verdict: str) -> dict[str, DataFrame]:
    """The pairs of each outcome."""
    return {name: pairs.where(F.col(verdict) == value) for name, value in TRANSLATION.items()}


def sample_per_class(df: DataFrame, group: Sequence[str], key: str, n: int, seed: int) -> DataFrame:
    """Exactly ``n`` random rows of each class, or all of a smaller class."""
    return first_per_group(df, group, [stable_hash(key, seed), F.col(key)], n)


def pick_pairs(df: DataFrame, columns: Sequence[str], pairs: Sequence[tuple]) -> DataFrame:
    """Rows whose key columns form one of the given tuples."""
    types = dict(df.dtypes)
    wanted = df.sparkSession.createDataFrame(list(pairs), ", ".join(f"`{c}` {types[c]}" for c in columns))
    return df.join(F.broadcast(wanted.distinct()), list(columns), "left_semi")  # a list given by the caller


def split_sizes(n: int, shares: dict[str, float]) -> dict[str, int]:
    """Exact sizes: every share is rounded down and the first one gets the rest."""
    names = list(shares)
    sizes = {name: int(n * shares[name]) for name in names[1:]}
    return {names[0]: n - sum(sizes.values()), **sizes}


def split_label(df: DataFrame, key: str, shares: dict[str, float], seed: int) -> Column:
    """The split of each row as an expression on its key. ``df`` holds every key once."""
    per_prefix = hash_counts(df, key, seed)
    sizes = split_sizes(sum(per_prefix.values()), shares)
    names = list(sizes)
    ends = [sum(list(sizes.values())[: i + 1]) for i in range(len(names) - 1)]
    label = F.lit(names[-1])
    for name, cut in reversed(list(zip(names, hash_cuts(df, key, seed, ends, per_prefix)))):
        label = F.when(below_cut(key, seed, cut), F.lit(name)).otherwise(label)
    return label


SPLIT_SHARES = {"train": 0.8, "valid": 0.1, "test": 0.1}


def split_rows(df: DataFrame, key: str, shares: dict[str, float] | None = None, seed: int = 42) -> DataFrame:
    """Random split of exact sizes. Only key hashes are counted; the rows themselves are not shuffled."""
    return df.withColumn("split", split_label(df, key, shares or SPLIT_SHARES, seed))


def split_groups(df: DataFrame, group: str, shares: dict[str, float] | None = None, seed: int = 42) -> DataFrame:
    """Split whole groups: exact sizes over the distinct groups, and no group is in two splits."""
    return df.withColumn("split", split_label(df.select(group).distinct(), group, shares or SPLIT_SHARES, seed))


def fewshot_curve(verdicts: DataFrame, k: str, verdict: str, total: Column) -> DataFrame:
    """Shares of correct and different results by number of examples; whatever is missing counts as error."""
    counts = verdicts.groupBy(k).agg(
        F.count_if(F.col(verdict) == CORRECT).alias("correct"), F.count_if(F.col(verdict) == COMPARISON).alias("different")
    )
    total = total.cast("double")
    share = lambda n: F.try_divide(n * 100.0, total)
    return counts.select(
        k,
        share(F.col("correct")).alias("pct_correct"),
        share(total - F.col("correct") - F.col("different")).alias("pct_error"),
        share(F.col("different")).alias("pct_different"),
    )


def to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str]) -> DataFrame:
    return df.unpivot(list(ids), [F.col(v).cast("double").alias(v) for v in values], "type", "value")


def funnel(df: DataFrame, stages: dict[str, Column]) -> DataFrame:
    """Rows that survive each stage and all stages before it, in one pass."""
    survived = F.lit(True)
    counts = []
    for place, (name, condition) in enumerate(stages.items()):
        survived = survived & F.coalesce(condition, F.lit(False))
        counts.append(F.struct(F.lit(place).alias("stage_no"), F.lit(name).alias("stage"), F.count_if(survived).alias("n")))
    return df.agg(F.array(*counts).alias("stages")).select(F.inline("stages"))


def learning_curve(df: DataFrame, keys: Sequence[str], metric: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(metric).alias("mean_metric"))


def sample_excluding(df: DataFrame, key: str, n: int, exclude: DataFrame, seed: int) -> DataFrame:
    """``n`` random rows whose key is not excluded; too few remaining rows are an error."""
    left = df.join(exclude.select(key), key, "left_anti")
    sample = left.orderBy(stable_hash(key, seed), key).limit(n)
    if sample.count() < n:
        raise ValueError(f"fewer than {n} rows are left to sample from")
    return sample
