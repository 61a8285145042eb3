"""Prompts and answers of many datasets as DataFrame jobs.

A prompt is first a set of numbered parts, one row each, so a dataset of any size stays spread over the
cluster. ``assemble`` joins the parts into volumes of a bounded number of parts; a dataset of ordinary
size is one volume, a huge one is several consecutive volumes, and nothing is cut off.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabeval.functions import fixed
from tabeval.functions.text import clean_answer, desc_sql_pairs
from tabeval.operators.ranks import first_per_group, with_ordinal

PARTS_PER_VOLUME = 1_000


def assemble(parts: DataFrame, group: Sequence[str], name: str = "prompt", per_volume: int = PARTS_PER_VOLUME) -> DataFrame:
    """Join rows (group, part_no, text) in order; at most ``per_volume`` parts meet in one row."""
    volume = F.floor(F.col("part_no") / per_volume).cast("bigint")
    ordered = F.array_sort(F.collect_list(F.struct("part_no", "text")))
    return (
        parts.withColumn("volume", volume)
        .groupBy(*group, "volume")
        .agg(F.array_join(F.transform(ordered, lambda p: p["text"]), "").alias(name))
    )


def _format(template: str, **values: Column) -> Column:
    """A text template with columns in its braces."""
    pieces: list[Column] = []
    rest = template
    while "{" in rest:
        before, rest = rest.split("{", 1)
        field, rest = rest.split("}", 1)
        pieces += [F.lit(before), values[field].cast("string")]
    return F.concat(*pieces, F.lit(rest))


def schema_prompt_parts(tables: DataFrame, ref: str, order: Sequence[str], schema: str, row: str, simple: bool = False) -> DataFrame:
    """The parts of each dataset's schema prompt: a head, one part per table, and a tail."""
    numbered = with_ordinal(tables, order, [ref], "table_no")
    body = numbered.select(
        ref,
        (F.col("table_no") + 1).alias("part_no"),
        _format(fixed.SCHEMA_PROMPT_TABLE, i=F.col("table_no"), schema=F.col(schema), row=F.col(row)).alias("text"),
    )
    sizes = tables.groupBy(ref).agg(F.count(F.lit(1)).alias("n"))
    joins = F.when(F.col("n") > 1, fixed.SCHEMA_PROMPT_JOINS).otherwise("")
    complexity = F.lit("" if simple else fixed.SCHEMA_PROMPT_COMPLEXITY)
    count = F.lit(fixed.QUERIES_PER_DATASET)
    frame = F.array(
        F.struct(F.lit(0).cast("bigint").alias("part_no"), _format(fixed.SCHEMA_PROMPT_HEAD, n=F.col("n")).alias("text")),
        F.struct(
            (F.col("n") + 1).alias("part_no"),
            _format(fixed.SCHEMA_PROMPT_TAIL, count=count, complexity=complexity, joins=joins).alias("text"),
        ),
    )
    ends = sizes.select(ref, F.inline(frame))
    return body.unionByName(ends)


def fewshot_parts(examples: DataFrame, group: Sequence[str], order: Sequence[str], sql: str, code: str, k: int | None = None) -> DataFrame:
    """Numbered example pairs, one part per pair; the first ``k`` of each group or all of them."""
    if k is not None:
        examples = first_per_group(examples, group, order, k)
    numbered = with_ordinal(examples, order, group, "part_no")
    shown = F.col("part_no") + 1
    pair = "\n{i}.%s: \n```\n{sql}\n```\n\n{i}.%s: \n```\n{code}\n```\n" % (fixed.SQL_LABEL, fixed.ANSWER_LABEL)
    return numbered.select(*group, "part_no", _format(pair, i=shown, sql=F.col(sql), code=F.col(code)).alias("text"))


def batches(df: DataFrame, group: Sequence[str], order: Sequence[str], size: int = fixed.BATCH_SIZE) -> DataFrame:
    """Fixed-size batches of each group's ordered rows: adds batch_no and the place inside the batch."""
    numbered = with_ordinal(df, order, group, "_no")
    return numbered.select(
        *df.columns,
        F.floor(F.col("_no") / size).cast("bigint").alias("batch_no"),
        (F.col("_no") % size).alias("place"),
    )


def batch_prompts(batched: DataFrame, group: Sequence[str], sql: str, head: str) -> DataFrame:
    """One prompt per batch: the shared head, then the batch's numbered queries."""
    item = _format("{i}.%s:\n```\n{sql}\n```\n" % fixed.SQL_LABEL, i=F.col("place") + 1, sql=F.col(sql))
    parts = batched.select(*group, "batch_no", F.col("place").alias("part_no"), item.alias("text"))
    # a batch has as many parts as its caller chose, and is one prompt
    prompts = assemble(parts, [*group, "batch_no"], per_volume=2**31 - 1).drop("volume")
    return prompts.withColumn("prompt", F.concat(F.lit(head), "prompt"))


def target_prompt(schema: Column) -> Column:
    return F.concat(F.lit(fixed.TARGET_PROMPT_HEAD), schema, F.lit(fixed.TARGET_PROMPT_TAIL))


def first_valid_batch(
    queries: DataFrame, ref: str, order: str, status: str, n: int = fixed.BATCH_SIZE, examples: DataFrame | None = None
) -> DataFrame:
    """The first ``n`` Valid queries of every dataset that has that many and is not used as an example."""
    valid = queries.where(F.col(status) == fixed.VALID)
    if examples is not None:
        valid = valid.join(examples.select(ref), ref, "left_anti")
    by_place = Window.partitionBy(ref).orderBy(order)
    picked = valid.withColumn("place", F.row_number().over(by_place)).where(F.col("place") <= n)
    # only n rows per dataset are left here, so counting them again costs nothing
    return picked.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(ref))).where(F.col("_n") == n).drop("_n")


def split_answers(df: DataFrame, answer: str, expected: Column) -> DataFrame:
    """One row per numbered answer; an answer text with fewer items than expected is rejected whole."""
    items = F.split(F.col(answer), fixed.NUMBERED_ANSWER, -1)
    last = F.when(F.size(items) >= expected, F.slice(items, F.size(items) - expected + 1, expected))
    kept = [F.col(c) for c in df.columns if c != answer]
    exploded = df.select(*kept, F.posexplode(last).alias("place", "_item"))
    return exploded.withColumn("code", clean_answer(F.col("_item"))).drop("_item")


def parse_desc_sql(df: DataFrame, answer: str, per_dataset: int = fixed.QUERIES_PER_DATASET) -> DataFrame:
    """One row per (desc, sql) pair of each raw answer; unusable answers give no rows."""
    kept = [F.col(c) for c in df.columns if c != answer]
    pairs = df.select(*kept, F.posexplode(desc_sql_pairs(F.col(answer), per_dataset)).alias("query_idx", "_pair"))
    return pairs.select("*", "_pair.desc", "_pair.sql").drop("_pair")


def parse_target_json(df: DataFrame, answer: str) -> DataFrame:
    """Suggested input and target columns; unparsable or incomplete answers are dropped."""
    parsed = F.from_json(answer, "input_columns array<string>, output_column string")
    wide = df.withColumn("_target", parsed).select("*", "_target.input_columns", "_target.output_column").drop("_target")
    return wide.where(F.col("input_columns").isNotNull() & F.col("output_column").isNotNull())


def pending(work: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Work that has no finished row yet."""
    return work.join(done.select(*keys), list(keys), "left_anti")


def reusable(batch: DataFrame, cache: DataFrame, group: Sequence[str], place: str, query: str) -> DataFrame:
    """Per group, whether the cached batch holds the same queries at the same places, row by row."""
    left = batch.select(*group, place, F.col(query).alias("_new"), F.lit(True).alias("_wanted"))
    right = cache.select(*group, place, F.col(query).alias("_old"))
    both = left.join(right, [*group, place], "full_outer")
    same = F.col("_new").eqNullSafe(F.col("_old"))
    return (
        both.groupBy(*group)
        .agg(F.bool_and(same).alias("reused"), F.bool_or(F.coalesce("_wanted", F.lit(False))).alias("_in_batch"))
        .where("_in_batch")
        .drop("_in_batch")
    )


def upsert(base: DataFrame, new: DataFrame, key: Sequence[str], overwrite: bool = True) -> DataFrame:
    """Rows of both tables by key; on a clash the new row wins, or the old one if not overwriting."""
    winner = F.desc("_side") if overwrite else F.asc("_side")
    both = base.withColumn("_side", F.lit(0)).unionByName(new.withColumn("_side", F.lit(1)))
    return first_per_group(both, key, [winner], 1).drop("_side")
