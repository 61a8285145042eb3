"""Column expressions for prompts, answers and SQL texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabeval.functions.fixed import (
    ANSWER_LABEL_CHARS, BLANK_LINE_BREAK, CODE_BLOCK_BREAK, KEYWORD_LABELS, KEYWORDS, KEYWORDS_SHORT, LEADING_NUMBER,
    QUERIES_PER_DATASET, SQL_NOISE,
)

WHITESPACE = " \t\n\r\f\v"


def strip(text: Column, characters: str = WHITESPACE) -> Column:
    """Remove any of the characters from both ends."""
    return F.btrim(text, F.lit(characters))


def clean_answer(text: Column) -> Column:
    """One answer without its label, the spaces and the code fence around it."""
    return strip(strip(strip(strip(text, ANSWER_LABEL_CHARS)), "`"))


def rewrite_code(code: Column) -> Column:
    """Rename ``value``, which is reserved, and turn single into double quotes."""
    return F.replace(F.replace(code, F.lit("value"), F.lit("value1")), F.lit("'"), F.lit('"'))


def row_text(columns: Sequence[str]) -> Column:
    """All values of a row as one text."""
    return F.concat_ws("; ", *[F.col(c).cast("string") for c in columns])


def classify_sql(sql: Column, mode: str = "words") -> Column:
    """The SQL components a query uses, as an array.

    ``words`` splits on anything that is not a letter, digit or underscore; ``whitespace`` splits on
    white space only and knows two keywords fewer.
    """
    keywords = KEYWORDS if mode == "words" else KEYWORDS_SHORT
    pattern = r"[^\p{L}\p{N}_]" if mode == "words" else r"(?U)\s+"
    found = F.array_intersect(F.array(*[F.lit(k) for k in keywords]), F.split(F.lower(sql), pattern, -1))
    labels = F.create_map(*[F.lit(x) for pair in KEYWORD_LABELS.items() for x in pair])
    return F.transform(found, lambda k: F.coalesce(F.try_element_at(labels, k), k))


def answer_pieces(answer: Column, per_dataset: int = QUERIES_PER_DATASET) -> Column:
    """Break a raw answer into its description and SQL pieces; null when it cannot be broken."""
    blocks = F.split(answer, CODE_BLOCK_BREAK, -1)
    # the text after the first "1." of the first block, if there is one
    head = F.split(blocks[0], r"1\.", -1)
    head = F.when(F.size(head) > 1, F.get(head, F.lit(1))).otherwise(head[0])
    # the last block ends at its last code fence
    last = F.regexp_extract(F.element_at(blocks, -1), r"^([\s\S]+```[\s\S]+```)", 1)
    fenced = F.when(
        last != "", F.concat(F.array(head), F.slice(blocks, 2, F.greatest(F.size(blocks) - 2, F.lit(0))), F.array(last))
    )
    parts = F.split(answer, BLANK_LINE_BREAK, -1)
    skip = F.when(parts[0].contains("1."), 0).otherwise(1)
    drop = F.when(F.element_at(parts, -1).contains("SELECT"), 0).otherwise(1)
    spaced = F.when(
        F.size(parts) > per_dataset, F.slice(parts, skip + 1, F.size(parts) - skip - drop)
    ).otherwise(parts)
    return F.when(F.size(blocks) > 1, fenced).otherwise(spaced)


def _clean_description(text: Column) -> Column:
    text = strip(text)
    unnumbered = strip(strip(F.regexp_replace(text, LEADING_NUMBER, "")), ":")
    return F.when(text.rlike(LEADING_NUMBER), unnumbered).otherwise(text)


def _without_noise(sql: Column) -> Column:
    for word in SQL_NOISE:
        sql = F.replace(sql, F.lit(word), F.lit(""))
    return strip(sql)


def desc_sql_pairs(answer: Column, per_dataset: int = QUERIES_PER_DATASET) -> Column:
    """The (desc, sql) pairs of a raw answer as an array of structs.

    With exactly two pieces per query, descriptions and SQL alternate; otherwise the first line of a
    piece describes the rest. The whole answer is null when any SQL lacks SELECT.
    """
    pieces = answer_pieces(answer, per_dataset)
    alternate = F.transform(
        F.filter(pieces, lambda p, i: i % 2 == 0),
        lambda p, i: F.struct(p.alias("desc"), F.get(pieces, i * 2 + 1).alias("sql")),
    )
    by_line = F.transform(
        pieces,
        lambda p: F.struct(
            F.substring_index(p, "\n", 1).alias("desc"),
            F.when(F.instr(p, "\n") > 0, F.substr(p, F.instr(p, "\n") + 1)).otherwise("").alias("sql"),
        ),
    )
    pairs = F.when(F.size(pieces) == 2 * per_dataset, alternate).otherwise(by_line)
    cleaned = F.transform(
        pairs, lambda x: F.struct(_clean_description(x["desc"]).alias("desc"), _without_noise(x["sql"]).alias("sql"))
    )
    complete = F.forall(cleaned, lambda x: x["sql"].contains("SELECT"))
    bare = F.transform(
        cleaned, lambda x: F.struct(x["desc"].alias("desc"), strip(strip(strip(x["sql"], "`"), "sql")).alias("sql"))
    )
    return F.when(complete, bare)
