"""C1-C13 over the driver tables."""

from pyspark.sql import functions as F

from tabeval.functions import text
from tabeval.operators import prompts
from tabeval.plans.registry import Tables, query

ORDERED = "(SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS no, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations)"


@query(
    "c01_schema_prompt",
    f"""SELECT conv_id, 0::BIGINT AS volume, '
We have a SQL database with ' || max(n) || ' tables. For each table, here is the schema and a sample row data.
' || string_agg('
Schema for table ' || no || ':
' || role || '
A sample row data from table ' || no || ':
' || text || '
', '' ORDER BY no) || '
Consider the typical users who access this database. What kind of SQLite SELECT queries would they write? '
|| 'List 15 examples SQL code that are directly executable with relatively high complexity, each following a description.
' || CASE WHEN max(n) > 1 THEN 'If possible, use joins.' ELSE '' END || ' Reply in the format of a description and the SQL code for each example
' AS prompt FROM {ORDERED} GROUP BY conv_id""",
)
def schema_prompt(t: Tables):
    parts = prompts.schema_prompt_parts(t.conversations, "conv_id", ["turn"], "role", "text")
    return prompts.assemble(parts, ["conv_id"])


def _fewshot_sql(where: str) -> str:
    fence = "chr(10) || '```' || chr(10)"
    return f"""SELECT conv_id, 0::BIGINT AS volume, string_agg(chr(10) || (no + 1) || '.SQL: ' || {fence} || text || {fence} || chr(10)
        || (no + 1) || '.REL: ' || {fence} || role || {fence}, '' ORDER BY no) AS prompt FROM {ORDERED} {where} GROUP BY conv_id"""


@query("c02_fewshot_prompt_all", _fewshot_sql(""))
def fewshot_prompt_all(t: Tables):
    return prompts.assemble(prompts.fewshot_parts(t.conversations, ["conv_id"], ["turn"], "text", "role"), ["conv_id"])


@query("c02_fewshot_prompt_first_k", _fewshot_sql("WHERE no < 3"))
def fewshot_prompt_first_k(t: Tables):
    return prompts.assemble(prompts.fewshot_parts(t.conversations, ["conv_id"], ["turn"], "text", "role", k=3), ["conv_id"])


HEAD = "Translate the queries below. Number the programs like the queries.\n"


@query(
    "c03_batch_prompt",
    f"""SELECT source, no // 10 AS batch_no, '{HEAD}' || string_agg((no % 10 + 1) || '.SQL:' || chr(10) || '```' || chr(10) || text
          || chr(10) || '```' || chr(10), '' ORDER BY no) AS prompt
        FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS no FROM documents) GROUP BY ALL""",
)
def batch_prompt(t: Tables):
    docs = t.documents.select("source", "doc_id", "text")
    return prompts.batch_prompts(prompts.batches(docs, ["source"], ["doc_id"]), ["source"], "text", HEAD)


@query(
    "c04_target_prompt",
    """SELECT doc_id, 'Consider a machine learning model that takes a few numeric input columns and predict a single classification '
         || 'target column. Given the following schema of a data table, suggest the input columns and target column, such that '
         || 'the target may be predictedfrom the inputs non-trivially. ' || chr(10) || 'Schema: ' || lang || ' ' || text || chr(10)
         || 'Respond in JSON format with ''input_columns'' and ''output_column''.' AS prompt FROM documents""",
)
def target_prompt(t: Tables):
    return t.documents.select("doc_id", prompts.target_prompt(F.concat("lang", F.lit(" "), "text")).alias("prompt"))


EVENT_STATUS = "CASE event_type WHEN 'error' THEN 'Error' WHEN 'signup' THEN 'Empty' ELSE 'Valid' END"


def event_status():
    return F.when(F.col("event_type") == "error", "Error").when(F.col("event_type") == "signup", "Empty").otherwise("Valid")


@query(
    "c05_first_valid_batch",
    f"""SELECT user_id, event_id, place FROM (
          SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS place,
                 count(*) OVER (PARTITION BY user_id) AS n
          FROM (SELECT *, {EVENT_STATUS} AS status FROM events) WHERE status = 'Valid'
            AND user_id NOT IN (SELECT user_id FROM events WHERE value > 300)) WHERE n >= 10 AND place <= 10""",
)
def first_valid_batch(t: Tables):
    queries = t.events.select("user_id", "event_id", event_status().alias("status"))
    examples = t.events.where(F.col("value") > 300).select("user_id")
    picked = prompts.first_valid_batch(queries, "user_id", "event_id", "status", examples=examples)
    return picked.select("user_id", "event_id", F.col("place").cast("bigint").alias("place"))


@query(
    "c06_batches",
    """SELECT user_id, event_id, no // 10 AS batch_no, no % 10 AS place
       FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS no FROM events)""",
)
def batches(t: Tables):
    return prompts.batches(t.events.select("user_id", "event_id"), ["user_id"], ["event_id"])


def raw_answers(t: Tables):
    """The assistant turns of each conversation as one numbered answer text."""
    turns = prompts.with_ordinal(t.conversations.where(F.col("role") == "assistant"), ["turn"], ["conv_id"], "part_no")
    answer = F.concat((F.col("part_no") + 1).cast("string"), F.lit(".REL:\n```\n"), "text", F.lit("\n```\n"))
    return prompts.assemble(turns.select("conv_id", "part_no", answer.alias("text")), ["conv_id"], "answer")


WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query(
    "c07_split_answers",
    f"""SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS place, trim(trim(trim(trim(
          chr(10) || '```' || chr(10) || text || chr(10) || '```' || chr(10), 'REL:'), {WS}), '`'), {WS}) AS code
        FROM conversations WHERE role = 'assistant'""",
)
def split_answers(t: Tables):
    turns = t.conversations.where(F.col("role") == "assistant")
    per_volume = F.lit(prompts.PARTS_PER_VOLUME)
    counts = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    expected = F.least(F.col("n") - F.col("volume") * per_volume, per_volume).cast("int")
    split = prompts.split_answers(raw_answers(t).join(counts, "conv_id"), "answer", expected)
    return split.select("conv_id", (F.col("volume") * per_volume + F.col("place")).alias("place"), "code")


@query(
    "c08_parse_desc_sql",
    """SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS query_idx,
         'Show turn ' || turn || ' said by the ' || role AS "desc",
         'SELECT text FROM conversations' || chr(10) || 'WHERE conv_id = ' || conv_id || ' AND turn = ' || turn || ';' AS sql
       FROM conversations""",
)
def parse_desc_sql(t: Tables):
    turns = prompts.with_ordinal(t.conversations, ["turn"], ["conv_id"], "part_no")
    piece = F.format_string(
        "%d. Show turn %d said by the %s\nSQL:\n```sql\nSELECT text FROM conversations\nWHERE conv_id = %d AND turn = %d;\n```\n\n",
        F.col("part_no") + 1, "turn", "role", "conv_id", "turn",
    )
    answers = prompts.assemble(turns.select("conv_id", "part_no", piece.alias("text")), ["conv_id"], "answer")
    place = F.col("volume") * prompts.PARTS_PER_VOLUME + F.col("query_idx")
    return prompts.parse_desc_sql(answers, "answer").withColumn("query_idx", place).drop("volume")


@query("c09_rewrite_code", """SELECT doc_id, replace(replace(text, 'value', 'value1'), '''', '"') AS code FROM documents""")
def rewrite_code(t: Tables):
    return t.documents.select("doc_id", text.rewrite_code(F.col("text")).alias("code"))


@query(
    "c10_parse_target_json",
    """SELECT event_id, event_type || ',value' AS input_columns, 'user ' || user_id AS output_column FROM events
       WHERE event_type NOT IN ('click', 'error')""",
)
def parse_target_json(t: Tables):
    good = F.to_json(
        F.struct(
            F.array("event_type", F.lit("value")).alias("input_columns"),
            F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("output_column"),
        )
    )
    kind = F.col("event_type")
    answer = F.when(kind == "error", F.col("props")).when(kind == "click", "no such columns").otherwise(good)
    parsed = prompts.parse_target_json(t.events.select("event_id", answer.alias("answer")), "answer").drop("answer")
    return parsed.withColumn("input_columns", F.array_join("input_columns", ","))


@query(
    "c10_parse_props",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL",
)
def parse_props(t: Tables):
    return t.events.select("event_id", F.from_json("props", "k bigint")["k"].alias("k")).where(F.col("k").isNotNull())


@query(
    "c11_pending",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')",
)
def pending(t: Tables):
    done = t.orders.where(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("c_custkey"))
    return prompts.pending(t.customer.select("c_custkey", "c_name"), done, ["c_custkey"])


@query(
    "c11_reusable_batches",
    """WITH b AS (SELECT user_id, no // 10 AS batch_no, no % 10 AS place, event_type FROM
                   (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS no FROM events)),
            c AS (SELECT user_id, no // 10 AS batch_no, no % 10 AS place, event_type FROM
                   (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS no FROM events WHERE value < 200))
       SELECT coalesce(b.user_id, c.user_id) AS user_id, coalesce(b.batch_no, c.batch_no) AS batch_no,
         bool_and(b.event_type IS NOT DISTINCT FROM c.event_type) AS reused
       FROM b FULL JOIN c ON b.user_id = c.user_id AND b.batch_no = c.batch_no AND b.place = c.place
       GROUP BY 1, 2 HAVING bool_or(b.user_id IS NOT NULL)""",
)
def reusable_batches(t: Tables):
    slim = t.events.select("user_id", "event_id", "event_type", "value")
    batch = prompts.batches(slim, ["user_id"], ["event_id"])
    cache = prompts.batches(slim.where(F.col("value") < 200), ["user_id"], ["event_id"])
    return prompts.reusable(batch, cache, ["user_id", "batch_no"], "place", "event_type")


NEW_ROWS = "SELECT c_custkey + 500 AS k, c_mktsegment AS payload FROM customer"


@query(
    "c12_upsert_overwrite",
    f"""SELECT coalesce(n.k, c_custkey) AS k, coalesce(n.payload, c_name) AS payload
        FROM customer FULL JOIN ({NEW_ROWS}) n ON n.k = c_custkey""",
)
def upsert_overwrite(t: Tables):
    return prompts.upsert(*_upsert_sides(t), ["k"], overwrite=True)


@query(
    "c12_upsert_keep_first",
    f"""SELECT coalesce(c_custkey, n.k) AS k, coalesce(c_name, n.payload) AS payload
        FROM customer FULL JOIN ({NEW_ROWS}) n ON n.k = c_custkey""",
)
def upsert_keep_first(t: Tables):
    return prompts.upsert(*_upsert_sides(t), ["k"], overwrite=False)


def _upsert_sides(t: Tables):
    base = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("payload"))
    return base, t.customer.select((F.col("c_custkey") + 500).alias("k"), F.col("c_mktsegment").alias("payload"))


@query(
    "c13_row_text",
    "SELECT p_partkey, concat_ws('; ', p_partkey, p_name, p_brand, p_type, p_size) AS row_text FROM part",
)
def row_text(t: Tables):
    return t.part.select("p_partkey", text.row_text(["p_partkey", "p_name", "p_brand", "p_type", "p_size"]).alias("row_text"))
