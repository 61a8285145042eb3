"""G1-G18 over the driver tables."""

from pyspark.sql import functions as F

from tabeval.functions.fixed import KEYWORD_LABELS, KEYWORDS, KEYWORDS_SHORT
from tabeval.functions.text import classify_sql
from tabeval.operators import analytics
from tabeval.operators.ranks import with_ordinal
from tabeval.plans.d_workload import QUERIES_SQL, STATUS_SQL, VERDICT_SQL, labelled, run_workload
from tabeval.plans.registry import Tables, query
from tabeval.plans.workload_fixture import values_sql
from tabeval.sources.files import export_pairs


def _kw_values(words) -> str:
    return "(VALUES " + ", ".join(f"('{w}', '{KEYWORD_LABELS.get(w, w)}')" for w in words) + ") kw(word, type)"


KW = _kw_values(KEYWORDS)
WORDS_SQL = r"regexp_split_to_array(lower({0}), '[^\p{{L}}\p{{N}}_]')"


def _classified_sql(source: str, column: str) -> str:
    """(source columns, type) per query and component."""
    return f"""(SELECT q.* EXCLUDE (words), kw.type FROM (SELECT *, {WORDS_SQL.format(column)} AS words FROM {source}) q
                JOIN {KW} ON list_contains(q.words, kw.word))"""


@query("g01_classify_sql", f"SELECT doc_id, type FROM {_classified_sql('documents', 'text')}")
def classify_words(t: Tables):
    return analytics.classified(t.documents.select("doc_id", "text"), "text")


@query(
    "g02_classify_sql_whitespace",
    f"""SELECT doc_id, type FROM (SELECT doc_id, regexp_split_to_array(lower(text), '\\s+') AS words FROM documents) q
        JOIN {_kw_values(KEYWORDS_SHORT)} ON list_contains(q.words, kw.word)""",
)
def classify_whitespace(t: Tables):
    return analytics.classified(t.documents.select("doc_id", "text"), "text", "whitespace")


def _validity_sql(source: str, column: str, total: bool) -> str:
    counts = ", ".join(f"count(*) FILTER (WHERE status = '{s.capitalize()}') AS {s}" for s in ("valid", "empty", "error"))
    table = f"""SELECT kw.type, coalesce(sql_count, 0) AS sql_count, coalesce(valid, 0) AS valid, coalesce(empty, 0) AS empty,
                  coalesce(error, 0) AS error FROM {KW} LEFT JOIN
                  (SELECT type, count(*) AS sql_count, {counts} FROM {_classified_sql(source, column)} GROUP BY type) USING (type)"""
    if total:
        table += f" UNION ALL SELECT 'Total', count(*), {counts} FROM {source}"
    shares = ", ".join(f"round({s} * 100.0 / nullif(sql_count, 0), 4) AS pct_{s}" for s in ("valid", "empty", "error"))
    return f"SELECT *, {shares} FROM ({table})"


def _rounded(table, names):
    return table.withColumns({f"pct_{n}": F.round(f"pct_{n}", 4) for n in names})


@query("g03_component_validity", _validity_sql(QUERIES_SQL, "text", False))
def component_validity(t: Tables):
    return _rounded(analytics.component_validity(labelled(t), "text", "status"), analytics.VALIDITY)


@query("g03_component_validity_of_run_workload", _validity_sql(values_sql(), "sql", True))
def component_validity_of_run_workload(t: Tables):
    """Run and label the fixture workload, classify its SQL, report validity per component and in total."""
    return _rounded(analytics.component_validity(run_workload(t), "sql", "status", total=True), analytics.VALIDITY)


@query("g04_component_validity_with_total", _validity_sql(QUERIES_SQL, "text", True))
def component_validity_with_total(t: Tables):
    return _rounded(analytics.component_validity(labelled(t), "text", "status", total=True), analytics.VALIDITY)


@query(
    "g05_component_accuracy",
    f"""SELECT kw.type, coalesce(sql_count, 0) AS sql_count, coalesce(correct, 0) AS correct,
          round(correct * 100.0 / nullif(sql_count, 0), 4) AS pct_correct FROM {KW} LEFT JOIN
          (SELECT type, count(*) AS sql_count, count(*) FILTER (WHERE verdict = 'correct') AS correct
           FROM {_classified_sql(QUERIES_SQL, 'text')} GROUP BY type) USING (type)""",
)
def component_accuracy(t: Tables):
    return _rounded(analytics.component_accuracy(labelled(t), "text", "verdict"), analytics.ACCURACY)


OUTCOMES = """count(*) FILTER (WHERE verdict = 'correct') AS correct, count(*) FILTER (WHERE verdict = 'error') AS error,
              count(*) FILTER (WHERE verdict = 'comparison') AS different"""


@query(
    "g06_component_translation",
    f"""SELECT *, round(correct * 100.0 / nullif(sql_count, 0), 4) AS pct_correct, round(error * 100.0 / nullif(sql_count, 0), 4) AS pct_error,
          round(different * 100.0 / nullif(sql_count, 0), 4) AS pct_different FROM (
        SELECT kw.type, coalesce(sql_count, 0) AS sql_count, coalesce(correct, 0) AS correct, coalesce(error, 0) AS error,
          coalesce(different, 0) AS different, coalesce(examples, 0) AS examples FROM {KW}
        LEFT JOIN (SELECT type, count(*) AS sql_count, {OUTCOMES} FROM {_classified_sql(QUERIES_SQL, 'text')} GROUP BY type) USING (type)
        LEFT JOIN (SELECT type, count(*) AS examples FROM {_classified_sql('benchmark', 'text')} GROUP BY type) USING (type)
        UNION ALL SELECT 'Total', count(*), {OUTCOMES}, (SELECT count(*) FROM benchmark) FROM {QUERIES_SQL})""",
)
def component_translation(t: Tables):
    table = analytics.component_translation(labelled(t), "text", "verdict", t.benchmark, "text")
    return _rounded(table, analytics.TRANSLATION)


@query(
    "g07_explode_aligned",
    """SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS place,
         l_partkey, l_returnflag FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P'""",
)
def explode_aligned(t: Tables):
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    lines = with_ordinal(t.lineitem.select("l_orderkey", "l_returnflag", *order), order, ["l_orderkey"], "no")
    per_order = export_pairs(lines, "l_orderkey", "no", ["l_partkey", "l_returnflag"])
    known = per_order.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus"), "l_orderkey")
    # orders still in progress have no flags, as a dataset that failed has none
    flags = F.when(F.col("o_orderstatus") != "P", F.col("l_returnflag"))
    exploded = analytics.explode_aligned(known.withColumn("l_returnflag", flags), ["l_partkey", "l_returnflag"])
    place = (F.col("volume") * 1000 + F.col("place")).alias("place")
    return exploded.select("l_orderkey", place, "l_partkey", "l_returnflag")


@query(
    "g08_corpus_stats",
    f"""SELECT CAST(sum(n) AS BIGINT) AS n_queries, CAST(sum(valid) AS BIGINT) AS n_valid, CAST(sum(translated) AS BIGINT) AS n_translated,
          CAST(sum(correct) AS BIGINT) AS n_correct, count(*) FILTER (WHERE valid > 0) AS datasets_any_valid,
          count(*) FILTER (WHERE correct > 0) AS datasets_any_correct FROM (
          SELECT lang, source, count(*) AS n, count(*) FILTER (WHERE {STATUS_SQL} = 'Valid' AND quality IS NOT NULL) AS valid,
            count(quality) AS translated, count(*) FILTER (WHERE {VERDICT_SQL} = 'correct') AS correct
          FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1, 2)""",
)
def corpus_stats(t: Tables):
    marks = labelled(t).select("doc_id", "status", "verdict")
    return analytics.corpus_stats(
        t.documents.select("doc_id", "lang", "source").join(marks, "doc_id", "left"), ["lang", "source"], "status", "verdict"
    )


@query(
    "g09_categorize",
    f"SELECT CASE verdict WHEN 'comparison' THEN 'different' ELSE verdict END AS category, doc_id FROM {QUERIES_SQL}",
)
def categorize(t: Tables):
    parts = analytics.categorize(labelled(t).select("doc_id", "verdict"), "verdict")
    frames = [df.select(F.lit(name).alias("category"), "doc_id") for name, df in parts.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query(
    "g10_sample_per_class",
    """SELECT doc_id, lang FROM documents
       QUALIFY row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id::VARCHAR || '42'), doc_id) <= 100""",
)
def sample_per_class(t: Tables):
    return analytics.sample_per_class(t.documents.select("doc_id", "lang"), ["lang"], "doc_id", 100, 42)


@query(
    "g11_pick_pairs",
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
       WHERE (l_orderkey, l_linenumber) IN ((1, 1), (2, 3), (5, 4), (7, 2), (11, 6), (12, 7), (20, 5))""",
)
def pick_pairs(t: Tables):
    pairs = [(1, 1), (2, 3), (5, 4), (7, 2), (11, 6), (12, 7), (20, 5)]
    return analytics.pick_pairs(t.lineitem, ["l_orderkey", "l_linenumber"], pairs).select("l_orderkey", "l_linenumber", "l_partkey")


def _split_case(n: str) -> str:
    tenth = f"CAST(floor({n} * 0.1) AS BIGINT)"
    return f"CASE WHEN no < {n} - 2 * {tenth} THEN 'train' WHEN no < {n} - {tenth} THEN 'valid' ELSE 'test' END"


@query(
    "g12_split_rows",
    f"""SELECT doc_id, {_split_case('n')} AS split FROM (
          SELECT doc_id, row_number() OVER (ORDER BY md5(doc_id::VARCHAR || '42')) - 1 AS no, count(*) OVER () AS n FROM documents)""",
)
def split_rows(t: Tables):
    return analytics.split_rows(t.documents.select("doc_id"), "doc_id")


@query(
    "g13_split_groups",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, {_split_case('n')} AS split FROM lineitem JOIN (
          SELECT k, row_number() OVER (ORDER BY md5(k::VARCHAR || '42')) - 1 AS no, count(*) OVER () AS n
          FROM (SELECT DISTINCT l_orderkey AS k FROM lineitem)) ON k = l_orderkey""",
)
def split_groups(t: Tables):
    return analytics.split_groups(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), "l_orderkey")


@query(
    "g14_fewshot_curve",
    f"""SELECT k, round(100.0 * correct / total, 6) AS pct_correct, round(100.0 * (total - correct - different) / total, 6) AS pct_error,
          round(100.0 * different / total, 6) AS pct_different FROM (
          SELECT (doc_id % 10) * 5 AS k, count(*) FILTER (WHERE verdict = 'correct') AS correct,
            count(*) FILTER (WHERE verdict = 'comparison') AS different, (SELECT count(*) / 10 FROM documents) AS total
          FROM {QUERIES_SQL} GROUP BY 1)""",
)
def fewshot_curve(t: Tables):
    # every document belongs to one of ten runs; those without a verdict were skipped and count as errors
    verdicts = labelled(t).select(((F.col("doc_id") % 10) * 5).alias("k"), "verdict")
    total = t.documents.agg(F.count(F.lit(1)) / 10).scalar()
    curve = analytics.fewshot_curve(verdicts, "k", "verdict", total)
    return curve.withColumns({c: F.round(c, 6) for c in curve.columns if c != "k"})


@query(
    "g15_to_long",
    """SELECT p_partkey, 'p_size' AS type, p_size::DOUBLE AS value FROM part
       UNION ALL SELECT p_partkey, 'p_retailprice', p_retailprice FROM part""",
)
def to_long(t: Tables):
    return analytics.to_long(t.part, ["p_partkey"], ["p_size", "p_retailprice"])


@query(
    "g16_funnel",
    """SELECT 0 AS stage_no, 'catalogued' AS stage, count(*) AS n FROM orders
       UNION ALL SELECT 1, 'priced', count(*) FROM orders WHERE o_totalprice > 100000
       UNION ALL SELECT 2, 'finished', count(*) FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F'
       UNION ALL SELECT 3, 'urgent', count(*) FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""",
)
def funnel(t: Tables):
    stages = {
        "catalogued": F.lit(True), "priced": F.col("o_totalprice") > 100000,
        "finished": F.col("o_orderstatus") == "F", "urgent": F.col("o_orderpriority") == "1-URGENT",
    }
    return analytics.funnel(t.orders, stages)


@query(
    "g17_learning_curve",
    """SELECT (event_id % 4) * 500 AS train_size, event_id % 5 AS split, event_type AS method, round(avg(value), 6) AS mean_metric
       FROM events GROUP BY 1, 2, 3""",
)
def learning_curve(t: Tables):
    runs = t.events.select(
        ((F.col("event_id") % 4) * 500).alias("train_size"), (F.col("event_id") % 5).alias("split"),
        F.col("event_type").alias("method"), "value",
    )
    curve = analytics.learning_curve(runs, ["train_size", "split", "method"], "value")
    return curve.withColumn("mean_metric", F.round("mean_metric", 6))


@query(
    "g18_sample_excluding",
    """SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 490000)
       ORDER BY md5(c_custkey::VARCHAR || '43'), c_custkey LIMIT 40""",
)
def sample_excluding(t: Tables):
    examples = t.orders.where(F.col("o_totalprice") > 490000).select(F.col("o_custkey").alias("c_custkey"))
    return analytics.sample_excluding(t.customer.select("c_custkey", "c_name"), "c_custkey", 40, examples, 43)


@query(
    "g01_component_sets",
    f"""SELECT types, count(*) AS n FROM (SELECT doc_id, string_agg(type, ',' ORDER BY type) AS types
        FROM {_classified_sql('documents', 'text')} GROUP BY doc_id) GROUP BY types""",
)
def component_sets(t: Tables):
    types = F.array_join(F.sort_array(classify_sql(F.col("text"))), ",")
    return t.documents.select(types.alias("types")).where(F.col("types") != "").groupBy("types").agg(F.count(F.lit(1)).alias("n"))
