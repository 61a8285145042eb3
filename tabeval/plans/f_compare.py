"""F1-F12 over the driver tables: result sets are orders and line items, and altered copies of them."""

from pyspark.sql import functions as F

from tabeval.operators import compare
from tabeval.plans.d_workload import QUERIES_SQL, labelled
from tabeval.plans.registry import Tables, query

RESULT = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]


def result(t: Tables):
    return t.orders.select(*RESULT)


def one_cell_changed(df, top=None):
    """The row of the dearest order gets another status; ``top`` is its price, if it is known."""
    top = df.agg(F.max("o_totalprice")).scalar() if top is None else top
    return df.withColumn("o_orderstatus", F.when(F.col("o_totalprice") == top, "X").otherwise(F.col("o_orderstatus")))


CHANGED_SQL = """(SELECT o_orderkey, o_custkey, CASE WHEN o_totalprice = (SELECT max(o_totalprice) FROM orders) THEN 'X' ELSE o_orderstatus END
    AS o_orderstatus, o_totalprice FROM orders)"""


@query("f01_align", "SELECT 'expected' AS side, o_orderkey AS c0, o_orderstatus AS c1 FROM orders UNION ALL SELECT 'actual', l_orderkey, l_linestatus FROM lineitem")
def align(t: Tables):
    left, right = compare.align(t.orders.select("o_orderkey", "o_orderstatus"), t.lineitem.select("l_orderkey", "l_linestatus"))
    return left.withColumn("side", F.lit("expected")).unionByName(right.withColumn("side", F.lit("actual")))


@query(
    "f02_ordered_differences",
    f"SELECT a.o_orderkey, a.o_orderstatus AS expected_status, b.o_orderstatus AS actual_status FROM orders a JOIN {CHANGED_SQL} b ON a.o_orderkey = b.o_orderkey WHERE a.o_orderstatus <> b.o_orderstatus",
)
def ordered_differences(t: Tables):
    found = compare.ordered_differences(result(t), one_cell_changed(result(t)), "o_orderkey")
    return found.select(
        "o_orderkey", F.col("expected.o_orderstatus").alias("expected_status"), F.col("actual.o_orderstatus").alias("actual_status")
    )


@query("f03_drop_all_null", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def drop_all_null(t: Tables):
    return compare.drop_all_null(t.customer.withColumn("empty", F.lit(None).cast("string")))


@query("f04_normalize_missing", "SELECT event_id, CASE event_type WHEN 'view' THEN NULL WHEN 'click' THEN NULL ELSE event_type END AS event_type FROM events")
def normalize_missing(t: Tables):
    kind = F.col("event_type")
    gaps = t.events.select("event_id", F.when(kind == "view", "{}").when(kind == "click", "").otherwise(kind).alias("event_type"))
    return compare.normalize_missing(gaps)


@query(
    "f05_f10_bag_differences",
    f"""SELECT o_orderstatus, o_totalprice, CASE WHEN sum(n) > 0 THEN 'expected' ELSE 'actual' END AS side, CAST(abs(sum(n)) AS BIGINT) AS surplus FROM (
          SELECT o_orderstatus, o_totalprice, 1 AS n FROM orders UNION ALL SELECT o_orderstatus, o_totalprice, -1 FROM {CHANGED_SQL}
          UNION ALL SELECT o_orderstatus, o_totalprice, -1 FROM orders WHERE o_totalprice > 480000) GROUP BY 1, 2 HAVING sum(n) <> 0""",
)
def bag_differences(t: Tables):
    expected = t.orders.select("o_orderstatus", "o_totalprice")
    extra = expected.where(F.col("o_totalprice") > 480000)
    actual = one_cell_changed(result(t)).select("o_orderstatus", "o_totalprice").unionAll(extra)
    return compare.bag_differences(expected, actual)


@query(
    "f06_tolerant_differences",
    """SELECT e.l_orderkey, e.l_extendedprice AS expected_price, a.l_extendedprice AS actual_price FROM
         (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS p FROM lineitem) e
       JOIN (SELECT * REPLACE (CASE WHEN l_quantity = 7 THEN l_extendedprice * 1.001 ELSE l_extendedprice * 1.000001 END AS l_extendedprice),
               row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS p FROM lineitem) a ON a.p = e.p
       WHERE NOT abs(e.l_extendedprice - a.l_extendedprice) <= 1e-8 + 1e-5 * abs(a.l_extendedprice)""",
)
def tolerant_differences(t: Tables):
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    noise = F.when(F.col("l_quantity") == 7, 1.001).otherwise(1.000001)
    noisy = t.lineitem.withColumn("l_extendedprice", F.col("l_extendedprice") * noise).select(*columns)
    found = compare.tolerant_differences(t.lineitem.select(*columns), noisy)
    return found.select(
        F.col("e_l_orderkey").alias("l_orderkey"), F.col("e_l_extendedprice").alias("expected_price"),
        F.col("a_l_extendedprice").alias("actual_price"),
    )


@query("f07_align_by_name", "SELECT c_acctbal AS c0, c_custkey AS c1, c_mktsegment AS c2, c_name AS c3, c_nationkey AS c4 FROM customer")
def align_by_name(t: Tables):
    ordered = compare.align_by_name(t.customer)
    return ordered.toDF(*[f"c{i}" for i in range(len(ordered.columns))])


@query("f08_drop_row_ids", "SELECT p_name, p_size FROM part")
def drop_row_ids(t: Tables):
    wide = t.part.select(F.col("p_partkey").alias("v1"), F.col("p_partkey").alias("COL1"), "p_name", "p_size")
    return compare.drop_row_ids(wide, {"v1": "FilePos", "p_name": "String", "p_size": "Int64"})


def holed(df, text):
    """One status is written as ``text``."""
    return df.withColumn("o_orderstatus", F.when(F.col("o_orderstatus") == "P", F.lit(text)).otherwise(F.col("o_orderstatus")))


def topped(df, value, top):
    """The dearest order, at a price of ``top``, costs ``value``, which need not be finite."""
    return df.withColumn("o_totalprice", F.when(F.col("o_totalprice") == top, F.lit(float(value))).otherwise(F.col("o_totalprice")))


def noisy(df):
    return df.withColumn("o_totalprice", F.col("o_totalprice") * (1 + 1e-9))


def mapped(df):
    return df.select("o_orderkey", "o_custkey", F.create_map(F.lit("status"), "o_orderstatus").alias("m"))


@query(
    "f09_verdicts",
    """SELECT * FROM (VALUES ('same order', 'correct'), ('shuffled', 'correct'), ('one cell changed', 'comparison'),
         ('one row dropped', 'comparison'), ('one row twice', 'comparison'), ('small noise', 'correct'), ('large noise', 'comparison'),
         ('column missing', 'comparison'), ('expected column all null', 'correct'), ('failed', 'error'), ('empty response', 'error'),
         ('empty texts shuffled', 'correct'), ('empty text against null', 'comparison'), ('empty record against null', 'correct'),
         ('decimal against double', 'correct'), ('two columns of one name', 'correct'), ('map column', 'correct'), ('map changed', 'comparison'),
         ('one name and a place', 'correct'), ('infinite against a number', 'comparison'), ('not a number against a number', 'comparison'),
         ('infinite on both sides', 'correct'), ('noise beside infinite', 'correct'), ('infinite of either sign', 'comparison'),
         ('not a number, same bags', 'correct'), ('noise beside not a number', 'comparison'), ('truth values as numbers', 'correct')) v(kind, verdict)""",
)
def verdicts(t: Tables):
    base = result(t)
    # read once: as subqueries they would be read again in every job
    top, dearest = base.agg(F.max("o_orderkey"), F.max("o_totalprice")).first()
    price = F.col("o_totalprice")
    cases = {
        "same order": (base, base, "o_orderkey"),
        "shuffled": (base, base.repartition(5, "o_custkey"), None),
        "one cell changed": (base, one_cell_changed(base, dearest), None),
        "one row dropped": (base, base.where(F.col("o_orderkey") < top), None),
        "one row twice": (base, base.unionAll(base.where(F.col("o_orderkey") == top)), None),
        "small noise": (base, base.withColumn("o_totalprice", price * (1 + 1e-9)), None),
        "large noise": (base, base.withColumn("o_totalprice", price * 1.01), None),
        "column missing": (base, base.drop("o_custkey"), None),
        "expected column all null": (base.withColumn("none", F.lit(None).cast("string")), base, None),
        "empty texts shuffled": (holed(base, ""), holed(base, "").repartition(5, "o_custkey"), None),
        "empty text against null": (holed(base, None), holed(base, ""), None),
        "empty record against null": (holed(base, None), holed(base, "{}"), None),
        "decimal against double": (base.withColumn("o_totalprice", price.cast("decimal(18,4)")), base.withColumn("o_totalprice", price.cast("double") * (1 + 1e-10)), None),
        "two columns of one name": (base.select("o_orderkey", "o_custkey", F.col("o_custkey").alias("o_orderkey")), base.select("o_orderkey", "o_custkey", "o_custkey"), None),
        "map column": (mapped(base), mapped(base).repartition(5, "o_custkey"), None),
        "map changed": (mapped(base), mapped(one_cell_changed(base, dearest)), None),
        "one name and a place": (base.select("o_orderkey", "o_custkey", F.col("o_totalprice").alias("o_custkey")), base.select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey"),
        "infinite against a number": (base, topped(base, "Infinity", dearest), None),
        "not a number against a number": (base, topped(base, "NaN", dearest), None),
        "infinite on both sides": (topped(base, "Infinity", dearest), topped(base, "Infinity", dearest).repartition(5, "o_custkey"), None),
        "noise beside infinite": (topped(base, "Infinity", dearest), noisy(topped(base, "Infinity", dearest)), None),
        "infinite of either sign": (topped(base, "Infinity", dearest), topped(base, "-Infinity", dearest), None),
        "not a number, same bags": (topped(base, "NaN", dearest), topped(base, "NaN", dearest), None),
        "noise beside not a number": (topped(base, "NaN", dearest), noisy(topped(base, "NaN", dearest)), None),
        "truth values as numbers": (base.select("o_orderkey", F.col("o_totalprice") > 9), base.select("o_orderkey", (F.col("o_totalprice") > 9).cast("int")), None),
        "failed": (base, None, None),
        "empty response": (base, base.select(), None),
    }
    rows = [(kind, verdict) for kind, (verdict, _) in compare.compare_all(cases).items()]
    return t.spark.createDataFrame(rows, "kind string, verdict string")


@query(
    "f11_scalar_match",
    """SELECT d.doc_id, n_chars AS gold, CASE WHEN toxic = 1 THEN n_chars + 1 ELSE n_chars END AS predicted,
         coalesce(toxic = 0 AND quality = 1, false) AS label, coalesce(quality = 0, false) AS error
       FROM documents d LEFT JOIN (SELECT * FROM labels) l ON l.doc_id = d.doc_id""",
)
def scalar_match(t: Tables):
    gold = t.documents.select("doc_id", F.col("n_chars").alias("gold"))
    predicted = F.when(F.col("toxic") == 1, F.col("gold") + 1).otherwise(F.col("gold"))
    guesses = gold.join(t.labels, "doc_id", "left").select(
        "doc_id", predicted.alias("predicted"), F.when(F.col("quality") == 0, 3).otherwise(1).alias("tries"), "quality"
    )
    matched = compare.scalar_match(guesses.where(F.col("quality").isNotNull()), gold, "doc_id", "predicted", "gold", "tries")
    return matched.withColumn("predicted", F.coalesce("predicted", "gold"))


@query(
    "f11_scalar_accuracy",
    """SELECT count(*) AS n, round(avg(CASE WHEN toxic = 0 AND quality = 1 THEN 1 ELSE 0 END), 9) AS accuracy
       FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def scalar_accuracy(t: Tables):
    return scalar_match(t).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.col("label").cast("int")), 9).alias("accuracy"))


@query(
    "f12_execution_accuracy",
    f"""SELECT lang, source, count(*) AS n, round(avg(CASE WHEN verdict = 'correct' THEN 1 ELSE 0 END), 9) AS accuracy FROM {QUERIES_SQL} GROUP BY ALL
        UNION ALL SELECT NULL, NULL, count(*), round(avg(CASE WHEN verdict = 'correct' THEN 1 ELSE 0 END), 9) FROM {QUERIES_SQL}""",
)
def execution_accuracy(t: Tables):
    per_dataset = compare.execution_accuracy(labelled(t), ["lang", "source"], "verdict")
    overall = compare.execution_accuracy(labelled(t), [], "verdict")
    both = per_dataset.unionByName(overall, allowMissingColumns=True)
    return both.withColumn("accuracy", F.round("accuracy", 9))
