"""J1-J11 over the driver tables."""

from pyspark.sql import functions as F

from tabeval.operators import splits
from tabeval.plans.registry import Tables, query


@query(
    "j01_suitable",
    """SELECT * FROM (VALUES ('customer', 'c_acctbal,c_nationkey', true), ('text inputs', NULL, false), ('numeric target', NULL, false),
         ('unknown column', NULL, false), ('no target', NULL, false), ('one class', NULL, false)) v(kind, inputs, is_suitable)""",
)
def suitable(t: Tables):
    base = t.customer.withColumn("constant", F.lit("same"))
    cases = {
        "customer": (["c_acctbal", "c_nationkey", "c_name"], "c_mktsegment"),
        "text inputs": (["c_name", "c_acctbal"], "c_mktsegment"),
        "numeric target": (["c_acctbal", "c_custkey"], "c_nationkey"),
        "unknown column": (["c_acctbal", "c_phone"], "c_mktsegment"),
        "no target": (["c_acctbal", "c_nationkey"], None),
        "one class": (["c_acctbal", "c_nationkey"], "missing_target"),
    }
    base = base.withColumn("missing_target", F.lit(None).cast("string"))
    rows = []
    for kind, (inputs, target) in cases.items():
        kept = splits.suitable(base, inputs, target)
        rows.append((kind, ",".join(kept) if kept else None, kept is not None))
    return t.spark.createDataFrame(rows, "kind string, inputs string, is_suitable boolean")


@query(
    "j02_problem_type",
    """SELECT o_orderpriority, 'o_orderstatus' AS target, count(DISTINCT o_orderstatus) AS classes,
         CASE WHEN count(DISTINCT o_orderstatus) <= 2 THEN 'binary' ELSE 'multiclass' END AS problem_type FROM orders GROUP BY 1
       UNION ALL SELECT o_orderpriority, 'o_totalprice', count(DISTINCT o_totalprice), 'regression' FROM orders GROUP BY 1""",
)
def problem_type(t: Tables):
    frames = [
        splits.problem_type(t.orders, target, ["o_orderpriority"]).select("o_orderpriority", F.lit(target).alias("target"), "classes", "problem_type")
        for target in ("o_orderstatus", "o_totalprice")
    ]
    return frames[0].unionByName(frames[1])


@query(
    "j03_to_dataset",
    """SELECT o_orderkey, o_totalprice AS x0, o_custkey::DOUBLE AS x1, coalesce(y, -1)::INTEGER AS y FROM
         (SELECT *, nullif(o_orderpriority, '5-LOW') AS label FROM orders) o
       LEFT JOIN (SELECT o_orderpriority, row_number() OVER (ORDER BY min(o_orderkey)) - 1 AS y FROM orders
                  WHERE o_orderpriority <> '5-LOW' GROUP BY 1) c ON c.o_orderpriority = o.label""",
)
def to_dataset(t: Tables):
    holed = t.orders.withColumn("label", F.nullif("o_orderpriority", F.lit("5-LOW")))
    data = splits.to_dataset(holed, ["o_totalprice", "o_custkey"], "label", "o_orderkey")
    return data.select("o_orderkey", F.col("features")[0].alias("x0"), F.col("features")[1].alias("x1"), "y")


@query("j04_encode_labels", "SELECT p_partkey, p_brand, (dense_rank() OVER (ORDER BY p_brand) - 1)::INTEGER AS code FROM part")
def encode_labels(t: Tables):
    return splits.encode_labels(t.part.select("p_partkey", "p_brand"), "p_brand")


@query(
    "j05_eval_sizes",
    """SELECT o_custkey, n, CASE WHEN 2 * 5 > least(n, 2000) THEN least(n, 2000) // 2 ELSE 5 END AS train_rows,
         2 * CASE WHEN 2 * 5 > least(n, 2000) THEN least(n, 2000) // 2 ELSE 5 END AS window_rows
       FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)""",
)
def eval_sizes(t: Tables):
    sizes = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return sizes.withColumns(splits.eval_sizes(F.col("n"), 5))


def window_sql(source: str, dataset: str, order: str, label: str, position: int, columns: str) -> str:
    """The rows (dataset, columns, place, part) of the first of eight windows whose halves hold every class."""
    train = f"(CASE WHEN 2 * {position} > least(n, 2000) THEN least(n, 2000) // 2 ELSE {position} END)"
    return f"""(
      WITH numbered AS (
        SELECT *, row_number() OVER (PARTITION BY {dataset} ORDER BY {order}) - 1 AS row_no FROM {source}
      ), facts AS (
        SELECT {dataset}, n, classes, {train} AS train_rows FROM (
          SELECT {dataset}, count(*) AS n, count(DISTINCT {label}) AS classes FROM {source} GROUP BY ALL)
      ), tries AS (
        SELECT {dataset}, classes, train_rows, try, CASE WHEN n > 2 * train_rows
            THEN ('0x' || substr(md5((try + 13)::VARCHAR || ':' || n::VARCHAR), 1, 8))::BIGINT % (n - 2 * train_rows + 1) ELSE 0 END AS first_row
        FROM facts, (SELECT unnest(range(8)) AS try)
      ), candidate AS (
        SELECT numbered.*, classes, try, row_no - first_row AS place, CASE WHEN row_no - first_row < train_rows THEN 'train' ELSE 'test' END AS part
        FROM numbered JOIN tries ON numbered.{dataset} = tries.{dataset} AND row_no >= first_row AND row_no < first_row + 2 * train_rows
      ), chosen AS (
        SELECT {dataset}, min(try) AS try FROM (
          SELECT {dataset}, try, bool_and(complete) AND count(*) = 2 AS fits FROM (
            SELECT {dataset}, try, part, count(DISTINCT {label}) = max(classes) AS complete FROM candidate GROUP BY ALL) GROUP BY ALL)
        WHERE fits GROUP BY ALL
      )
      SELECT {dataset}, {columns}, place::BIGINT AS place, part FROM candidate SEMI JOIN chosen USING ({dataset}, try))"""


@query(
    "j06_valid_split",
    "SELECT * FROM "
    + window_sql("lineitem", "l_linenumber", "l_orderkey, l_partkey, l_suppkey, l_quantity", "l_returnflag", 1000, "l_orderkey, l_partkey, l_suppkey, l_returnflag, l_quantity"),
)
def valid_split(t: Tables):
    # one dataset per line number; the label is the return flag
    return splits.valid_split(
        t.lineitem.select("l_linenumber", "l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity").withColumn(
            "row_id", F.struct("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
        ),
        "l_linenumber", "row_id", "l_returnflag", 1000,
    ).drop("row_id")


@query(
    "j06_valid_split_counts",
    """SELECT l_linenumber, part, least(n, 2000) // 2 AS n, 3::BIGINT AS classes FROM
         (SELECT l_linenumber, count(*) AS n FROM lineitem GROUP BY 1), (VALUES ('train'), ('test')) v(part)""",
)
def valid_split_counts(t: Tables):
    """However the window lies, both halves have their size and all classes."""
    return valid_split(t).groupBy("l_linenumber", "part").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("l_returnflag").alias("classes")
    )


@query(
    "j07_train_valid",
    """SELECT c_custkey, c_mktsegment, CASE WHEN no < n - CAST(floor(n * 0.8) AS BIGINT) THEN 'valid' ELSE 'train' END AS split FROM (
         SELECT *, row_number() OVER (ORDER BY md5(c_custkey::VARCHAR || '42')) - 1 AS no, count(*) OVER () AS n
         FROM customer WHERE c_mktsegment <> 'BUILDING')""",
)
def train_valid(t: Tables):
    holed = t.customer.withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    return splits.train_valid(holed, ["c_acctbal", "c_mktsegment"], "c_custkey").drop("c_acctbal")


@query(
    "j08_train_valid_test",
    """SELECT o_orderkey, o_totalprice, o_orderstatus AS output, CASE WHEN no < n - 2 * u THEN 'train' WHEN no < n - u THEN 'valid' ELSE 'test' END AS split
       FROM (SELECT *, row_number() OVER (ORDER BY md5(o_orderkey::VARCHAR || '42')) - 1 AS no, count(*) OVER () AS n,
               CAST(floor(count(*) OVER () * 0.1) AS BIGINT) AS u FROM orders)""",
)
def train_valid_test(t: Tables):
    rows = splits.train_valid_test(t.orders, ["o_totalprice", "o_custkey"], "o_orderstatus", "o_orderkey")
    return rows.select("o_orderkey", F.col("inputs.o_totalprice").alias("o_totalprice"), "output", "split")


ROW_ORDER = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@query(
    "j09_balanced_binary",
    f"""SELECT l_orderkey, l_partkey, l_suppkey, y, 2 * no + y AS place FROM (
          SELECT *, row_number() OVER (PARTITION BY y ORDER BY {', '.join(ROW_ORDER)}) - 1 AS no, least(sum(y) OVER (), sum(1 - y) OVER ()) AS m
          FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem)) WHERE no < m""",
)
def balanced_binary(t: Tables):
    marked = t.lineitem.select(*ROW_ORDER, F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"))
    return splits.balanced_binary(marked, "y", ROW_ORDER).select("l_orderkey", "l_partkey", "l_suppkey", "y", "place")


@query("j10_shuffle_cap", "SELECT doc_id, lang FROM documents ORDER BY md5(doc_id::VARCHAR || '13'), doc_id LIMIT 150")
def shuffle_cap(t: Tables):
    return splits.shuffle_cap(t.documents.select("doc_id", "lang"), "doc_id", 150)


@query(
    "j11_kfold",
    "SELECT o_orderkey, (('0x' || substr(md5(o_orderkey::VARCHAR || '42'), 1, 8))::BIGINT % 5)::INTEGER AS fold FROM orders",
)
def kfold(t: Tables):
    return splits.kfold(t.orders.select("o_orderkey"), "o_orderkey")


@query(
    "j11_stratified_kfold",
    """SELECT o_orderkey, o_orderstatus, ((row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(o_orderkey::VARCHAR || '42'), o_orderkey) - 1) % 5)::INTEGER AS fold
       FROM orders""",
)
def stratified_kfold(t: Tables):
    return splits.stratified_kfold(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderkey", "o_orderstatus")
