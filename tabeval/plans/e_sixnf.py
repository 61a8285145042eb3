"""E14, E36-E41, M1, M2 over the driver tables in column-per-relation form."""

from pyspark.sql import functions as F

from tabeval.operators import sixnf
from tabeval.plans.registry import Tables, query

COLUMNS = ["c_name", "c_nationkey", "c_mktsegment"]
HOLED_SQL = "(SELECT c_custkey, c_name, c_nationkey, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment FROM customer)"
TRIPLES_SQL = f"""(SELECT 'c_name' AS col, c_custkey AS row_id, c_name AS val, c_name IS NULL AS missing FROM {HOLED_SQL}
    UNION ALL SELECT 'c_nationkey', c_custkey, c_nationkey::VARCHAR, c_nationkey IS NULL FROM {HOLED_SQL}
    UNION ALL SELECT 'c_mktsegment', c_custkey, c_mktsegment, c_mktsegment IS NULL FROM {HOLED_SQL})"""


def holed(t: Tables):
    return t.customer.withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))


def triples(t: Tables):
    return sixnf.to_sixnf(holed(t), "c_custkey", COLUMNS)


@query(
    "e14_cross_product_of_columns_and_rows",
    "SELECT col, c_custkey AS row_id FROM customer CROSS JOIN (VALUES ('c_name'), ('c_nationkey'), ('c_mktsegment')) v(col)",
)
def cross_product(t: Tables):
    return sixnf.columns_by_rows(t.customer, "c_custkey", COLUMNS)


@query("e36_to_sixnf", f"SELECT * FROM {TRIPLES_SQL}")
def to_sixnf(t: Tables):
    return triples(t)


@query("e37_from_sixnf", f"SELECT c_custkey AS row_id, c_name, c_nationkey, c_mktsegment FROM {HOLED_SQL}")
def from_sixnf(t: Tables):
    return sixnf.from_sixnf(triples(t), {"c_name": "string", "c_nationkey": "int", "c_mktsegment": "string"})


@query(
    "e38_sixnf_row_filter",
    f"SELECT col, row_id, val FROM {TRIPLES_SQL} WHERE row_id IN (SELECT c_custkey FROM customer WHERE c_nationkey > 12)",
)
def row_filter(t: Tables):
    return sixnf.rows_where(triples(t), "c_nationkey", F.col("val").cast("int") > 12).drop("missing")


@query(
    "e39_sixnf_join_on_shared_value",
    """SELECT o_orderkey AS order_row, o_orderpriority AS priority, c_mktsegment AS segment
       FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment <> 'BUILDING'""",
)
def join_on_shared_value(t: Tables):
    orders = sixnf.to_sixnf(t.orders, "o_orderkey", ["o_custkey", "o_orderpriority"])
    customers = sixnf.to_sixnf(holed(t), "c_custkey", ["c_custkey", "c_mktsegment"])
    placed = sixnf.relation(orders, "o_custkey", "order_row", "customer")
    known = sixnf.relation(customers, "c_custkey", "customer_row", "customer")
    both = sixnf.join_on_value(placed, known, "customer")
    return (
        both.join(sixnf.relation(orders, "o_orderpriority", "order_row", "priority"), "order_row")
        .join(sixnf.relation(customers, "c_mktsegment", "customer_row", "segment"), "customer_row")
        .select("order_row", "priority", "segment")
    )


@query("e40_existential_projection", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem WHERE l_quantity > 45")
def existential_projection(t: Tables):
    return sixnf.exists(t.lineitem.where(F.col("l_quantity") > 45), ["l_suppkey", "l_returnflag"])


@query("e40_kept_projection", "SELECT l_orderkey, l_suppkey, l_returnflag FROM lineitem WHERE l_quantity > 45")
def kept_projection(t: Tables):
    return t.lineitem.where(F.col("l_quantity") > 45).select("l_orderkey", "l_suppkey", "l_returnflag")


@query(
    "e41_named_intermediate_relations",
    """WITH big AS (SELECT o_custkey, o_orderkey FROM orders WHERE o_totalprice > 200000),
            returned AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R'),
            clean AS (SELECT o_custkey FROM big WHERE o_orderkey NOT IN (SELECT l_orderkey FROM returned))
       SELECT c_name, count(*) AS n FROM clean JOIN customer ON o_custkey = c_custkey GROUP BY c_name""",
)
def named_relations(t: Tables):
    big = t.orders.where(F.col("o_totalprice") > 200000).select("o_custkey", "o_orderkey")
    returned = t.lineitem.where(F.col("l_returnflag") == "R").select("l_orderkey")
    clean = big.join(returned, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti")
    return clean.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_name").agg(F.count(F.lit(1)).alias("n"))


def orders_above(limit: float, status: str):
    """A user-defined relation with parameters, for use with DataFrame.transform."""
    return lambda orders: orders.where((F.col("o_totalprice") > limit) & (F.col("o_orderstatus") == status))


@query(
    "m01_parameterised_relation",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 350000 AND o_orderstatus = 'F'",
)
def parameterised_relation(t: Tables):
    return t.orders.transform(orders_above(350000, "F")).select("o_orderkey", "o_totalprice")


@query(
    "m02_user_aggregate",
    """SELECT event_type, round(sqrt(avg(value * value)), 6) AS root_mean_square, round(max(value) - min(value), 6) AS spread
       FROM events GROUP BY 1""",
)
def user_aggregate(t: Tables):
    # a user aggregate is a function from a column to an aggregate expression
    root_mean_square = lambda c: F.sqrt(F.avg(c * c))
    spread = lambda c: F.max(c) - F.min(c)
    value = F.col("value")
    return t.events.groupBy("event_type").agg(
        F.round(root_mean_square(value), 6).alias("root_mean_square"), F.round(spread(value), 6).alias("spread")
    )
