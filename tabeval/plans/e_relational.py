"""The relational query surface, as DataFrame queries.

Money columns have two decimals, so their sums are rounded to two digits and products to four.
"""

from pyspark.sql import functions as F

from tabeval.plans.registry import Tables, query


@query("e01_projection", "SELECT c_name, c_mktsegment FROM customer")
def projection(t: Tables):
    return t.customer.select("c_name", "c_mktsegment")


@query("e02_select_star", "SELECT * FROM customer")
def select_star(t: Tables):
    return t.customer.select("*")


@query("e03_equality_string", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'")
def equality_string(t: Tables):
    return t.orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey")


@query("e03_equality_number", "SELECT l_orderkey, l_partkey FROM lineitem WHERE l_linenumber = 3")
def equality_number(t: Tables):
    return t.lineitem.where(F.col("l_linenumber") == 3).select("l_orderkey", "l_partkey")


@query(
    "e04_range_conjunction",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
       WHERE l_quantity > 10 AND l_quantity <= 20 AND l_discount >= 0.05 AND l_returnflag = 'N'""",
)
def range_conjunction(t: Tables):
    return t.lineitem.where(
        (F.col("l_quantity") > 10)
        & (F.col("l_quantity") <= 20)
        & (F.col("l_discount") >= 0.05)
        & (F.col("l_returnflag") == "N")
    ).select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "e05_disjunction_across_join",
    """SELECT o_orderkey, c_name, o_totalprice, c_acctbal FROM orders JOIN customer ON o_custkey = c_custkey
       WHERE o_totalprice >= 400000 OR c_acctbal >= 9000""",
)
def disjunction_across_join(t: Tables):
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .where((F.col("o_totalprice") >= 400000) | (F.col("c_acctbal") >= 9000))
        .select("o_orderkey", "c_name", "o_totalprice", "c_acctbal")
    )


@query("e06_in_list", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def in_list(t: Tables):
    return t.orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey", "o_orderpriority")


@query("e07_like_ignoring_case", "SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%RING%'")
def like_ignoring_case(t: Tables):
    return t.part.where(F.col("p_name").ilike("%RING%")).select("p_partkey", "p_name")


@query(
    "e08_negation_anti_join",
    """SELECT c_custkey, c_name FROM customer c
       WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)""",
)
def negation_anti_join(t: Tables):
    dear = t.orders.where(F.col("o_totalprice") > 300000)
    return t.customer.join(dear, F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey", "c_name")


@query(
    "e08_negation_left_join_null",
    """SELECT c_custkey, c_name FROM customer
       LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
       WHERE o_orderkey IS NULL""",
)
def negation_left_join_null(t: Tables):
    urgent = t.orders.where((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"))
    return (
        t.customer.join(urgent, F.col("o_custkey") == F.col("c_custkey"), "left")
        .where(F.col("o_orderkey").isNull())
        .select("c_custkey", "c_name")
    )


@query(
    "e09_inner_join",
    "SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'",
)
def inner_join(t: Tables):
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .where(F.col("c_mktsegment") == "BUILDING")
        .select("o_orderkey", "c_name", "c_mktsegment")
    )


@query(
    "e10_multi_key_join",
    """SELECT l_orderkey, l_linenumber, l_partkey, lines FROM lineitem
       JOIN (SELECT l_orderkey AS k, l_linenumber AS n, count(*) AS lines FROM lineitem GROUP BY 1, 2) d
         ON l_orderkey = k AND l_linenumber = n
       WHERE l_returnflag = 'R' AND l_linestatus = 'O'""",
)
def multi_key_join(t: Tables):
    per_line = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("lines"))
    return (
        t.lineitem.where((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"))
        .join(per_line, ["l_orderkey", "l_linenumber"])
        .select("l_orderkey", "l_linenumber", "l_partkey", "lines")
    )


@query(
    "e11_join_chain",
    """SELECT o_orderkey, c_name, n_name, r_name FROM orders
       JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'""",
)
def join_chain(t: Tables):
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .where(F.col("r_name") == "ASIA")
        .select("o_orderkey", "c_name", "n_name", "r_name")
    )


@query(
    "e12_join_then_grouped_sum_of_expression",
    """SELECT n_name, round(sum(l_quantity + l_linenumber + l_extendedprice), 2) AS total_usage FROM lineitem
       JOIN supplier ON l_suppkey = s_suppkey AND l_returnflag = 'R'
       JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name""",
)
def join_then_grouped_sum(t: Tables):
    usage = F.col("l_quantity") + F.col("l_linenumber") + F.col("l_extendedprice")
    return (
        t.lineitem.where(F.col("l_returnflag") == "R")
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name")
        .agg(F.round(F.sum(usage), 2).alias("total_usage"))
    )


@query(
    "e13_join_projection_with_side_filter",
    """SELECT l_orderkey, l_extendedprice, p_name, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey
       WHERE p_size = 11""",
)
def join_projection(t: Tables):
    return (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .where(F.col("p_size") == 11)
        .select("l_orderkey", "l_extendedprice", "p_name", "p_brand")
    )


@query("e15_distinct", "SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders")
def distinct(t: Tables):
    return t.orders.select("o_orderpriority", "o_orderstatus").distinct()


@query("e16_count_rows", "SELECT count(*) AS n FROM lineitem")
def count_rows(t: Tables):
    return t.lineitem.agg(F.count(F.lit(1)).alias("n"))


@query("e17_count_distinct", "SELECT count(DISTINCT user_id) AS users, count(DISTINCT event_type) AS types FROM events")
def count_distinct(t: Tables):
    return t.events.agg(F.count_distinct("user_id").alias("users"), F.count_distinct("event_type").alias("types"))


@query("e18_global_sum", "SELECT round(sum(l_extendedprice), 2) AS total FROM lineitem")
def global_sum(t: Tables):
    return t.lineitem.agg(F.round(F.sum("l_extendedprice"), 2).alias("total"))


@query("e18_filtered_sum", "SELECT round(sum(l_quantity), 2) AS total FROM lineitem WHERE l_discount >= 0.05")
def filtered_sum(t: Tables):
    return t.lineitem.where(F.col("l_discount") >= 0.05).agg(F.round(F.sum("l_quantity"), 2).alias("total"))


@query("e19_filtered_avg", "SELECT round(avg(c_acctbal), 4) AS mean FROM customer WHERE c_mktsegment = 'MACHINERY'")
def filtered_avg(t: Tables):
    return t.customer.where(F.col("c_mktsegment") == "MACHINERY").agg(F.round(F.avg("c_acctbal"), 4).alias("mean"))


@query(
    "e20_several_aggregates",
    "SELECT round(avg(value), 4) AS mean, max(value) AS top FROM events WHERE event_type = 'purchase'",
)
def several_aggregates(t: Tables):
    return t.events.where(F.col("event_type") == "purchase").agg(
        F.round(F.avg("value"), 4).alias("mean"), F.max("value").alias("top")
    )


@query(
    "e21_min_max_set_count",
    """SELECT min(o_custkey) AS low, max(o_custkey) AS high, count(DISTINCT o_custkey) AS n
       FROM orders WHERE o_orderstatus = 'O'""",
)
def min_max_set_count(t: Tables):
    return t.orders.where(F.col("o_orderstatus") == "O").agg(
        F.min("o_custkey").alias("low"), F.max("o_custkey").alias("high"), F.count_distinct("o_custkey").alias("n")
    )


@query("e22_group_count", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment")
def group_count(t: Tables):
    return t.customer.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query(
    "e23_group_avg",
    "SELECT c_nationkey, round(avg(c_acctbal), 4) AS mean_balance FROM customer GROUP BY c_nationkey",
)
def group_avg(t: Tables):
    return t.customer.groupBy("c_nationkey").agg(F.round(F.avg("c_acctbal"), 4).alias("mean_balance"))


@query(
    "e24_group_sums",
    """SELECT l_returnflag, round(sum(l_quantity), 2) AS total_quantity, round(sum(l_extendedprice), 2) AS total_price
       FROM lineitem GROUP BY l_returnflag""",
)
def group_sums(t: Tables):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.round(F.sum("l_quantity"), 2).alias("total_quantity"),
        F.round(F.sum("l_extendedprice"), 2).alias("total_price"),
    )


@query(
    "e25_group_two_keys_after_in",
    """SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders
       WHERE o_orderpriority IN ('1-URGENT', '5-LOW') GROUP BY 1, 2""",
)
def group_two_keys(t: Tables):
    return (
        t.orders.where(F.col("o_orderpriority").isin("1-URGENT", "5-LOW"))
        .groupBy("o_orderstatus", "o_orderpriority")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "e26_group_order_by_aggregate",
    """SELECT event_type, round(avg(value), 4) AS mean_value, count(*) AS n FROM events
       GROUP BY event_type ORDER BY mean_value DESC""",
)
def group_order_by(t: Tables):
    return (
        t.events.groupBy("event_type")
        .agg(F.round(F.avg("value"), 4).alias("mean_value"), F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("mean_value"))
    )


@query(
    "e27_rows_at_maximum",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice = (SELECT max(o_totalprice) FROM orders)",
)
def rows_at_maximum(t: Tables):
    top = t.orders.agg(F.max("o_totalprice")).scalar()
    return t.orders.where(F.col("o_totalprice") == top).select("o_orderkey", "o_totalprice")


@query(
    "e28_scalar_subquery_then_group",
    """SELECT c_mktsegment, round(avg(c_nationkey), 4) AS mean_nation FROM customer
       WHERE c_acctbal > (SELECT avg(c_acctbal) FROM customer) GROUP BY c_mktsegment""",
)
def scalar_subquery_group(t: Tables):
    mean = t.customer.agg(F.avg("c_acctbal")).scalar()
    return (
        t.customer.where(F.col("c_acctbal") > mean)
        .groupBy("c_mktsegment")
        .agg(F.round(F.avg("c_nationkey"), 4).alias("mean_nation"))
    )


@query(
    "e29_percentage_above_average",
    """SELECT round(count(*) * 100.0 / (SELECT count(*) FROM customer), 4) AS percentage FROM customer
       WHERE c_acctbal > (SELECT avg(c_acctbal) FROM customer)""",
)
def percentage_above_average(t: Tables):
    mean = t.customer.agg(F.avg("c_acctbal")).scalar()
    above = F.count_if(F.col("c_acctbal") > mean)
    return t.customer.agg(
        F.round(F.try_divide(above.cast("double") * 100.0, F.count(F.lit(1))), 4).alias("percentage")
    )


@query("e30_order_by", "SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal DESC, s_suppkey")
def order_by(t: Tables):
    return t.supplier.select("s_suppkey", "s_acctbal").orderBy(F.desc("s_acctbal"), "s_suppkey")


@query(
    "e31_top_k",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
)
def top_k(t: Tables):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)


@query(
    "e32_having",
    "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 12",
)
def having(t: Tables):
    return t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 12)


@query("e33_union", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def union_set(t: Tables):
    return t.customer.select(F.col("c_nationkey").alias("k")).union(t.supplier.select("s_nationkey")).distinct()


@query("e33_union_all", "SELECT c_custkey AS k, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def union_all(t: Tables):
    customers = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    return customers.union(t.supplier.select("s_suppkey", "s_name"))


@query("e34_intersect", "SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders")
def intersect(t: Tables):
    return t.customer.select(F.col("c_custkey").alias("k")).intersect(t.orders.select("o_custkey"))


@query(
    "e35_except",
    "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'",
)
def except_set(t: Tables):
    partial = t.orders.where(F.col("o_orderstatus") == "P").select("o_custkey")
    return t.customer.select(F.col("c_custkey").alias("k")).subtract(partial)


@query(
    "e35_except_all",
    """SELECT o_custkey AS k FROM orders EXCEPT ALL SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'""",
)
def except_bag(t: Tables):
    partial = t.orders.where(F.col("o_orderstatus") == "P").select("o_custkey")
    return t.orders.select(F.col("o_custkey").alias("k")).exceptAll(partial)


@query(
    "e42_row_arithmetic",
    """SELECT l_orderkey, l_partkey, round(l_extendedprice * (1 - l_discount) * (1 + l_tax) + l_quantity, 6) AS charge
       FROM lineitem""",
)
def row_arithmetic(t: Tables):
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")) + F.col("l_quantity")
    return t.lineitem.select("l_orderkey", "l_partkey", F.round(charge, 6).alias("charge"))


@query(
    "e43_boolean_flag_and_key",
    """SELECT l_orderkey, l_partkey FROM (SELECT *, l_returnflag = 'R' AS is_returned FROM lineitem)
       WHERE is_returned AND l_linenumber = 2""",
)
def boolean_flag_and_key(t: Tables):
    flagged = t.lineitem.withColumn("is_returned", F.col("l_returnflag") == "R")
    return flagged.where(F.col("is_returned") & (F.col("l_linenumber") == 2)).select("l_orderkey", "l_partkey")
