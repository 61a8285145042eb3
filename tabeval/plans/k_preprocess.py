"""K1-K18 over the driver tables. Training rows are chosen by an ordinary column, as a split column would be."""

from pyspark.sql import functions as F

from tabeval.operators import preprocess
from tabeval.plans.registry import Tables, query


def _round(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


HOLED_SQL = "(SELECT c_custkey, c_nationkey, c_mktsegment, CASE WHEN c_nationkey % 5 <> 0 THEN c_acctbal END AS c_acctbal FROM customer)"


def holed(t: Tables):
    balance = F.when(F.col("c_nationkey") % 5 != 0, F.col("c_acctbal"))
    return t.customer.select("c_custkey", "c_nationkey", "c_mktsegment", balance.alias("c_acctbal"))


@query(
    "k01_impute_mean",
    f"""SELECT c_custkey, round(coalesce(c_acctbal, (SELECT avg(c_acctbal) FROM {HOLED_SQL} WHERE c_nationkey < 20)), 6) AS c_acctbal FROM {HOLED_SQL}""",
)
def impute_mean(t: Tables):
    filled = preprocess.impute_mean(holed(t), ["c_acctbal"], F.col("c_nationkey") < 20)
    return _round(filled, "c_acctbal").select("c_custkey", "c_acctbal")


SEGMENTS = ["AUTOMOBILE", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(
    "k02_one_hot",
    "SELECT c_custkey, c_nationkey, "
    + ", ".join(f"CASE WHEN c_mktsegment = '{s}' THEN 1.0 ELSE 0.0 END::DOUBLE AS \"c_mktsegment_{s}\"" for s in SEGMENTS)
    + " FROM customer",
)
def one_hot(t: Tables):
    # BUILDING is not among the training rows, so it is an unknown category
    rows = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    return preprocess.one_hot(rows, "c_mktsegment", F.col("c_mktsegment") != "BUILDING")


@query(
    "k02_one_hot_sparse",
    """SELECT l_orderkey, l_partkey, l_suppkey, (SELECT count(DISTINCT l_suppkey) FROM lineitem WHERE l_linenumber <= 2) AS size, place,
         CASE WHEN place IS NULL THEN 0 ELSE 1 END AS entries
       FROM lineitem LEFT JOIN (SELECT l_suppkey, row_number() OVER (ORDER BY l_suppkey) - 1 AS place FROM (SELECT DISTINCT l_suppkey FROM lineitem WHERE l_linenumber <= 2)) c
         USING (l_suppkey)""",
)
def one_hot_sparse(t: Tables):
    """A place per supplier of the training rows."""
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", F.col("l_suppkey").alias("supplier"))
    hot = preprocess.one_hot_sparse(rows, "supplier", F.col("l_linenumber") <= 2)
    # the entries of the sparse vector itself: as an array, it would hold every supplier in every row
    flags = F.unwrap_udt("supplier_hot")
    size, place = flags["size"].cast("bigint"), F.get(flags["indices"], F.lit(0)).cast("bigint")
    entries = F.aggregate(flags["values"], F.lit(0.0), lambda total, x: total + x).cast("int")
    return hot.select("l_orderkey", "l_partkey", "l_suppkey", size.alias("size"), place.alias("place"), entries.alias("entries"))


@query(
    "k03_min_max",
    """SELECT l_orderkey, l_partkey, round((l_quantity - a) / (b - a), 6) AS l_quantity, round((l_extendedprice - c) / (d - c), 6) AS l_extendedprice
       FROM lineitem, (SELECT min(l_quantity) AS a, max(l_quantity) AS b, min(l_extendedprice) AS c, max(l_extendedprice) AS d FROM lineitem WHERE l_linenumber <= 4)""",
)
def min_max(t: Tables):
    scaled = preprocess.min_max(t.lineitem, ["l_quantity", "l_extendedprice"], F.col("l_linenumber") <= 4)
    return _round(scaled, "l_quantity", "l_extendedprice").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")


@query(
    "k04_z_score",
    """SELECT l_orderkey, l_partkey, round(greatest(least((l_extendedprice - m) / (s + 0.000001), 100), -100), 6) AS l_extendedprice
       FROM lineitem, (SELECT avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS s FROM lineitem WHERE l_linenumber <= 4)""",
)
def z_score(t: Tables):
    scaled = preprocess.z_score(t.lineitem, ["l_extendedprice"], F.col("l_linenumber") <= 4)
    return _round(scaled, "l_extendedprice").select("l_orderkey", "l_partkey", "l_extendedprice")


@query(
    "k05_masked_stats",
    f"""SELECT c_mktsegment, 'c_acctbal' AS col, round(avg(c_acctbal), 6) AS mean, round(stddev_samp(c_acctbal), 6) AS std,
          round(1 - count(c_acctbal) / count(*), 9) AS ignored_share FROM {HOLED_SQL} GROUP BY 1""",
)
def masked_stats(t: Tables):
    stats = preprocess.masked_stats(holed(t), ["c_acctbal"], group=["c_mktsegment"])
    return _round(_round(stats, "mean", "std"), "ignored_share", digits=9)


@query(
    "k06_soft_clip",
    """WITH v AS (SELECT event_id, CASE WHEN event_id % 97 = 0 THEN value * 40 ELSE value END AS x FROM events),
            r AS (SELECT avg(x) AS m, stddev_samp(x) AS s FROM v),
            f AS (SELECT avg(x) AS m, stddev_samp(x) AS s FROM v, r WHERE x BETWEEN r.m - 4 * r.s AND r.m + 4 * r.s),
            u AS (SELECT event_id, greatest(-ln(1 + abs(x)) + f.m - 4 * f.s, x) AS x, f.m + 4 * f.s AS upper FROM v, f)
       SELECT event_id, round(least(ln(1 + abs(x)) + upper, x), 6) AS x FROM u""",
)
def soft_clip(t: Tables):
    spiked = F.when(F.col("event_id") % 97 == 0, F.col("value") * 40).otherwise(F.col("value"))
    return _round(preprocess.soft_clip(t.events.select("event_id", spiked.alias("x")), ["x"]), "x")


@query(
    "k07_rank_transform",
    "SELECT o_orderkey, o_orderstatus, count(*) OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice) AS rank FROM orders",
)
def rank_transform(t: Tables):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    return preprocess.rank_transform(rows, "o_totalprice", ["o_orderstatus"]).drop("o_totalprice")


@query("k08_drop_constant", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem")
def drop_constant(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", F.lit(3.0).alias("flat"), F.lit(None).cast("double").alias("empty"))
    return preprocess.drop_constant(rows, ["l_quantity", "flat", "empty"])


@query(
    "k09_scale_by_used",
    "SELECT l_orderkey, l_partkey, round(l_quantity / (18 / 100.0), 6) AS plain, round(l_quantity / sqrt(l_linenumber / 100.0), 6) AS rooted FROM lineitem",
)
def scale_by_used(t: Tables):
    quantity = F.col("l_quantity")
    return t.lineitem.select(
        "l_orderkey", "l_partkey", F.round(preprocess.scale_by_used(quantity, 18), 6).alias("plain"),
        F.round(preprocess.scale_by_used(quantity, F.col("l_linenumber"), square_root=True), 6).alias("rooted"),
    )


YEO_JOHNSON_SQL = """(CASE WHEN x >= 0 THEN CASE WHEN abs(lam) < 1e-12 THEN ln(1 + x) ELSE (pow(1 + x, lam) - 1) / lam END
  ELSE CASE WHEN abs(lam - 2) < 1e-12 THEN -ln(1 - x) ELSE -(pow(1 - x, 2 - lam) - 1) / (2 - lam) END END)"""


def _power_sql(columns: list[str], source: str, rows: str, keys: str) -> str:
    """Exponents on the same grids: nine from -3 to 5, then three times five around the peak of the parabola through the best."""
    train = " UNION ALL ".join(f"SELECT '{c}' AS col, {c}::DOUBLE AS x FROM {source} WHERE {rows}" for c in columns)
    parts = [f"""
WITH t AS MATERIALIZED ({train}
), base AS MATERIALIZED (SELECT col, count(*) AS n, sum(sign(x) * ln(1 + abs(x))) AS jac FROM t GROUP BY col
), p0 AS MATERIALIZED (SELECT col, 1.0::DOUBLE AS lam FROM base)"""]
    for r, (step, half) in enumerate([(1.0, 4), (0.2, 2), (0.02, 2), (0.002, 2)]):
        parts.append(f"""
, g{r} AS MATERIALIZED (SELECT col, i, lam + {step} * (i - {half}) AS lam FROM p{r}, (SELECT unnest(range({2 * half + 1})) AS i)
), l{r} AS MATERIALIZED (
  SELECT col, i, lam, max(-n / 2 * ln(var)) + max((lam - 1) * jac) AS score FROM (
    SELECT col, i, lam, var_pop({YEO_JOHNSON_SQL}) AS var FROM t JOIN g{r} USING (col) GROUP BY ALL) JOIN base USING (col) GROUP BY ALL
), p{r + 1} AS MATERIALIZED (
  SELECT col, CASE WHEN below IS NULL OR above IS NULL OR below - 2 * score + above >= 0 THEN lam
      ELSE lam + {step} * (below - above) / (2 * (below - 2 * score + above)) END AS lam FROM (
    SELECT *, lag(score) OVER (PARTITION BY col ORDER BY i) AS below, lead(score) OVER (PARTITION BY col ORDER BY i) AS above,
      row_number() OVER (PARTITION BY col ORDER BY score DESC, i) AS place FROM l{r}) WHERE place = 1
)""")
    parts.append(f"""
, fitted AS MATERIALIZED (SELECT col, lam, avg({YEO_JOHNSON_SQL}) AS mean, stddev_pop({YEO_JOHNSON_SQL}) AS std FROM t JOIN p4 USING (col) GROUP BY ALL)""")
    shown = ", ".join(
        f"round(((SELECT {YEO_JOHNSON_SQL} FROM (SELECT lineitem.{c}::DOUBLE AS x)) - f{i}.mean) / f{i}.std, 3) + 0.0 AS {c}".replace("lam", f"f{i}.lam") for i, c in enumerate(columns)
    )
    joins = ", ".join(f"(SELECT * FROM fitted WHERE col = '{c}') f{i}" for i, c in enumerate(columns))
    return "".join(parts) + f"\nSELECT {keys}, {shown} FROM {source}, {joins}"


def power_transformed(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_extendedprice", "l_quantity", "l_linenumber")
    return preprocess.power_transform(rows, ["l_extendedprice", "l_quantity"], F.col("l_linenumber") <= 4)


@query("k10_power_transform", _power_sql(["l_extendedprice", "l_quantity"], "lineitem", "l_linenumber <= 4", "l_orderkey, l_partkey, l_linenumber"))
def power_transform(t: Tables):
    return _round(power_transformed(t), "l_extendedprice", "l_quantity", digits=3)


@query("k11_quantile_normal")
def quantile_normal(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_extendedprice", "l_linenumber")
    return preprocess.quantile_normal(rows, "l_extendedprice", F.col("l_linenumber") <= 4)


@query(
    "k10_power_transform_moments",
    """SELECT 'l_extendedprice' AS col, count(*) AS n, true AS is_centred, true AS is_scaled FROM lineitem WHERE l_linenumber <= 4
       UNION ALL SELECT 'l_quantity', count(*), true, true FROM lineitem WHERE l_linenumber <= 4""",
)
def power_transform_moments(t: Tables):
    """The training rows of a transformed column have mean 0 and variance 1."""
    long = power_transformed(t).where(F.col("l_linenumber") <= 4).unpivot([], ["l_extendedprice", "l_quantity"], "col", "x")
    return long.groupBy("col").agg(
        F.count("x").alias("n"), (F.abs(F.avg("x")) < 1e-6).alias("is_centred"), (F.abs(F.var_pop("x") - 1) < 1e-6).alias("is_scaled")
    )


@query(
    "k11_quantile_normal_shares",
    """SELECT count(*) AS n, 0.16::DOUBLE AS below_minus_one, 0.5::DOUBLE AS below_zero, 0.84::DOUBLE AS below_one FROM lineitem WHERE l_linenumber <= 4""",
)
def quantile_normal_shares(t: Tables):
    """The training rows lie around 0 as a standard normal does."""
    rows = quantile_normal(t).where(F.col("l_linenumber") <= 4)
    share = lambda limit, name: F.round(F.avg((F.col("l_extendedprice") <= limit).cast("int")), 2).alias(name)
    return rows.agg(
        F.count(F.lit(1)).alias("n"), share(-1.0, "below_minus_one"), share(0.0, "below_zero"), share(1.0, "below_one")
    )


@query(
    "k12_robust_scale",
    """SELECT l_orderkey, l_partkey, round((l_extendedprice - q2) / ((q3 - q1) / 1.3489795003921634), 6) AS l_extendedprice FROM lineitem,
         (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS q2, quantile_cont(l_extendedprice, 0.75) AS q3
          FROM lineitem WHERE l_linenumber <= 4)""",
)
def robust_scale(t: Tables):
    scaled = preprocess.robust_scale(t.lineitem, ["l_extendedprice"], F.col("l_linenumber") <= 4)
    return _round(scaled, "l_extendedprice").select("l_orderkey", "l_partkey", "l_extendedprice")


@query("k13_subsample_features", "SELECT vec_id, 20 AS width, true AS in_order FROM embeddings")
def subsample_features(t: Tables):
    chosen = preprocess.subsample_features(F.col("embedding"), 64, 20, seed=7)
    places = preprocess.subsample_features(F.sequence(F.lit(0), F.lit(63)), 64, 20, seed=7)
    same = F.forall(places, lambda i: F.array_contains(chosen, F.get("embedding", i)))
    return t.embeddings.select("vec_id", F.size(chosen).alias("width"), (same & (F.sort_array(places) == places)).alias("in_order"))


@query(
    "k14_shift_and_pad_features",
    """SELECT vec_id, place - 1 AS place, round(x, 6) AS x FROM (
         SELECT vec_id, unnest(list_concat(embedding[6:64], embedding[1:5], list_value(0.0, 0.0, 0.0, 0.0, 0.0, 0.0)))::DOUBLE AS x,
           generate_subscripts(list_concat(embedding[6:64], embedding[1:5], list_value(0.0, 0.0, 0.0, 0.0, 0.0, 0.0)), 1) AS place FROM embeddings)""",
)
def shift_and_pad(t: Tables):
    shifted = preprocess.shift_features(F.col("embedding").cast("array<double>"), 5, 70)
    long = t.embeddings.select("vec_id", F.posexplode(shifted).alias("place", "x"))
    return long.select("vec_id", F.col("place").cast("bigint").alias("place"), F.round("x", 6).alias("x"))


@query(
    "k15_shift_labels",
    """SELECT vec_id, (label + 3) % 10 AS shifted, round(embedding[4]::DOUBLE, 6) AS first_output, round(embedding[3]::DOUBLE, 6) AS last_output FROM embeddings""",
)
def shift_labels(t: Tables):
    outputs = preprocess.unshift_outputs(F.slice("embedding", 1, 10).cast("array<double>"), 3)
    return t.embeddings.select(
        "vec_id", preprocess.shift_labels(F.col("label"), 3, 10).alias("shifted"),
        F.round(outputs[0], 6).alias("first_output"), F.round(F.element_at(outputs, -1), 6).alias("last_output"),
    )


@query(
    "k16_missing_codes",
    """SELECT event_id, CASE event_type WHEN 'error' THEN -1 WHEN 'click' THEN 1 WHEN 'signup' THEN 2 ELSE 0 END AS code,
         CASE event_type WHEN 'error' THEN 0 WHEN 'click' THEN 3.4028234663852886e38 WHEN 'signup' THEN -3.4028234663852886e38 ELSE value END::DOUBLE AS filled FROM events""",
)
def missing_codes(t: Tables):
    kind = F.col("event_type")
    broken = (
        F.when(kind == "error", float("nan")).when(kind == "click", float("inf")).when(kind == "signup", -float("inf"))
        .otherwise(F.col("value"))
    )
    filled, code = preprocess.missing_codes(broken)
    return t.events.select("event_id", code.alias("code"), filled.alias("filled"))


@query(
    "k17_missing_as_class",
    "SELECT o_orderkey, coalesce(c, -1) AS own, coalesce(c, 0) AS reference FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN ascii(o_orderstatus) END AS c FROM orders)",
)
def missing_as_class(t: Tables):
    coded = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.ascii("o_orderstatus")).alias("c"))
    return coded.select(
        "o_orderkey", preprocess.missing_as_class("c").alias("own"), preprocess.missing_as_class("c", "reference").alias("reference")
    )


@query("k18_zero_missing", f"SELECT c_custkey, coalesce(c_acctbal, 0.0) AS c_acctbal FROM {HOLED_SQL}")
def zero_missing(t: Tables):
    return holed(t).select("c_custkey", preprocess.zero_missing("c_acctbal").alias("c_acctbal"))
