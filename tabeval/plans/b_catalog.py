"""B1-B21 over the driver tables."""

from pyspark.sql import functions as F

from tabeval.functions import names
from tabeval.functions.fixed import MAX_CATALOG_ROWS, SQL_TYPES
from tabeval.operators import catalog
from tabeval.plans.registry import Tables, query


@query(
    "b01_union_catalogs",
    """SELECT name, nation, balance, segment FROM (
         SELECT 0 AS s, c_custkey AS k, c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment
         FROM customer
         UNION ALL SELECT 1, s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier)
       ORDER BY s, k""",
)
def union_catalogs(t: Tables):
    return catalog.union_catalogs(both_catalogs(t), "k").drop("k")


@query(
    "b01_union_catalogs_capped",
    """SELECT name, nation, balance, segment FROM (
         SELECT 0 AS s, c_custkey AS k, c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment
         FROM customer
         UNION ALL SELECT 1, s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier)
       ORDER BY s, k LIMIT 70000""",
)
def union_catalogs_capped(t: Tables):
    return catalog.union_catalogs(both_catalogs(t), "k", MAX_CATALOG_ROWS).drop("k")


def both_catalogs(t: Tables):
    customers = t.customer.select(
        F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"),
    )
    suppliers = t.supplier.select(
        F.monotonically_increasing_id().alias("Unnamed: 0"), F.col("s_suppkey").alias("k"),
        F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"),
    )
    return [customers, suppliers]


@query(
    "b02_filter_catalog",
    "SELECT p_partkey, p_name, p_size FROM part WHERE p_retailprice > 905 AND p_size BETWEEN 10 AND 30",
)
def filter_catalog(t: Tables):
    return catalog.filter_catalog(t.part, "p_retailprice", 905, "p_size", (10, 30)).select("p_partkey", "p_name", "p_size")


@query(
    "b03_parse_size",
    """SELECT p_partkey, size_text, CAST(regexp_extract(size_text, '[0-9]+') AS BIGINT) *
         CASE regexp_extract(size_text, '[A-Z]+') WHEN 'KB' THEN 1024 WHEN 'MB' THEN 1048576 ELSE 1073741824 END AS bytes
       FROM (SELECT p_partkey, CAST(p_size AS VARCHAR) ||
               CASE WHEN p_size < 15 THEN 'KB' WHEN p_size < 35 THEN 'MB' ELSE 'GB' END AS size_text FROM part)""",
)
def parse_size(t: Tables):
    unit = F.when(F.col("p_size") < 15, "KB").when(F.col("p_size") < 35, "MB").otherwise("GB")
    sized = t.part.select("p_partkey", F.concat(F.col("p_size").cast("string"), unit).alias("size_text"))
    return sized.withColumn("bytes", names.parse_size(F.col("size_text")))


@query(
    "b04_size_ranges",
    """SELECT range_no, min(o_totalprice) AS low, max(o_totalprice) AS high, count(*) AS n_rows, count(*) > 500 AS over_limit
       FROM (SELECT o_totalprice, (rank() OVER (ORDER BY o_totalprice) - 1) // 250 AS range_no FROM orders) GROUP BY 1""",
)
def size_ranges(t: Tables):
    return catalog.size_ranges(t.orders, "o_totalprice", 500)


WORDS = "array_to_string(list_transform(string_split({0}, '{1}'), lambda w: upper(w[1]) || w[2:]), '')"


@query(
    "b05_sanitize_column_names",
    f"""SELECT p_partkey, regexp_replace(
          array_to_string(list_transform(regexp_split_to_array(b, '\\s+'), lambda w: upper(w[1]) || w[2:]), ''),
          '[[:punct:]]', '', 'g') AS clean
        FROM (SELECT p_partkey, {WORDS.format("a", "_")} AS b
              FROM (SELECT p_partkey, {WORDS.format("p_name || '-' || p_brand || '_(' || p_type || ')'", "-")} AS a FROM part))""",
)
def sanitize_column_names(t: Tables):
    raw = F.concat("p_name", F.lit("-"), "p_brand", F.lit("_("), "p_type", F.lit(")"))
    return t.part.select("p_partkey", names.clean_column_name(raw).alias("clean"))


@query(
    "b06_sanitize_table_names",
    f"""SELECT c_custkey, {WORDS.format("b", "-")} AS clean
        FROM (SELECT c_custkey, {WORDS.format("a", "_")} AS b
              FROM (SELECT c_custkey, {WORDS.format("c_name || ' of_the-' || c_mktsegment", " ")} AS a FROM customer))""",
)
def sanitize_table_names(t: Tables):
    raw = F.concat("c_name", F.lit(" of_the-"), "c_mktsegment")
    return t.customer.select("c_custkey", names.clean_table_name(raw).alias("clean"))


@query(
    "b07_b08_describe_tables",
    """SELECT 'customer' AS table_name, 'CREATE TABLE customer(
    c_custkey  BIGINT,
    c_name  TEXT,
    c_nationkey  INT,
    c_acctbal  FLOAT,
    c_mktsegment  TEXT
);' AS ddl, (SELECT CAST(to_json(c) AS VARCHAR) FROM customer c ORDER BY c_custkey LIMIT 1) AS first_row
       UNION ALL SELECT 'part', 'CREATE TABLE part(
    p_partkey  BIGINT,
    p_name  TEXT,
    p_brand  TEXT,
    p_type  TEXT,
    p_size  INT,
    p_retailprice  FLOAT
);', (SELECT CAST(to_json(p) AS VARCHAR) FROM part p ORDER BY p_partkey LIMIT 1)""",
)
def describe_tables(t: Tables):
    return catalog.describe_tables(t.spark, {"customer": (t.customer, "c_custkey"), "part": (t.part, "p_partkey")})


@query(
    "b09_map_types",
    """SELECT o_orderkey, sql_type, CASE sql_type WHEN 'TEXT' THEN 'string' WHEN 'FLOAT' THEN 'float' ELSE 'int' END AS engine_type
       FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'TEXT' WHEN 'O' THEN 'FLOAT' ELSE 'BIGINT' END AS sql_type FROM orders)""",
)
def map_types(t: Tables):
    kind = F.when(F.col("o_orderstatus") == "F", "TEXT").when(F.col("o_orderstatus") == "O", "FLOAT").otherwise("BIGINT")
    return catalog.map_types(t.orders.select("o_orderkey", kind.alias("sql_type")), "sql_type", SQL_TYPES)


@query(
    "b10_profile",
    """SELECT c_nationkey, 2 AS number_of_input_columns, count(*) AS number_of_rows,
         bool_or(c_acctbal IS NULL OR c_mktsegment IS NULL OR c_custkey IS NULL OR c_nationkey IS NULL OR c_name IS NULL) AS missingness,
         count(DISTINCT c_mktsegment) AS number_of_classes
       FROM (SELECT * REPLACE (nullif(c_mktsegment, 'BUILDING') AS c_mktsegment) FROM customer) GROUP BY 1""",
)
def profile(t: Tables):
    holes = t.customer.withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    return catalog.profile(holes, ["c_acctbal", "c_custkey"], "c_mktsegment", ["c_nationkey"])


@query(
    "b11_meta_filter",
    """SELECT p_partkey, p_size, p_retailprice FROM part
       WHERE p_size >= 5 AND p_size <= 40 AND p_retailprice <= 1500""",
)
def meta_filter(t: Tables):
    return catalog.meta_filter(t.part, {"p_size": (5, 40), "p_retailprice": (None, 1500)}).select(
        "p_partkey", "p_size", "p_retailprice"
    )


@query(
    "b12_dedupe_keep_first",
    """SELECT doc_id, lang, source FROM documents
       QUALIFY row_number() OVER (PARTITION BY lang, source, n_chars ORDER BY doc_id) = 1""",
)
def dedupe_keep_first(t: Tables):
    slim = t.documents.select("doc_id", "lang", "source", "n_chars")
    return catalog.dedupe_keep_first(slim, ["lang", "source", "n_chars"], ["doc_id"]).drop("n_chars")


@query(
    "b13_exclude_by_name",
    "SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM benchmark b WHERE b.text = d.text)",
)
def exclude_by_name(t: Tables):
    return catalog.exclude_overlap(t.documents.select("doc_id", "text"), t.benchmark, ["text"]).select("doc_id")


@query(
    "b13_exclude_by_composed_key",
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l WHERE NOT EXISTS (
         SELECT 1 FROM lineitem r WHERE r.l_returnflag = 'R' AND r.l_orderkey = l.l_orderkey AND r.l_linenumber = l.l_linenumber)""",
)
def exclude_by_composed_key(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    returned = t.lineitem.where(F.col("l_returnflag") == "R")
    return catalog.exclude_overlap(lines, returned, ["l_orderkey", "l_linenumber"])


@query(
    "b14_exclude_patterns",
    """SELECT p_partkey, p_name FROM part
       WHERE p_name NOT LIKE '%ring%' AND p_name NOT LIKE '%red%' AND p_partkey NOT IN (3, 5, 8, 13)""",
)
def exclude_patterns(t: Tables):
    return catalog.exclude_patterns(t.part, "p_name", ["ring", "red"], "p_partkey", [3, 5, 8, 13]).select("p_partkey", "p_name")


STATUS_COUNTS = """(SELECT o_custkey, least(f, o, p) AS minority, greatest(f, o, p) AS majority, f FROM (
    SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_orderstatus = 'O') AS o,
           count(*) FILTER (WHERE o_orderstatus = 'P') AS p FROM orders GROUP BY 1))"""


@query(
    "b15_ratio_filter",
    f"SELECT o_custkey, minority, majority FROM {STATUS_COUNTS} WHERE minority / majority > 0.05 AND f <> 1",
)
def ratio_filter(t: Tables):
    counts = t.orders.groupBy("o_custkey").agg(
        *[F.count_if(F.col("o_orderstatus") == s.upper()).alias(s) for s in ("f", "o", "p")]
    )
    sides = counts.select(
        "o_custkey", F.least("f", "o", "p").alias("minority"), F.greatest("f", "o", "p").alias("majority"), "f"
    )
    return catalog.ratio_filter(sides, "minority", "majority", 0.05, "f").drop("f")


@query(
    "b16_report_columns",
    """SELECT c_name AS "Name", coalesce(n, 0) AS "Instances" FROM customer
       LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey""",
)
def report_columns(t: Tables):
    counts = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    joined = t.customer.join(counts, "c_custkey", "left")
    return catalog.report_columns(joined, {"c_name": "Name", "n": "Instances"}, ["n"])


@query(
    "b17_cap_dataset",
    """SELECT vec_id, label, len(embedding[1:32]) AS width, true AS samples_capped, true AS feats_capped, true AS classes_capped
       FROM (SELECT * FROM embeddings ORDER BY vec_id LIMIT 400)
       WHERE label < (SELECT DISTINCT label FROM (SELECT * FROM embeddings ORDER BY vec_id LIMIT 400) ORDER BY label LIMIT 1 OFFSET 6)""",
)
def cap_dataset(t: Tables):
    capped = catalog.cap_dataset(t.embeddings, "vec_id", "embedding", "label", 400, max_features=32, max_classes=6)
    return capped.withColumn("width", F.size("embedding").cast("bigint")).drop("embedding")


@query(
    "b18_cap_suffix",
    """SELECT c_custkey, CASE WHEN letters = '' THEN '' ELSE ' [' || letters || ']' END AS suffix FROM (
         SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN 's' ELSE '' END || CASE WHEN c_nationkey > 12 THEN 'f' ELSE '' END ||
           CASE WHEN c_mktsegment = 'BUILDING' THEN 'c' ELSE '' END AS letters FROM customer)""",
)
def cap_suffix(t: Tables):
    flags = (F.col("c_acctbal") > 5000, F.col("c_nationkey") > 12, F.col("c_mktsegment") == "BUILDING")
    return t.customer.select("c_custkey", catalog.cap_suffix(*flags).alias("suffix"))


@query(
    "b19_in_suite",
    """SELECT c_custkey, c_name FROM customer
       WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def in_suite(t: Tables):
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT")
    return catalog.in_suite(t.customer, urgent, "c_custkey", "o_custkey").select("c_custkey", "c_name")


@query(
    "b20_enrich",
    """SELECT d.doc_id, lang, n_chars, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
       WHERE lang IS NOT NULL AND n_chars IS NOT NULL AND n_chars > 0""",
)
def enrich(t: Tables):
    meta = t.documents.select("doc_id", "lang", "n_chars")
    return catalog.enrich(meta, t.labels, "doc_id", ["lang", "n_chars"], "n_chars")


@query(
    "b21_subset_without_categorical",
    """SELECT o_orderpriority, count(*) AS n_rows, count(DISTINCT o_orderstatus) AS classes,
         max(CASE WHEN o_orderpriority LIKE '%-%' AND o_orderpriority < '3' THEN 1 ELSE 0 END) AS n_categorical
       FROM orders GROUP BY 1 HAVING max(CASE WHEN o_orderpriority < '3' THEN 1 ELSE 0 END) = 0""",
)
def subset_without_categorical(t: Tables):
    marked = t.orders.withColumn(
        "categorical", F.when(F.col("o_orderpriority") < "3", F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))
    )
    return catalog.subset_by_profile(marked, "o_orderpriority", "o_orderstatus", "categorical")


@query(
    "b21_subset_by_size",
    """SELECT l_returnflag, count(*) AS n_rows, count(DISTINCT l_linestatus) AS classes FROM lineitem
       GROUP BY 1 HAVING count(*) >= 10000 AND count(DISTINCT l_linestatus) <= 2""",
)
def subset_by_size(t: Tables):
    return catalog.subset_by_profile(t.lineitem, "l_returnflag", "l_linestatus", min_rows=10000, max_classes=2)
