"""A1-A12 over the driver tables: whole tables are written to the shared folder and read back."""

from pyspark.sql import functions as F

from tabeval.operators.prompts import batches
from tabeval.operators.ranks import with_ordinal
from tabeval.plans.registry import Tables, query
from tabeval.session import scratch_path
from tabeval.sources import files


@query(
    "a01_list_files",
    """SELECT replace('corpus/' || o_orderpriority, '/', '_') AS dataset, count(DISTINCT o_orderstatus) AS n_files, true AS all_filled
       FROM orders GROUP BY 1""",
)
def list_files(t: Tables):
    path = scratch_path(t.spark, "corpus")
    marked = t.orders.withColumn("dataset", F.replace(F.concat(F.lit("corpus/"), "o_orderpriority"), F.lit("/"), F.lit("_")))
    (
        marked.hint("rebalance", "dataset", "o_orderstatus")
        .write.partitionBy("dataset", "o_orderstatus").option("header", "true").csv(path)
    )
    found = files.list_files(t.spark, path)
    # one status may be written by several tasks on a cluster, so folders are counted
    folder = F.regexp_extract("path", "(dataset=.*)/[^/]*$", 1)
    return (
        found.withColumn("dataset", F.url_decode(F.regexp_extract("path", "dataset=([^/]*)", 1)))
        .groupBy("dataset")
        .agg(F.count_distinct(folder).alias("n_files"), F.bool_and(F.col("length") > 0).alias("all_filled"))
    )


@query(
    "a02_read_csv_table",
    """SELECT c_custkey AS "CCustkey", c_name AS "CName", c_nationkey AS "CNationkey", c_acctbal AS "CAcctbal",
              c_mktsegment AS "CMktsegment" FROM customer""",
)
def read_csv_table(t: Tables):
    path = scratch_path(t.spark, "csv")
    files.write_csv(t.customer.select(F.col("c_custkey").alias("Unnamed: 0"), "*"), path)
    table = files.read_csv_table(t.spark, path, max_rows=None)
    return table.withColumn("CCustkey", F.col("CCustkey").cast("bigint"))


TEXTS_PER_FILE = 2_000


@query(
    "a02_read_csv_texts",
    """SELECT doc_id AS "DocId", '"' || lang || '", ' || text AS "Text", source AS "Source" FROM documents""",
)
def read_csv_texts(t: Tables):
    """Whole texts with quotes, separators and line breaks, written and read back."""
    path = scratch_path(t.spark, "csv")
    quoted = F.concat(F.lit('"'), "lang", F.lit('", '), "text")
    files.write_csv(t.documents.select("doc_id", quoted.alias("text"), "source"), path, TEXTS_PER_FILE)
    table = files.read_csv_table(t.spark, path)
    return table.withColumn("DocId", F.col("DocId").cast("bigint"))


@query(
    "a03_register_dataset",
    """SELECT p_brand AS brand, count(*) AS n, max(s_name) AS supplier FROM part
       JOIN supplier ON p_partkey = s_suppkey GROUP BY 1""",
)
def register_dataset(t: Tables):
    root = scratch_path(t.spark, "dataset")
    files.write_csv(t.part, f"{root}/part_list")
    files.write_csv(t.supplier, f"{root}/supplier-list")
    paths = {name: f"{root}/{name}" for name in ("part_list", "supplier-list", "missing_list")}
    outcome = files.register_dataset(t.spark, paths, lambda s, p: files.read_csv_table(s, p, max_rows=None))
    assert [error is None for _, error in outcome] == [True, True, False]
    return t.spark.sql(
        """SELECT PBrand AS brand, count(*) AS n, max(SName) AS supplier FROM PartList
           JOIN SupplierList ON PPartkey = SSuppkey GROUP BY 1"""
    )


@query("a04_read_csv_with_schema", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def read_csv_with_schema(t: Tables):
    path = scratch_path(t.spark, "quoted")
    files.write_csv(t.documents, path, TEXTS_PER_FILE)
    columns = {"doc_id": "int", "text": "string", "lang": "string", "source": "string", "n_chars": "int"}
    return files.read_csv_with_schema(t.spark, path, columns)


@query("a05_read_json_table", "SELECT event_id, user_id, event_type, value FROM events")
def read_json_table(t: Tables):
    path = scratch_path(t.spark, "json")
    files.write_json(t.events.select("event_id", "user_id", "event_type", "value"), path)
    return files.read_json_table(t.spark, path)


@query("a06_read_export", "SELECT c_custkey, c_name, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer")
def read_export(t: Tables):
    path = scratch_path(t.spark, "arrays")
    rows = t.customer.select("c_custkey", "c_name", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    files.write_record_arrays(with_ordinal(rows, ["c_custkey"], name="place"), path, "place")
    return files.read_export(t.spark, path)


@query(
    "a07_export_catalog",
    """SELECT c_custkey AS ref, 0::BIGINT AS volume, c_name AS name, 'TABLE ' || c_mktsegment AS schema_text, count(*) AS n_queries,
         string_agg(o_orderpriority, ';' ORDER BY o_orderkey) AS sql_translated,
         string_agg(o_orderstatus, ';' ORDER BY o_orderkey) AS sql_executable
       FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY ALL""",
)
def export_catalog(t: Tables):
    ref = F.col("o_custkey").alias("ref")
    numbered = with_ordinal(t.orders.select(ref, "o_orderkey", "o_orderpriority", "o_orderstatus"), ["o_orderkey"], ["ref"], "place")
    queries = numbered.select("ref", "place", F.col("o_orderpriority").alias("sql_translated"))
    flags = numbered.select("ref", "place", F.col("o_orderstatus").alias("sql_executable"))
    known = t.customer.select(F.col("c_custkey").alias("ref"), "c_name", "c_mktsegment")
    catalog = known.select("ref", F.col("c_name").alias("name"))
    descriptions = known.select("ref", F.concat(F.lit("TABLE "), "c_mktsegment").alias("schema_text"))
    path = scratch_path(t.spark, "export")
    files.write_json(files.export_catalog(catalog, descriptions, queries, flags, "ref", "place"), path)
    back = files.read_json_table(t.spark, path).where(F.col("volume").isNotNull())
    joined = {c: F.array_join(c, ";") for c in ("sql_translated", "sql_executable")}
    return back.withColumns(joined)


@query(
    "a08_export_pairs",
    """SELECT o_custkey AS ref, 0::BIGINT AS volume, string_agg(o_orderpriority, ';' ORDER BY o_orderkey) AS sql_code,
         string_agg(o_orderstatus, ';' ORDER BY o_orderkey) AS info, string_agg(o_orderkey, ';' ORDER BY o_orderkey) AS sql_indices
       FROM orders GROUP BY 1""",
)
def export_pairs(t: Tables):
    pairs = t.orders.select(
        F.col("o_custkey").alias("ref"), "o_orderkey", F.col("o_orderpriority").alias("sql_code"),
        F.col("o_orderstatus").alias("info"), F.col("o_orderkey").cast("string").alias("sql_indices"),
    )
    numbered = with_ordinal(pairs, ["o_orderkey"], ["ref"], "place").drop("o_orderkey")
    path = scratch_path(t.spark, "pairs")
    columns = ["sql_code", "info", "sql_indices"]
    files.write_json(files.export_pairs(numbered, "ref", "place", columns), path)
    return files.read_json_table(t.spark, path).withColumns({c: F.array_join(c, ";") for c in columns})


@query("a09_write_csv", "SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice FROM lineitem")
def write_csv(t: Tables):
    path = scratch_path(t.spark, "result")
    files.write_csv(t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice"), path)
    schema = "l_orderkey bigint, l_linenumber int, l_returnflag string, l_extendedprice double"
    return t.spark.read.schema(schema).option("header", "true").csv(path)


@query("a10_load_meta", "SELECT doc_id, quality FROM labels WHERE toxic = 0")
def load_meta(t: Tables):
    return files.load_meta(t.labels, "toxic", no_missing=True).select("doc_id", "quality")


@query(
    "a11_read_batches",
    "SELECT no // 10 AS batch_no, no % 10 AS place, s_name FROM (SELECT *, row_number() OVER (ORDER BY s_suppkey) - 1 AS no FROM supplier)",
)
def read_batches(t: Tables):
    path = scratch_path(t.spark, "batches")
    batched = batches(t.supplier.select("s_suppkey", "s_name"), [], ["s_suppkey"]).drop("s_suppkey")
    files.write_batches(batched, path, "batch_no", "place")
    return files.read_batches(t.spark, path, "batch_no", "place: bigint, s_name: string")


@query("a12_read_gz_json", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def read_gz_json(t: Tables):
    path = scratch_path(t.spark, "split")
    files.write_json(t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"), path, "gzip")
    return files.read_gz_json(t.spark, path)
