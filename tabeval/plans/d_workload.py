"""D1-D7 over the driver tables."""

from pyspark.sql import functions as F

from tabeval.operators import workload
from tabeval.plans.registry import Tables, query
from tabeval.plans.workload_fixture import TABLES_OF, numbered, values_sql
from tabeval.session import scratch_path


def register_views(t: Tables):
    def register(session, ref):
        for name in TABLES_OF[ref]:
            session.read.parquet(f"{t.folder}/{name}.parquet").createOrReplaceTempView(name)

    return register


def run_workload(t: Tables):
    """Run the fixture workload; each query is executed over the whole tables."""
    queries = [(ref, place, sql) for ref, place, sql, _ in numbered()]
    return workload.label_workload(t.spark, queries, register_views(t), scratch_path(t.spark, "labels"))


@query("d01_label_workload", f"SELECT ref, query_idx, sql, status FROM {values_sql()}")
def label_workload(t: Tables):
    return run_workload(t).select("ref", "query_idx", "sql", "status")


@query(
    "d02_timeout_nulls_whole_dataset",
    "SELECT * FROM (VALUES ('quick', 0, 'Valid'), ('quick', 1, 'Empty'), ('slow', 0, NULL), ('slow', 1, NULL)) w(ref, query_idx, status)",
)
def timeout(t: Tables):
    def register(session, ref):
        session.read.parquet(f"{t.folder}/lineitem.parquet").createOrReplaceTempView("lineitem")

    # the slow query builds a long array for every row, of a length that does not grow with the table, so it ends only by being interrupted
    slow = "SELECT sum(size(sequence(0L, 1000000L + l_orderkey % 1000))) FROM lineitem"
    queries = [
        ("quick", 0, "SELECT count(*) FROM lineitem"),
        ("quick", 1, "SELECT l_orderkey FROM lineitem WHERE l_quantity < 0"),
        ("slow", 0, "SELECT count(*) FROM lineitem"),
        ("slow", 1, slow),
    ]
    labels = workload.label_workload(t.spark, queries, register, scratch_path(t.spark, "labels"), timeout_s=5, parallel=1)  # the slow one takes all cores
    return labels.select("ref", "query_idx", "status")


@query(
    "d03_prior_state",
    """SELECT event_id // 3 AS ref, CASE WHEN bool_or(event_type = 'purchase') THEN max(CASE WHEN event_type = 'purchase' THEN props END)
         WHEN bool_or(event_type = 'signup') THEN 'OOM' ELSE 'pending' END AS state FROM events GROUP BY 1""",
)
def prior_state(t: Tables):
    ref = F.expr("event_id div 3").alias("ref")
    kind = F.col("event_type")
    runs = t.events.where(kind.isin("signup", "purchase")).select(
        ref, F.lit(True).alias("started"), (kind == "purchase").alias("finished"),
        F.when(kind == "purchase", F.col("props")).alias("flags"),
    )
    return workload.prior_state(runs, t.events.select(ref).distinct(), "ref")


STATUS_SQL = "CASE WHEN quality = 1 THEN 'Valid' WHEN toxic = 0 THEN 'Empty' ELSE 'Error' END"
VERDICT_SQL = "CASE WHEN quality = 1 THEN 'correct' WHEN toxic = 0 THEN 'comparison' ELSE 'error' END"
QUERIES_SQL = f"(SELECT d.*, {STATUS_SQL} AS status, {VERDICT_SQL} AS verdict FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"


def labelled(t: Tables):
    """Documents stand for queries; their labels give the status and the verdict."""
    good, mild = F.col("quality") == 1, F.col("toxic") == 0
    return t.documents.join(t.labels, "doc_id").select(
        "doc_id", "lang", "source", "text",
        F.when(good, "Valid").when(mild, "Empty").otherwise("Error").alias("status"),
        F.when(good, "correct").when(mild, "comparison").otherwise("error").alias("verdict"),
    )


@query(
    "d04_eligible",
    f"""SELECT lang, source, count(*) FILTER (WHERE status = 'Valid') AS n_valid, 3::BIGINT AS n_selected FROM {QUERIES_SQL}
        GROUP BY 1, 2 HAVING count(*) FILTER (WHERE status = 'Valid') >= 3""",
)
def eligible(t: Tables):
    return workload.eligible(labelled(t), ["lang", "source"], "status", 3)


@query(
    "d04_eligible_totals",
    f"""SELECT count(*) AS n_datasets, CAST(count(*) * 3 AS BIGINT) AS n_queries FROM (
          SELECT lang, source FROM {QUERIES_SQL} WHERE status = 'Valid' GROUP BY 1, 2 HAVING count(*) >= 3)""",
)
def eligible_totals(t: Tables):
    return workload.eligible_totals(labelled(t), ["lang", "source"], "status", 3)


@query(
    "d05_sample_datasets",
    "SELECT c_custkey, c_name FROM customer ORDER BY md5(c_custkey::VARCHAR || '42'), c_custkey LIMIT 50",
)
def sample_datasets(t: Tables):
    return workload.sample_datasets(t.customer.select("c_custkey", "c_name"), "c_custkey", 50, 42)


@query("d05_pick", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (2, 3, 5, 7, 11, 13, 17, 19)")
def pick(t: Tables):
    return workload.pick(t.customer, "c_custkey", [2, 3, 5, 7, 11, 13, 17, 19]).select("c_custkey", "c_name")


@query(
    "d06_timing_summary",
    """SELECT event_type, count(value) AS n, round(sum(value), 2) AS total_s, round(avg(value), 6) AS mean_s,
         round(quantile_cont(value, 0.5), 6) AS median_s, round(quantile_cont(value, 0.9), 6) AS p90_s FROM events GROUP BY 1""",
)
def timing_summary(t: Tables):
    summary = workload.timing_summary(t.events, ["event_type"], "value")
    digits = {"total_s": 2, "mean_s": 6, "median_s": 6, "p90_s": 6}
    return summary.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query(
    "d07_yield_rate",
    f"""SELECT CAST(sum(valid) AS BIGINT) AS n_valid, count(*) AS n_datasets, round(sum(valid) / (count(*) * 15), 6) AS yield FROM (
          SELECT lang, source, count(*) FILTER (WHERE {STATUS_SQL} = 'Valid') AS valid
          FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1, 2)""",
)
def yield_rate(t: Tables):
    flags = t.documents.select("doc_id", "lang", "source").join(labelled(t).select("doc_id", "status"), "doc_id", "left")
    rate = workload.yield_rate(flags, ["lang", "source"], "status")
    return rate.withColumn("yield", F.round("yield", 6))
