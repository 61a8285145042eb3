"""Run a workload of SQL queries, label each one, and select datasets by their labels."""

from __future__ import annotations

import logging
import threading
import time
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import groupby, islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabeval.functions.fixed import BATCH_SIZE, EMPTY, ERROR, LABEL_TIMEOUT_S, QUERIES_PER_DATASET, VALID
from tabeval.operators.ranks import exact_quantiles, stable_hash

STATUS_SCHEMA = "ref string, query_idx int, sql string, status string, seconds double, problem string"


def reads_only(spark: SparkSession, sql: str) -> bool:
    """Whether a statement only reads: its parsed plan holds no command and no insert. Statements that fail to parse raise."""
    jvm, session = spark._jvm, spark._jsparkSession
    command = jvm.java.lang.Class.forName("org.apache.spark.sql.catalyst.plans.logical.Command", False, jvm.java.lang.Thread.currentThread().getContextClassLoader())
    plans = [session.sessionState().sqlParser().parsePlan(sql)]
    while plans:
        plan = plans.pop()
        if command.isInstance(plan) or plan.nodeName().startswith(("Insert", "UnresolvedExecuteImmediate", "ExecuteImmediate")):
            return False
        children = plan.children()
        plans += [children.apply(i) for i in range(children.size())]
    return True


def run_query(spark: SparkSession, sql: str) -> tuple[str, str | None]:
    """Status and problem of one query. Every result cell is computed, on the executors; one row comes back."""
    try:
        if not reads_only(spark, sql):
            raise ValueError("not a query")
        result = spark.sql(sql)
        result = result.toDF(*[f"c{i}" for i in range(len(result.columns))])
        cells = [F.to_json(F.struct(c)) if "map<" in kind or "variant" in kind else F.col(c) for c, kind in result.dtypes]  # these have no hash
        facts = result.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*cells)).alias("cells")).first()
        return (VALID if facts["n"] else EMPTY), None
    except Exception as error:  # any failure of a foreign query is its label
        return ERROR, f"{type(error).__name__}: {str(error).splitlines()[0][:200]}"


logging.getLogger("SQLQueryContextLogger").setLevel(logging.CRITICAL)  # failing queries are results here


def label_dataset(spark: SparkSession, sqls: Sequence[str], timeout_s: float = LABEL_TIMEOUT_S) -> list[tuple] | None:
    """(status, seconds, problem) per query, or None when the whole batch takes longer than the limit."""
    context = spark.sparkContext
    tag = f"label-{uuid.uuid4().hex}"
    late, done = threading.Event(), threading.Event()

    def stop_when_late() -> None:
        if not done.wait(timeout_s):
            late.set()
            context.cancelJobsWithTag(tag)
            while not done.wait(1.0):  # a job may have started just after the last cancellation
                context.cancelJobsWithTag(tag)

    watcher = threading.Thread(target=stop_when_late, daemon=True)
    watcher.start()
    context.addJobTag(tag)
    context.setInterruptOnCancel(True)
    labels = []
    try:
        for sql in sqls:
            started = time.monotonic()
            status, problem = run_query(spark, sql)
            if late.is_set():
                return None
            labels.append((status, time.monotonic() - started, problem))
        return labels
    finally:
        done.set()
        context.removeJobTag(tag)
        context.setInterruptOnCancel(False)


# A task sees that its job was cancelled when it asks for the next batch of rows, so a batch is what a late query may still work through
BATCH_ROWS = {"spark.sql.parquet.columnarReaderBatchSize": 64, "spark.sql.orc.columnarReaderBatchSize": 64}


def own_session(spark: SparkSession) -> SparkSession:
    """A session with the same SQL settings but its own views, so datasets may share table names, and small batches of rows."""
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and session.conf.isModifiable(key):
            session.conf.set(key, value)
    for key, rows in BATCH_ROWS.items():
        session.conf.set(key, str(min(rows, int(spark.conf.get(key)))))
    return session


def ordered_queries(workload: DataFrame) -> Iterator[tuple[str, int, str]]:
    """The queries (ref, query_idx, sql) of a table, one dataset behind the other, a small range at a time."""
    columns = ["ref", "query_idx", "sql"]
    spread = workload.select(*columns).repartitionByRange("ref", "query_idx").sortWithinPartitions("ref", "query_idx")
    return (tuple(row) for row in spread.toLocalIterator(prefetchPartitions=True))


QUERIES_PER_BATCH = 1_000  # labels written at a time


def _datasets(queries: Iterable[tuple[str, int, str]]) -> Iterator[tuple[str, list]]:
    """All queries of one dataset after the other: the time limit holds for a dataset, however many queries it has."""
    for ref, rows in groupby(queries, key=lambda q: q[0]):
        yield ref, list(rows)


def label_workload(
    spark: SparkSession,
    queries: Iterable[tuple[str, int, str]],
    register: Callable[[SparkSession, str], None],
    path: str,
    timeout_s: float = LABEL_TIMEOUT_S,
    parallel: int = 8,
    flush_every: int = 200,
) -> DataFrame:
    """Label queries (ref, query_idx, sql), given in order of ref, and keep the labels as a table at ``path``.

    Each query is its own Spark job, started from the driver; datasets run side by side in sessions of
    their own, into which ``register(session, ref)`` puts the views. Labels are written after every
    ``flush_every`` datasets, so a restart loses little and may skip what is there already
    (``ordered_queries(pending(workload, labels, keys))``).
    """

    def label(dataset: tuple[str, list]) -> list[tuple]:
        ref, rows = dataset
        session = own_session(spark)
        try:
            register(session, ref)
            labels = label_dataset(session, [sql for _, _, sql in rows], timeout_s)
        except Exception as error:
            labels = [(ERROR, 0.0, f"{type(error).__name__}")] * len(rows)
        if labels is None:
            labels = [(None, None, "timeout")] * len(rows)
        return [(ref, idx, sql, *found) for (_, idx, sql), found in zip(rows, labels)]

    datasets = _datasets(queries)
    with ThreadPoolExecutor(parallel) as pool:
        while chunk := list(islice(datasets, flush_every)):
            labelled = (row for rows in pool.map(label, chunk) for row in rows)
            while part := list(islice(labelled, QUERIES_PER_BATCH * 10)):
                spark.createDataFrame(part, STATUS_SCHEMA).write.mode("append").parquet(path)
    return spark.read.schema(STATUS_SCHEMA).parquet(path)


def prior_state(runs: DataFrame, refs: DataFrame, ref: str) -> DataFrame:
    """State of each dataset after a crash: OOM if started but never finished, its flags, or pending."""
    seen = runs.groupBy(ref).agg(
        F.bool_or("started").alias("started"), F.bool_or("finished").alias("finished"), F.max("flags").alias("flags")
    )
    started, finished = F.coalesce("started", F.lit(False)), F.coalesce("finished", F.lit(False))
    state = F.when(finished, F.col("flags")).when(started, F.lit("OOM")).otherwise(F.lit("pending"))
    return refs.join(seen, ref, "left").select(ref, state.alias("state"))


def eligible(flags: DataFrame, ref: Sequence[str], status: str, k: int = BATCH_SIZE) -> DataFrame:
    """Datasets with at least ``k`` Valid queries; k queries are selected from each."""
    return (
        flags.groupBy(*ref)
        .agg(F.count_if(F.col(status) == VALID).alias("n_valid"))
        .where(F.col("n_valid") >= k)
        .withColumn("n_selected", F.lit(k).cast("bigint"))
    )


def eligible_totals(flags: DataFrame, ref: Sequence[str], status: str, k: int = BATCH_SIZE) -> DataFrame:
    """How many datasets and queries pass the gate."""
    return eligible(flags, ref, status, k).agg(
        F.count(F.lit(1)).alias("n_datasets"), F.coalesce(F.sum("n_selected"), F.lit(0)).alias("n_queries")
    )


def sample_datasets(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    return df.orderBy(stable_hash(key, seed), key).limit(n)


def pick(df: DataFrame, key: str, ids: Sequence) -> DataFrame:
    return df.where(F.col(key).isin(list(ids)))


def timing_summary(runs: DataFrame, group: Sequence[str], seconds: str) -> DataFrame:
    """Total, mean, median and 90 % time per group."""
    totals = runs.groupBy(*group).agg(
        F.count(seconds).alias("n"), F.sum(seconds).alias("total_s"), F.avg(seconds).alias("mean_s")
    )
    return totals.join(exact_quantiles(runs, group, seconds, {"median_s": 0.5, "p90_s": 0.9}), list(group), "left")


def yield_rate(flags: DataFrame, ref: Sequence[str], status: str, per_dataset: int = QUERIES_PER_DATASET) -> DataFrame:
    """Share of Valid queries when every dataset, also one without flags, should give ``per_dataset``."""
    per_ref = flags.groupBy(*ref).agg(F.count_if(F.col(status) == VALID).alias("valid"))
    return per_ref.agg(
        F.sum("valid").alias("n_valid"),
        F.count(F.lit(1)).alias("n_datasets"),
        F.try_divide(F.sum("valid").cast("double"), F.count(F.lit(1)) * per_dataset).alias("yield"),
    )
