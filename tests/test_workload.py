import time

import pytest
from pyspark.sql import functions as F

from tabeval.operators import workload


@pytest.fixture(scope="module")
def session(spark):
    spark.range(100).select("id", F.concat(F.lit("n"), "id").alias("name")).createOrReplaceTempView("things")
    return spark


@pytest.mark.parametrize(
    "sql, status",
    [
        ("SELECT * FROM things", "Valid"),
        ("SELECT * FROM things WHERE id < 0", "Empty"),
        ("SELECT nothing FROM things", "Error"),
        ("SELECT id FROM", "Error"),
        ("SELECT 1 / (id - 50) FROM things", "Error"),  # fails in a row that a LIMIT 1 would never reach
        ("SELECT CAST(name AS INT) FROM things", "Error"),
        ("SELECT a.id, b.id FROM things a JOIN things b ON a.id = b.id", "Valid"),  # two columns of one name
        ("SELECT name, id FROM things GROUP BY name", "Error"),
        ('SELECT * FROM things WHERE name = "n5"', "Valid"),  # double quotes around a text
    ],
)
def test_status(session, sql, status):
    assert workload.run_query(session, sql)[0] == status


def test_a_late_dataset_has_no_labels(session):
    slow = "SELECT sum(size(sequence(0L, 300000L + id))) FROM range(0, 4000000, 1, 8)"
    started = time.monotonic()
    assert workload.label_dataset(session, ["SELECT 1", slow, "SELECT 2"], timeout_s=2) is None
    assert time.monotonic() - started < 20
    assert [x[0] for x in workload.label_dataset(session, ["SELECT 1"], timeout_s=60)] == ["Valid"]


def test_datasets_may_share_table_names(session, tmp_path):
    def register(own, ref):
        if ref == "broken":
            raise ValueError("no files")
        own.range(int(ref)).createOrReplaceTempView("t")

    queries = [(ref, i, sql) for ref in ("0", "3", "broken") for i, sql in enumerate(["SELECT * FROM t", "SELECT count(*) FROM t"])]
    labels = workload.label_workload(session, queries, register, str(tmp_path / "labels"), flush_every=1)
    got = {(r["ref"], r["query_idx"]): r["status"] for r in labels.collect()}
    assert got == {
        ("0", 0): "Empty", ("0", 1): "Valid", ("3", 0): "Valid", ("3", 1): "Valid", ("broken", 0): "Error", ("broken", 1): "Error",
    }


def test_prior_state(session):
    runs = session.createDataFrame(
        [("a", True, False, None), ("b", True, False, None), ("b", False, True, "[Valid]")],
        "ref string, started boolean, finished boolean, flags string",
    )
    refs = session.createDataFrame([("a",), ("b",), ("c",)], "ref string")
    state = {r["ref"]: r["state"] for r in workload.prior_state(runs, refs, "ref").collect()}
    assert state == {"a": "OOM", "b": "[Valid]", "c": "pending"}


def test_yield_counts_datasets_without_flags(session):
    flags = session.createDataFrame([("a", "Valid"), ("a", "Empty"), ("b", None)], "ref string, status string")
    row = workload.yield_rate(flags, ["ref"], "status").first()
    assert row["yield"] == pytest.approx(1 / 30)


def test_a_late_dataset_is_null_as_a_whole_however_many_queries_it_has(session, tmp_path, monkeypatch):
    monkeypatch.setattr(workload, "QUERIES_PER_BATCH", 2)

    def slow(spark, sql):
        time.sleep(0.3)
        return "Valid", None

    monkeypatch.setattr(workload, "run_query", slow)
    queries = [("late", i, "SELECT 1") for i in range(9)] + [("quick", 0, "SELECT 1")]
    labels = workload.label_workload(session, queries, lambda own, ref: None, str(tmp_path / "l"), timeout_s=1.5)
    assert {(r["ref"], r["status"]) for r in labels.collect()} == {("late", None), ("quick", "Valid")} and labels.count() == 10


def test_a_workload_table_is_read_in_order_and_resumed(session, tmp_path, monkeypatch):
    from tabeval.operators.prompts import pending

    monkeypatch.setattr(workload, "QUERIES_PER_BATCH", 3)
    rows = [(f"d{i % 4}" if i < 20 else "hot", i, f"SELECT {i}") for i in range(40)]
    table = session.createDataFrame(rows, "ref string, query_idx int, sql string").repartition(5)
    listed = list(workload.ordered_queries(table))
    assert listed == sorted(rows)
    path = str(tmp_path / "labels")
    first = workload.label_workload(session, listed[:17], lambda own, ref: None, path)
    assert first.count() == 17
    rest = workload.ordered_queries(pending(table, first, ["ref", "query_idx"]))
    labels = workload.label_workload(session, rest, lambda own, ref: None, path)
    assert labels.count() == 40 == labels.select("ref", "query_idx").distinct().count()


def test_maps_and_variants_are_valid_and_only_queries_run(spark, tmp_path):
    assert workload.run_query(spark, "SELECT map('a', 1) AS m, parse_json('{\"a\": 1}') AS v") == ("Valid", None)
    spark.createDataFrame([(1,)], "x int").createOrReplaceTempView("kept")
    for statement in ("DROP VIEW kept", f"INSERT OVERWRITE DIRECTORY '{tmp_path}/o' USING parquet SELECT 1", "CREATE TEMPORARY VIEW made AS SELECT 1", "WITH a AS (SELECT 1) INSERT INTO kept SELECT * FROM a"):
        assert workload.run_query(spark, statement)[0] == "Error"
    assert not (tmp_path / "o").exists() and workload.run_query(spark, "SELECT * FROM kept")[0] == "Valid"
    assert workload.run_query(spark, "WITH a AS (SELECT 1 AS x) SELECT * FROM a WHERE x > 1")[0] == "Empty"


def test_a_cancelled_task_has_few_rows_left_to_work_through(spark):
    key = "spark.sql.parquet.columnarReaderBatchSize"
    assert int(workload.own_session(spark).conf.get(key)) <= 64
    spark.conf.set(key, "16")  # a smaller batch of the caller's stays
    try:
        assert workload.own_session(spark).conf.get(key) == "16"
    finally:
        spark.conf.unset(key)
