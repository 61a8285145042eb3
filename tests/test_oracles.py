"""Every registered query with SQL must give the same rows as DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as entry_module
from check_oracle import compare, duck

FOLDER = entry_module.SMOKE_DIR
QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, connection, name):
    notes = compare(QUERIES[name](spark, FOLDER), connection.sql(ORACLES[name]))
    assert [n for n in notes if n != "no rows"] == []


@pytest.mark.parametrize("name", ["i15_signed_rank_p_values", "i16_rank_sum_p_values", "i17_sequential_variance", "j06_valid_split", "k11_quantile_normal"])
def test_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry_gives_a_total_row(spark):
    rows = entry_module.entry(spark).collect()
    assert rows[0]["type"] == "Total" and rows[0]["sql_count"] == 37
    assert len(rows) == 21


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_no_query_plans_a_nested_loop_over_two_tables(spark):
    """Joins without keys are allowed only against a single aggregated row."""
    for name in ("e14_cross_product_of_columns_and_rows", "e27_rows_at_maximum", "j09_balanced_binary", "g16_funnel"):
        plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
