"""Properties of the physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from tabeval.operators import analytics, benchmark, catalog, compare, preprocess, ranks, splits

QUERIES = entry_module.queries()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def named(spark, name):
    return plan_of(QUERIES[name](spark, entry_module.SMOKE_DIR))


def test_filters_and_columns_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = named(spark, "e04_range_conjunction")
    assert "GreaterThan(l_quantity,10.0)" in plan and "EqualTo(l_returnflag,N)" in plan
    for name, columns in (("e24_group_sums", 3), ("b10_profile", 5), ("h03_auroc_binary", 5), ("i05_ranks_higher_better", 3)):
        for schema in re.findall(r"ReadSchema: struct<([^>]*)>", named(spark, name)):
            assert len(schema.split(",")) <= columns, (name, schema)


@pytest.mark.parametrize("name", ["b12_dedupe_keep_first", "g10_sample_per_class", "c05_first_valid_batch", "i19_leaderboard"])
def test_top_rows_are_pruned_before_the_shuffle(spark, name):
    plan = named(spark, name)
    assert re.search(r"WindowGroupLimit[^\n]*Final[\s\S]*Exchange hash[\s\S]*WindowGroupLimit[^\n]*Partial", plan)


def test_bags_are_counted_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("a"))
    plan = plan_of(compare.bag_differences(df, df))
    assert plan.count("Exchange") == 1 and plan.index("Exchange") < plan.index("partial_sum")


def test_splitting_does_not_move_rows(spark):
    df = spark.range(1000).withColumn("payload", F.col("id") * 2)
    assert "Exchange" not in plan_of(analytics.split_rows(df, "id"))
    assert "Exchange" not in plan_of(analytics.split_groups(df, "id"))


@pytest.mark.parametrize(
    "transform",
    [preprocess.z_score, preprocess.min_max, preprocess.impute_mean, preprocess.soft_clip, preprocess.robust_scale, preprocess.power_transform],
)
def test_fitted_transformations_are_map_only(spark, transform):
    df = spark.range(1000).select("id", (F.col("id") * 0.5).alias("x"))
    plan = plan_of(transform(df, ["x"]))
    assert "Exchange" not in plan and "Python" not in plan


def test_ties_within_a_dataset_need_no_second_shuffle(spark):
    cells = spark.range(40).select((F.col("id") % 8).alias("dataset"), F.col("id").cast("string").alias("method"), F.rand(1).alias("value"))
    assert plan_of(benchmark.ranks(cells)).count("Exchange") == 1


def test_duplicates_are_dropped_without_python(spark):
    df = spark.range(10).select("id", F.lit(1).alias("k"))
    assert "Python" not in plan_of(catalog.dedupe_keep_first(df, ["k"], ["id"]))


def test_excluded_rows_are_told_apart_by_their_columns(spark):
    rows = spark.createDataFrame([("a_b", "c"), ("a", "b_c"), (None, "x"), ("nan", "x")], "p string, q string")
    known = spark.createDataFrame([("a", "b_c"), (None, "x")], "p string, q string")
    assert sorted(tuple(r) for r in catalog.exclude_overlap(rows, known, ["p", "q"]).collect()) == [("a_b", "c"), ("nan", "x")]


def test_null_keys_have_a_place_in_splits(spark):
    rows = spark.createDataFrame([(None, 1), *[(f"k{i}", 1) for i in range(20)]], "k string, x int")
    counts = ranks.hash_counts(rows, "k", 1)
    assert sum(counts.values()) == 21
    cut = ranks.hash_cuts(rows, "k", 1, [7], counts)[0]
    assert rows.where(ranks.below_cut("k", 1, cut)).count() == 7


def test_a_sparse_vector_is_not_spread_over_all_its_places(spark):
    plan = named(spark, "k02_one_hot_sparse")
    assert "array_position" not in plan and "unwrap" in plan.lower()


def test_windows_and_folds_sort_by_columns_and_keep_the_dataset_without_a_join(spark):
    rows = spark.range(50).select("id", (F.col("id") % 2).cast("string").alias("y"), (F.col("id") % 5).alias("d"))
    data = splits.to_dataset(rows, ["id"], "y", "id", keep=["d"])
    assert sorted((r["id"], r["features"], r["d"]) for r in data.collect()) == [(i, [float(i)], i % 5) for i in range(50)]
    assert not re.search(r"Sort \[[^\]]*md5", plan_of(splits.stratified_kfold(rows, "id", "y")))
