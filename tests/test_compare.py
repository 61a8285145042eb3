import pytest
from pyspark.sql import functions as F

from tabeval.operators import compare

SCHEMA = "id int, name string, x double"
ROWS = [(1, "a", 1.0), (2, None, 2.0), (3, "c", None), (3, "c", None)]


@pytest.fixture(scope="module")
def base(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def other(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def verdict(expected, actual, **more):
    return compare.compare(expected, actual, **more)[0]


def test_same_rows_in_any_order(spark, base):
    assert verdict(base, other(spark, ROWS[::-1])) == "correct"


def test_columns_are_matched_by_place(spark, base):
    assert verdict(base, other(spark, ROWS, "p int, q string, r double")) == "correct"


def test_multiplicity_counts(spark, base):
    assert verdict(base, other(spark, ROWS[:3])) == "comparison"
    assert verdict(base, other(spark, [ROWS[0], *ROWS])) == "comparison"


def test_missing_texts_are_null(spark, base):
    assert verdict(base, other(spark, [(1, "a", 1.0), (2, "{}", 2.0), (3, "c", None), (3, "c", None)])) == "correct"


def test_tolerance_applies_only_without_nulls(spark):
    left = other(spark, [(1, "a", 100.0), (2, "b", 5.0)])
    assert verdict(left, other(spark, [(2, "b", 5.0000001), (1, "a", 100.0001)])) == "correct"
    assert verdict(left, other(spark, [(2, "b", 5.1), (1, "a", 100.0)])) == "comparison"
    holed = other(spark, [(1, "a", None), (2, "b", 5.0)])
    near = other(spark, [(1, "a", None), (2, "b", 5.0000001)])
    assert verdict(holed, near) == "comparison"
    assert compare.equal_tolerant(holed, near, nulls_equal=True)


def test_widths_must_fit_but_an_all_null_column_may_go(spark, base):
    assert verdict(base, base.drop("x")) == "comparison"
    assert verdict(base.withColumn("none", F.lit(None).cast("int")), base) == "correct"


def test_failures(spark, base):
    assert compare.compare(base, None, problem="parse error") == ("error", "parse error")
    assert compare.compare(base, base.select()) == ("error", "empty response")


def test_ordered_comparison_sees_a_swap(spark):
    a = other(spark, [(1, "a"), (2, "b")], "place int, v string")
    b = other(spark, [(1, "b"), (2, "a")], "place int, v string")
    assert not compare.equal_ordered(a, b, "place") and compare.equal_ordered(a, a, "place")
    assert verdict(a, b, place="place") == "correct"  # falls back to bags


def test_pairing_of_very_many_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(compare, "RANGE_ROWS", 100)
    many = spark.range(500).select((F.col("id") % 3).alias("k"), F.lit(1.5).alias("x"))
    noisy = many.withColumn("x", F.col("x") + 1e-9)
    assert compare.equal_tolerant(many, noisy)
    assert not compare.equal_tolerant(many, many.withColumn("x", F.when(F.col("k") == 1, 1.6).otherwise(1.5)))


def test_bag_differences_report_side_and_surplus(spark, base):
    rows = compare.bag_differences(base, other(spark, [*ROWS[:3], (9, "z", 1.0)])).collect()
    assert {(r["id"], r["side"], r["surplus"]) for r in rows} == {(3, "expected", 1), (9, "actual", 1)}


def test_sixnf_round_trip(spark, base):
    from tabeval.operators import sixnf

    keyed = base.withColumn("row", F.monotonically_increasing_id())
    triples = sixnf.to_sixnf(keyed, "row", ["id", "name", "x"])
    assert triples.count() == 12 and triples.where("missing").count() == 3
    back = sixnf.from_sixnf(triples, {"id": "int", "name": "string", "x": "double"})
    assert verdict(base, back.drop("row_id")) == "correct"
    # the explicit product of columns and rows has the same cells
    cells = sixnf.columns_by_rows(keyed, "row", ["id", "name", "x"])
    assert cells.exceptAll(triples.select("col", "row_id")).count() == 0


def test_a_number_is_not_its_text(spark):
    numbers, texts = other(spark, [(1,), (2,)], "x int"), other(spark, [("1",), ("2",)], "x string")
    assert verdict(numbers, texts) == "comparison"
    assert verdict(numbers, other(spark, [(2.0,), (1.0,)], "x double")) == "correct"
    assert verdict(other(spark, [(True,)], "x boolean"), other(spark, [("yes",)], "x string")) == "comparison"


def test_numbers_that_are_not_finite(spark):
    inf, nan = float("inf"), float("nan")

    def numbers(*values):
        return other(spark, [(float(v),) for v in values], "x double")

    for wrong in (numbers(1, inf), numbers(1, nan), numbers(1, -inf)):
        assert verdict(numbers(1, 5), wrong) == "comparison" and verdict(wrong, numbers(1, 5)) == "comparison"
    assert verdict(numbers(1, inf), numbers(1 + 1e-9, inf)) == "correct"
    assert verdict(numbers(1, inf), numbers(1 + 1e-9, -inf)) == "comparison"
    assert verdict(numbers(1, nan), numbers(nan, 1)) == "correct"  # equal as bags
    assert verdict(numbers(1, nan), numbers(nan, 1 + 1e-9)) == "comparison"
    assert verdict(numbers(0.0), numbers(-0.0)) == "correct"


def test_one_name_twice_beside_a_place(spark):
    twice = spark.sql("SELECT 1 AS p, 2 AS a, 3 AS a UNION ALL SELECT 2, 4, 5")
    assert verdict(twice, twice, place="p") == "correct"
    assert verdict(twice, spark.sql("SELECT 1 AS p, 2 AS a, 3 AS a UNION ALL SELECT 2, 4, 6"), place="p") == "comparison"


def test_truth_values_are_numbers(spark):
    assert verdict(other(spark, [(True,), (False,)], "x boolean"), other(spark, [(0,), (1,)], "x int")) == "correct"
    assert verdict(other(spark, [(True,)], "x boolean"), other(spark, [(0.0,)], "x double")) == "comparison"


@pytest.mark.parametrize("rows", [1, 7, 1000])
def test_pairing_agrees_with_sorting(spark, monkeypatch, rows):
    """Places do not depend on the ranges: pairs are those of two sorted lists, also where noise moves rows between ranges."""
    monkeypatch.setattr(compare, "RANGE_ROWS", rows)
    left = [(i % 5, float(i * i % 23) / 3, None if i % 7 == 0 else f"t{i % 4}") for i in range(60)]
    right = [(k, x + (0.4 if i % 9 == 0 else 0.0), s) for i, (k, x, s) in enumerate(left)]
    schema = "k int, x double, s string"
    found = compare.tolerant_differences(other(spark, left, schema), other(spark, right, schema).toDF("p", "q", "r"), nulls_equal=True)
    order = lambda r: tuple((v is not None, v or 0 if not isinstance(v, str) else v) for v in r)  # noqa: E731  nulls first, as Spark sorts
    pairs = list(zip(sorted(left, key=order), sorted(right, key=order)))
    expected = [(e, a) for e, a in pairs if not (e[0] == a[0] and abs(e[1] - a[1]) <= 1e-8 + 1e-5 * abs(a[1]) and e[2] == a[2])]
    got = [(tuple(r[f"e_{c}"] for c in "kxs"), tuple(r[f"a_{c}"] for c in "pqr")) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr) and expected


def test_no_window_takes_all_rows(spark):
    rows = spark.range(100).select("id", (F.col("id") * 1.0).alias("x"))
    plan = compare.tolerant_differences(rows, rows)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_columns_without_a_type_hold_nulls(spark, base, monkeypatch):
    untyped = base.withColumn("x", F.lit(None))
    assert verdict(untyped, base.withColumn("x", F.lit(None).cast("double"))) == "correct"
    assert verdict(untyped, untyped) == "correct"
    monkeypatch.setattr(compare, "RANGE_ROWS", 2)
    assert verdict(untyped, base) == "comparison"


def test_empty_texts_are_values_of_their_own(spark):
    left = other(spark, [(1, "", 1.0), (2, "b", 2.0)])
    assert verdict(left, other(spark, [(2, "b", 2.0), (1, "", 1.0)])) == "correct"
    assert verdict(left, other(spark, [(2, "b", 2.0), (1, None, 1.0)])) == "comparison"


def test_decimals_are_compared_with_the_tolerance(spark):
    left = other(spark, [(1,)], "id int").selectExpr("CAST(1.1 AS DECIMAL(10,4)) AS x")
    assert verdict(left, other(spark, [(1.1000000001,)], "x double")) == "correct"
    assert verdict(left, other(spark, [(1.2,)], "x double")) == "comparison"


def test_two_columns_of_one_name_and_maps(spark):
    twice = "SELECT 1 AS a, 2 AS a, CAST(NULL AS INT) AS b"
    assert verdict(spark.sql(twice), spark.sql("SELECT 1 AS a, 2 AS a")) == "correct"
    assert verdict(spark.sql(twice), spark.sql("SELECT 2 AS a, 1 AS a")) == "comparison"
    assert verdict(spark.sql("SELECT map('x', 1, 'y', 2) AS m"), spark.sql("SELECT map('y', 2, 'x', 1) AS m")) == "correct"
    assert verdict(spark.sql("SELECT map('x', 1) AS m"), spark.sql("SELECT map('x', 2) AS m")) == "comparison"


def test_equal_values_of_two_types_have_one_hash(spark):
    left = spark.sql("SELECT int(id) AS a, date'2024-01-01' AS d, map('k', int(id)) AS m FROM range(9)")
    right = spark.sql("SELECT id AS a, timestamp'2024-01-01 00:00:00' AS d, map('k', int(id)) AS m FROM range(9)")
    assert compare.compare(left, right) == ("correct", None)
    other = right.withColumn("m", F.create_map(F.lit("k"), F.lit(3)))
    assert compare.compare(left, other)[0] == "comparison"


def test_the_first_pass_needs_no_decimals(spark, monkeypatch):
    """Sums of hashes stay longs, map entries are not written as text, and both survive rows that occur many times."""
    plans = []
    df = spark.sql("SELECT id % 3 AS a, map('k', id % 3) AS m FROM range(1000)")
    seen = type(df).first
    monkeypatch.setattr(type(df), "first", lambda self: (plans.append(self._jdf.queryExecution().optimizedPlan().toString()), seen(self))[1])
    assert compare.compare(df, df.repartition(7)) == ("correct", None)
    assert plans and all("decimal(38,0)" not in plan and "to_json" not in plan for plan in plans)


def test_results_that_no_pairing_brings_together_are_not_sorted(spark, monkeypatch):
    def sort(*args, **kwargs):
        raise AssertionError("sorted")

    df = spark.sql("SELECT string(id) AS t, id * 1.5D AS x FROM range(500)")

    def with_first(text):
        return df.withColumn("x", F.when(F.col("t") == "7", F.lit(text).cast("double")).otherwise(F.col("x")))

    for kind in ("Infinity", "NaN"):  # a row of noise beside
        other = with_first(kind).withColumn("x", F.col("x") * (1 + 1e-9))
        assert compare.compare(with_first(kind), other)[0] == ("correct" if kind == "Infinity" else "comparison")
    monkeypatch.setattr(compare, "tolerant_differences", sort)
    cases = [(df, df.withColumn("x", F.col("x") * 1.01)), (df, with_first("Infinity")), (with_first("NaN"), df), (df, with_first(None)),
             (with_first("Infinity"), with_first("-Infinity"))]
    assert [compare.compare(*case)[0] for case in cases] == ["comparison"] * 5
    with pytest.raises(AssertionError, match="sorted"):
        compare.compare(df, df.withColumn("x", F.col("x") * (1 + 1e-9)))
