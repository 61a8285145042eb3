"""Do two result sets agree - in order, as bags, or within a tolerance?"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabeval.functions.fixed import COMPARISON, CORRECT, FAILED
from tabeval.session import scratch_path, shuffle_partitions

ROW_ID_ROLE = "FilePos"  # fixed value: type name of a row-id column
INDEX_NAME = "COL1"  # fixed value: name of the CSV index column
MISSING_TEXTS = ("{}", "")  # fixed value: how a missing cell may be written
EMPTY_RECORD = ("{}",)  # fixed value: how a missing cell comes back in a result
RTOL, ATOL = 1e-5, 1e-8  # fixed values: tolerance of the last comparison

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def is_numeric(spark_type: str) -> bool:
    return spark_type in NUMERIC or spark_type.startswith("decimal")


def align(expected: DataFrame, actual: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """Both tables with common column names by position; None when their widths differ."""
    if len(expected.columns) != len(actual.columns):
        return None
    names = [f"c{i}" for i in range(len(expected.columns))]

    def typed(df: DataFrame, other: DataFrame) -> DataFrame:
        """A column without a type, which holds only nulls, takes the type of its partner; truth values beside numbers are 0 and 1."""
        kinds = [b if a == "void" else "int" if a == "boolean" and is_numeric(b) else a for (_, a), (_, b) in zip(df.dtypes, other.dtypes)]
        return df.toDF(*names).select(*[F.col(c).cast("string" if k == "void" else k).alias(c) for c, k in zip(names, kinds)])

    return typed(expected, actual), typed(actual, expected)


def _kind(spark_type: str) -> str:
    """Types that can hold equal values: numbers and truth values, texts, times."""
    if is_numeric(spark_type) or spark_type == "boolean":
        return "number"
    return "time" if spark_type in ("date", "timestamp", "timestamp_ntz") else spark_type


def same_kinds(expected: DataFrame, actual: DataFrame) -> bool:
    """Whether every pair of columns can hold equal values; a number never equals its text."""
    return all(_kind(a) == _kind(b) for (_, a), (_, b) in zip(expected.dtypes, actual.dtypes))


def align_by_name(df: DataFrame) -> DataFrame:
    """Columns in the order of their names, for results that are keyed by column name."""
    return df.select(*[F.col(f"`{c}`") for c in sorted(df.columns)])


def drop_row_ids(df: DataFrame, roles: dict[str, str]) -> DataFrame:
    """Drop row-id columns (by declared type) and the CSV index column."""
    return df.drop(*[c for c in df.columns if roles.get(c) == ROW_ID_ROLE or c == INDEX_NAME])


def drop_all_null(df: DataFrame) -> DataFrame:
    """Without the columns that hold no value at all."""
    if not df.columns:
        return df
    names = [f"_{i}" for i in range(len(df.columns))]  # two columns may have one name
    placed = df.toDF(*names)
    filled = placed.agg(*[F.count(c).alias(c) for c in names]).first()
    kept = [(c, name) for c, name in zip(names, df.columns) if filled[c] > 0]
    return placed.select(*[c for c, _ in kept]).toDF(*[name for _, name in kept])


def _filled(name: str, kind: str, texts: Sequence[str]) -> Column:
    column = F.col(f"`{name}`")
    return F.when(~column.isin(*texts), column) if kind == "string" else column


def normalize_missing(df: DataFrame, texts: Sequence[str] = MISSING_TEXTS) -> DataFrame:
    """Texts that stand for a missing cell become null."""
    return df.select(*[_filled(c, kind, texts).alias(c) for c, kind in df.dtypes])


def _any_row(df: DataFrame) -> bool:
    return df.limit(1).count() > 0


def ordered_differences(expected: DataFrame, actual: DataFrame, place: str) -> DataFrame:
    """Places whose rows differ or exist on one side only; nulls in the same cell are equal."""
    columns = [c for c in expected.columns if c != place]
    left = expected.select(place, F.struct(*columns).alias("expected"))
    right = actual.select(place, F.struct(*columns).alias("actual"))
    return left.join(right, place, "full_outer").where(~F.col("expected").eqNullSafe(F.col("actual")))


def equal_ordered(expected: DataFrame, actual: DataFrame, place: str) -> bool:
    return not _any_row(ordered_differences(expected, actual, place))


def bag_differences(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows that occur more often on one side, with the surplus; equal rows are counted before the shuffle."""
    sides = expected.withColumn("_n", F.lit(1)).unionAll(actual.withColumn("_n", F.lit(-1)))
    counted = sides.groupBy(*expected.columns).agg(F.sum("_n").alias("_n")).where(F.col("_n") != 0)
    side = F.when(F.col("_n") > 0, "expected").otherwise("actual")
    return counted.select(*expected.columns, side.alias("side"), F.abs("_n").alias("surplus"))


HASH_PARTS = (0, 22, 44)  # first bits of the parts of a hash; sums of parts stay below 63 bits up to 2**41 rows


def _hashes_differ(name: str) -> Column:
    """Whether row hashes, those of the second side subtracted, sum up to other than 0, part by part; only if the bags differ."""
    parts = [F.shiftrightunsigned(name, start).bitwiseAND(F.lit((1 << 22) - 1)) for start in HASH_PARTS]
    return reduce(lambda a, b: a | b, [F.coalesce(F.sum(part * F.col("_n")), F.lit(0)) != 0 for part in parts])


def _first_facts(expected: DataFrame, actual: DataFrame, texts: Sequence[str], exact: Sequence[str]) -> dict:
    """What one pass over both sides tells: their rows, how many the first has more, whether the bags certainly differ -
    as they are, with missing cells of the second side normalized, and so in the columns that have no tolerance -, and of the
    other columns what every pairing within a tolerance must keep."""
    common = {f.name: f.dataType for f in expected.unionAll(actual).schema}  # equal values of two types have one hash in their common type

    def plain(df: DataFrame) -> dict[str, Column]:
        return {f.name: F.col(f.name) if f.dataType == common[f.name] else F.col(f.name).cast(common[f.name]) for f in df.schema}

    filled = plain(actual) | {c: _filled(c, kind, texts) for c, kind in actual.dtypes if kind == "string"}

    def hashes(columns: dict[str, Column]) -> list[Column]:
        fixed = [F.xxhash64(*[columns[c] for c in exact]).alias("exact")] if exact else []
        return [F.xxhash64(*columns.values()).alias("normalized"), *fixed]

    numbers = [c for c in expected.columns if c not in exact]

    def values(columns: dict[str, Column]) -> list[Column]:
        holed = reduce(lambda a, b: a | b, [v.isNull() for v in columns.values()])
        return [holed.alias("_holed"), *[columns[c].cast("double").alias(f"v_{c}") for c in numbers]]

    left = expected.select(F.xxhash64(*plain(expected).values()).alias("bag"), *hashes(plain(expected)), *values(plain(expected)), F.lit(1).cast("bigint").alias("_n"))
    right = actual.select(F.xxhash64(*plain(actual).values()).alias("bag"), *hashes(filled), *values(filled), F.lit(-1).cast("bigint").alias("_n"))
    kinds = [c for c in left.columns if c in ("bag", "normalized", "exact")]
    sums = [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("_n"), F.lit(0)).alias("more"), *[_hashes_differ(c).alias(c) for c in kinds]]
    sums += [F.count_if("_holed").alias("holes"), *[_moments(f"v_{c}").alias(f"v_{c}") for c in numbers]]
    return left.unionAll(right).agg(*sums).first().asDict()


def _moments(name: str) -> Column:
    """Of a number on both sides: the difference of the finite sums, the size of the second side, infinite ones more on the first, and NaN."""
    v, n = F.col(name), F.col("_n")
    finite = F.abs(v) < float("inf")  # NaN is larger than any number
    return F.struct(
        F.sum(F.when(finite, v * n)).alias("gap"), F.sum(F.when(finite & (n < 0), F.abs(v))).alias("size"),
        F.sum(F.when(v == float("inf"), n)).alias("high"), F.sum(F.when(v == -float("inf"), n)).alias("low"), F.count_if(F.isnan(v)).alias("nan"),
    )


def _cannot_pair(facts: dict, rtol: float, atol: float) -> bool:
    """Whether no pairing can be within the tolerance: a null or NaN, which is close to nothing, other infinite numbers, or sums farther
    apart than all tolerances together (and as much again, for the rounding of sums)."""
    if facts["holes"]:
        return True
    for name in (f for f in facts if f.startswith("v_")):
        gap, size = facts[name]["gap"] or 0.0, facts[name]["size"] or 0.0
        if facts[name]["high"] or facts[name]["low"] or facts[name]["nan"]:
            return True
        if math.isfinite(gap) and math.isfinite(size) and abs(gap) > 2 * (facts["rows"] / 2 * atol + rtol * size):
            return True
    return False


def equal_bag(expected: DataFrame, actual: DataFrame) -> bool:
    return not _any_row(bag_differences(expected, actual))


def _close(a: Column, b: Column, rtol: float, atol: float) -> Column:
    """Equal numbers, infinite ones too, or finite ones within the tolerance; NaN is close to nothing."""
    a, b = a.cast("double"), b.cast("double")
    finite = (F.abs(a) < float("inf")) & (F.abs(b) < float("inf"))  # NaN is larger than any number
    return F.when(finite, F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)).otherwise((a == b) & ~F.isnan(a))


SALTS = 1024
RANGE_ROWS, LEAST_RANGE_ROWS = 500_000, 20_000  # rows of both sides that one range holds, about


def _placed(expected: DataFrame, actual: DataFrame, size: int) -> DataFrame:
    """The rows of both sides (``_side`` 0 and 1) with their place in the order of all columns of their side.

    Both sides are cut into the same ranges and sorted there; a place is the place inside the range and the number of rows of
    the side in earlier ranges. Equal rows are told apart by a salt, so that a row with very many copies
    is spread over several ranges; their mutual order does not matter. The ranges are kept as a written table:
    a row must not change its place when a task runs again.
    """
    spark = expected.sparkSession
    columns = expected.columns
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).alias("_salt")
    sides = expected.select("*", F.lit(0).alias("_side"), salt).unionAll(actual.select("*", F.lit(1).alias("_side"), salt))
    path = scratch_path(spark, "paired")
    ranges = max(1, math.ceil(size / RANGE_ROWS), min(shuffle_partitions(spark), math.ceil(size / LEAST_RANGE_ROWS)))
    ordered = (
        sides.repartitionByRange(ranges, *columns, "_salt")
        .sortWithinPartitions("_side", *columns, "_salt")
        .select("_side", *columns, F.monotonically_increasing_id().alias("_id"))
    )
    ordered.write.parquet(path)
    rows = spark.read.schema(ordered.schema).parquet(path).withColumn("_range", F.shiftright("_id", 33))
    pieces = rows.groupBy("_side", "_range").agg(F.count(F.lit(1)).alias("_rows"), F.min("_id").alias("_first"))
    earlier = Window.partitionBy("_side").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    pieces = pieces.select("_side", "_range", (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    return rows.join(pieces, ["_side", "_range"]).select("_side", (F.col("_id") + F.col("_shift")).alias("_place"), *columns)


def tolerant_differences(
    expected: DataFrame, actual: DataFrame, rtol: float = RTOL, atol: float = ATOL, nulls_equal: bool = False, rows: int | None = None
) -> DataFrame:
    """Sorts both sides by all columns and pairs them by place; numbers may differ a little, nulls are not equal.

    The columns of a side have names of their own and pair by position. Infinite numbers are close to themselves only, NaN to
    nothing. ``rows`` is the number of rows of both sides, if the caller knows it.
    """
    rows = expected.count() + actual.count() if rows is None else rows
    numeric = {c for (c, a), (_, b) in zip(expected.dtypes, actual.dtypes) if is_numeric(a) and is_numeric(b)}
    kinds = dict(expected.dtypes), {c: b for c, (_, b) in zip(expected.columns, actual.dtypes)}
    placed = _placed(expected, actual.toDF(*expected.columns), rows)
    left = placed.where("_side = 0").select("_place", *[F.col(c).cast(kinds[0][c]).alias(f"e_{c}") for c in expected.columns])
    right = placed.where("_side = 1").select("_place", *[F.col(c).cast(kinds[1][c]).alias(f"a_{d}") for c, d in zip(expected.columns, actual.columns)])
    same = []
    for c, d in zip(expected.columns, actual.columns):
        e, a = F.col(f"e_{c}"), F.col(f"a_{d}")
        equal = _close(e, a, rtol, atol) if c in numeric else e == a
        equal = F.coalesce(equal, F.lit(False))
        same.append(equal | (e.isNull() & a.isNull()) if nulls_equal else equal)
    return left.join(right, "_place", "full_outer").where(~reduce(lambda x, y: x & y, same))


def equal_tolerant(expected: DataFrame, actual: DataFrame, rtol: float = RTOL, atol: float = ATOL, nulls_equal: bool = False) -> bool:
    n = expected.count()
    if n != actual.count():
        return False
    return not _any_row(tolerant_differences(expected, actual, rtol, atol, nulls_equal, 2 * n))


def compare(expected: DataFrame, actual: DataFrame | None, place: str | None = None, problem: str | None = None) -> tuple[str, str | None]:
    """Verdict and problem: ``correct``, ``comparison`` (other results) or ``error`` (no result).

    Correct are results that are equal as bags - those equal at every place are -, equal as bags after empty records of the
    actual side became null, or equal within the tolerance. One pass over both sides tells what is left to try: hashes that
    differ show different bags, hashes that agree are confirmed row by row, and sums too far apart show that no pairing is within the
    tolerance. ``place``, a column with the order of rows, is no part of
    the result. Sorting is needed only if the columns without a tolerance agree as bags.
    """
    if problem is not None or actual is None:
        return FAILED, problem
    if not actual.columns:
        return FAILED, "empty response"
    plain = (expected, actual) if place is None else (expected.drop(place), actual.drop(place))
    aligned = align(*plain) or align(drop_all_null(plain[0]), plain[1])
    if aligned is None or not same_kinds(*aligned):
        return COMPARISON, None
    left, right = (_comparable(df) for df in aligned)
    if not left.columns:
        return (CORRECT if left.count() == right.count() else COMPARISON), None
    filled = normalize_missing(right, EMPTY_RECORD)  # the same as before where no column is text
    exact = [c for (c, a), (_, b) in zip(left.dtypes, right.dtypes) if not (is_numeric(a) and is_numeric(b))]
    facts = _first_facts(left, right, EMPTY_RECORD, exact)
    if facts["more"]:
        return COMPARISON, None
    for name, other in (("bag", right), ("normalized", filled)):
        if not facts[name] and equal_bag(left, other):
            return CORRECT, None
    if len(exact) == len(left.columns) or facts.get("exact") or _cannot_pair(facts, RTOL, ATOL):
        return COMPARISON, None
    return (COMPARISON if _any_row(tolerant_differences(left, filled, rows=facts["rows"])) else CORRECT), None


def compare_all(cases: dict[str, tuple], parallelism: int = 8) -> dict[str, tuple[str, str | None]]:
    """The verdict of every case (expected, actual[, place[, problem]]); a few are compared side by side."""
    with ThreadPoolExecutor(parallelism) as pool:
        return dict(zip(cases, pool.map(lambda case: compare(*case), cases.values())))


def _comparable(df: DataFrame) -> DataFrame:
    """Maps are compared by their entries in the order of the keys, other columns that cannot be grouped by their JSON text."""

    def text(name: str, kind: str) -> Column:
        column = F.col(name)
        if kind.startswith("map<"):
            return F.sort_array(F.map_entries(column)) if "map<" not in kind[4:] and "variant" not in kind else F.to_json(column)
        return F.to_json(F.struct(column)) if "map<" in kind or "variant" in kind else column

    return df.select(*[text(c, kind).alias(c) for c, kind in df.dtypes])


def scalar_match(predictions: DataFrame, gold: DataFrame, key: str, predicted: str, expected: str, tries: str, max_tries: int = 3) -> DataFrame:
    """One row per question: whether the first value equals the gold value, and whether the query kept failing."""
    failed = F.coalesce(F.col(tries), F.lit(0)) >= max_tries
    label = F.coalesce(F.col(predicted).eqNullSafe(F.col(expected)) & ~failed, F.lit(False))
    return gold.join(predictions, key, "left").select(key, expected, predicted, label.alias("label"), failed.alias("error"))


def execution_accuracy(verdicts: DataFrame, ref: Sequence[str], verdict: str) -> DataFrame:
    """Share of correct verdicts by dataset; datasets without any verdict are skipped."""
    correct = (F.col(verdict) == CORRECT).cast("int")
    return (
        verdicts.where(F.col(verdict).isNotNull())
        .groupBy(*ref)
        .agg(F.count(F.lit(1)).alias("n"), F.avg(correct).alias("accuracy"))
    )
