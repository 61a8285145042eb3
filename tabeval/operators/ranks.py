"""Orders, running totals, quantiles and exact cuts that survive hot groups.

A plain window sorts each group in one task. That is the best plan while the largest group is small, so the
group size is checked first; a larger group is cut into value ranges of bounded size, each range is
sorted on its own, and the totals of the earlier ranges are added.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabeval.session import scratch_path, shuffle_partitions

PLAIN_GROUP_ROWS = 1_000_000  # largest group that one task may sort
MAX_RANGES = 100_000
PLAIN_TOP_N = 1_000  # Spark prunes row_number() <= n before the shuffle up to this n


def group_sizes(df: DataFrame, group: Sequence[str]) -> tuple[int, int]:
    """Rows of the largest group and of all groups; map-side counts, one row comes back."""
    counts = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    row = counts.agg(F.max("_n").alias("largest"), F.sum("_n").alias("whole")).first()
    return row["largest"] or 0, row["whole"] or 0


def _plan(df: DataFrame, group: Sequence[str], plain_limit: int | None) -> tuple[bool, int]:
    """Whether one task may sort a whole group, and otherwise into how many ranges to cut the rows."""
    limit = PLAIN_GROUP_ROWS if plain_limit is None else plain_limit
    largest, whole = group_sizes(df, group)
    ranges = min(MAX_RANGES, max(shuffle_partitions(df.sparkSession), 2 * whole // PLAIN_GROUP_ROWS))
    return largest <= limit, ranges


def may_sort_groups(df: DataFrame, group: Sequence[str], plain_limit: int | None = None) -> bool:
    """Whether the largest group is small enough for a plain window."""
    return _plan(df, group, plain_limit)[0]


def attach(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on key columns, null keys included; the keys of the right side are dropped."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    condition = reduce(lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"_right_{key}")) for key in keys])
    return left.join(renamed, condition, how).drop(*[f"_right_{key}" for key in keys])


def with_range_bucket(df: DataFrame, value: str, n: int, name: str = "_bucket") -> DataFrame:
    """Number the quantile range of a numeric column; the n ranges hold about equally many rows."""
    wide = df.withColumn("_as_double", F.col(value).cast("double"))
    cuts = wide.approxQuantile("_as_double", [i / n for i in range(1, n)], 1 / (4 * n))
    splits = [-float("inf"), *sorted(set(cuts)), float("inf")]
    if len(splits) < 3:
        return df.withColumn(name, F.lit(0.0))
    bucketizer = Bucketizer(splits=splits, inputCol="_as_double", outputCol=name, handleInvalid="keep")
    return bucketizer.transform(wide).drop("_as_double")


NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _bucketed_by_order(counted: DataFrame, value: str, n: int) -> DataFrame:
    """Rows with the number of their range of a value of any type that has an order; equal values share a range.

    The ranges are kept as a written table: a row must not change its range when a task runs again.
    """
    spark = counted.sparkSession
    path = scratch_path(spark, "ranges")
    counted.repartitionByRange(n, value).withColumn("_bucket", F.spark_partition_id().cast("double")).write.parquet(path)
    return spark.read.parquet(path)


def cumulative_by_value(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    sums: dict[str, Column] | None = None,
    plain_limit: int | None = None,
) -> DataFrame:
    """One row per group and distinct value, with each sum, its total below the value and its group total.

    ``sums`` maps a name to the expression to add up; the default counts rows as ``n``. The result has
    ``<name>``, ``<name>_below`` (strictly smaller values) and ``<name>_total``.
    """
    sums = sums or {"n": F.lit(1)}
    group = list(group)
    rows = df.where(F.col(value).isNotNull())
    added = [F.sum(expr).alias(name) for name, expr in sums.items()]
    plain, ranges_wanted = _plan(rows, group, plain_limit)
    if plain:
        counted = rows.groupBy(*group, value).agg(*added)
        whole = Window.partitionBy(*group)
        earlier = whole.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
        return counted.select(
            "*",
            *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"{name}_below") for name in sums],
            *[F.sum(name).over(whole).alias(f"{name}_total") for name in sums],
        )
    kind = dict(rows.dtypes)[value]
    if kind in NUMERIC or kind.startswith("decimal"):
        counted = with_range_bucket(rows, value, ranges_wanted).groupBy(*group, "_bucket", value).agg(*added)
    else:
        counted = _bucketed_by_order(rows.groupBy(*group, value).agg(*added), value, ranges_wanted)
    # at most one row per range and group, so these windows stay small
    ranges = counted.groupBy(*group, "_bucket").agg(*[F.sum(name).alias(f"_{name}") for name in sums])
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        *group,
        "_bucket",
        *[F.coalesce(F.sum(f"_{name}").over(earlier), F.lit(0)).alias(f"_{name}_before") for name in sums],
        *[F.sum(f"_{name}").over(whole).alias(f"{name}_total") for name in sums],
    )
    inside = Window.partitionBy(*group, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    ordered = counted.select(
        "*", *[F.coalesce(F.sum(name).over(inside), F.lit(0)).alias(f"_{name}_inside") for name in sums]
    )
    return attach(ordered, ranges, [*group, "_bucket"]).select(
        *group,
        value,
        *sums,
        *[(F.col(f"_{name}_inside") + F.col(f"_{name}_before")).alias(f"{name}_below") for name in sums],
        *[f"{name}_total" for name in sums],
    )


def with_ordinal(
    df: DataFrame,
    order: Sequence[str | Column],
    group: Sequence[str] = (),
    name: str = "ordinal",
    plain_limit: int | None = None,
) -> DataFrame:
    """Number the rows of each group from 0 in the given order. The order should end in a unique column."""
    group, order = list(group), list(order)
    plain, ranges_wanted = _plan(df, group, plain_limit)
    if plain:
        window = Window.partitionBy(*group).orderBy(*order)
        return df.withColumn(name, F.row_number().over(window).cast("bigint") - 1)
    # The ranges are kept as a written table: the place of a row must not change when a task runs again.
    spark = df.sparkSession
    keys = [*[F.col(g) for g in group], *order]
    path = scratch_path(spark, "ordered")
    (
        df.repartitionByRange(ranges_wanted, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id())
        .write.parquet(path)
    )
    spread = spark.read.parquet(path).withColumn("_part", F.shiftright("_place", 33))
    pieces = spread.groupBy("_part", *group).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first")
    )
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    place = F.col("_place") - F.col("_first") + F.col("_before")
    return attach(spread, pieces, ["_part", *group]).select(*df.columns, place.alias(name))


def first_per_group(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group. Up to PLAIN_TOP_N each map task drops all but n rows per group."""
    if n <= PLAIN_TOP_N:
        window = Window.partitionBy(*group).orderBy(*order)
        return df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") <= n).drop("_rn")
    return with_ordinal(df, order, group, "_rn").where(F.col("_rn") < n).drop("_rn")


def exact_quantiles(
    df: DataFrame, group: Sequence[str], value: str, probs: dict[str, float], plain_limit: int | None = None
) -> DataFrame:
    """Exact, linearly interpolated quantiles per group, without holding a group in one place."""
    group = list(group)
    running = cumulative_by_value(df, group, value, plain_limit=plain_limit)
    ends = []
    for name, p in probs.items():
        place = (F.col("n_total") - 1) * F.lit(float(p))
        for side, index in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            inside = (F.col("n_below") <= index) & (index < F.col("n_below") + F.col("n"))
            ends.append(F.max(F.when(inside, F.col(value))).alias(f"_{name}_{side}"))
    found = running.groupBy(*group).agg(F.max("n_total").alias("n_total"), *ends)
    picked = []
    for name, p in probs.items():
        place = (F.col("n_total") - 1) * F.lit(float(p))
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        picked.append((low + (high - low) * (place - F.floor(place))).alias(name))
    return found.select(*group, *picked)


NULL_KEY = "\u0000null"  # no key is written like this


def stable_hash(key: str | Column, seed: int | str) -> Column:
    """A hash that orders rows the same way on every run and in every engine that has md5. A null key has one, too."""
    column = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.coalesce(column.cast("string"), F.lit(NULL_KEY)), F.lit(str(seed))))


PREFIX_LENGTH = 4  # hexadecimal digits, so at most 65,536 prefixes


def hash_counts(df: DataFrame, key: str, seed: int | str) -> dict[str, int]:
    """Rows per hash prefix. The number of prefixes is fixed, whatever the number of rows."""
    prefix = F.substring(stable_hash(key, seed), 1, PREFIX_LENGTH)
    return dict(df.groupBy(prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("n")).collect())


def hash_cuts(df: DataFrame, key: str, seed: int | str, counts: Sequence[int], per_prefix: dict[str, int]) -> list[str | None]:
    """For each count, the hash below which exactly that many rows lie; None when it is past the end.

    ``key`` must be unique. Only the rows of the prefixes that hold a cut are sorted; the rows of the table
    are never shuffled.
    """
    places: list[tuple[str, int] | None] = []
    for count in counts:
        before, place = 0, None
        for prefix in sorted(per_prefix):
            if before <= count < before + per_prefix[prefix]:
                place = (prefix, count - before + 1)
                break
            before += per_prefix[prefix]
        places.append(place)
    wanted = {place for place in places if place}
    if not wanted:
        return [None] * len(places)
    hashed = df.select(stable_hash(key, seed).alias("h")).withColumn("prefix", F.substring("h", 1, PREFIX_LENGTH))
    inside = hashed.where(F.col("prefix").isin(sorted({prefix for prefix, _ in wanted})))
    numbered = inside.withColumn("no", F.row_number().over(Window.partitionBy("prefix").orderBy("h")))
    hit = reduce(lambda a, b: a | b, [(F.col("prefix") == prefix) & (F.col("no") == no) for prefix, no in wanted])
    found = {(row["prefix"], row["no"]): row["h"] for row in numbered.where(hit).collect()}
    return [found[place] if place else None for place in places]


def below_cut(key: str, seed: int | str, cut: str | None) -> Column:
    return F.lit(True) if cut is None else stable_hash(key, seed) < F.lit(cut)
