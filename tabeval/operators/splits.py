"""Which tables suit a model, label codes, evaluation windows, splits and folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabeval.functions.fixed import WINDOW_ROWS
from tabeval.operators.analytics import split_rows
from tabeval.operators.ranks import stable_hash, with_ordinal
from tabeval.session import scratch_path

NUMERIC_INPUTS = ("int", "bigint", "double", "float", "smallint", "tinyint")
TEXT = "string"

# fixed values: a numeric target is a class label only below these limits
LARGE_TABLE_ROWS, REGRESSION_SHARE, REGRESSION_SHARE_SMALL, MAX_NUMERIC_CLASSES = 1_000, 0.05, 0.1, 1_000


def problem_type_of(classes: Column, rows: Column, numeric: bool) -> Column:
    """binary up to two classes; a numeric target of high cardinality is regression; else multiclass."""
    share = F.when(rows > LARGE_TABLE_ROWS, REGRESSION_SHARE).otherwise(REGRESSION_SHARE_SMALL)
    many = (classes > MAX_NUMERIC_CLASSES) | (classes / rows > share)
    continuous = many if numeric else F.lit(False)
    return F.when(classes <= 2, "binary").when(continuous, "regression").otherwise("multiclass")


def problem_type(df: DataFrame, target: str, group: Sequence[str] = ()) -> DataFrame:
    numeric = dict(df.dtypes)[target] in NUMERIC_INPUTS
    facts = df.groupBy(*group).agg(F.count_distinct(target).alias("classes"), F.count(target).alias("n_rows"))
    return facts.withColumn("problem_type", problem_type_of(F.col("classes"), F.col("n_rows"), numeric))


def suitable(df: DataFrame, inputs: Sequence[str], target: str | None) -> list[str] | None:
    """The numeric inputs of a table that suits classification, or None.

    The suggested columns must exist, the target must be text with at least two values, and at least two
    numeric inputs must be left. Only the target is scanned, and only when the schema already fits.
    """
    types = dict(df.dtypes)
    if target is None or target not in types or any(c not in types for c in inputs):
        return None
    numeric = [c for c in inputs if types[c] in NUMERIC_INPUTS]
    if types[target] != TEXT or len(numeric) < 2:
        return None
    facts = problem_type(df, target).first()
    if facts["classes"] < 2 or facts["problem_type"] not in ("binary", "multiclass"):
        return None
    return numeric


SMALL_ROWS = 100_000  # rows of a table of a few narrow columns that may be broadcast


def small(table: DataFrame) -> DataFrame:
    """The table, to be broadcast if it has few rows: a join on its key then leaves hot keys of the other side where they are."""
    return F.broadcast(table) if table.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else table


def factorize(df: DataFrame, label: str, row_id: str, name: str = "y") -> DataFrame:
    """Codes by first appearance of each label, -1 for missing ones."""
    first_seen = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.min(row_id).alias("_first"))
    codes = small(with_ordinal(first_seen, ["_first", label], name=name).drop("_first"))
    return df.join(codes, label, "left").withColumn(name, F.coalesce(name, F.lit(-1)).cast("int"))


def to_dataset(df: DataFrame, inputs: Sequence[str], target: str, row_id: str, keep: Sequence[str] = ()) -> DataFrame:
    """Feature array and label code of every row, and the columns in ``keep``."""
    coded = factorize(df, target, row_id)
    return coded.select(row_id, F.array(*[F.col(c).cast("double") for c in inputs]).alias("features"), "y", *keep)


def encode_labels(df: DataFrame, label: str, name: str = "code") -> DataFrame:
    """Code = number of smaller distinct labels."""
    codes = small(with_ordinal(df.select(label).distinct().where(F.col(label).isNotNull()), [label], name=name))
    return df.join(codes, label, "left").withColumn(name, F.col(name).cast("int"))


def eval_sizes(n_rows: Column, position: int, window: int = WINDOW_ROWS) -> dict[str, Column]:
    """Window and train sizes: at most ``window`` rows, and the train half shrinks with a small table."""
    usable = F.least(n_rows, F.lit(window))
    train = F.when(F.lit(2 * position) > usable, F.floor(usable * 0.5)).otherwise(F.lit(position)).cast("bigint")
    return {"train_rows": train, "window_rows": train * 2}


SEEDS = range(13, 21)  # fixed value: seeds of the window starts that are tried


def window_starts(n_rows: Column, window: Column) -> Column:
    """The start of the window for each seed: a hash of the seed and the number of rows, among the starts that leave a whole window."""

    def start(seed: int) -> Column:
        number = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), n_rows.cast("string"))), 1, 8), 16, 10).cast("bigint")
        return F.when(n_rows > window, F.pmod(number, n_rows - window + 1)).otherwise(F.lit(0).cast("bigint"))

    return F.array(*[start(seed) for seed in SEEDS])


def valid_split(
    df: DataFrame, dataset: str, row_id: str, label: str, position: int, split: int = 1, window: int = WINDOW_ROWS,
    regression: bool = False,
) -> DataFrame:
    """Train and test rows of one contiguous window per dataset, both halves holding every class.

    Split 1 keeps the row order, other splits permute it. The first of eight starts that fits is used; a
    dataset without one gives no rows. A ``regression`` target has no classes, so its first start is used.
    """
    if split == 1:
        numbered = with_ordinal(df, [row_id], [dataset], "_no")
    else:  # a column for the hash: sorting by an expression works it out in every comparison
        numbered = with_ordinal(df.withColumn("_hash", stable_hash(row_id, split)), ["_hash", row_id], [dataset], "_no").drop("_hash")
    facts = df.groupBy(dataset).agg(F.count(F.lit(1)).alias("_n"), F.count_distinct(label).alias("_classes"))
    facts = facts.withColumns(eval_sizes(F.col("_n"), position, window))
    facts = facts.withColumn("_starts", window_starts(F.col("_n"), F.col("window_rows")))
    placed = numbered.join(small(facts), dataset)
    offset = F.col("_no") - F.col("_start")
    # a row meets at most eight candidate windows, and a candidate holds at most ``window`` rows
    candidates = (
        placed.select("*", F.posexplode("_starts").alias("_try", "_start"))
        .where((offset >= 0) & (offset < F.col("window_rows")))
        .withColumn("part", F.when(offset < F.col("train_rows"), "train").otherwise("test"))
    )
    # a few rows per dataset, kept so that the order is made once
    path = scratch_path(df.sparkSession, "windows")
    candidates.where("_try = 0" if regression else "true").write.parquet(path)
    candidates = df.sparkSession.read.parquet(path)
    if regression:
        return candidates.select(*df.columns, (F.col("_no") - F.col("_start")).alias("place"), "part")
    halves = candidates.groupBy(dataset, "_try", "part").agg(
        (F.count_distinct(label) == F.first("_classes")).alias("_complete")
    )
    tries = halves.groupBy(dataset, "_try").agg((F.bool_and("_complete") & (F.count(F.lit(1)) == 2)).alias("_ok"))
    chosen = tries.where("_ok").groupBy(dataset).agg(F.min("_try").alias("_try"))
    kept = candidates.join(small(chosen), [dataset, "_try"], "left_semi")
    return kept.select(*df.columns, (F.col("_no") - F.col("_start")).alias("place"), "part")


def train_valid(df: DataFrame, columns: Sequence[str], key: str, seed: int = 42) -> DataFrame:
    """Complete rows of the selected columns, 80 % rounded down for training and the rest for validation."""
    complete = df.select(key, *[c for c in columns if c != key]).dropna()
    return split_rows(complete, key, {"valid": 0.2, "train": 0.8}, seed)


def train_valid_test(df: DataFrame, inputs: Sequence[str], output: str, key: str, seed: int = 42) -> DataFrame:
    """Input struct and output of every row with its 80/10/10 split."""
    rows = split_rows(df, key, {"train": 0.8, "valid": 0.1, "test": 0.1}, seed)
    return rows.select(key, F.struct(*inputs).alias("inputs"), F.col(output).alias("output"), "split")


def balanced_binary(df: DataFrame, label: str, order: Sequence[str], name: str = "place") -> DataFrame:
    """As many rows of each class as the smaller class has, numbered so that the classes alternate."""
    minority = df.agg(F.least(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1))).scalar()
    numbered = with_ordinal(df.where(F.col(label).isin(0, 1)), order, [label], "_no")
    kept = numbered.where(F.col("_no") < minority)
    return kept.withColumn(name, F.col("_no") * 2 + F.col(label)).drop("_no")


def shuffle_cap(df: DataFrame, key: str, n: int, seed: int = 13) -> DataFrame:
    return df.orderBy(stable_hash(key, seed), key).limit(n)


def kfold(df: DataFrame, key: str, k: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """A fold per row from its key alone, so nothing is shuffled; folds are only nearly equal in size."""
    number = F.conv(F.substring(stable_hash(key, seed), 1, 8), 16, 10).cast("bigint")
    return df.withColumn(name, (number % k).cast("int"))


def stratified_kfold(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """Folds that share out every class evenly."""
    numbered = with_ordinal(df.withColumn("_hash", stable_hash(key, seed)), ["_hash", key], [label], "_no")
    return numbered.withColumn(name, (F.col("_no") % k).cast("int")).drop("_no", "_hash")

