"""The range-wise paths must agree with the plain windows, also when one key holds most rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabeval.operators import ranks

random.seed(5)
ROWS = [("hot" if random.random() < 0.6 else random.choice("abc"), random.choice([0.5, random.gauss(0, 3)]), i) for i in range(3000)]
ROWS += [(None, 1.0, 3000 + i) for i in range(20)] + [("a", None, 4000)]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(ROWS, "g string, v double, id bigint").repartition(7).cache()


def as_set(df, digits=9):
    return {tuple(round(x, digits) if isinstance(x, float) else x for x in row) for row in df.collect()}


@pytest.mark.parametrize("group", [[], ["g"]])
def test_cumulative_by_value(frame, group):
    sums = {"n": F.lit(1), "even": (F.col("id") % 2 == 0).cast("bigint")}
    plain = ranks.cumulative_by_value(frame, group, "v", sums)
    ranged = ranks.cumulative_by_value(frame, group, "v", sums, plain_limit=0)
    assert plain.columns == ranged.columns
    assert as_set(plain) == as_set(ranged)
    values = [v for g, v, _ in ROWS if v is not None and (not group or g == "hot")]
    row = next(r for r in ranged.collect() if r["v"] == 0.5 and (not group or r["g"] == "hot"))
    assert row["n"] == values.count(0.5) and row["n_below"] == sum(v < 0.5 for v in values) and row["n_total"] == len(values)


@pytest.mark.parametrize("group", [[], ["g"]])
def test_with_ordinal(frame, group):
    plain = ranks.with_ordinal(frame, ["v", "id"], group)
    ranged = ranks.with_ordinal(frame, ["v", "id"], group, plain_limit=0)
    assert plain.columns == ranged.columns
    assert as_set(plain) == as_set(ranged)
    assert ranged.count() == len(ROWS)


def test_exact_quantiles(frame):
    probs = {"low": 0.0, "q1": 0.25, "mid": 0.5, "p90": 0.9, "high": 1.0}
    for limit in (None, 0):
        for row in ranks.exact_quantiles(frame, ["g"], "v", probs, plain_limit=limit).collect():
            values = [v for g, v, _ in ROWS if g == row["g"] and v is not None]
            for name, p in probs.items():
                assert row[name] == pytest.approx(np.quantile(values, p))


def test_first_per_group_beyond_the_pruned_size(frame, monkeypatch):
    small = ranks.first_per_group(frame, ["g"], ["v", "id"], 40)
    monkeypatch.setattr(ranks, "PLAIN_TOP_N", 10)
    monkeypatch.setattr(ranks, "PLAIN_GROUP_ROWS", 500)
    assert as_set(small) == as_set(ranks.first_per_group(frame, ["g"], ["v", "id"], 40))


def test_hash_cuts_are_exact(spark):
    ids = spark.range(5000).withColumnRenamed("id", "k")
    counts = [0, 1, 1234, 4999, 5000]
    per_prefix = ranks.hash_counts(ids, "k", 7)
    assert sum(per_prefix.values()) == 5000
    for count, cut in zip(counts, ranks.hash_cuts(ids, "k", 7, counts, per_prefix)):
        assert ids.where(ranks.below_cut("k", 7, cut)).count() == count


def test_shared_dir_needs_a_setting_on_a_cluster():
    from types import SimpleNamespace

    from tabeval.session import shared_dir

    def session(master, setting=None):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda path: None)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: setting), sparkContext=context)

    with pytest.raises(RuntimeError):
        shared_dir(session("spark://somewhere"))
    assert shared_dir(session("spark://somewhere", "hdfs:///shared")) == "hdfs:///shared"
    assert shared_dir(session("local[2]"))


def test_text_is_ordered_in_ranges_as_in_one_piece(spark):
    rows = [(i % 2, f"v{i * 37 % 90}") for i in range(400)] + [(0, None)]
    df = spark.createDataFrame(rows, "g int, t string")
    plain, cut = (sorted(tuple(r) for r in ranks.cumulative_by_value(df, ["g"], "t", plain_limit=limit).collect()) for limit in (None, 5))
    assert plain == cut and len(plain) > 50
