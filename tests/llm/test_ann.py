import numpy as np

from tabeval.llm import ann

SCHEMA = "vec_id bigint, embedding array<float>, v int, ids string, query string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "i", "q") for i, v in rows], SCHEMA)


def exact(ids, points, query, k):
    at = ids.index(query)
    gaps = np.sqrt(((points - points[at]) ** 2).sum(axis=1))
    return [(ids[j], gaps[j]) for j in np.lexsort((ids, gaps)) if ids[j] != query][:k]


def test_recall_and_exact_scores_on_given_vectors(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = ann.nearest(rows, rows.where("vec_id % 100 = 0")).collect()
    table = sorted((r["vec_id"], r["embedding"]) for r in rows.collect())
    ids, points = [i for i, _ in table], np.array([v for _, v in table], dtype=np.float64)
    hits = total = 0
    for query in {r["query_id"] for r in got}:
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == query)
        assert [m[0] for m in mine] == list(range(1, 11)) and [m[1:] for m in mine] == sorted([m[1:] for m in mine], key=lambda m: (m[1], m[0]))
        best = exact(ids, points, query, 10)
        hits += len({m[1] for m in mine} & {b[0] for b in best})
        total += len(best)
        gaps = dict(exact(ids, points, query, len(ids)))
        assert all(abs(gaps[v] - s) < 1e-12 for _, v, s in mine)
    assert total == 10 * sum(i % 100 == 0 for i in ids) and hits >= 0.9 * total


def test_large_groups_of_equal_vectors_ties_and_unusable_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(0, 400)] + [(1000 + i, list(rng.integers(-2, 3, 3) + 0.5)) for i in range(60)]
    odd = [(5000, None), (5100, [0.0, 0.0, 0.0]), (5200, [1.0, None, 2.0]), (5300, [float("nan"), 1, 1]), (5400, [float("inf"), 1, 1]), (5500, [1.0, 2.0]), (5600, []), (None, [1.0, 1.0, 1.0])]
    whole = frame(spark, rows + odd + rows[:5])
    got = ann.nearest(whole, whole.where("vec_id % 100 = 0"), share=8.0)  # all leaves of all trees, so the answer is exact
    ids, points = [i for i, _ in rows], np.array([v for _, v in rows])
    found = {}
    for r in got.collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], round(r["score"], 9)))
    assert set(found) == {0, 100, 200, 300, 1000}
    for query, mine in found.items():
        assert sorted(mine) == [(n + 1, v, round(float(s), 9)) for n, (v, s) in enumerate(exact(ids, points, query, 10))]


def test_few_rows_pieces_of_leaves_and_empty_tables(spark, monkeypatch):
    rows = [(100, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0])]
    got = ann.nearest(frame(spark, rows), frame(spark, rows[:1])).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"])] == [(100, 1, 3), (100, 2, 2)]
    assert ann.nearest(frame(spark, []), frame(spark, [])).collect() == []
    alone = frame(spark, rows[:1])
    assert ann.nearest(alone, alone).collect() == []
    rng = np.random.default_rng(4)
    many = frame(spark, [(i, rng.normal(size=4)) for i in range(600)])
    whole = sorted(tuple(r) for r in ann.nearest(many, many.where("vec_id % 10 = 0"), share=8.0).collect())
    monkeypatch.setattr(ann, "GROUP_ROWS", 40)
    monkeypatch.setattr(ann, "GROUP_QUERIES", 7)
    monkeypatch.setattr(ann, "CELLS", 50)
    assert sorted(tuple(r) for r in ann.nearest(many, many.where("vec_id % 10 = 0"), share=8.0).collect()) == whole
