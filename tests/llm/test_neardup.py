import random
import re

import pytest

from tabeval.llm import graph, neardup

SCHEMA = "doc_id bigint, text string, node string, digest string, label int, `key` int"
ABC = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, words, percent=80):
    sets = {}
    for doc, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ABC))
        sets[doc] = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
    label = {d: d for d in sets}

    def root(d):
        while label[d] != d:
            d = label[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d), root(d) == d) for d in ids}


def frame(spark, docs):
    return spark.createDataFrame([(d, t, "x", "y", 1, 2) for d, t in docs], SCHEMA)


def corpus(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.randint(30, 120))] for _ in range(12)]
    docs = []
    for place in range(160):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        docs.append((1000 - place, (" " if place % 2 else "\n\t").join(w.upper() if place % 3 == 0 else w for w in words)))
    docs += [(2000 + i, t) for i, t in enumerate([None, "", " \n ", "one", "ONE", "one two three", "Ä b c d", "ä b c d", "a b c d e"])]
    return docs


@pytest.mark.parametrize("words", [4, 5])
def test_same_as_comparing_all_pairs(spark, words):
    docs = corpus()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(frame(spark, docs), words=words).collect()}
    assert got == plain(docs, words)


def test_blocks_and_salts_do_not_change_the_result(spark, monkeypatch):
    docs = corpus(8)
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 300)
    monkeypatch.setattr(neardup, "SALT_ROWS", 2)
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(frame(spark, docs), words=4).collect()}
    assert got == {d: x[1] for d, x in plain(docs, 4).items()}


def test_members_that_only_reach_each_other_past_the_hub(spark):
    """The hub of a table entry resembles neither of two documents enough that resemble each other."""
    base = [f"b{i}" for i in range(60)]
    left = base[:36] + [f"l{i}" for i in range(24)]
    right = left[:58] + ["r1", "r2"]
    docs = [(1, " ".join(base)), (2, " ".join(left)), (3, " ".join(right))]
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(frame(spark, docs), words=4).collect()}
    assert got == {1: 1, 2: 2, 3: 2} == {d: x[1] for d, x in plain(docs, 4).items()}


def test_null_keys_repeated_rows_and_empty_tables(spark):
    docs = [(None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (7, "a b c d e f")]
    rows = sorted([tuple(r) for r in neardup.near_duplicates(frame(spark, docs), words=4).collect()], key=str)
    assert rows == [(5, 3, 5, True), (5, 3, 5, True), (7, 3, 5, False), (None, 3, None, True)]
    assert neardup.near_duplicates(frame(spark, []), words=4).collect() == []
    nothing = neardup.near_duplicates(frame(spark, [(1, None), (2, "")]), words=4).collect()
    assert sorted(tuple(r) for r in nothing) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(60)]
    star = [(100, 100 + i) for i in range(1, 40)]
    links = [(b, a) if rng.random() < 0.5 else (a, b) for a, b in chain + star + [(200, 201), (300, 300)]]
    rng.shuffle(links)
    got = {r["node"]: r["label"] for r in graph.components(spark.createDataFrame(links, "hub bigint, node bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(40)}, 200: 200, 201: 200}
