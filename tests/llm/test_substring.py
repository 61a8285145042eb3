import random

import numpy as np
import pytest

from tabeval.llm import substring, words

SCHEMA = "doc_id bigint, text string, start int, run int, digest string"


def plain(docs, size):
    first, out = {}, {}
    for doc, text in sorted(docs, key=lambda d: d[0]):
        w = (text or "").encode().split()
        gone = set()
        for i in range(len(w) - size + 1):
            if first.setdefault(tuple(w[i : i + size]), (doc, i)) != (doc, i):
                gone |= set(range(i, i + size))
        out[doc] = (len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode())
    return out


def frame(spark, docs):
    return spark.createDataFrame([(d, t, 1, 2, "z") for d, t in docs], SCHEMA)


def corpus(seed=2):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["é", "日本", "a b"]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(15, 60))] for _ in range(6)]
    docs = []
    for place in range(120):
        parts = []
        for _ in range(rng.randint(1, 4)):
            parts += rng.choice(passages) if rng.random() < 0.4 else [rng.choice(vocabulary) for _ in range(rng.randint(1, 50))]
        docs.append((500 - place, rng.choice([" ", "\n", " \t "]).join(parts)))
    docs += [(1000 + i, docs[i][1]) for i in range(10)]
    docs += [(2000, "x " * 45), (2001, "x " * 30), (2002, " ".join("abcabcabc" * 10)), (2003, None), (2004, ""), (2005, "short text")]
    return docs


@pytest.mark.parametrize("size, max_cells", [(20, 1 << 29), (20, 1 << 10), (5, 1 << 29), (9, 1 << 29)])
def test_same_as_looking_at_every_window(spark, monkeypatch, size, max_cells):
    """Also with a sketch far too small: it may only let more windows pass."""
    docs = corpus()
    monkeypatch.setattr(substring, "SEGMENTS", 8)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substring.remove_repeats(frame(spark, docs), size=size, max_cells=max_cells).collect()}
    assert got == plain(docs, size)


def test_null_keys_repeated_rows_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(30))
    got = sorted(([tuple(r) for r in substring.remove_repeats(frame(spark, [(None, text), (3, text), (3, text), (4, text)])).collect()]), key=str)
    assert got == [(3, 30, 0, text), (3, 30, 0, text), (4, 30, 30, ""), (None, 30, 0, text)]
    assert substring.remove_repeats(frame(spark, [])).collect() == []


def test_estimates_are_never_below_the_counts():
    rng = np.random.default_rng(0)
    hashes = words.mix(rng.integers(0, 50, 4000).astype(np.uint64))
    least = substring.anchors(hashes, 20)
    places = substring.anchor_places(hashes, 20)
    assert set(least.tolist()) == set(places.tolist())
    run = words.windows(hashes, 8, 211)
    assert (least == [run[i : i + 13].min() for i in range(len(least))]).all()


def test_word_hashes_of_long_texts_do_not_depend_on_pieces(monkeypatch):
    raw = " ".join(["word", "x" * 5000, "é" * 700, "y"] * 40).encode()
    whole = words.WordHasher().words(raw)
    monkeypatch.setattr(words, "PIECE", 97)
    for a, b in zip(whole, words.WordHasher().words(raw)):
        assert (a == b).all()
    starts, ends, hashes = whole
    assert [raw[s:e] for s, e in zip(starts, ends)] == raw.split() and len(set(hashes.tolist())) == 4
