import hashlib
import random
import zlib

import numpy as np
import pytest

from tabeval.llm import runs

SCHEMA = "doc_id bigint, text string, runs string, n_words int, collapsed string"


def plain_runs(words):
    """All runs by definition: every period, every stretch of equal words that far apart."""
    found = set()
    for q in range(1, len(words) // 4 + 1):
        start = None
        for i in range(len(words) - q + 1):
            same = i < len(words) - q and words[i] == words[i + q]
            if same and start is None:
                start = i
            if not same and start is not None:
                length = i + q - start
                smaller = any(all(words[j] == words[j + p] for j in range(start, i + q - p)) for p in range(1, q))
                if length >= max(6, 4 * q) and not smaller:
                    found.add((start, length, q))
                start = None
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for start, length, q in found for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def grammar_runs(texts):
    numbers, symbols, owner = {}, [], []
    for i, words in enumerate(texts):
        symbols += [numbers.setdefault((i, w), len(numbers)) for w in words]
        owner += [i] * len(words)
    start, end, period = runs.periodic_runs(np.array(symbols, dtype=np.int64), np.array(owner, dtype=np.int64))
    base = np.cumsum([0] + [len(t) for t in texts])
    out = [[] for _ in texts]
    for s, e, p in zip(start.tolist(), end.tolist(), period.tolist()):
        i = int(np.searchsorted(base, s, side="right")) - 1
        out[i].append((s - int(base[i]), e - s, p))
    return out


def drawn_text(rng):
    """Words of a small alphabet with repeated stretches, some nested."""
    letters = "abcdefgh"[: rng.randint(1, 8)]
    words: list = []
    for _ in range(rng.randint(0, 8)):
        piece = [rng.choice(letters) for _ in range(rng.randint(1, 9))]
        if words and rng.random() < 0.3:
            piece = words[-rng.randint(1, min(len(words), 30)) :]
        words += piece * rng.choice([1, 1, 2, 3, 4, 5, 7, 12])
    return words[:400]


@pytest.mark.parametrize("seed", range(6))
def test_runs_agree_with_the_definition(seed):
    rng = random.Random(seed)
    texts = [drawn_text(rng) for _ in range(60)]
    assert grammar_runs(texts) == [plain_runs(t) for t in texts]


def test_long_and_adversarial_texts():
    flip = {"a": "ab", "b": "ba"}
    word = "a"
    for _ in range(11):
        word = "".join(flip[c] for c in word)  # Thue-Morse: no run at all
    fibonacci = ["b", "a"]
    while len(fibonacci[-1]) < 1500:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    texts = [list(word), list(fibonacci[-1]), ["x"] * 3000, list("ab") * 1000, list("aab" * 40 + "c") * 6]
    assert grammar_runs(texts[:1]) == [[]]
    assert grammar_runs(texts[2:4]) == [[(0, 3000, 1)], [(0, 2000, 2)]]
    assert grammar_runs([texts[4]]) == [plain_runs(texts[4])]
    assert grammar_runs([texts[1]]) == [plain_runs(texts[1])]


def test_every_place_of_a_rule_derives_the_same_words():
    rng = random.Random(5)
    words = [w for _ in range(40) for w in drawn_text(rng)]
    numbers = {w: i for i, w in enumerate(sorted(set(words)))}
    symbols = np.array([numbers[w] for w in words])
    rule, start, middle, end = runs.nonterminals(symbols, np.zeros(len(words), dtype=np.int64))
    first = {}
    for r, s, m, e in zip(rule.tolist(), start.tolist(), middle.tolist(), end.tolist()):
        assert s < m < e
        one = first.setdefault(r, (s, m - s, e - s))
        assert one[1:] == (m - s, e - s) and words[s:e] == words[one[0] : one[0] + e - s]
    assert len(rule) == len(words) - 1 and len(first) < len(rule) / 3  # the text repeats, so rules do


def test_misleading_hashes_are_noticed(monkeypatch):
    words = list("abcabcabcabcabcabdabababab")
    true = runs.Prefixes.same
    calls = []

    def misled(self, a, b, length):
        return np.ones(len(a), dtype=bool) if self.wrong else true(self, a, b, length)

    class Once(runs.Prefixes):
        def __init__(self, symbols, seed):
            super().__init__(symbols, seed)
            self.wrong = seed == 0
            calls.append(seed)

    Once.same = misled
    monkeypatch.setattr(runs, "Prefixes", Once)
    assert grammar_runs([words]) == [plain_runs(words)] and calls == [0, 1]


def test_documents_with_odd_values(spark):
    long = " ".join(["lorem", "ipsum"] * 40_000 + [str(i) for i in range(60_000)])
    texts = [(1, "a a a a a a b"), (2, None), (3, ""), (4, " \t\n "), (5, "x y " * 4 + "z"), (None, "q q q q q q"), (5, "x y " * 4 + "z"), (6, long), (7, "é é é é é é é é é é é é")]
    got = {}
    for r in runs.collapse_runs(spark.createDataFrame([(i, t, "r", 0, "c") for i, t in texts], SCHEMA)).collect():
        got.setdefault(r["doc_id"], []).append((r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]))
    assert got[1] == [(7, [(0, 6, 1)], "a b")] and got[None] == [(6, [(0, 6, 1)], "q")]
    assert got[2] == got[3] == got[4] == [(0, [], "")]
    assert got[5] == [(9, [(0, 8, 2)], "x y z")] * 2
    assert got[6] == [(140_000, [(0, 80_000, 2)], " ".join(["lorem", "ipsum"] + [str(i) for i in range(60_000)]))]
    assert got[7] == [(6, [(0, 6, 1)], "é é")]
    assert runs.collapse_runs(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_against_brute_force(spark):
    import __spark_entry__

    folder = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in __spark_entry__.queries()["op11_periodic_runs"](spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(got) == len(rows)
    some = 0
    for row in rows:
        words = [w.decode() for w in (row["text"] or "").encode().split()]
        h = zlib.crc32(str(row["doc_id"]).encode())
        if h % 10 == 0 and words:
            a = h // 10 % len(words)
            p = 1 + (len(words) - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))]
        elif len(words) > 1500:
            continue  # too long for the definition; those with a planted run are all compared
        if len(words) > 6000:
            continue
        found = plain_runs(words)
        mine = got[row["doc_id"]]
        some += bool(found)
        best = max(found, key=lambda r: (r[1], -r[0], -r[2])) if found else None
        assert mine["n_runs"] == len(found)
        assert (mine["start"], mine["length"], mine["period"]) == (best or (None, None, None))
        assert mine["exponent_milli"] == (1000 * best[1] // best[2] if best else None)
        assert mine["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest()
        assert mine["collapsed_sha256"] == hashlib.sha256(collapsed(words, found).encode()).hexdigest()
    assert some > 10
