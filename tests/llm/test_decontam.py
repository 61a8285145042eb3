import random
import re
from collections import Counter

from tabeval.llm import decontam

SCHEMA = "doc_id bigint, text string, items string, item_id int, hit string"
ITEMS = "item_id bigint, text string, doc_id int"


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").lower())


def bag(words, size):
    return Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def plain(docs, items, least=0.8):
    out = {}
    for doc, text in docs:
        w, found = words_of(text), {}
        for item, item_text in items:
            v = words_of(item_text)
            if not v:
                continue
            size = min(5, len(v))
            for at in range(len(w) - len(v) + 1):
                a, b = bag(w[at : at + len(v)], size), bag(v, size)
                both = sum((a & b).values())
                score = both / (sum(a.values()) + sum(b.values()) - both)
                if score >= least:
                    found[item] = max(found.get(item, 0), score)
        out[doc] = (bool(found), sorted(i for i in found if i is not None), max(found.values(), default=0.0))
    return out


def corpus(seed=4):
    rng = random.Random(seed)
    vocabulary = [f"word{i}" for i in range(60)] + ["été", "l"]
    items = [(10 + i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(12, 45)))) for i in range(25)]
    items += [(90, "tiny item"), (91, "five words are just enough"), (92, None), (93, "..."), (94, "same same same same same same same same")]
    docs = []
    for place in range(120):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 80))]
        if place % 2:
            passage = rng.choice(items[:25])[1].split()
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                passage[rng.choice([0, -1, rng.randrange(len(passage))])] = rng.choice(vocabulary)
            at = rng.randint(0, len(words))
            words[at:at] = [p.upper() + rng.choice(["", ",", "!"]) for p in passage]
        docs.append((place, " ".join(words)))
    docs += [(500, "a Tiny, item."), (501, "Five words are just enough"), (502, "same " * 30), (503, None), (504, ""), (505, "same " * 7)]
    return docs, items


def run(spark, docs, items):
    frame = spark.createDataFrame([(d, t, "i", 1, "h") for d, t in docs], SCHEMA)
    benchmark = spark.createDataFrame([(i, t, 7) for i, t in items], ITEMS)
    return decontam.contaminated(frame, benchmark)


def test_same_as_scoring_every_window(spark):
    docs, items = corpus()
    got = {r["doc_id"]: (r["contaminated"], r["items"], r["best"]) for r in run(spark, docs, items).collect()}
    expected = plain(docs, items)
    assert got.keys() == expected.keys()
    for doc in got:
        assert got[doc][:2] == expected[doc][:2] and abs(got[doc][2] - expected[doc][2]) < 1e-12, doc
    assert 20 < sum(x[0] for x in got.values()) < 80 and any(0.8 <= x[2] < 1 for x in got.values())


def test_a_benchmark_in_blocks_gives_the_same(spark, monkeypatch):
    docs, items = corpus(9)
    whole = sorted(tuple(r) for r in run(spark, docs, items).collect())
    monkeypatch.setattr(decontam, "ITEM_BLOCK", 7)
    assert sorted(tuple(r) for r in run(spark, docs, items).collect()) == whole


def test_blocks_reach_every_fingerprint_within_the_radius():
    rng = random.Random(0)
    index = decontam.ItemIndex([(1, "a b c d e f g h i j k l")], 5, 0.8)
    mark = index.items[0][1]
    table = index.tables[12]
    for _ in range(300):
        other = mark
        for bit in rng.sample(range(decontam.BITS), decontam.RADIUS):
            other ^= 1 << bit
        assert any(table.get(key) for key in enumerate(index._blocks(other)))


def test_null_keys_and_empty_tables(spark):
    text = "one two three four five six seven"
    got = sorted([tuple(r) for r in run(spark, [(None, text), (1, text), (1, text)], [(None, text), (5, text)]).collect()], key=str)
    assert got == [(1, True, [5], 1.0), (1, True, [5], 1.0), (None, True, [5], 1.0)]
    assert [tuple(r) for r in run(spark, [(1, text)], []).collect()] == [(1, False, [], 0.0)]
    assert run(spark, [], [(5, text)]).collect() == []


def test_windows_with_repeated_shingles_are_verified_exactly():
    def best(item, text):
        index = decontam.ItemIndex([(1, item)], 5, 0.8)
        return index.matches(decontam.item_words(decontam.WordHasher(decontam.BREAKS), text))

    for run in (11, 16, 22, 33):
        for seed in range(20):
            head = " ".join(f"w{seed}x{i}" for i in range(9 * run))
            repeated, other = " ".join(["zero"] * run), " ".join(f"o{seed}x{i}" for i in range(run))
            assert best(f"{head} {repeated}", f"{head} {other}").get(1, 0) >= 0.8 and best(f"{head} {other}", f"{head} {repeated}").get(1, 0) >= 0.8
    assert best("0 " * 50, "0 " * 5000) == {1: 1.0}


def test_blocks_meet_by_text_also_without_a_key(spark, monkeypatch):
    monkeypatch.setattr(decontam, "ITEM_CHARS", 60)
    items = [" ".join(f"i{n}w{k}" for k in range(12)) for n in range(3)]
    docs = spark.createDataFrame([(None, items[2] + " a"), (None, "clean text"), (None, None), (7, items[1]), (7, items[2] + " " + items[0])], "doc_id bigint, text string")
    got = decontam.contaminated(docs, spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string"))
    assert sorted((r["doc_id"] or 0, r["contaminated"], r["items"]) for r in got.collect()) == [(0, False, []), (0, False, []), (0, True, [2]), (7, True, [0, 2]), (7, True, [1])]
