import itertools
import random

import pytest

from tabeval.llm import pieces
from tabeval.llm.stages import PIECES_MODEL

sentencepiece = pytest.importorskip("sentencepiece")
SCHEMA = "doc_id bigint, text string, ids string, round_trip string"


@pytest.fixture(scope="module")
def machine():
    return pieces.Transducer(pieces.read_model(PIECES_MODEL))


@pytest.fixture(scope="module")
def plain():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES_MODEL)


def test_same_ids_as_the_reference_encoder(machine, plain):
    rng = random.Random(5)
    letters = list("abcdefgh    \n\t.,ABCéßñ日本語ァ▁𝒳🙂́ <>0123xyz\x00")
    for place in range(6000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 30)))
        if place % 3 == 0:
            text = " " * rng.randint(0, 40) + text + " " * rng.randint(0, 20)
        if place % 5 == 0:
            text = "".join(plain.id_to_piece(rng.randrange(259, 32000)) for _ in range(5)).replace("▁", " ")
        ids = plain.encode(text)
        assert machine.encode(text) == ids, text
        assert machine.decode(ids) == plain.decode(ids) == text.replace("▁", " ")


def test_paths_do_not_depend_on_what_is_remembered(machine, monkeypatch):
    fresh = pieces.Transducer(machine.model)
    monkeypatch.setattr(pieces, "KEPT_WORDS", 3)
    monkeypatch.setattr(pieces, "KEPT_CHARS", 4)
    text = "the unrelentingly repetitive theorems of theology " * 3
    assert fresh.encode(text) == machine.encode(text)


def test_unigram_models_take_the_cheapest_path():
    model = {"pieces": ["<unk>", "▁a", "▁ab", "b", "bc", "c", "<0x64>"], "scores": [0, -1, -2.5, -1.2, -3.0, -1.0, 0], "kinds": [2, 1, 1, 1, 1, 1, 6], "bpe": False, "prefix": True, "fallback": True}
    machine = pieces.Transducer(model)
    assert machine.encode("abcd") == [1, 3, 5, 6]  # 1 + 1.2 + 1 beats 2.5 + 1 and 1 + 3
    assert machine.decode([1, 3, 5, 6]) == "abcd"


def test_frames_with_nulls_repeated_rows_long_texts_and_no_rows(spark, plain):
    long = "lorem ipsum " * 20_000 + "x" * 3000
    rows = [(1, "hello wörld\n", "i", "r"), (1, "hello wörld\n", "i", "r"), (2, None, None, None), (3, "", "", ""), (None, "a▁b", "", ""), (4, long, "", "")]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = pieces.encode(frame, PIECES_MODEL)
    by = {r["doc_id"]: r for r in got.collect()}
    assert got.count() == 6 and by[2]["ids"] is None and by[2]["round_trip"] is None and by[3]["ids"] == []
    assert all(by[d]["ids"] == plain.encode(t) and by[d]["round_trip"] for d, t, *_ in rows if t is not None)
    back = {r["doc_id"]: r["text"] for r in pieces.decode(got, PIECES_MODEL).collect()}
    assert back == {1: "hello wörld\n", 2: None, 3: "", None: "a b", 4: long}
    assert pieces.encode(spark.createDataFrame([], SCHEMA), PIECES_MODEL).collect() == []


def test_pairs_read_off_the_merge_trees_are_those_of_the_merges():
    machine = pieces.Transducer(pieces.read_model(PIECES_MODEL))
    assert machine.rank and machine.loose == {p for p in machine.ids if "▁▁" in p}
    rng, known = random.Random(8), sorted(machine.ids)
    cut = []
    while len(cut) < 4000:
        joined = rng.choice(known) + rng.choice(known)
        at = rng.randrange(1, len(joined))
        if joined[:at] in machine.ids and joined[at:] in machine.ids:
            cut.append((joined[:at], joined[at:]))
    cut += [("", p) for p in known[:4000]] + [("▁" * i, "▁" * j) for i in range(1, 17) for j in range(1, 17) if {"▁" * i, "▁" * j} <= set(known)]
    for a, b in cut:
        assert machine.together(a, b) == (machine.merged(a + b) == ([a, b] if a else [b])), (a, b)


def test_models_with_equal_scores_are_merged_out():
    model = {"pieces": ["<unk>", "a", "b", "ab", "ba", "aba"], "scores": [0.0, -9.0, -9.0, -1.0, -1.0, -2.0], "kinds": [2, 1, 1, 1, 1, 1], "bpe": True, "prefix": False, "fallback": False}
    machine = pieces.Transducer(model)
    assert not machine.rank
    for n in range(1, 7):
        for letters in itertools.product("ab", repeat=n):
            word = "".join(letters)
            assert machine.least_path(word) == [machine.ids[p] for p in machine.merged(word)]
