import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tabeval.llm import licenses

SCHEMA = "doc_id bigint, text string, w string, at int, labels string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text, templates=licenses.TEMPLATES, share=licenses.SHARE):
    """Places and fits by trying every start of every template."""
    words = WORD.findall((text or "").translate(LOWER))
    places = sorted((i, label) for phrase, label in licenses.BASE_PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split())
    found = set()
    for label, passage, keys in templates:
        asked = passage.split()
        for start in range(-len(asked), len(words)):
            same = sum(0 <= start + j < len(words) and words[start + j] == x for j, x in enumerate(asked))
            stretch = f" {' '.join(words[max(start, 0) : max(start + len(asked), 0)])} "
            if same >= len(asked) - licenses.misses(len(asked), share) and all(f" {key} " in stretch for key in keys):
                found.add((label, start, same / len(asked)))
    return len(words), places, sorted(found)


def scanned(spark, texts, **more):
    rows = spark.createDataFrame([(i, t, "w", 0, "l") for i, t in enumerate(texts)], SCHEMA)
    return {r["doc_id"]: r for r in licenses.scan(rows, **more).collect()}


def agrees(row, text, **more):
    n, places, found = brute(text, **more)
    assert row["n_words"] == n and sorted((p["start"], p["label"]) for p in row["places"]) == places
    assert sorted({(f["label"], f["start"], f["share"]) for f in row["found"]}) == found
    assert row["n_base"] == len(places)
    assert (row["first_word"], row["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
    assert row["base_labels"] == ",".join(sorted({label for _, label in places}))
    assert row["labels"] == ",".join(sorted({label for _, label in places} | {label for label, _, _ in found}))
    assert row["score"] == (1.0 if places else max((s for _, _, s in found), default=0.0))


TEXTS = [
    "Licensed under the Apache License, Version 2.0.",
    "x Licensed under CC BY-NC 4.0. cc by cc by, All Rights\nReserved all rights reserved",
    "This work is licensed under the GNU General Public License, version 3.",
    "RELEASED under a MIT license; released under the mit licence",
    "apache license version 2 0",  # cut off by the start of the text
    "a b licensed under the apache license version",  # and by its end: the phrase "2 0" is missing
    "you can redistribute it and or modify it under some terms of the gnu general public license as published by the free software foundation",
    "redistribution and use in source and binary forms with or without modification are permitted provided that these following conditions are met",
    "ALL RIGHTS RESERVEDé all rights réserved general public license",
    "licenseſ Kelvin cc by cc-by CC BY",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated docs",
]


def test_given_texts_agree_with_every_start(spark):
    got = scanned(spark, TEXTS)
    for i, text in enumerate(TEXTS):
        agrees(got[i], text)
    assert got[0]["labels"] == "apache-2.0" and got[1]["labels"] == "cc-by,cc-by-nc-4.0,reserved" and got[2]["labels"] == "gpl,gpl-3.0"
    assert got[4]["labels"] == "" and got[5]["labels"] == "" and "bsd" in got[7]["labels"] and got[10]["labels"] == "mit"


def test_empty_odd_and_long_texts(spark):
    long = "the license " * 60_000 + "all rights reserved " * 20_000 + "x" * 1_000_000
    texts = [None, "", " \t\n", "!?%", long, "cc by", "cc by"]
    got = scanned(spark, texts)
    for i in (0, 1, 2, 3):
        assert (got[i]["n_words"], got[i]["n_base"], got[i]["first_word"], got[i]["labels"], got[i]["score"]) == (0, 0, None, "", 0.0)
    assert (got[4]["n_words"], got[4]["n_base"], got[4]["first_word"], got[4]["last_word"]) == (180_001, 20_000, 120_000, 179_997)
    assert got[5]["labels"] == got[6]["labels"] == "cc-by"
    assert licenses.scan(spark.createDataFrame([], SCHEMA)).collect() == []
    doubled = spark.createDataFrame([(None, "cc by", "w", 0, "l")] * 3, SCHEMA)
    assert [r["base_labels"] for r in licenses.scan(doubled).collect()] == ["cc-by"] * 3


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(st.sampled_from("a b c d e".split()), max_size=24), min_size=1, max_size=8))
def test_rare_places_lose_no_fit(spark, texts):
    templates = [("t1", "a b c d e", ("c d",)), ("t2", "a a b", ()), ("t3", "e d c b a a b c d e", ("b",)), ("t4", "d d", ("d d",))]
    lines = [" ".join(t) for t in texts]
    got = scanned(spark, lines, templates=templates)
    for i, line in enumerate(lines):
        agrees(got[i], line, templates=templates)


def test_index_holds_the_rarest_places_and_frequencies_count_documents(spark):
    rows = spark.createDataFrame([(["a", "a", "b"],), (["a", "z"],), (["c"],)], "w array<string>")
    assert licenses.document_frequency(rows, ["a", "b", "c", "d"]) == {"a": 2, "b": 1, "c": 1}
    index = licenses.postings([("t", "a b c d a", ())], 0.8, {"a": 2, "b": 1, "c": 1})
    assert index == {"d": [(0, 3)], "b": [(0, 1)], "c": [(0, 2)]}


def test_no_python_in_the_plan(spark):
    rows = spark.createDataFrame([(1, "cc by", "w", 0, "l")], SCHEMA)
    plan = licenses.scan(rows)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Exchange", plan)
