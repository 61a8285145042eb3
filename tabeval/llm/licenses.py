"""Licence scan: a positional index of rare licence words, relative positions intersected, key phrases verified.

Only DataFrame functions. A template is a short passage of a licence. It fits a text at a place if at least ``share`` of its
words stand at their own places relative to it and every mandatory phrase of the template occurs within that stretch.
With n words and m of them allowed to differ, of any m + 2 places of the template at least two agree wherever it fits. So only the
m + 2 places whose words have the highest IDF over the corpus are looked up, places of a text on which two postings
agree are compared in full, and nothing is lost whatever the words looked up are.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # of a lower-cased text; digits and whatever is not ASCII belong to words

BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}  # fixed values

TEMPLATES = [  # fixed values: label, passage, mandatory phrases
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "2 0")),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0", ("apache org", "license 2 0")),
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "licensed under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("hereby granted free of charge",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("source and binary forms",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee",)),
    ("gpl-2.0", "gnu general public license version 2", ("general public license", "version 2")),
    ("gpl-3.0", "gnu general public license version 3", ("general public license", "version 3")),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ("gnu general public license",)),
    ("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    ("lgpl", "gnu library general public license", ("library general public license",)),
    ("agpl", "gnu affero general public license", ("affero general public license",)),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license", "2 0")),
    ("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0", ("eclipse public license", "2 0")),
    ("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    ("cc-by-nd-4.0", "licensed under cc by nd 4 0", ("cc by nd 4 0",)),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution",)),
    ("cc0-1.0", "the person who associated a work with this deed has dedicated the work to the public domain", ("public domain",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software", "public domain")),
]
SHARE = 0.8
BITS = 40  # of a coded candidate, for the place; the template's number stands above them


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Words of a text; none for null. Only A-Z is lower-cased in effect: other letters keep being word characters."""
    spaced = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), NOT_A_WORD, " "))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " ", -1))


def misses(n: int, share: float) -> int:
    """How many of n words may differ. Counted in thousandths, so that 0.8 of 5 is 4."""
    return n - math.ceil(n * round(share * 1000) / 1000 - 1e-9)


def document_frequency(words: DataFrame, vocabulary: Sequence[str]) -> dict[str, int]:
    """In how many rows of ``w`` each licence word occurs; summed map-side, one row a licence word comes back."""
    known = F.array_distinct(F.filter("w", lambda x: x.isin(*vocabulary)))
    return {r["word"]: r["n"] for r in words.select(F.explode(known).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}


def postings(templates: Sequence[tuple], share: float, frequency: dict[str, int]) -> dict[str, list[tuple[int, int]]]:
    """Word -> (template, place) of the rarest places of every template: one more than the number of differing words plus one."""
    index: dict[str, list[tuple[int, int]]] = {}
    for number, (_, passage, _) in enumerate(templates):
        words = passage.split()
        rare = sorted(range(len(words)), key=lambda j: (frequency.get(words[j], 0), words[j], j))
        for j in rare[: misses(len(words), share) + 2]:
            index.setdefault(words[j], []).append((number, j))
    return index


def scan(docs: DataFrame, doc: str = "doc_id", text: str = "text", templates: Sequence[tuple] = TEMPLATES, share: float = SHARE) -> DataFrame:
    """(doc_id, n_words, places, n_base, first_word, last_word, base_labels, found, labels, score), one row per document.

    ``places`` are the starts of the base phrases with their labels; ``found`` the fits of templates: label, first word, share of
    the words in place. ``score`` is 1 with a base phrase, else the best share, else 0. Labels are distinct, sorted and joined by
    commas. A template needs two words at least.

    Defined cases: null and empty texts, and texts without a word, have no words and no labels; null keys and repeated rows give a row
    each; overlapping places all count; a template cut off by an end of the text fits if enough words are left;
    the Kelvin sign reads as k in templates (no base phrase has a k); an empty table gives no rows. Other columns
    are not looked at.
    """
    if any(len(passage.split()) < 2 for _, passage, _ in templates):
        raise ValueError("a template needs two words")
    rows = docs.select(F.col(f"`{doc}`").alias("doc_id"), words_of(F.col(f"`{text}`").cast("string")).alias("w"))
    vocabulary = sorted({word for _, passage, _ in templates for word in passage.split()})
    index = postings(templates, share, document_frequency(rows, vocabulary))
    starts = {phrase.split()[0] for phrase in BASE_PHRASES}
    asked = sorted(set(index) | starts)

    def spots(w: Column) -> Column:
        """Places of words that are looked up."""
        every = F.when(F.size(w) > 0, F.sequence(F.lit(0), F.size(w) - 1)).otherwise(F.array().cast("array<int>"))
        return F.filter(every, lambda i: F.get(w, i).isin(*asked))

    def base(w: Column, at: Column) -> Column:
        """(start, label) of every place of a base phrase."""

        def here(i: Column) -> Column:
            out = F.lit(None).cast("string")
            for phrase, label in BASE_PHRASES.items():
                fits = F.lit(True)
                for j, word in enumerate(phrase.split()):
                    fits = fits & F.coalesce(F.get(w, i + j) == word, F.lit(False))
                out = F.when(fits, F.lit(label)).otherwise(out)
            return F.struct(i.cast("bigint").alias("start"), out.alias("label"))

        return F.filter(F.transform(F.filter(at, lambda i: F.get(w, i).isin(*sorted(starts))), here), lambda s: s["label"].isNotNull())

    coded = F.map_from_arrays(
        F.array(*[F.lit(word) for word in index]),
        F.array(*[F.array(*[F.lit((number << BITS) - j) for number, j in found]) for found in index.values()]),
    )

    def candidates(w: Column, at: Column) -> Column:
        """Coded (template, start) on which two postings at least agree."""
        shift = 1 << (BITS - 1)  # a start may lie before the text
        codes = F.array_sort(F.flatten(F.transform(F.filter(at, lambda i: F.get(w, i).isin(*sorted(index))), lambda i: F.transform(F.element_at(coded, F.get(w, i)), lambda c: c + i + F.lit(shift)))))
        return let(codes, lambda cs: F.array_distinct(F.filter(cs, lambda c, n: F.get(cs, n - 1) == c)))

    shapes = F.array(*[
        F.struct(F.lit(label).alias("label"), F.array(*[F.lit(word) for word in passage.split()]).alias("words"), F.lit(len(passage.split()) - misses(len(passage.split()), share)).alias("least"), F.array(*[F.lit(f" {key} ") for key in keys]).cast("array<string>").alias("keys"))
        for label, passage, keys in templates
    ])

    def verified(w: Column, code: Column) -> Column:
        """The fit of one candidate, its share -1 if it does not fit."""
        shape = F.get(shapes, F.shiftright(code, BITS).cast("int"))
        start = (code.bitwiseAND(F.lit((1 << BITS) - 1)) - F.lit(1 << (BITS - 1))).cast("int")

        def judged(s: Column) -> Column:
            same = F.size(F.filter(F.transform(s["words"], lambda x, j: F.coalesce(F.get(w, start + j) == x, F.lit(False))), lambda x: x))
            first = F.greatest(start, F.lit(0))
            stretch = F.concat(F.lit(" "), F.array_join(F.slice(w, first + 1, F.greatest(start + F.size(s["words"]) - first, F.lit(0))), " "), F.lit(" "))
            fits = (same >= s["least"]) & F.forall(s["keys"], lambda key: F.contains(stretch, key))
            return F.struct(s["label"].alias("label"), start.cast("bigint").alias("start"), F.when(fits, same / F.size(s["words"])).otherwise(-1.0).alias("share"))

        return let(shape, judged)

    def scanned(w: Column, at: Column) -> Column:
        return F.struct(
            base(w, at).alias("places"),
            F.filter(F.transform(candidates(w, at), lambda c: verified(w, c)), lambda f: f["share"] >= 0).alias("found"),
        )

    done = rows.select("doc_id", F.size("w").cast("bigint").alias("n_words"), let(F.col("w"), lambda w: let(spots(w), lambda at: scanned(w, at))).alias("s"))
    flat = done.select("doc_id", "n_words", F.col("s.places").alias("places"), F.col("s.found").alias("found"))
    by_base = F.array_distinct(F.col("places.label"))
    return flat.select(
        "doc_id", "n_words", "places",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min("places.start").alias("first_word"), F.array_max("places.start").alias("last_word"),
        F.array_join(F.array_sort(by_base), ",").alias("base_labels"), "found",
        F.array_join(F.array_sort(F.array_distinct(F.concat(by_base, F.col("found.label")))), ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max("found.share"), F.lit(0.0))).alias("score"),
    )
