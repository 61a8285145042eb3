"""Removal of repeated word windows, behind a count-min prefilter.

Pass 1 sketches every partition and merges the sketches: a window is counted under its anchor, the least hash among its
runs of 8 words, so equal windows always share a cell and counts are only ever overestimated. Pass 2 groups exactly
those windows whose estimate says "repeated". The sketch has a fixed largest size; when it is too small for the corpus
more windows pass, but none is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabeval.llm.frames import arrow_map, partitions, picked, written
from tabeval.llm.words import WordHasher, mix, numbers, windows

ANCHOR = 8  # words of an anchor run
ROWS = 2  # hash rows of the sketch
SEGMENTS = 64  # pieces of a sketch row, merged independently
MAX_CELLS = 1 << 29  # per row; as a bitmap at most 64 MB a row


def sliding(values: np.ndarray, size: int, pick=np.minimum) -> np.ndarray:
    """The least (or largest) of every run of ``size`` values."""
    have, out = 1, values
    while have < size:
        step = min(have, size - have)
        out = pick(out[:-step], out[step:])
        have += step
    return out


def utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def anchors(hashes: np.ndarray, size: int) -> np.ndarray:
    """The anchor of every window of ``size`` words, by start."""
    run = min(ANCHOR, size)
    if len(hashes) < size:
        return np.zeros(0, dtype=np.uint64)
    return sliding(windows(hashes, run, 211), size - run + 1)


def anchor_places(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hashes of all runs that are the anchor of some window, one for each place."""
    run = min(ANCHOR, size)
    least, span = anchors(hashes, size), size - min(ANCHOR, size) + 1
    if not len(least):
        return least
    edge = np.zeros(span - 1, dtype=np.uint64)
    most = sliding(np.concatenate([edge, least, edge]), span, np.maximum)
    runs = windows(hashes, run, 211)
    return runs[most == runs]


def cells_of(values: np.ndarray, row: int, cells: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(values * numbers(307 + row, 1)) & np.uint64(cells - 1)


def sketch(docs: DataFrame, size: int, cells: int) -> np.ndarray:
    """The merged sketch as one bit per cell: was it hit at least twice. Shape (ROWS, cells / 8)."""
    width = cells // SEGMENTS

    def partial(batch: pa.RecordBatch) -> Iterator[dict]:
        hasher = WordHasher()
        found = [anchor_places(hasher.hashes(utf8(t)), size) for t in batch.column("text").to_pylist()]
        values = np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)
        segments, blobs = [], []
        for row in range(ROWS):
            at, n = np.unique(cells_of(values, row, cells), return_counts=True)
            cuts = np.searchsorted(at, np.arange(SEGMENTS + 1, dtype=np.uint64) * np.uint64(width))
            packed = (at % np.uint64(width)).astype(np.uint32) << np.uint32(1) | (n > 1)
            for s in range(SEGMENTS):
                if cuts[s] < cuts[s + 1]:
                    segments.append(row * SEGMENTS + s)
                    blobs.append(packed[cuts[s] : cuts[s + 1]].astype(np.uint32).tobytes())
        yield {"segment": segments, "cells": blobs}

    schema = pa.schema([("segment", pa.int32()), ("bits", pa.binary())])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts = None, None

        def full():
            return pa.RecordBatch.from_arrays([pa.array([held], pa.int32()), pa.array([np.packbits(counts > 1).tobytes()], pa.binary())], schema=schema)

        for batch in batches:
            for segment, blob in zip(batch.column("segment").to_pylist(), batch.column("cells").to_pylist()):
                if segment != held:
                    if held is not None:
                        yield full()
                    held, counts = segment, np.zeros(width, dtype=np.uint8)
                packed = np.frombuffer(blob, dtype=np.uint32)
                at = packed >> np.uint32(1)
                counts[at] = np.minimum(counts[at] + 1 + (packed & np.uint32(1)).astype(np.uint8), 2)
        if held is not None:
            yield full()

    parts = arrow_map(docs.select("text"), partial, "segment int, cells binary")
    merged = parts.repartition(min(partitions(docs.sparkSession), ROWS * SEGMENTS), "segment").sortWithinPartitions("segment").mapInArrow(merge, "segment int, bits binary")
    bits = np.zeros((ROWS * SEGMENTS, width // 8), dtype=np.uint8)
    for row in merged.collect():  # bounded: ROWS * cells / 8 bytes
        bits[row["segment"]] = np.frombuffer(row["bits"], dtype=np.uint8)
    return bits.reshape(ROWS, -1)


def perhaps_repeated(bits: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Whether the estimate of each anchor is at least two."""
    cells = bits.shape[1] * 8
    sure = np.ones(len(least), dtype=bool)
    for row in range(len(bits)):
        at = cells_of(least, row, cells)
        sure &= (bits[row][(at >> np.uint64(3)).astype(np.int64)] >> (7 - (at & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
    return sure


def runs_of(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First start and length of every run of consecutive starts (sorted)."""
    first = np.flatnonzero(np.diff(starts, prepend=starts[0] - 2) != 1)
    return starts[first], np.diff(np.append(first, len(starts)))


def later_windows(docs: DataFrame, size: int, bits: np.ndarray) -> DataFrame:
    """(doc_id, start, run): starts of windows whose word sequence also starts earlier, as runs.

    Within a batch all but the earliest occurrence of a window are settled at once and leave as runs; only the earliest goes
    into the shuffle. So a window that every document holds costs one row per batch.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(bits)

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        hasher, bits = WordHasher(), shared.value
        parts = []
        for place, (doc, text) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())):
            hashes = hasher.hashes(utf8(text))
            least = anchors(hashes, size)
            if not len(least):
                continue
            turn = np.flatnonzero(np.diff(least, prepend=~least[:1]))
            sure = np.repeat(perhaps_repeated(bits, least[turn]), np.diff(np.append(turn, len(least))))
            at = np.flatnonzero(sure)
            if len(at):
                parts.append((windows(hashes, size, 401)[at], windows(hashes, size, 503)[at], np.full(len(at), doc), at))
        if not parts:
            return
        w1, w2, doc, start = (np.concatenate(p) for p in zip(*parts))
        order = np.lexsort((start, doc, w2, w1))
        w1, w2, doc, start = w1[order], w2[order], doc[order], start[order]
        same = (w1[1:] == w1[:-1]) & (w2[1:] == w2[:-1])
        first = np.concatenate([[True], ~same])
        group = np.cumsum(first) - 1
        head_doc, head_start = doc[first][group], start[first][group]
        later = (doc != head_doc) | (start != head_start)
        yield {"w1": w1[first].view(np.int64), "w2": w2[first].view(np.int64), "doc_id": doc[first], "start": start[first], "run": np.zeros(first.sum(), dtype=np.int64)}
        if later.any():
            doc, start = doc[later], start[later]
            order = np.lexsort((start, doc))
            doc, start = doc[order], start[order]
            key = np.cumsum(np.diff(doc, prepend=doc[0]) != 0) * (1 << 40) + start  # runs end with a document
            key, one = np.unique(key, return_index=True)
            begin, length = runs_of(key)
            at = one[np.searchsorted(key, begin)]
            yield {"w1": mix(begin.astype(np.uint64) ^ doc[at].astype(np.uint64)).view(np.int64), "w2": np.zeros(len(at), dtype=np.int64), "doc_id": doc[at], "start": start[at], "run": length}

    rows = arrow_map(docs, lambda b: ({k: pa.array(v) for k, v in c.items()} for c in step(b)), "w1 bigint, w2 bigint, doc_id bigint, start bigint, run bigint")
    dealt = rows.repartition(partitions(spark), "w1").sortWithinPartitions("w1", "w2", "doc_id", "start")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("run", pa.int64())])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the window of the last row and its first occurrence
        for batch in batches:
            w1, w2, doc, start, run = (batch.column(i).to_numpy() for i in range(5))
            if not len(w1):
                continue
            ready = run > 0
            a, b, d, s = w1[~ready], w2[~ready], doc[~ready], start[~ready]
            out = [(doc[ready], start[ready], run[ready])]
            if len(a):
                first = np.concatenate([[last is None or (a[0], b[0]) != last[:2]], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
                heads = np.flatnonzero(first)
                group = np.cumsum(first) - 1
                first_doc, first_start = d[heads], s[heads]
                if not first[0]:
                    first_doc, first_start, group = np.append(last[2], first_doc), np.append(last[3], first_start), group + 1
                later = (d != first_doc[group]) | (s != first_start[group])
                out.append((d[later], s[later], np.ones(later.sum(), dtype=np.int64)))
                last = (a[-1], b[-1], first_doc[group[-1]], first_start[group[-1]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*out)], schema=schema)

    return dealt.mapInArrow(settle, "doc_id bigint, start bigint, run bigint")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 20, max_cells: int = MAX_CELLS) -> DataFrame:
    """One row per document: key, n_words, n_removed and kept, the words left joined by one space.

    A window is ``size`` consecutive words of one document. Every word covered by a window whose word sequence also starts
    earlier (smaller key, or same document and earlier start) goes; windows are judged on the input. Defined cases: null,
    empty or short texts keep all their words; a null key is neither earlier nor later than anything; repeated
    rows of one key are the same document, so they do not remove each other; an empty table gives no rows.
    """
    source = picked(docs, doc_id=key, text=text)

    def describe(batch: pa.RecordBatch) -> Iterator[dict]:
        words = [utf8(t).split() for t in batch.column("text").to_pylist()]
        digests = [hashlib.blake2b(b" ".join(w), digest_size=16).digest() for w in words]
        yield {"doc_id": batch.column("doc_id"), "n_words": [len(w) for w in words], "digest": digests}

    facts = written(arrow_map(source, describe, "doc_id bigint, n_words bigint, digest binary"), "facts").where("doc_id is not null")
    whole = facts.where(F.col("n_words") >= size)
    firsts = whole.groupBy("digest").agg(F.min("doc_id").alias("first"))
    copies = whole.join(firsts, "digest").where("doc_id > first").select("doc_id", "n_words").distinct()
    copies = written(copies, "copies")
    total = whole.agg(F.sum("n_words")).first()[0] or 0
    cells = 1 << 16
    while cells < min(max_cells, 4 * total * 2 // max(2, size - ANCHOR + 2)):
        cells *= 2
    # exact copies lose all their words; only first copies are searched
    searched = source.where("doc_id is not null").join(copies.select("doc_id"), "doc_id", "left_anti")
    removed = later_windows(searched, size, sketch(searched, size, cells))
    whole_runs = copies.select("doc_id", F.lit(0).cast("bigint").alias("start"), (F.col("n_words") - (size - 1)).alias("run"))
    spans = removed.unionByName(whole_runs).groupBy("doc_id").agg(F.collect_list(F.struct("start", "run")).alias("spans"))

    def rebuild(batch: pa.RecordBatch) -> Iterator[dict]:
        counts, gone, kept = [], [], []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans")):
            words = utf8(text).split()
            counts.append(len(words))
            left = words
            if spans.is_valid:
                start, run = (spans.values.field(c).to_numpy() for c in ("start", "run"))
                edges = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(edges, np.minimum(start, len(words)), 1)
                np.add.at(edges, np.minimum(start + run + size - 1, len(words)), -1)
                left = list(compress(words, np.cumsum(edges[:-1]) == 0))
            gone.append(len(words) - len(left))
            kept.append(b" ".join(left).decode("utf-8", "surrogatepass"))
        yield {key: batch.column("doc_id"), "n_words": counts, "n_removed": gone, "kept": kept}

    return arrow_map(source.join(spans, "doc_id", "left"), rebuild, f"`{key}` {dict(source.dtypes)['doc_id']}, n_words bigint, n_removed bigint, kept string")
