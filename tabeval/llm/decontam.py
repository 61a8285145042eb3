"""Benchmark decontamination: SimHash fingerprints of item-sized windows, found again through Hamming blocks.

For every benchmark item all windows of its length are considered. A window is fingerprinted if it holds enough of
the benchmark's shingles to reach the wanted similarity at all (a necessary condition, so nothing is lost). Its
fingerprint is looked up in a multi-index: split into blocks, two fingerprints within the radius differ in at most
radius // blocks bits of some block, and all such block values are indexed. Where a window or an item repeats a
shingle, the distance tells little: there the candidates are all items that hold one of the window's rarest shingles, of which a
similar item must have one. Candidates are verified by the exact similarity of the weighted shingles (weights are the numbers of occurrences).
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from hashlib import blake2b
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabeval.llm.frames import arrow_map, carried, list_array, picked
from tabeval.llm.words import WordHasher, windows

BREAKS = tuple(b for b in range(128) if not chr(b).isalnum())  # ASCII that is neither letter nor digit ends a word
BITS, BLOCKS, RADIUS = 64, 8, 22  # a similarity of 0.8 is about 9.7 +- 2.9 differing bits
ITEM_BLOCK = 20_000  # items that are broadcast at a time
ITEM_CHARS = 16_000_000  # and their characters
GATE = 20  # bits of the shingle gate


def item_words(hasher: WordHasher, text: str | None) -> np.ndarray:
    return hasher.hashes((text or "").lower().encode("utf-8", "surrogatepass"))


def shingle_run(hashes: np.ndarray, words: int) -> np.ndarray:
    """All shingles in order, repetitions included; a shorter sequence is one shingle."""
    return windows(hashes, min(words, len(hashes)), 101 + min(words, len(hashes))) if len(hashes) else hashes


def fingerprint(shingles: np.ndarray) -> int:
    """SimHash: the sign of the weighted sum of the shingles' bits. Repetitions are the weights."""
    bits = np.unpackbits(shingles.view(np.uint8).reshape(len(shingles), 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > len(shingles)).tobytes(), "big")


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity."""
    both = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return both / (sum(a.values()) + sum(b.values()) - both)


class ItemIndex:
    """Benchmark items by window length, with the Hamming blocks of their fingerprints."""

    def __init__(self, items: list[tuple[int, str]], words: int, least: float):
        hasher = WordHasher(BREAKS)
        self.words, self.least = words, least
        self.items, self.tables = {}, defaultdict(lambda: defaultdict(list))
        shingles_by_size, by_length = defaultdict(set), defaultdict(list)
        self.repeats: list[bool] = []  # whether an item has a shingle more than once
        for item, text in items:
            hashes = item_words(hasher, text)
            if not len(hashes):
                continue
            run = shingle_run(hashes, words)
            place = len(self.items)
            self.items[place] = (item, fingerprint(run), Counter(run.tolist()))
            self.repeats.append(len(self.items[place][2]) < len(run))
            by_length[len(hashes)].append(place)
            shingles_by_size[min(words, len(hashes))].update(run.tolist())
            for block, value in self._near(fingerprint(run)):
                self.tables[len(hashes)][block, value].append(place)
        self.tables = {n: dict(t) for n, t in self.tables.items()}
        self.holders = {n: (self._holders(places), self._holders([p for p in places if self.repeats[p]])) for n, places in by_length.items()}
        self.gates = {}
        for size, found in shingles_by_size.items():
            values = np.array(sorted(found), dtype=np.uint64)
            gate = np.zeros(1 << GATE, dtype=bool)
            gate[(values >> np.uint64(64 - GATE)).astype(np.int64)] = True
            self.gates[size] = (gate, values)

    @staticmethod
    def _blocks(value: int) -> list[int]:
        width = BITS // BLOCKS
        return [value >> (width * b) & ((1 << width) - 1) for b in range(BLOCKS)]

    def _near(self, value: int) -> Iterator[tuple[int, int]]:
        """Every block value within radius // BLOCKS bits."""
        width = BITS // BLOCKS
        masks = [sum(1 << b for b in flips) for k in range(RADIUS // BLOCKS + 1) for flips in combinations(range(width), k)]
        for block, part in enumerate(self._blocks(value)):
            for mask in masks:
                yield block, part ^ mask

    def _holders(self, places: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Shingles in order, and beside each an item that holds it."""
        sizes = [len(self.items[p][2]) for p in places]
        shingles = np.fromiter((s for p in places for s in self.items[p][2]), dtype=np.uint64, count=sum(sizes))
        order = np.argsort(shingles, kind="stable")
        return shingles[order], np.repeat(np.array(places, dtype=np.int64), sizes)[order]

    @staticmethod
    def _sharing(part: np.ndarray, need: int, holders: tuple[np.ndarray, np.ndarray]) -> set[int]:
        """The items that may share ``need`` of the window's shingles: they hold one of any len(part) - need + 1 of these."""
        shingles, places = holders
        if not len(shingles):
            return set()
        low, high = np.searchsorted(shingles, part), np.searchsorted(shingles, part, "right")
        rarest = np.argsort(high - low, kind="stable")[: len(part) - need + 1]
        return {p for at in rarest.tolist() for p in places[low[at] : high[at]].tolist()}

    def _known(self, run: np.ndarray, size: int) -> np.ndarray:
        """Which shingles of a run some item holds."""
        gate, values = self.gates[size]
        known = gate[(run >> np.uint64(64 - GATE)).astype(np.int64)]
        at = np.flatnonzero(known)
        place = np.minimum(np.searchsorted(values, run[at]), len(values) - 1)
        known[at] = values[place] == run[at]
        return known

    def matches(self, hashes: np.ndarray) -> dict[int, float]:
        """Item to best similarity, for the items some window of the text resembles enough."""
        found: dict[int, float] = {}
        for size in self.gates:
            if len(hashes) < size:
                continue
            run = windows(hashes, size, 101 + size)
            known = self._known(run, size)
            if not known.any():
                continue
            below = np.concatenate([[0], np.cumsum(known)])
            order = np.argsort(run, kind="stable")
            same = run[order[1:]] == run[order[:-1]]
            before = np.full(len(run), -1)
            before[order[1:][same]] = order[:-1][same]
            before = np.maximum.accumulate(before)  # a window that ends here and starts there or earlier repeats a shingle
            for n, table in self.tables.items():
                if min(self.words, n) != size or n > len(hashes):
                    continue
                span = n - size + 1  # shingles of a window of n words
                need = math.ceil(2 * self.least / (1 + self.least) * span - 1e-9)
                last = run[:0]
                for start in np.flatnonzero(below[span:] - below[:-span] >= need).tolist():
                    part = run[start : start + span]
                    repeated = before[start + span - 1] >= start
                    if repeated and np.array_equal(part, last):
                        continue  # a run of one word
                    mark, last, weights = fingerprint(part), part, None
                    near = {place for key in enumerate(self._blocks(mark)) for place in table.get(key, ())}
                    near = {place for place in near if (mark ^ self.items[place][1]).bit_count() <= RADIUS}
                    every, repeating = self.holders[n]
                    near |= self._sharing(part, need, every if repeated else repeating)
                    for place in near:
                        item, _, bag = self.items[place]
                        weights = weights or Counter(part.tolist())
                        score = similarity(weights, bag)
                        if score >= self.least - 1e-12:
                            found[item] = max(score, found.get(item, 0.0))
        return found


def item_blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks of at most ITEM_BLOCK items and, but for a longer item, ITEM_CHARS characters; one block at least."""
    block, chars, given = [], 0, False
    for row in items.toLocalIterator():
        size = len(row["text"] or "")
        if block and (len(block) == ITEM_BLOCK or chars + size > ITEM_CHARS):
            yield block
            block, chars, given = [], 0, True
        block.append((row["item"], row["text"]))
        chars += size
    if block or not given:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", words: int = 5, least: float = 0.8, carry: bool = False) -> DataFrame:
    """One row per document: key, contaminated, items (sorted ids of the items it holds) and best similarity.

    A document holds an item if a window of as many words as the item has a weighted similarity of ``least`` or more on shingles
    of ``words`` lower-cased words (runs of letters, digits and non-ASCII characters). Defined cases: items without words match nothing; items shorter than a shingle are one
    shingle; null or empty documents hold nothing; a null item id matches but is not listed; repeated rows get equal results.

    ``carry`` adds the document's own columns as one struct ``row``, so that a filter needs no join.

    The benchmark is the stated query set. It is broadcast in blocks of ITEM_BLOCK items or ITEM_CHARS characters, read one at a time; a larger one costs one scan per block.
    """
    source = picked(docs, doc_id=key, text=text)
    kind = dict(source.dtypes)["doc_id"]
    parts = []
    for block in item_blocks(picked(benchmark, item=item, text=item_text)):
        shared = source.sparkSession.sparkContext.broadcast(block)
        step, kinds = _matcher(shared, words, least), f"doc_id {kind}, mark string, items array<bigint>, hit boolean, best double"
        with_row = carry and not parts
        parts.append(arrow_map(*carried(docs, key, text, source.columns, {}, step, kinds)) if with_row else arrow_map(source, step, kinds))
    if len(parts) == 1:
        held = parts[0]
    else:  # what a document holds depends on its text only, so the blocks meet by its digest
        hits = [p.where("hit").select("mark", "items", "best").dropDuplicates(["mark"]) for p in parts[1:]]
        rest = hits[0]
        for p in hits[1:]:
            rest = rest.unionByName(p)
        rest = rest.groupBy("mark").agg(F.flatten(F.collect_list("items")).alias("more"), F.max("best").alias("high"))
        held = parts[0].join(rest, "mark", "left").select(
            "doc_id", F.concat("items", F.coalesce("more", F.array().cast("array<bigint>"))).alias("items"),
            (F.col("hit") | F.col("high").isNotNull()).alias("hit"), F.greatest("best", F.coalesce("high", F.lit(0.0))).alias("best"), *(["row"] if carry else []),
        )
    return held.select(F.col("doc_id").alias(key), F.col("hit").alias("contaminated"), F.array_sort(F.array_distinct("items")).alias("items"), "best", *(["row"] if carry else []))


def _matcher(shared, words: int, least: float):
    made: list[ItemIndex] = []

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        if not made:
            made.append(ItemIndex(shared.value, words, least))
        hasher = WordHasher(BREAKS)
        texts = batch.column("text").to_pylist()
        found = [made[0].matches(item_words(hasher, t)) if t else {} for t in texts]
        yield {
            "doc_id": batch.column("doc_id"),
            "mark": [blake2b(t.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest() if t else None for t in texts],
            "items": list_array([np.array([i for i in f if i is not None], dtype=np.int64) for f in found], pa.int64()),
            "hit": [bool(f) for f in found],
            "best": [max(f.values(), default=0.0) for f in found],
        }

    return step
