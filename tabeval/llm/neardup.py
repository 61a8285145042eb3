"""MinHash near-duplicate detection with tensored banding.

A table key of 2r minhashes is a pair of two shorter keys, one from each of two collections of m keys of r minhashes.
So m * m tables cost only 2 * m * r minhashes instead of m * m * 2 * r. Documents that share a table key are
candidates; every link is confirmed on the full shingle sets.

The work is linear in hot groups: documents with equal sets are one node, and the members of a table entry are compared
with its smallest node. Candidates that are connected through table entries but not through confirmed links are then
compared exactly in indexed blocks, which emit links only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabeval.llm.frames import arrow_map, list_array, partitions, picked, written
from tabeval.llm.graph import components
from tabeval.llm.words import LOWER, WordHasher, mix, numbers, shingles

HALF_KEYS = 10  # m: keys in each of the two collections, so m * m tables
HALF_ROWS = 3  # r: minhashes in each half key
BLOCK_SHINGLES = 200_000  # shingles indexed in one block
SALT_ROWS = 2_000  # members compared with one copy of their hub's set


def lowered_words(hasher: WordHasher, text: str) -> np.ndarray:
    return hasher.hashes(text.encode("utf-8", "surrogatepass").translate(LOWER))


class Signer:
    """Minhashes of a set of 64-bit numbers, gathered into two collections of half keys."""

    def __init__(self, half_keys: int, half_rows: int, seed: int = 11):
        n = 2 * half_keys * half_rows
        self.factors, self.shifts = numbers(seed, n), numbers(seed + 1, n)
        self.shape = (2, half_keys, half_rows)

    def half_keys(self, values: np.ndarray) -> np.ndarray:
        least = np.empty(len(self.factors), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for k, (a, b) in enumerate(zip(self.factors, self.shifts)):
                x = values * a
                x ^= x >> np.uint64(29)
                x *= b
                least[k] = x.min()
            groups = least.reshape(self.shape)
            out = np.zeros(groups.shape[:2], dtype=np.uint64)
            for j, factor in enumerate(numbers(5, groups.shape[2])):
                out += groups[:, :, j] * factor
            return mix(out + np.arange(out.size, dtype=np.uint64).reshape(out.shape))


def signatures(docs: DataFrame, words: int, half_keys: int, half_rows: int) -> DataFrame:
    """(doc_id, n_shingles, digest of the shingle set, half keys a and b); digest and keys are null for empty sets."""

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        hasher, signer = WordHasher(), Signer(half_keys, half_rows)
        counts, digests, a, b = [], [], [], []
        for text in batch.column("text"):
            text = text.as_py()
            found = shingles(lowered_words(hasher, text), words) if text else ()
            counts.append(len(found))
            if len(found):
                keys = signer.half_keys(found).view(np.int64)
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                a.append(keys[0])
                b.append(keys[1])
            else:
                digests.append(None)
                a.append(None)
                b.append(None)
        yield {"doc_id": batch.column("doc_id"), "n_shingles": counts, "digest": digests, "a": list_array(a, pa.int64()), "b": list_array(b, pa.int64())}

    return arrow_map(docs, step, f"doc_id {dict(docs.dtypes)['doc_id']}, n_shingles bigint, digest binary, a array<bigint>, b array<bigint>")


def table_keys(nodes: DataFrame) -> DataFrame:
    """(key, node): every pair of half keys, one from each collection, is a key of its own table."""
    pairs = F.flatten(F.transform("a", lambda x: F.transform("b", lambda y: F.xxhash64(x, y))))
    return nodes.select(F.explode(pairs).alias("key"), "node")


def confirmed(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Of (hub, node) pairs, those whose shingle sets are similar enough. ``docs`` has node and text.

    A hub's members are dealt out with copies of the hub, at most about SALT_ROWS members to a copy, and
    compared in a stream; a task holds one hub's set and one member's at a time.
    """
    sizes = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / SALT_ROWS).cast("int").alias("copies"))
    copies = sizes.select(F.col("hub").alias("node"), "hub", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("salt"), F.lit(0).alias("place"))
    members = pairs.join(sizes, "hub").select("node", "hub", F.pmod(F.xxhash64("node"), F.col("copies")).cast("int").alias("salt"), F.lit(1).alias("place"))
    wanted = copies.unionByName(members)
    dealt = docs.join(wanted, "node").repartition(partitions(docs.sparkSession), "hub", "salt").sortWithinPartitions("hub", "salt", "place", "node")
    schema = pa.schema([("hub", pa.int64()), ("node", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held, mine = WordHasher(), None, None
        for batch in batches:
            hubs, nodes = [], []
            for hub, salt, place, node, text in zip(*(batch.column(c).to_pylist() for c in ("hub", "salt", "place", "node", "text"))):
                found = shingles(lowered_words(hasher, text), words)
                if place == 0:
                    held, mine = (hub, salt), found
                elif held == (hub, salt):
                    both = len(np.intersect1d(mine, found, assume_unique=True))
                    if 100 * both >= percent * (len(mine) + len(found) - both):
                        hubs.append(hub)
                        nodes.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(hubs, pa.int64()), pa.array(nodes, pa.int64())], schema=schema)

    return dealt.mapInArrow(run, "hub bigint, node bigint")


def links_across(groups: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """All similar (hub, node) pairs with different labels inside each group of ``groups`` (node, n, label, family).

    Only families with several labels are looked at. A family is cut into blocks of about BLOCK_SHINGLES; every
    member lies in one block, and the members outside the family's commonest label are also sent to every block as
    probes. A task indexes one block by shingle and counts each probe's overlap with all its members at once, so
    no pair of documents becomes a row unless it is a link. ``docs`` has node and text.
    """
    sizes = groups.groupBy("family", "label").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n"))
    families = sizes.groupBy("family").agg(
        F.max_by("label", F.struct("rows", "label")).alias("main"), F.count(F.lit(1)).alias("labels"),
        F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("blocks"),
    ).where("labels > 1").drop("labels")
    dealt = groups.join(families, "family")
    members = dealt.select("node", "label", "family", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"), F.lit(0).alias("place"))
    probes = dealt.where("label != main").select("node", "label", "family", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("place"))
    rows = docs.join(members.unionByName(probes), "node").repartition(partitions(docs.sparkSession), "family", "block").sortWithinPartitions("family", "block", "place", "node")
    schema = pa.schema([("hub", pa.int64()), ("node", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held, sets, index = WordHasher(), None, [], None
        for batch in batches:
            hubs, nodes = [], []
            for family, block, place, node, label, text in zip(*(batch.column(c).to_pylist() for c in ("family", "block", "place", "node", "label", "text"))):
                if held != (family, block):
                    held, sets, index = (family, block), [], None
                found = shingles(lowered_words(hasher, text), words)
                if place == 0:
                    sets.append((node, label, found))
                    continue
                if not sets:  # no member was dealt to this block
                    continue
                index = index or BlockIndex(sets)
                for other in index.similar(found, label, percent):
                    hubs.append(min(node, other))
                    nodes.append(max(node, other))
            yield pa.RecordBatch.from_arrays([pa.array(hubs, pa.int64()), pa.array(nodes, pa.int64())], schema=schema)

    return rows.mapInArrow(run, "hub bigint, node bigint").distinct()


class BlockIndex:
    """Shingle sets of a block, sorted by shingle, to count a set's overlap with all of them at once."""

    def __init__(self, sets: list[tuple[int, int, np.ndarray]]):
        self.nodes = np.array([s[0] for s in sets])
        self.labels = np.array([s[1] for s in sets])
        self.sizes = np.array([len(s[2]) for s in sets])
        values, owners = np.concatenate([s[2] for s in sets]), np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(values, kind="stable")
        self.owners = owners[order]
        self.values, first = np.unique(values[order], return_index=True)
        self.bounds = np.append(first, len(values))

    def similar(self, found: np.ndarray, label: int, percent: int) -> list[int]:
        at = np.searchsorted(self.values, found)
        hit = at[(at < len(self.values)) & (self.values[np.minimum(at, len(self.values) - 1)] == found)]
        low, counts = self.bounds[hit], self.bounds[hit + 1] - self.bounds[hit]
        places = np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        both = np.bincount(self.owners[places], minlength=len(self.nodes))
        near = (100 * both >= percent * (self.sizes + len(found) - both)) & (self.labels != label)
        return self.nodes[near].tolist()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80, half_keys: int = HALF_KEYS, half_rows: int = HALF_ROWS) -> DataFrame:
    """One row per document: key, n_shingles, component_id (smallest key reachable over links) and kept.

    Documents are linked when 100 * |A and B| >= percent * |A or B| for their sets of ``words``-word shingles; with fewer
    words the whole sequence is the one shingle. Defined cases: a null text or one without words has an empty set and
    links with nothing; a null key gets a null component and stays; repeated rows each get the same result; equal
    sets are always linked, whatever their number; an empty table gives no rows.
    A pair exactly at 0.8 is missed with probability 0.003 (m = 10, r = 3), one at 0.9 with 10^-5.
    """
    source = picked(docs, doc_id=key, text=text)
    signed = written(signatures(source, words, half_keys, half_rows), "signatures")
    nodes = signed.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull()).groupBy("digest").agg(
        F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("a").alias("a"), F.first("b").alias("b")
    )
    nodes = written(nodes.select("digest", "node", "n", "a", "b"), "nodes")
    texts = source.select(F.col("doc_id").alias("node"), "text").join(nodes.select("node"), "node", "left_semi")

    keys = table_keys(nodes)
    hubs = keys.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    stars = written(keys.join(hubs, "key").where("node != hub").select("hub", "node").distinct(), "stars")
    links = written(confirmed(stars, texts, words, percent), "links")
    labels = components(links)

    # candidates of one family that the stars have left apart are compared exactly, block by block
    families = components(stars).withColumnRenamed("label", "family")
    groups = families.join(nodes.select("node", "n"), "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    more = written(links_across(groups, texts, words, percent), "across")
    if not more.isEmpty():
        labels = components(links.unionByName(more))

    found = nodes.join(labels, "node", "left").select("digest", F.coalesce("label", "node").alias("label"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id"))
    return signed.join(found, "digest", "left").select(
        F.col("doc_id").alias(key), "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
