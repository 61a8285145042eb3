"""URL rules in a cascade of Bloom filters.

Level 1 encodes the listed keys, level 2 the keys of the corpus that level 1 takes by mistake, level 3 the listed keys that level 2
takes by mistake, and so on until no mistakes are left. The corpus's complete key universe is known, so membership is exact
for every key it can ask for, without a join: the first level that says no decides.

A key is a domain suffix of the host followed by a prefix of the path, as a rule is written: ``example.com/en/``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabeval.llm.frames import arrow_map, picked, written
from tabeval.llm.words import mix, numbers

FIRST_RATE, LATER_RATE = 0.05, 0.5  # wanted share of mistakes per level
LEAST_BITS = 256
MAX_BYTES = 64 << 20  # of all levels of a cascade; larger lists are looked up by a join instead


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(_url, instr(_url, '://') + 3)"))
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(_url, instr(_url, '://') + 3)"))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def with_keys(pages: DataFrame, lengths: list[int]) -> DataFrame:
    """The keys of each page's host and path, the longest first, and two hashes of each.

    ``lengths``: the path lengths that occur in the rules; no other prefix can match one.
    """
    labels = F.split("host", r"\.")
    suffixes = F.when(F.col("host") != "", F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).otherwise(F.array().cast("array<string>"))
    ends = F.filter(F.array(*[F.lit(n) for n in sorted(lengths, reverse=True)]).cast("array<int>"), lambda n: n <= F.length("path"))
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(ends, lambda n: F.concat(s, F.substring(F.col("path"), F.lit(1), n)))))
    ordered = F.transform(F.array_sort(F.transform(keys, lambda k: F.struct((-F.length(k)).alias("n"), k.alias("key")))), lambda x: x["key"])
    return pages.withColumn("keys", ordered)


def hashes(keys: Column) -> tuple[Column, Column]:
    return F.transform(keys, lambda k: F.xxhash64(k)), F.transform(keys, lambda k: F.xxhash64(k, F.lit("second")))


@dataclass
class Bloom:
    bits: np.ndarray  # packed
    size: int
    probes: int
    level: int

    @classmethod
    def places(cls, h1: np.ndarray, h2: np.ndarray, size: int, probe: int, level: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mix(h1.view(np.uint64) ^ numbers(level, 1)) + np.uint64(probe) * (h2.view(np.uint64) | np.uint64(1))) % np.uint64(size)

    def holds(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        found = np.ones(len(h1), dtype=bool)
        for probe in range(self.probes):
            at = self.places(h1, h2, self.size, probe, self.level)
            found &= (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return found


def member(levels: list[Bloom], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Whether each key is listed: the parity of the first level that says no."""
    listed, open_ = np.zeros(len(h1), dtype=bool), np.arange(len(h1))
    for level in levels:
        said = level.holds(h1[open_], h2[open_])
        listed[open_[~said]] = level.level % 2 == 0
        open_ = open_[said]
    listed[open_] = len(levels) % 2 == 1
    return listed


def _bloom(keys: DataFrame, n: int, rate: float, level: int) -> Bloom:
    """A filter of the (h1, h2) keys. Every batch sends the distinct places it sets; words of 64 bits are merged by key."""
    probes = max(1, round(-math.log2(rate)))
    size = max(LEAST_BITS, 64 * math.ceil(n * probes / math.log(2) / 64))

    def words(batch: pa.RecordBatch) -> Iterator[dict]:
        h1, h2 = batch.column("h1").to_numpy(), batch.column("h2").to_numpy()
        at = np.unique(np.concatenate([Bloom.places(h1, h2, size, p, level) for p in range(probes)]))
        word, first = np.unique(at >> np.uint64(6), return_index=True)
        ones = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first) if len(at) else at
        yield {"word": word.view(np.int64), "ones": ones.view(np.int64)}

    merged = arrow_map(keys.select("h1", "h2"), words, "word bigint, ones bigint").groupBy("word").agg(F.bit_or("ones").alias("ones"))
    bits = np.zeros(size // 64, dtype=np.uint64)
    rows = merged.toPandas()  # bounded: size / 64 words, and the caller has checked the size
    bits[rows["word"].to_numpy(dtype=np.int64)] = rows["ones"].to_numpy(dtype=np.int64).view(np.uint64)
    return Bloom(bits.view(np.uint8), size, probes, level)


def _taken(keys: DataFrame, level: Bloom) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        h1, h2 = batch.column("h1").to_numpy(), batch.column("h2").to_numpy()
        keep = shared.value.holds(h1, h2)
        yield {"h1": h1[keep], "h2": h2[keep]}

    return arrow_map(keys.select("h1", "h2"), step, "h1 bigint, h2 bigint")


def cascade(listed: DataFrame, universe: DataFrame, max_bytes: int = MAX_BYTES) -> list[Bloom] | None:
    """The levels for the (h1, h2) keys ``listed`` over ``universe``; None if they would pass ``max_bytes``."""
    inside, outside = written(listed.distinct(), "listed"), None
    levels: list[Bloom] = []
    while True:
        n, rate = inside.count(), LATER_RATE if levels else FIRST_RATE
        if not n and levels:
            return levels
        if sum(len(level.bits) for level in levels) + n * max(1, round(-math.log2(rate))) / math.log(2) / 8 > max_bytes:
            return None
        levels.append(_bloom(inside, n, rate, len(levels) + 1))
        if outside is None:
            outside = written(universe.join(inside, ["h1", "h2"], "left_anti").distinct(), "universe")
        inside, outside = written(_taken(outside, levels[-1]), "mistakes"), inside


def judge(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", max_bytes: int = MAX_BYTES) -> DataFrame:
    """One row per page: key, host, path, rule (null if none) and verdict.

    ``rules`` has (host, path, verdict), verdict allow or block. A rule fits its host and all subdomains if the path starts with its
    path; the longest wins, an equally long one of a longer host first. A url that fits no rule is in neither cascade, so it is
    allowed. Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``, ``#`` or the end.
    Defined cases: a null url, or one without ``://``, has empty host and path and fits nothing; null keys and repeated rows
    are judged like any other; without rules everything is allowed; an empty table gives no rows.
    """
    source = picked(pages, page_id=key, _url=url)
    placed = source.select("page_id", host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"))
    written_rules = rules.where("host is not null and path is not null").select(F.concat("host", "path").alias("key"), F.length("path").alias("n"), "verdict")
    lengths = [r["n"] for r in written_rules.select("n").distinct().collect()]  # at most as many as a path is long
    keyed = with_keys(placed, lengths)
    universe = placed.select("host", "path").distinct()
    universe = with_keys(universe, lengths).select(F.explode("keys").alias("key")).distinct().select(F.xxhash64("key").alias("h1"), F.xxhash64("key", F.lit("second")).alias("h2"))
    universe = written(universe, "keys")
    sides = {}
    for verdict in ("allow", "block"):
        listed = written_rules.where(F.col("verdict") == verdict).select(F.xxhash64("key").alias("h1"), F.xxhash64("key", F.lit("second")).alias("h2"))
        sides[verdict] = cascade(listed, universe, max_bytes)
    if any(side is None for side in sides.values()):
        return _judged_by_join(keyed, written_rules).select(F.col("page_id").alias(key), "host", "path", "rule", "verdict")
    shared = pages.sparkSession.sparkContext.broadcast(sides)

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        h1, h2, keys = batch.column("h1"), batch.column("h2"), batch.column("keys")
        sizes = np.diff(h1.offsets.to_numpy())
        first, second = h1.flatten().to_numpy(), h2.flatten().to_numpy()
        allow, block = (member(shared.value[v], first, second) for v in ("allow", "block"))
        owners = np.repeat(np.arange(len(sizes)), sizes)
        hit = np.flatnonzero(allow | block)
        rows, at = np.unique(owners[hit], return_index=True)  # the first key is the longest
        rule, verdict = [None] * len(sizes), ["allow"] * len(sizes)
        flat = keys.flatten()
        for row, place in zip(rows.tolist(), hit[at].tolist()):
            rule[row] = flat[place].as_py()
            verdict[row] = "block" if block[place] else "allow"
        yield {c: batch.column(c) for c in ("page_id", "host", "path")} | {"rule": rule, "verdict": verdict}

    h1, h2 = hashes(F.col("keys"))
    kind = dict(source.dtypes)["page_id"]
    out = arrow_map(keyed.select("page_id", "host", "path", "keys", h1.alias("h1"), h2.alias("h2")), step, f"page_id {kind}, host string, path string, rule string, verdict string")
    return out.withColumnRenamed("page_id", key)


def _judged_by_join(keyed: DataFrame, rules: DataFrame) -> DataFrame:
    """The same by a join on keys, for lists that no bounded cascade holds."""
    places = keyed.select("host", "path", "keys").distinct()
    found = places.select("host", "path", F.posexplode("keys").alias("at", "key")).join(rules.select("key", "verdict"), "key")
    best = found.groupBy("host", "path").agg(F.min(F.struct("at", F.when(F.col("verdict") == "block", 0).otherwise(1).alias("o"), F.col("key").alias("rule"), "verdict")).alias("b"))
    return keyed.join(best, ["host", "path"], "left").select("page_id", "host", "path", "b.rule", F.coalesce("b.verdict", F.lit("allow")).alias("verdict"))
