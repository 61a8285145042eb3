"""Periodic runs of words, found in a Re-Pair grammar of each text.

Re-Pair replaces the most frequent pairs of neighbouring symbols by new symbols until no pair repeats; here every pair
whose count lies in the upper half of its text's counts goes in the same sweep, the more frequent one first where two overlap. What is
left is halved into a balanced tree. A run lies wholly inside the lowest nonterminal that holds both its ends, and there crosses
the boundary of the two halves. So the runs that cross a nonterminal's boundary are computed once for each nonterminal, at the place where
it first occurs, and then moved to all places where it is derived. A nonterminal may cut a run off at its ends; of overlapping
intervals of one period the merged, maximal one is the run.

At least four periods make a run, so one side of the boundary holds two of them. That leaves a quarter of a nonterminal's
length as possible periods, and of these few pass a look at single words. Extents are measured with prefix hashes by
halving; every run that results is then compared word by word, and a text group whose hashes misled is computed again with others.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tabeval.llm.frames import arrow_map, picked

LEAST_LENGTH, LEAST_PERIODS = 6, 4  # a run has at least max(6, 4 * period) words
GROUP_WORDS = 200_000  # texts handled together hold about so many words; a longer text is handled alone
CANDIDATES = 2_000_000  # pairs of nonterminal and period looked at together
PRIMES = (np.uint64(2147483647), np.uint64(2147483629))


def looped_tail(key, n: int) -> np.ndarray:
    """Which original word stands at each of n places: one key in ten repeats a stretch of its text to the end."""
    places = np.arange(n)
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    if h % 10 or not n:
        return places
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.where(places < a, places, a + (places - a) % p)


# ---- the grammar -------------------------------------------------------------------------------------


def nonterminals(symbols: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, ...]:
    """The grammar of several texts: for each derived place its rule, start, boundary and end, counted in words.

    ``symbols`` are numbers below 2^32, different in different texts; ``text`` is the number of the text of each word, in order.
    A rule made by a replacement has two places at least, a rule of the balanced tree one.
    """
    sym = symbols.astype(np.uint64)
    start, width = np.arange(len(sym)), np.ones(len(sym), dtype=np.int64)
    alive = np.ones(len(sym), dtype=bool)  # whether the pair that starts here may repeat
    fresh, rules = int(sym.max()) + 1 if len(sym) else 0, 0
    made: list[tuple[np.ndarray, ...]] = []
    while True:
        at = np.flatnonzero(alive[:-1] & (text[:-1] == text[1:]))
        if not len(at):
            break
        key = (sym[at] << np.uint64(32)) | sym[at + 1]
        # of overlapping places of one pair every second counts
        follows = np.flatnonzero((at[1:] == at[:-1] + 1) & (key[1:] == key[:-1])) + 1
        if len(follows):
            head = np.ones(len(at), dtype=bool)
            head[follows] = False
            begin = np.flatnonzero(head)
            odd = (np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))) % 2 == 1
            at, key = at[~odd], key[~odd]
        order = np.argsort(key)
        sorted_key = key[order]
        edge = np.flatnonzero(np.append(True, sorted_key[1:] != sorted_key[:-1]))
        sizes = np.diff(np.append(edge, len(key)))
        times = np.empty(len(key), dtype=np.int64)
        times[order] = np.repeat(sizes, sizes)
        alive[at[times < 2]] = False  # a pair that does not repeat never will
        keep = times >= 2
        at, key, times = at[keep], key[keep], times[keep]
        if not len(at):
            break
        most = np.zeros(int(text[-1]) + 1, dtype=np.int64)
        np.maximum.at(most, text[at], times)
        upper = 2 * times >= most[text[at]]
        at, key, times = at[upper], key[upper], times[upper]
        # neighbouring places: the more frequent pair, then the larger key, wins
        touch = at[1:] == at[:-1] + 1
        first = (times[:-1] > times[1:]) | ((times[:-1] == times[1:]) & (key[:-1] > key[1:]))
        wins = np.ones(len(at), dtype=bool)
        wins[1:] &= ~(touch & first)
        wins[:-1] &= ~(touch & ~first)
        at, key = at[wins], key[wins]
        pairs, rule, uses = np.unique(key, return_inverse=True, return_counts=True)
        used = uses[rule] >= 2
        at, rule = at[used], rule[used]
        made.append((rules + rule, start[at], start[at] + width[at], start[at] + width[at] + width[at + 1]))
        sym[at] = (fresh + rule).astype(np.uint64)
        width[at] += width[at + 1]
        alive[at] = True
        before = at[at > 0] - 1
        alive[before] = True
        fresh, rules = fresh + len(pairs), rules + len(pairs)
        left = np.ones(len(sym), dtype=bool)
        left[at + 1] = False
        sym, start, width, alive, text = sym[left], start[left], width[left], alive[left], text[left]
    while len(start):  # the rest as a balanced tree: neighbours in twos, level by level
        edge = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
        sizes = np.diff(np.append(edge, len(text)))
        place = np.arange(len(text)) - np.repeat(edge, sizes)
        at = np.flatnonzero((place % 2 == 0) & (place + 1 < np.repeat(sizes, sizes)))
        if not len(at):
            break
        made.append((rules + np.arange(len(at)), start[at], start[at] + width[at], start[at] + width[at] + width[at + 1]))
        rules += len(at)
        width[at] += width[at + 1]
        left = np.ones(len(text), dtype=bool)
        left[at + 1] = False
        start, width, text = start[left], width[left], text[left]
    if not made:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    return tuple(np.concatenate(part) for part in zip(*made))


# ---- equal stretches ---------------------------------------------------------------------------------


class Prefixes:
    """Hashes of all stretches of a sequence, modulo two primes."""

    def __init__(self, symbols: np.ndarray, seed: int):
        draw = np.random.default_rng(seed)
        top = int(symbols.max()) + 1 if len(symbols) else 1
        self.parts = []
        for prime in PRIMES:
            values = draw.integers(1, int(prime), top, dtype=np.uint64)[symbols]
            powers = np.ones(len(symbols) + 1, dtype=np.uint64)
            powers[1:2] = draw.integers(2, int(prime), dtype=np.uint64)
            done = 2
            while done < len(powers):  # doubled: base^(i + j) = base^i * base^j
                step = powers[done - 1] * powers[1] % prime
                more = min(done, len(powers) - done)
                powers[done : done + more] = powers[:more] * step % prime
                done += more
            sums = np.zeros(len(symbols) + 1, dtype=np.uint64)
            np.cumsum(values * powers[:-1] % prime, out=sums[1:])  # below 2^31 each: no overflow up to 2^33 words
            self.parts.append((prime, powers, sums % prime))

    def same(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the stretches of ``length`` from a and from b (a <= b) hash equally."""
        out = np.ones(len(a), dtype=bool)
        for prime, powers, sums in self.parts:
            left = (sums[a + length] + prime - sums[a]) % prime * powers[b - a] % prime
            out &= left == (sums[b + length] + prime - sums[b]) % prime
        return out

    def reach(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool = False) -> np.ndarray:
        """How far, up to ``most``, the sequence goes on equally from a and from b, or back from before them."""
        low, high = np.zeros(len(a), dtype=np.int64), most.astype(np.int64)
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            middle = (low[open_] + high[open_] + 1) // 2
            shift = middle if back else 0
            equal = self.same(a[open_] - shift, b[open_] - shift, middle)
            low[open_[equal]] = middle[equal]
            high[open_[~equal]] = middle[~equal] - 1


# ---- runs --------------------------------------------------------------------------------------------


def crossing(symbols: np.ndarray, prefixes: Prefixes, start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """(nonterminal, start, end, period) of the runs across the boundary, each with its smallest period."""
    found: list[tuple[np.ndarray, ...]] = []
    for node, q in _periods((end - start) // LEAST_PERIODS):
        s, m, e = start[node], middle[node], end[node]
        for right in (False, True):
            fits = np.flatnonzero((e - m >= 2 * q) if right else (m - s >= 2 * q))
            a = m[fits] if right else m[fits] - 2 * q[fits]
            for look in (lambda q: q - 1, lambda q: q * 0, lambda q: q // 2):  # single words before hashes
                near = look(q[fits])
                hit = symbols[a + near] == symbols[a + near + q[fits]]
                fits, a = fits[hit], a[hit]
            step = q[fits]
            hit = prefixes.same(a, a + step, step)
            fits, a, step = fits[hit], a[hit], step[hit]
            if not len(fits):
                continue
            to = a + step + prefixes.reach(a, a + step, e[fits] - a - step)
            since = a - prefixes.reach(a, a + step, a - s[fits], back=True)
            whole = (to - since >= np.maximum(LEAST_LENGTH, LEAST_PERIODS * step)) & (since < m[fits]) & (to > m[fits])
            found.append((node[fits][whole], since[whole], to[whole], step[whole]))
    if not found:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    node, since, to, q = (np.concatenate(part) for part in zip(*found))
    order = np.lexsort((q, to, since, node))
    node, since, to, q = node[order], since[order], to[order], q[order]
    # a multiple of the smallest period has the same extent
    new = np.append(True, (node[1:] != node[:-1]) | (since[1:] != since[:-1]) | (to[1:] != to[:-1]))[: len(node)]
    return node[new], since[new], to[new], q[new]


def _periods(most: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of nonterminal and period, a bounded number at a time."""
    ends = np.cumsum(most)
    for low in range(0, int(ends[-1]) if len(ends) else 0, CANDIDATES):
        flat = np.arange(low, min(low + CANDIDATES, int(ends[-1])))
        node = np.searchsorted(ends, flat, side="right")
        yield node, flat - (ends[node] - most[node]) + 1


def merged(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """Intervals of one period that share at least a period are parts of one run."""
    if not len(start):
        return start, end, period
    order = np.lexsort((start, period))
    start, end, period = start[order], end[order], period[order]
    shift = np.cumsum(np.append(0, period[1:] != period[:-1])) * (int(end.max()) + 1)
    so_far = np.maximum.accumulate(end + shift) - shift
    new = np.ones(len(start), dtype=bool)
    new[1:] = (period[1:] != period[:-1]) | (so_far[:-1] - start[1:] < period[1:])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    start, end, period = start[first], so_far[last], period[first]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def periodic_runs(symbols: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, ...]:
    """(start, end, period) of all runs of several texts laid end to end, by start, then period."""
    rule, start, middle, end = nonterminals(symbols, text)
    long_enough = end - start >= LEAST_LENGTH
    rule, start, middle, end = rule[long_enough], start[long_enough], middle[long_enough], end[long_enough]
    _, first, number = np.unique(rule, return_index=True, return_inverse=True)
    for seed in count():
        node, since, to, q = crossing(symbols, Prefixes(symbols, seed), start[first], middle[first], end[first])
        # to every place where the nonterminal is derived
        order = np.argsort(number, kind="stable")
        places = np.bincount(number, minlength=len(first))
        offset = np.cumsum(places) - places
        each = places[node]
        nth = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
        moved = start[order[np.repeat(offset[node], each) + nth]] - np.repeat(start[first][node], each)
        s, e, p = merged(np.repeat(since, each) + moved, np.repeat(to, each) + moved, np.repeat(q, each))
        if _exact(symbols, s, e, p):
            return s, e, p


def _exact(symbols: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> bool:
    """Whether the words of every interval repeat with its period."""
    return all(np.array_equal(symbols[s : e - p], symbols[s + p : e]) for s, e, p in zip(start.tolist(), end.tolist(), period.tolist()))


# ---- the operator ------------------------------------------------------------------------------------


def _grouped(sizes: list[int]) -> Iterator[range]:
    low, words = 0, 0
    for i, n in enumerate(sizes):
        if words and words + n > GROUP_WORDS:
            yield range(low, i)
            low, words = i, 0
        words += n
    if low < len(sizes):
        yield range(low, len(sizes))


def _collapse(keys: list, raws: list, loop_tails: bool) -> dict:
    """Runs and collapsed texts of some texts."""
    lines, ids, texts, used = [], [], [], 0
    for i, (key, raw) in enumerate(zip(keys, raws)):
        words = raw.split()  # of bytes: at space and \x09-\x0D only
        if loop_tails:
            words = [words[j] for j in looped_tail(key, len(words)).tolist()]
        numbers: defaultdict = defaultdict(count(used).__next__)
        ids.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
        used += len(numbers)
        texts.append(np.full(len(words), i))
        lines.append(words)
    symbols = np.concatenate(ids) if ids else np.zeros(0, dtype=np.int64)
    start, end, period = periodic_runs(symbols, np.concatenate(texts) if texts else symbols)
    gone = np.zeros(len(symbols) + 1, dtype=np.int64)
    np.add.at(gone, start + period, 1)
    np.add.at(gone, end, -1)
    kept = np.cumsum(gone)[:-1] == 0
    base = np.cumsum([0] + [len(words) for words in lines])
    cut = np.searchsorted(start, base)
    out: dict = {"n_words": [len(words) for words in lines], "runs": [], "collapsed": []}
    for i, words in enumerate(lines):
        inside = slice(cut[i], cut[i + 1])
        out["runs"].append([{"start": s, "length": n, "period": p} for s, n, p in zip((start[inside] - base[i]).tolist(), (end[inside] - start[inside]).tolist(), period[inside].tolist())])
        mine = kept[base[i] : base[i + 1]]
        out["collapsed"].append(b" ".join(words if mine.all() else [words[j] for j in np.flatnonzero(mine).tolist()]).decode())
    return out


def collapse_runs(docs: DataFrame, doc: str = "doc_id", text: str = "text", loop_tails: bool = False) -> DataFrame:
    """(doc_id, n_words, runs, collapsed), one row per document.

    Words are runs of characters outside space and \\x09-\\x0D. A run is a stretch of words with smallest period q and at
    least max(6, 4 q) words that no neighbouring word extends. ``runs`` has start, length and period, by start, then period;
    ``collapsed`` the words outside all runs or among the first q of each, joined by one space. With ``loop_tails`` one
    document in ten, by the CRC of its key, first repeats a stretch up to its end.

    Defined cases: null and empty texts have no words, no runs and an empty text; repeated rows give a row each; a null key
    repeats no tail; texts of any length are handled whole; an empty table gives no rows. Other columns are not looked at.
    """
    rows = picked(docs, doc_id=doc, text=text)
    kind = dict(rows.dtypes)["doc_id"]

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        keys = batch.column("doc_id")
        raws = batch.column("text").cast(pa.binary())
        sizes = [n or 0 for n in pc.divide(pc.binary_length(raws), 5).to_pylist()]
        for part in _grouped(sizes):
            some = keys.slice(part.start, len(part))
            yield {"doc_id": some} | _collapse(some.to_pylist(), [raws[i].as_py() or b"" for i in part], loop_tails)

    return arrow_map(rows, step, f"doc_id {kind}, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")
