"""Words and word windows of a text as 64-bit hashes, computed with numpy.

A word is a run of characters outside space and \\x09-\\x0D. Its hash is the sum of a random number per byte times
a power per place, mixed; windows and shingles combine word hashes in the same way. Two different words or windows
agree with a probability of about 2^-64. Long texts are hashed in pieces, so the memory is a few times
the text.
"""

from __future__ import annotations

import numpy as np

PIECE = 1 << 20  # bytes hashed at a time
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))  # A-Z only; other bytes of UTF-8 stay
SPACE = (32, 9, 10, 11, 12, 13)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def numbers(seed: int, n: int) -> np.ndarray:
    """n odd pseudo-random 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


class WordHasher:
    """Hashes and byte spans of the words of UTF-8 texts. ``breaks``: bytes that end a word."""

    def __init__(self, breaks: tuple[int, ...] = SPACE, seed: int = 7):
        self.table = numbers(seed, 256)
        self.inside = np.ones(256, dtype=bool)
        self.inside[list(breaks)] = False
        self.base = np.uint64(int(numbers(seed + 1, 1)[0]))
        self.powers = np.ones(1, dtype=np.uint64)

    def _powers(self, n: int) -> np.ndarray:
        while len(self.powers) < n:
            step = self.powers[-1] * self.base
            self.powers = np.concatenate([self.powers, self.powers * step])
        return self.powers

    def _piece(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        inside = self.inside[data]
        edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
        starts, ends = edge[::2], edge[1::2]
        if not len(starts):
            return starts, ends, np.zeros(0, dtype=np.uint64)
        lengths = ends - starts
        flat = data[inside]
        first = np.cumsum(lengths) - lengths
        place = np.arange(len(flat)) - np.repeat(first, lengths)
        with np.errstate(over="ignore"):
            terms = self.table[flat] * self._powers(int(lengths.max()))[place]
            return starts, ends, mix(np.add.reduceat(terms, first) + lengths.astype(np.uint64))

    def words(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end byte and hash of every word."""
        data = np.frombuffer(raw, dtype=np.uint8)
        parts, at = [], 0
        while at < len(data):
            end = min(len(data), at + PIECE)
            while end < len(data) and self.inside[data[end - 1]] and self.inside[data[end]]:
                step = data[end : end + PIECE]
                stop = np.flatnonzero(~self.inside[step])
                end += int(stop[0]) if len(stop) else len(step)
            starts, ends, hashes = self._piece(data[at:end])
            parts.append((starts + at, ends + at, hashes))
            at = end
        if not parts:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        return tuple(np.concatenate(p) for p in zip(*parts))

    def hashes(self, raw: bytes) -> np.ndarray:
        return self.words(raw)[2]


def windows(hashes: np.ndarray, size: int, seed: int = 101) -> np.ndarray:
    """The hash of every run of ``size`` consecutive words, by start."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j, factor in enumerate(numbers(seed, size)):
            out += hashes[j : j + n] * factor
        return mix(out)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """The sorted distinct hashes of all runs of ``size`` words; with fewer words the whole sequence is the only one."""
    if not len(hashes):
        return np.zeros(0, dtype=np.uint64)
    return np.unique(windows(hashes, min(size, len(hashes)), 101 + min(size, len(hashes))))
