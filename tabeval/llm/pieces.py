"""SentencePiece encoding and decoding as a shortest path through a weighted transducer.

The transducer is the composition of the normaliser (space to the visible space mark, dummy prefix), the pieces (one arc for each piece
that matches at a position) and the byte fallback (arcs for characters that are in no piece). Its states are
positions of the input together with the last piece; weights are added along a path and the least path is taken.

For unigram models an arc costs minus the piece's score. For BPE models a pair of neighbouring pieces costs nothing if merging their joined
text gives just these two pieces, else infinity; this is read off the merge trees of the two, which are compiled once. A segmentation is the one that the merges produce exactly if
all its neighbours agree in this way, so one path of finite weight is left - for every prefix of the input as well. Pieces never span the end of a word, so words are composed one by one and kept for reuse.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabeval.llm.frames import arrow_map, list_array, picked

MARK = "▁"
KEPT_WORDS = 800_000  # words, and pairs of pieces, a worker remembers; then it starts anew
KEPT_CHARS = 40  # longer words are not remembered
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # fixed values of the model format
UNIGRAM, BPE = 1, 2


def read_model(path: str) -> dict:
    """Pieces, scores, kinds and settings of a model file, as plain values that can be broadcast."""
    from sentencepiece import sentencepiece_model_pb2 as format_

    model = format_.ModelProto()
    model.ParseFromString(Path(path).read_bytes())
    rules, trainer = model.normalizer_spec, model.trainer_spec
    if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces or trainer.treat_whitespace_as_suffix:
        raise ValueError("only the identity normaliser with escaped, unreduced white space is compiled")
    if trainer.model_type not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are compiled")
    return {
        "pieces": [p.piece for p in model.pieces], "scores": [p.score for p in model.pieces], "kinds": [p.type for p in model.pieces],
        "bpe": trainer.model_type == BPE, "prefix": rules.add_dummy_prefix, "fallback": trainer.byte_fallback,
    }


class Transducer:
    def __init__(self, model: dict):
        self.model, self.scores = model, model["scores"]
        kinds = model["kinds"]
        self.ids = {p: i for i, p in enumerate(model["pieces"]) if kinds[i] in (NORMAL, USER)}
        self.root: dict = {}  # the pieces as a tree of their characters; "" leads to the id of a piece that ends there
        for piece, i in self.ids.items():
            node = self.root
            for character in piece:
                node = node.setdefault(character, {})
            node[""] = i
        self.longest = max(map(len, self.ids), default=1)
        self.unknown = kinds.index(UNKNOWN) if UNKNOWN in kinds else 0
        self.bytes_ = {int(p[3:5], 16): i for i, p in enumerate(model["pieces"]) if kinds[i] == BYTE}
        self.out = [
            bytes([int(p[3:5], 16)]) if kinds[i] == BYTE else b"" if kinds[i] == CONTROL else b" \xe2\x81\x87 " if kinds[i] == UNKNOWN else p.replace(MARK, " ").encode()
            for i, p in enumerate(model["pieces"])
        ]
        whole = not any(MARK in p.lstrip(MARK) for p in self.ids)
        self.split = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+" if whole else r"(?s).+").findall
        self.agreeing: dict[int, bool] = {}
        self.words = _Words(self)
        self.rank: dict[str, int] = {}  # of every character and every piece that merges make: the place of its merge, characters first
        self.halves: dict[str, tuple[str, str]] = {}  # the two parts of its last merge
        self.loose: set[str] = set()  # pieces whose merges depend on more than ranks
        if model["bpe"]:
            self._grow()

    def _grow(self) -> None:
        """Ranks and halves of the pieces, those of better score first: a piece's halves are the two parts that earlier merges leave of it.

        Pieces of one score are merged by place alone. Where these come last of all, as runs of space marks do, they and the
        pieces that hold one are merged out; any other model with equal scores keeps no ranks, and all its pairs are merged out.
        """
        scores = Counter(self.scores[i] for p, i in self.ids.items() if len(p) > 1)
        tied = [p for p, i in self.ids.items() if len(p) > 1 and scores[self.scores[i]] > 1]
        if tied and {self.scores[self.ids[p]] for p in tied} != {min(scores)}:
            return
        shared = re.compile("|".join(re.escape(p) for p in sorted(tied, key=len)) or r"(?!)").search
        longer = sorted((p for p in self.ids if len(p) > 1), key=lambda p: -self.scores[self.ids[p]])
        self.loose = {p for p in longer if shared(p)}
        rank = self.rank
        rank |= dict.fromkeys(chain.from_iterable(self.ids), 0)
        for place, piece in enumerate((p for p in longer if p not in self.loose), 1):
            for i in range(1, len(piece)):
                left, right = piece[:i], piece[i:]
                if left in rank and right in rank and self.apart(left, right):
                    self.halves[piece] = left, right
                    rank[piece] = place
                    break
        rank |= dict.fromkeys(tied, len(longer) + 1)

    def apart(self, a: str, b: str) -> bool:
        """Whether merges leave two pieces apart that they make, each by itself, of their texts.

        The merges along the border are undone, the latest first. What lies at the border then would have been merged instead if
        its merge comes before the one undone; of equal merges the left one comes first.
        """
        rank, halves = self.rank, self.halves
        limit = len(self.scores) + 2
        rank_a, rank_b = rank[a], rank[b]
        while True:
            joined = rank.get(a + b)
            if joined is not None and joined < limit:
                return False
            if rank_a > rank_b:
                limit = rank_a
                a = halves[a][1]
                rank_a = rank[a]
            elif rank_b:
                limit = rank_b + 1
                b = halves[b][0]
                rank_b = rank[b]
            else:
                return True

    def merged(self, text: str) -> list[str]:
        """What the merges make of a short text: always the best-scored neighbouring pair, the leftmost among equals."""
        parts = list(text)
        while len(parts) > 1:
            best = None
            for i in range(len(parts) - 1):
                found = self.ids.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or self.scores[found] > best[0]):
                    best = (self.scores[found], i)
            if best is None:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def together(self, a: str, b: str) -> bool:
        """Whether the merges make just these two pieces of their joined text; with an empty first one, whether they make the second."""
        rank = self.rank
        if rank and a not in self.loose and b not in self.loose:
            return b in rank and (not a or a in rank and self.apart(a, b))
        return self.merged(a + b) == ([a, b] if a else [b])

    def agree(self, pair: int) -> bool:
        """The same of two ids coded as one number, remembered."""
        if len(self.agreeing) > KEPT_WORDS:
            self.agreeing.clear()
        before, piece = divmod(pair, len(self.scores) + 1)
        pieces = self.model["pieces"]
        known = self.agreeing[pair] = self.together(pieces[before - 1] if before else "", pieces[piece])
        return known

    def fallback(self, character: str) -> list[int]:
        if not self.model["fallback"]:
            return [self.unknown]
        return [self.bytes_[b] for b in character.encode("utf-8", "surrogatepass")]

    def least_path(self, word: str) -> list[int]:
        """Ids along the path of least weight."""
        return self._bpe_path(word) if self.model["bpe"] else self._unigram_path(word)

    def arcs(self, word: str, begin: int) -> list[tuple[int, int]]:
        """(end, id) of the pieces that match at a position, the longest last; one step without a piece over a character in none."""
        node, found, end = self.root, [], begin
        for character in word[begin : begin + self.longest]:
            node = node.get(character)
            if node is None:
                break
            end += 1
            piece = node.get("")
            if piece is not None:
                found.append((end, piece))
        return found if found and found[0][0] == begin + 1 else [(begin + 1, -1)]

    def _bpe_path(self, word: str) -> list[int]:
        """The only path of finite weight, searched depth first.

        Each prefix has one such path, so a position that was left without a way to the end is not entered again.
        """
        arcs, known, wide, n = self.arcs, self.agreeing, len(self.scores) + 1, len(word)
        at, open_, path, stack, dead = 0, arcs(word, 0), [], [], bytearray(n + 1)
        before = -1  # no piece, or a fallback arc, which is a border for all merges
        while at < n:
            while open_:
                end, piece = open_.pop()
                if dead[end]:
                    continue
                if piece >= 0:
                    pair = (before + 1) * wide + piece
                    fits = known.get(pair)
                    if fits is None:
                        fits = self.agree(pair)
                    if not fits:
                        continue
                stack.append((at, open_, before))
                path.append((at, end, piece))
                at, open_, before = end, arcs(word, end), piece
                break
            else:
                dead[at] = 1
                if not stack:  # several pieces of one score: not a matter of neighbours
                    return [i for p in self.merged(word) for i in ([self.ids[p]] if p in self.ids else self.fallback(p))]
                at, open_, before = stack.pop()
                path.pop()
        return [i for at, end, piece in path for i in ((piece,) if piece >= 0 else self.fallback(word[at:end]))]

    def _unigram_path(self, word: str) -> list[int]:
        n = len(word)
        penalty = min((s for s, k in zip(self.scores, self.model["kinds"]) if k == NORMAL), default=0.0) - 10.0  # fixed value
        cost, back = [0.0] + [float("inf")] * n, [0] * (n + 1)
        for begin in range(n):
            single = False
            for end in range(begin + 1, min(n, begin + self.longest) + 1):
                found = self.ids.get(word[begin:end])
                if found is not None:
                    single |= end == begin + 1
                    total = cost[begin] - self.scores[found]
                    if total < cost[end]:
                        cost[end], back[end] = total, begin
            if not single and cost[begin] - penalty < cost[begin + 1]:
                cost[begin + 1], back[begin + 1] = cost[begin] - penalty, begin
        path, at = [], n
        while at:
            piece = word[back[at] : at]
            path.append([self.ids[piece]] if piece in self.ids else self.fallback(piece))
            at = back[at]
        return [i for step in reversed(path) for i in step]

    def normalise(self, text: str) -> str:
        return (MARK if self.model["prefix"] and text else "") + text.replace(" ", MARK)

    def encode(self, text: str) -> list[int]:
        words = self.words
        return list(chain.from_iterable([words[w] for w in self.split(self.normalise(text))]))

    def decode(self, ids) -> str:
        out = self.out
        raw = b"".join([out[i] for i in ids])
        return (raw[1:] if self.model["prefix"] and raw[:1] == b" " else raw).decode("utf-8", "replace")


class _Words(dict):
    """Remembered paths of words."""

    def __init__(self, transducer: Transducer):
        self.transducer = transducer

    def __missing__(self, word: str) -> list[int]:
        path = self.transducer.least_path(word)
        if len(word) <= KEPT_CHARS:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = path
        return path


def machine_of(model: dict) -> Transducer:
    """The compiled model, kept with the broadcast value: the tasks of one worker share it and the words it remembers."""
    if "machine" not in model:
        model["machine"] = Transducer(model)
    return model["machine"]


def encode(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, ids and round_trip (decoding gives the normalised text back).

    Defined cases: null text has null ids and round_trip; an empty text has no ids; the visible space mark in a text is a space,
    as in the format; null keys and repeated rows are encoded like any other; an empty table gives no rows.
    """
    source = picked(docs, doc_id=key, text=text)
    shared = source.sparkSession.sparkContext.broadcast(read_model(model_path))  # bounded: one vocabulary

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        machine = machine_of(shared.value)
        column, keys = batch.column("text").to_pylist(), batch.column("doc_id")
        for at in range(0, len(column), 1000):
            ids, same = [], []
            for text in column[at : at + 1000]:
                if text is None:
                    ids.append(None)
                    same.append(None)
                else:
                    path = machine.encode(text)
                    ids.append(np.array(path, dtype=np.int32))
                    same.append(machine.decode(path) == text.replace(MARK, " "))
            yield {"doc_id": keys.slice(at, 1000), "ids": list_array(ids, pa.int32()), "round_trip": same}

    return arrow_map(source, step, f"doc_id {dict(source.dtypes)['doc_id']}, ids array<int>, round_trip boolean").withColumnRenamed("doc_id", key)


def decode(rows: DataFrame, model_path: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """(key, text) from (key, ids). Null ids give null; byte pieces that are no UTF-8 give replacement characters."""
    source = picked(rows, doc_id=key, ids=ids).select("doc_id", F.col("ids").cast("array<int>").alias("ids"))
    shared = source.sparkSession.sparkContext.broadcast(read_model(model_path))

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        machine = machine_of(shared.value)
        yield {"doc_id": batch.column("doc_id"), "text": [None if x is None else machine.decode([i for i in x if i is not None]) for x in batch.column("ids").to_pylist()]}

    return arrow_map(source, step, f"doc_id {dict(source.dtypes)['doc_id']}, text string").withColumnRenamed("doc_id", key)
