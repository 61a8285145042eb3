"""Language identification with a string kernel.

The kernel of two texts is the number of n-grams (blended spectrum of orders 1 to 3, presence only) that both hold, divided by the
geometric mean of their numbers. Nystroem landmarks turn it into features, on which one-versus-rest kernel ridge
regression is fitted. Scoring is a product of batches: presence matrix times landmark matrix gives the kernel, times
the coefficients gives the decision values.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabeval.llm.frames import arrow_map, carried, picked

ORDERS = (1, 2, 3)
SAMPLE_PER_LANGUAGE = 300  # labelled documents the fit may see, a bounded sample
SAMPLE_CHARS = 20_000  # of a document the fit may see, from its first letter on
SAMPLE_TOTAL = 100_000_000  # characters the fit may see; with many languages the excerpts are shorter
LANDMARKS_PER_LANGUAGE = 32
MAX_LANGUAGES = 100  # the commonest ones are learned
RIDGE = 1e-3
SHARPNESS = 4.0  # of the probabilities made from decision values
BLOCK = 64  # documents scored in one product


MARK, LETTER = 1, 2


def letter_table() -> np.ndarray:
    """Of every code point whether it is a letter or a mark; all others end a word."""
    kinds = np.zeros(0x110000, dtype=np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))[0]
        if kind in "LM":
            kinds[code] = LETTER if kind == "L" else MARK
    return kinds


def ngrams(text: str, letters: np.ndarray) -> tuple[np.ndarray, bool]:
    """The distinct n-grams with a letter of a text in lower case, words set off by single spaces, and whether there is a letter.

    An n-gram of up to three code points of 21 bits is one 64-bit number, so no two are confused.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kinds = letters[np.minimum(codes, 0x10FFFF)]
    if not (kinds == LETTER).any():  # marks alone, as those behind a symbol, are no text
        return np.zeros(0, dtype=np.int64), False
    inside = kinds > 0
    codes = np.where(inside, codes, np.uint32(32))
    codes = codes[inside | np.concatenate([[False], inside[:-1]])].astype(np.int64)
    codes = np.concatenate([[32], codes, [32]]) if inside[-1] else np.concatenate([[32], codes])
    grams, value = [], np.zeros(len(codes), dtype=np.int64)
    for order in range(1, max(ORDERS) + 1):
        value = (value[: len(codes) - order + 1] << 21) + codes[order - 1 :]
        if order in ORDERS and len(value):
            found = np.unique(value)
            grams.append(found[found != 32])  # a space alone says nothing, and every text has it
    return np.concatenate(grams), True  # orders differ in size, so they cannot clash


def gather(grams: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Places in the vocabulary of the n-grams that are in it."""
    at = np.minimum(np.searchsorted(vocabulary, grams), len(vocabulary) - 1)
    return at[vocabulary[at] == grams]


@dataclass
class Model:
    languages: list[str]
    vocabulary: np.ndarray  # sorted n-grams of all landmarks
    landmarks: np.ndarray  # presence matrix, n-grams x landmarks, columns divided by the root of their size
    coefficients: np.ndarray  # landmarks x languages

    def kernel(self, sets: list[np.ndarray]) -> np.ndarray:
        present = np.zeros((len(sets), len(self.vocabulary)), dtype=np.float32)
        for row, grams in enumerate(sets):
            present[row, gather(grams, self.vocabulary)] = 1
        sizes = np.array([max(1, len(g)) for g in sets], dtype=np.float32)
        return present @ self.landmarks / np.sqrt(sizes)[:, None]

    def predict(self, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place of the best language, its probability and the largest kernel value with a landmark."""
        kernel = self.kernel(sets)
        values = SHARPNESS * (kernel @ self.coefficients)
        odds = np.exp(values - values.max(axis=1, keepdims=True))
        odds /= odds.sum(axis=1, keepdims=True)
        return odds.argmax(axis=1), odds.max(axis=1), kernel.max(axis=1)


def pieces(text: str) -> list[str]:
    """A sampled text and shorter parts of it, so that short texts are learned too."""
    return [text, *[text[at : at + n] for n in (25, 100, 400) for at in (len(text) // 3, 2 * len(text) // 3) if len(text) > 2 * n]]


def fit(sample: list[tuple[str, str]]) -> Model | None:
    """Fit on (text, language) pairs; None if none of them has a letter."""
    letters = letter_table()
    examples = []
    for place, (text, language) in enumerate(sample):
        for part, piece in enumerate(pieces(text)):
            grams, has = ngrams(piece, letters)
            if has:
                examples.append((grams, language, part == 0))
    if not examples:
        return None
    languages = sorted({language for _, language, _ in examples})
    chosen = []
    for language in languages:  # whole documents spread over the range of sizes
        own = sorted((g for g, l, whole in examples if l == language and whole), key=len)
        chosen += [own[i] for i in sorted({round(x) for x in np.linspace(0, len(own) - 1, min(len(own), LANDMARKS_PER_LANGUAGE))})]
    vocabulary = np.unique(np.concatenate(chosen))
    landmarks = np.zeros((len(vocabulary), len(chosen)), dtype=np.float32)
    for column, grams in enumerate(chosen):
        landmarks[np.searchsorted(vocabulary, grams), column] = 1 / np.sqrt(len(grams))
    model = Model(languages, vocabulary, landmarks, np.zeros((len(chosen), len(languages)), dtype=np.float32))
    inner = model.kernel(chosen).astype(np.float64)
    values, vectors = np.linalg.eigh((inner + inner.T) / 2)
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])  # Nystroem: features are kernel rows times this
    features = np.concatenate([model.kernel([g for g, _, _ in examples[i : i + BLOCK]]) for i in range(0, len(examples), BLOCK)]).astype(np.float64) @ root
    index = {language: i for i, language in enumerate(languages)}
    targets = -np.ones((len(examples), len(languages)))
    targets[np.arange(len(examples)), [index[l] for _, l, _ in examples]] = 1
    weights = 1 / np.array([sum(l == language for _, l, _ in examples) for language in languages])[[index[l] for _, l, _ in examples]]
    weights /= weights.mean()
    gram = features.T @ (features * weights[:, None]) + RIDGE * len(examples) * np.trace(features.T @ features) / features.size * np.eye(features.shape[1])
    model.coefficients = (root @ np.linalg.solve(gram, features.T @ (targets * weights[:, None]))).astype(np.float32)
    return model


def training_sample(docs: DataFrame, per_language: int, max_languages: int | None = MAX_LANGUAGES, sample_chars: int = SAMPLE_CHARS) -> list[tuple[str, str]]:
    """Excerpts of at most about ``per_language`` texts of each language, whatever their lengths, picked by a hash of the key, so that reruns agree."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("learn"))
    common = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang")
    counts = {r["lang"]: r["n"] for r in (common if max_languages is None else common.limit(max_languages)).collect()}
    if not counts:
        return []
    # a share per language: the picked rows are a bounded number, whatever the size of the table
    shares = F.element_at(F.create_map(*[F.lit(x) for l, n in counts.items() for x in (l, min(1.0, per_language / n))]), F.col("lang"))
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    picked_rows = usable.where(draw < shares).select("text", "lang", F.xxhash64("doc_id").alias("h"), F.xxhash64("text").alias("t"))
    most = max(1, min(sample_chars, SAMPLE_TOTAL // (per_language * len(counts))))
    excerpt = F.when(F.length("text") <= most, F.col("text")).otherwise(F.substring(F.regexp_replace("text", r"^[^\p{L}\p{M}]++", ""), 1, most))
    rows = picked_rows.withColumn("text", excerpt).orderBy("h", "lang", "t").limit(2 * per_language * len(counts)).collect()
    return [(r["text"], r["lang"]) for r in rows]


def held_out(key) -> Column:
    """Whether a document is kept from the fit; a null key is."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(True))


def identify_languages(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = SAMPLE_PER_LANGUAGE, carry: bool = False, max_languages: int | None = MAX_LANGUAGES, sample_chars: int = SAMPLE_CHARS) -> DataFrame:
    """One row per document: key, held_out, lang_pred, score (0 to 1) and similarity to the nearest landmark.

    Learned from documents with a language whose crc32(key as text) mod 3 is not 1 (held_out tells those), from
    a sample of about ``per_language`` rows per language. Languages are counted over all of them; the ``max_languages`` commonest are
    learned (None: all), from at most ``sample_chars`` characters of a text. Defined cases: a null text or one without a letter is ``und``
    with score 0; a null key counts as held out; with nothing to learn from all is ``und``; equal decision values go to
    the language that sorts first; an empty table gives no rows. Only the text decides. ``carry`` adds the document's own
    columns as one struct ``row``, so that a filter needs no join.
    """
    source = picked(docs, doc_id=key, text=text, lang=lang)
    source = source.withColumn("held_out", held_out(F.col("doc_id")))
    model = fit(training_sample(source.withColumn("learn", ~F.col("held_out")), per_language, max_languages, sample_chars))
    shared = source.sparkSession.sparkContext.broadcast(model)
    tables: list[np.ndarray] = []

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        if not tables:
            tables.append(letter_table())
        model = shared.value
        texts = batch.column("text").to_pylist()
        names, scores, nearest = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        waiting: list[tuple[int, np.ndarray]] = []

        def settle() -> None:
            best, odds, near = model.predict([g for _, g in waiting])
            for (row, _), b, o, n in zip(waiting, best, odds, near):
                names[row], scores[row], nearest[row] = model.languages[b], o, n
            waiting.clear()

        for row, text in enumerate(texts if model else ()):
            grams, has = ngrams(text, tables[0]) if text else (None, False)
            if has:
                waiting.append((row, grams))
                if len(waiting) == BLOCK:
                    settle()
        if waiting:
            settle()
        yield {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "lang_pred": names, "score": pa.array(np.clip(scores, 0, 1)), "similarity": pa.array(nearest)}

    given, kinds = source.select("doc_id", "text", "held_out"), f"doc_id {dict(source.dtypes)['doc_id']}, held_out boolean, lang_pred string, score double, similarity double"
    out = arrow_map(*carried(docs, key, text, given.columns, {"held_out": held_out(F.col(f"`{key}`"))}, step, kinds)) if carry else arrow_map(given, step, kinds)
    return out.withColumnRenamed("doc_id", key)
