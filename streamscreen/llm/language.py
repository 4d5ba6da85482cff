"""The language of a text, by string kernels.

Kernel: two texts are as alike as the character n-grams (n up to ``ORDERS``) that both hold, by presence, over the root of
the product of their numbers of n-grams. Nystroem: a fixed number of training passages are landmarks; a text is mapped
to its kernel with each landmark and whitened by the landmarks' own kernel matrix. Ridge regression, one
language against the rest, is solved in closed form on the mapped training passages. Scoring a batch of texts is two
matrix products: presence by landmarks, kernels by weights.

Texts are lower-cased code point by code point, and everything but letters is one space. N-grams are told apart by
a hash of ``HASH_BITS`` bits; those that no landmark holds play no part in the kernel.

Fitting uses at most ``PASSAGES`` passages of at most ``PASSAGE_CHARS`` characters in all languages together, chosen by
a hash of doc_id; they are what reaches the driver. Prediction reads every whole text, in pieces of ``PIECE`` characters.

Defined results: a null text or one without a letter is ``und`` with score 0; ties go to the language that sorts
first; repeated rows give repeated results; with nothing to learn from every text is ``und``; an empty table gives no rows; other
columns are kept, and columns named lang_pred or score are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDERS = 3
HASH_BITS = 18
LANDMARKS = 192
PASSAGES = 2400
PASSAGE_CHARS = 1200
RIDGE = 1e-2
PIECE = 1 << 20
UNKNOWN = "und"
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Code point -> its lower-case code point, or 32 if it is no letter."""
    if not _LETTERS:
        codes = np.full(0x110000, 32, dtype=np.uint32)
        for c in range(0x110000):
            if chr(c).isalpha():
                low = chr(c).lower()
                codes[c] = ord(low) if len(low) == 1 else c
        _LETTERS.append(codes)
    return _LETTERS[0]


def _grams(text: str) -> Iterator[np.ndarray]:
    """Hashes of the n-grams of a text, piece by piece; n-grams across pieces are in the latter."""
    letters = _letters()
    tail = np.array([32], dtype=np.uint32)
    for at in range(0, len(text), PIECE):
        codes = letters[np.frombuffer(text[at:at + PIECE].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        codes = np.concatenate([tail, codes])
        keep = np.ones(len(codes), dtype=bool)
        keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
        codes = codes[keep]
        hashed = codes
        for n in range(1, ORDERS + 1):
            if n > 1:
                hashed = hashed[:-1] * np.uint32(0x9E3779B1) + codes[n - 1:]
            if not len(hashed):
                break
            yield ((hashed + np.uint32(n)) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - HASH_BITS)
        tail = codes[-ORDERS:]


def _has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


@dataclass
class Model:
    languages: list[str]
    #: hash -> column of the presence matrix; the last column is for all others
    columns: np.ndarray
    #: presence of each n-gram in each landmark, divided by the root of the landmark's count
    landmarks: np.ndarray
    weights: np.ndarray

    def presence(self, texts: list[str]) -> np.ndarray:
        found = np.zeros((len(texts), self.landmarks.shape[0] + 1), dtype=np.float32)
        for row, text in zip(found, texts, strict=True):
            for hashes in _grams(text):
                row[self.columns[hashes]] = 1
        return found[:, :-1]

    def kernel(self, texts: list[str]) -> np.ndarray:
        presence = self.presence(texts)
        held = np.sqrt(np.maximum(presence.sum(axis=1, keepdims=True), 1))
        return (presence @ self.landmarks) / held

    def scores(self, texts: list[str]) -> np.ndarray:
        return self.kernel(texts) @ self.weights

    def predict(self, texts: list[str | None], batch: int = 256) -> tuple[list[str], list[float]]:
        names, values = [], []
        for at in range(0, len(texts), batch):
            part = texts[at:at + batch]
            known = [i for i, t in enumerate(part) if self.languages and _has_letter(t)]
            own_names, own_values = [UNKNOWN] * len(part), [0.0] * len(part)
            if known:
                margin = self.scores([part[i] for i in known]).astype(np.float64)
                best = margin.argmax(axis=1)
                share = np.exp(4 * (margin - margin.max(axis=1, keepdims=True)))
                share = share.max(axis=1) / share.sum(axis=1)
                for i, b, s in zip(known, best, share, strict=True):
                    own_names[i], own_values[i] = self.languages[b], float(s)
            names += own_names
            values += own_values
        return names, values


def fit(passages: list[tuple[str, str]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """A model from (text, language) pairs; landmarks are spread over the languages in turn."""
    passages = [(t, lang) for t, lang in passages if _has_letter(t)]
    languages = sorted({lang for _, lang in passages})
    if not languages:
        return Model([], np.zeros(1 << HASH_BITS, dtype=np.int32), np.zeros((0, 0), np.float32), np.zeros((0, 0), np.float32))
    by_language = {lang: [t for t, own in passages if own == lang] for lang in languages}
    turns = max(map(len, by_language.values()))
    chosen = [ts[i] for i in range(turns) for ts in by_language.values() if i < len(ts)][:landmarks]
    sets = [np.unique(np.concatenate(list(_grams(t)))) for t in chosen]
    vocabulary = np.unique(np.concatenate(sets))
    columns = np.full(1 << HASH_BITS, len(vocabulary), dtype=np.int32)
    columns[vocabulary] = np.arange(len(vocabulary), dtype=np.int32)
    held = np.zeros((len(vocabulary), len(chosen)), dtype=np.float32)
    for j, s in enumerate(sets):
        held[columns[s], j] = 1 / np.sqrt(len(s))
    model = Model(languages, columns, held, np.zeros((len(chosen), len(languages)), np.float32))
    # K_mm^(-1/2), without the directions that the landmarks do not span.
    values, vectors = np.linalg.eigh((held.T @ held).astype(np.float64))
    spanned = values > 1e-6 * values.max()
    whiten = vectors[:, spanned] / np.sqrt(values[spanned])
    texts = [t for t, _ in passages]
    mapped = np.concatenate([model.kernel(texts[i:i + 256]) for i in range(0, len(texts), 256)]).astype(np.float64) @ whiten
    # Each language weighs the same, whatever its share of the passages.
    own = np.array([languages.index(lang) for _, lang in passages])
    weight = (len(own) / len(languages) / np.bincount(own, minlength=len(languages)))[own][:, None]
    target = np.where(own[:, None] == np.arange(len(languages)), 1.0, -1.0)
    solved = np.linalg.solve(mapped.T @ (weight * mapped) + ridge * len(own) / 100 * np.eye(mapped.shape[1]),
                             mapped.T @ (weight * target))
    model.weights = (whiten @ solved).astype(np.float32)
    return model


def training_passages(labelled: DataFrame, passages: int = PASSAGES, chars: int = PASSAGE_CHARS) -> list[tuple[str, str]]:
    """(passage, language) pairs from doc_id, text, lang: about the same number for each language, ``passages`` at most.

    Every third passage is short, as many texts are. The rows are chosen by hash, never by sorting a language's rows.
    """
    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return []
    each = max(1, passages // len(counts))
    dice = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)).cast("long")
    # A little more than needed is drawn, then cut to the bound.
    rates = [F.when(F.col("lang") == lang, min(1_000_000, int(1_200_000 * each / n) + 50_000 // n)) for lang, n in sorted(counts.items())]
    drawn = usable.withColumn("_dice", dice).where(F.col("_dice") < F.coalesce(*rates)).select(
        "lang", "_dice", F.substr("text", F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - chars, F.lit(1))).cast("int") + 1,
                                  F.when(F.col("_dice") % 3 == 0, F.lit(80)).otherwise(F.lit(chars))).alias("text"))
    rows = drawn.sort("_dice", "text").limit(2 * passages).collect()
    kept: dict[str, list[tuple[str, str]]] = {}
    for r in rows:
        kept.setdefault(r["lang"], []).append((r["text"], r["lang"]))
    return [p for lang in sorted(kept) for p in kept[lang][:each]]


def predict(docs: DataFrame, model: Model, text: Column | None = None) -> DataFrame:
    """``docs`` with lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def named(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            names, values = shared.value.predict(texts.tolist())
            yield pd.DataFrame({"lang_pred": names, "score": values})

    own = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.select(*own, named(F.col("text") if text is None else text).alias("_lang")).select(
        *own, "_lang.lang_pred", "_lang.score")
