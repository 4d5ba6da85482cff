"""Toxic passages: maximum-scoring segments over token log-odds.

Lexicon: words and word beginnings, counted once per document in labelled toxic and other documents. The toxic
share of a unit has a Dirichlet prior whose mean is the share of the shorter beginning above it (at the top that of all
words), so rare words lean on what is known of their beginnings. Units that differ significantly from chance score their
log-odds; every other word scores ``DRIFT``.

Passages: all maximal segments of positive sum, in one linear scan of a document's words. Calibration: for
documents that are not toxic, the best segment of n words follows an extreme-value law, P(M >= s) = 1 - exp(-K n exp(-lambda s));
lambda solves the scores' moment equation and K is its maximum-likelihood value. A segment of expected number
(E-value) at most ``SIGNIFICANT`` is a passage. A document's evidence is the sum of -ln E of its passages, and a
logistic curve turns it into a score from 0 to 1.

Lexicon and calibration are fitted on different halves of at most ``MAX_ROWS`` labelled rows, chosen by a hash of doc_id. What reaches
the driver is the significant units, three numbers for each calibration row and the number of hits of each lexicon score. Scoring reads every whole text, ``PIECE``
characters at a time.

Defined results: a null or empty text has no passages and gets the score of no evidence; rows whose label is null are not
learned from; without labels of both kinds every score is the toxic share (0 without any); repeated rows give
repeated results; an empty table gives no rows; other columns are kept, and columns named score or passages are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamscreen.llm.common import labelled_sample
from streamscreen.session import durable

MAX_ROWS = 24_000
BEGINNINGS = (4, 5, 6)
PRIOR = 4.0
MIN_COUNT = 3
#: Least likelihood-ratio statistic (chi-squared, one degree of freedom) of a unit in the lexicon.
MIN_STATISTIC = 18.0
DRIFT = -0.25
SIGNIFICANT = 0.05
PIECE = 1 << 20
CACHE = 300_000
_WORD = re.compile(r"[^\W_]+")


@dataclass
class Model:
    #: beginning -> log-odds, by length, and whole words
    beginnings: dict[int, dict[str, float]] = field(default_factory=dict)
    words: dict[str, float] = field(default_factory=dict)
    decay: float = 1.0
    k: float = 1.0
    curve: tuple[float, float] = (0.0, 0.0)

    def __post_init__(self):
        self._seen: dict[str, float] = {}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_seen"}

    def __setstate__(self, state):
        self.__dict__.update(state, _seen={})

    def word_score(self, word: str) -> float:
        """The most specific unit that the lexicon has for the word; 0 for none."""
        score = self.words.get(word)
        if score is None:
            for n in sorted(self.beginnings, reverse=True):
                if len(word) > n and (score := self.beginnings[n].get(word[:n])) is not None:
                    break
        return score or 0.0

    def scored(self, text: str) -> tuple[int, list[tuple[int, float]]]:
        """The number of words and the (position, score) of those that the lexicon has."""
        seen, count, found = self._seen, 0, []
        for piece in pieces(text):
            words = _WORD.findall(piece)
            for i, word in enumerate(words, count):
                score = seen.get(word)
                if score is None:
                    if len(seen) >= CACHE:
                        seen.clear()
                    # Found in the text itself and then lower-cased, as letters can grow: positions are those of the text.
                    score = seen[word] = self.word_score(word.lower())
                if score:
                    found.append((i, score))
            count += len(words)
        return count, found

    def e_value(self, score: float, n: int) -> float:
        return self.k * n * math.exp(-min(self.decay * score, 700.0))

    def passages(self, text: str | None) -> tuple[float, list[tuple[int, int, float, float]]]:
        """Evidence, and (first word, word after the last, score, E-value) of each significant passage."""
        if not text:
            return 0.0, []
        n, found = self.scored(text)
        kept = [(a, b, s, e) for a, b, s in segments(found) if (e := self.e_value(s, n)) <= SIGNIFICANT]
        return sum(-math.log(max(e, 1e-300)) for *_, e in kept), kept

    def probability(self, evidence: float) -> float:
        a, b = self.curve
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, a + b * math.log1p(evidence)))))


def pieces(text: str) -> Iterator[str]:
    """The text in pieces of about ``PIECE`` characters that end between words."""
    at = 0
    while at < len(text):
        end = min(at + PIECE, len(text))
        while end < len(text) and (text[end - 1].isalnum() and text[end].isalnum()):
            end += 1
        yield text[at:end]
        at = end


def segments(found: list[tuple[int, float]], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal segments of positive sum, as (first word, word after the last, sum), in linear time.

    ``found`` holds the positions with a score of their own; every other position scores ``drift`` (negative). Open
    candidates are kept with the sums before and after them; a new one merges with those it improves on.
    """
    stack: list[tuple[int, int, float, float]] = []  # first, end, sum before, sum after
    total, last = 0.0, 0
    for at, score in found:
        total += drift * (at - last)
        last = at + 1
        before, total = total, total + score
        if score <= 0:
            continue
        first = at
        # Candidates that began at or above this one's level can't be its left end.
        position = len(stack) - 1
        while position >= 0:
            while position >= 0 and stack[position][2] >= before:
                position -= 1
            if position < 0 or stack[position][3] >= total:
                break
            first, before = stack[position][0], stack[position][2]
            del stack[position:]
            position = len(stack) - 1
        stack.append((first, at + 1, before, total))
    return [(a, b, after - before) for a, b, before, after in stack]


def _units(text: Column) -> Column:
    """Distinct words of a text with their beginnings, each marked by the beginning's length (0: whole word)."""
    words = F.array_distinct(F.transform(F.array_remove(F.split(text, r"[^\p{L}\p{N}]+"), ""), F.lower))

    def starts(n: int) -> Column:
        cut = F.transform(F.filter(words, lambda w: F.length(w) > n), lambda w: F.left(w, F.lit(n)))
        return F.transform(F.array_distinct(cut), lambda p: F.struct(F.lit(n).alias("n"), p.alias("unit")))

    whole = F.transform(words, lambda w: F.struct(F.lit(0).alias("n"), w.alias("unit")))
    return F.concat(whole, *map(starts, BEGINNINGS))


def _statistic(toxic: Column, every: Column, share: float) -> Column:
    """Likelihood-ratio statistic of ``toxic`` out of ``every`` against ``share``."""
    term = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    return 2 * (term(toxic, every * share) + term(every - toxic, every * (1 - share)))


def lexicon(labelled: DataFrame) -> tuple[dict[int, dict[str, float]], dict[str, float]]:
    """Scores of the significant units of (text, toxic) rows."""
    counted = labelled.select("toxic", F.explode(_units(F.col("text"))).alias("u")).groupBy("u.n", "u.unit").agg(
        F.sum(F.col("toxic").cast("long")).alias("toxic"), F.count(F.lit(1)).alias("every")).where(
        F.col("every") >= MIN_COUNT)
    whole = labelled.agg(F.avg(F.col("toxic").cast("double")).alias("share")).first()["share"]
    if not whole or whole >= 1:
        return {}, {}
    rows = counted.where((_statistic(F.col("toxic"), F.col("every"), whole) >= MIN_STATISTIC)
                         & (F.col("toxic") > F.col("every") * whole)).collect()
    logit = lambda p: math.log(p / (1 - p))
    share: dict[int, dict[str, float]] = {n: {} for n in (0, *BEGINNINGS)}

    def above(unit: str) -> float:
        for n in sorted(BEGINNINGS, reverse=True):
            if len(unit) > n and unit[:n] in share[n]:
                return share[n][unit[:n]]
        return whole

    for row in sorted(rows, key=lambda r: (r["n"] == 0, r["n"], r["unit"])):
        share[row["n"]][row["unit"]] = min(0.9999, (row["toxic"] + PRIOR * above(row["unit"])) / (row["every"] + PRIOR))
    score = lambda units: {u: s for u, p in units.items() if (s := logit(p) - logit(whole)) > 0}
    return {n: score(share[n]) for n in BEGINNINGS}, score(share[0])


def _decay(words: float, scores: np.ndarray, hits: np.ndarray) -> float:
    """The positive root of the moment equation sum p(s) exp(lambda s) = 1 over words that are not toxic; 1 at most.

    ``hits`` words score ``scores``, the rest of all ``words`` score ``DRIFT``.
    """
    own = hits.sum()
    rest = words - own
    if not own or rest <= 0:
        return 1.0
    moment = lambda x: ((hits * np.exp(x * scores)).sum() + rest * math.exp(x * DRIFT)) / words - 1
    if moment(1e-3) >= 0:
        return 0.05
    low, high = 1e-3, 1.0
    if moment(high) <= 0:
        return 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if moment(middle) < 0 else (low, middle)
    return max(low, 0.05)


def _curve(evidence: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on log(1 + evidence), by Newton's method with a slight ridge."""
    x = np.column_stack([np.ones(len(evidence)), np.log1p(evidence)])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-2 * np.eye(2), x.T @ (toxic - p) - 1e-2 * w)
        w += np.clip(step, -5, 5)
    return float(w[0]), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_ROWS) -> Model:
    """A model of documents (doc_id, text) and their labels (doc_id, ``label`` 0 or 1)."""
    rows = labelled_sample(docs, labels, label, max_rows).where(F.col("text").isNotNull())
    # Three passes read the sample.
    sample = durable(rows.select("doc_id", "text", (F.col(label) > 0).cast("int").alias("toxic")), "toxic-sample")
    half = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(2))
    beginnings, words = lexicon(sample.where(half == 0))
    model = Model(beginnings, words)

    @F.pandas_udf("struct<n:long,best:double,tally:array<struct<score:double,hits:long>>>")
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            made = []
            for text in texts:
                n, found = model.scored(text)
                tally = [{"score": s, "hits": c} for s, c in Counter(s for _, s in found).items()]
                made.append((n, max((s for *_, s in segments(found)), default=0.0), tally))
            yield pd.DataFrame(made, columns=["n", "best", "tally"])

    # Two passes read what was measured.
    rows = durable(sample.where(half == 1).select("toxic", measured("text").alias("m")), "toxic-measured")
    counts = rows.select("toxic", "m.n", "m.best").collect()
    if not counts or len({r["toxic"] for r in counts}) < 2:
        share = np.mean([float(r["toxic"]) for r in counts]) if counts else 0.0
        model.curve = (math.log(max(share, 1e-6) / max(1 - share, 1e-6)), 0.0)
        return model
    calm = [r for r in counts if not r["toxic"]]
    lengths = np.array([r["n"] for r in calm], dtype=float)
    # Every hit counts; the distinct scores are no more than the lexicon's.
    tally = sorted(rows.where(F.col("toxic") == 0).select(F.explode("m.tally").alias("t")).groupBy("t.score").agg(
        F.sum("t.hits").alias("hits")).collect())
    model.decay = _decay(lengths.sum(), *np.array(tally, dtype=float).reshape(-1, 2).T)
    spread = (lengths * np.exp(-model.decay * np.array([r["best"] for r in calm]))).sum()
    model.k = len(calm) / max(spread, 1.0)

    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def evidence(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shared.value.passages(t)[0] for t in texts], dtype="float64")

    known = sample.where(half == 1).select("toxic", evidence("text").alias("evidence")).collect()
    model.curve = _curve(np.array([r["evidence"] for r in known]), np.array([float(r["toxic"] > 0) for r in known]))
    return model


def _offsets(text: str, kept: list[tuple[int, int, float, float]]) -> list[tuple[int, int, float, float]]:
    """Word positions of passages as code points of the text."""
    ends = iter(kept)
    current, made, start, at = next(ends), [], 0, 0
    for match in _WORD.finditer(text):
        if at == current[0]:
            start = match.start()
        if at == current[1] - 1:
            made.append((start, match.end(), current[2], current[3]))
            if (current := next(ends, None)) is None:
                break
        at += 1
    return made


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with score and passages: start, end (code points), score and E-value of each."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<score:double,passages:array<struct<start:int,end:int,score:double,e_value:double>>>")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for texts in batches:
            scores, spans = [], []
            for text in texts:
                evidence, kept = own.passages(text)
                scores.append(own.probability(evidence))
                spans.append([dict(zip(("start", "end", "score", "e_value"), p, strict=True))
                              for p in _offsets(text, kept)] if kept else [])
            yield pd.DataFrame({"score": scores, "passages": spans})

    own = [F.col(f"`{c}`") for c in docs.columns if c not in ("score", "passages")]
    return docs.select(*own, scored("text").alias("_toxic")).select(*own, "_toxic.score", "_toxic.passages")
