"""Quality of a text by a sparse ensemble of rules over its statistics.

Statistics are columns of one scan (``STATISTICS``). A forest of shallow trees is grown on labelled
documents; every path from a root to a node is a rule, a conjunction of comparisons. A logistic regression with an L1 penalty on rules
and clipped statistics keeps a few of them. What is kept compiles to a Spark column: the score of a
document is an expression over its statistics, evaluated where the text is read, without Python and without a shuffle.

Fitting uses at most ``MAX_ROWS`` labelled rows, chosen by a hash of doc_id; only their statistics are written and
trained on, with Spark's own forest and regression. Scoring covers every whole text.

Defined results: a null or empty text has all statistics 0 and is scored like any other; with no
labels of both kinds every score is the share of label 1 (0.5 without any); repeated rows give repeated results; an empty
table gives no rows; other columns are kept.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamscreen.functions.once import once
from streamscreen.llm.common import labelled_sample
from streamscreen.session import durable

MAX_ROWS = 20_000
TREES, DEPTH, PENALTY, SEED = 20, 3, 0.002, 11
THRESHOLD = 0.3
STATISTICS = ("chars_log", "word_length", "distinct_words", "short_words", "repeated_next", "upper", "symbols",
              "digits", "exclamations", "sentence_ends", "line_length_log", "distinct_lines", "symbol_words")


def with_statistics(docs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``columns`` of ``docs`` and the statistics of the column ``text``."""
    rows = docs.select(*columns, F.coalesce("text", F.lit("")).alias("_t"))
    # Lists and lengths that several statistics use are columns of their own, so that each is computed once.
    rows = rows.select(*columns, "_t", F.length("_t").alias("_n"),
                       F.array_remove(F.split("_t", r"\s+"), "").alias("_w"), F.split("_t", "\n").alias("_lines"))
    rows = rows.select(*columns, "_t", "_n", "_w", F.size("_w").alias("_words"), "_lines")
    per_char = lambda c: F.coalesce(c / F.nullif("_n", F.lit(0)), F.lit(0.0))
    per_word = lambda c: F.coalesce(c / F.nullif("_words", F.lit(0)), F.lit(0.0))
    taken = lambda pattern: F.col("_n") - F.length(F.regexp_replace("_t", pattern, ""))
    left = lambda text: F.col("_n") - F.length(F.replace("_t", F.lit(text), F.lit("")))
    return rows.select(
        *columns,
        F.log1p("_n").alias("chars_log"),
        per_word(F.col("_n") - F.col("_words")).alias("word_length"),
        per_word(F.size(F.array_distinct("_w"))).alias("distinct_words"),
        per_word(F.size(F.filter("_w", lambda w: F.length(w) <= 3))).alias("short_words"),
        per_word(F.size(F.filter("_w", lambda w, i: w == F.get("_w", i - 1)))).alias("repeated_next"),
        per_char(taken(r"\p{Lu}+")).alias("upper"),
        per_char(F.length(F.regexp_replace("_t", r"[\p{L}\p{N}\s]+", ""))).alias("symbols"),
        per_char(taken("[0-9]+")).alias("digits"),
        per_word(left("!")).alias("exclamations"),
        per_word(left(".")).alias("sentence_ends"),
        F.log1p(F.col("_n") / F.size("_lines")).alias("line_length_log"),
        (F.size(F.array_distinct("_lines")) / F.size("_lines")).alias("distinct_lines"),
        per_word(F.size(F.filter("_w", lambda w: ~w.rlike(r"[\p{L}\p{N}]")))).alias("symbol_words"))


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool  # strictly above, or at most
    value: float

    def column(self) -> Column:
        return F.col(self.statistic) > self.value if self.above else F.col(self.statistic) <= self.value


Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class Model:
    intercept: float
    rules: tuple[tuple[Rule, float], ...]
    #: (statistic, low, high, weight): statistics clipped to what training saw
    linear: tuple[tuple[str, float, float, float], ...]

    def score(self) -> Column:
        """The score as an expression over the statistics."""
        parts = [F.when(_holds(rule), w).otherwise(0.0) for rule, w in self.rules]
        parts += [_clipped(name, low, high) * w for name, low, high, w in self.linear]
        total = reduce(lambda a, b: a + b, parts, F.lit(self.intercept))
        return 1 / (1 + F.exp(-F.greatest(F.least(total, F.lit(30.0)), F.lit(-30.0))))


def _holds(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, [c.column() for c in rule])


def _clipped(name: str, low: float, high: float) -> Column:
    return F.greatest(F.least(F.col(name), F.lit(high)), F.lit(low))


def tree_rules(text: str, names: Sequence[str] = STATISTICS) -> list[Rule]:
    """Every path of a tree, from its printed form (``If (feature i <= v)`` and ``Else (feature i > v)``, indented)."""
    path: list[tuple[int, Condition]] = []
    found: list[Rule] = []
    for line in text.splitlines():
        match = re.match(r"^(\s*)(?:If|Else) \(feature (\d+) (<=|>) ([-+0-9.eE]+|NaN)\)", line)
        if not match:
            continue
        depth = len(match[1])
        path = [p for p in path if p[0] < depth]
        path.append((depth, Condition(names[int(match[2])], match[3] == ">", float(match[4]))))
        found.append(tuple(c for _, c in path))
    return found


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS) -> Model:
    """A model of documents (doc_id, text) and their labels (doc_id, ``label`` 0 or 1)."""
    sample = labelled_sample(docs, labels, label, max_rows)
    rows = with_statistics(sample.withColumn("label", (F.col(label) > 0).cast("double")), ["label"])
    # One order and one partition of a bounded sample: sums of floats come out alike in every run.
    known = durable(rows, "quality-statistics").repartition(1).sortWithinPartitions("label", *STATISTICS)
    count, share = known.agg(F.count(F.lit(1)), F.avg("label")).first()
    if not count or share in (0.0, 1.0):
        p = min(max(share if count else 0.5, 1e-6), 1 - 1e-6)
        return Model(math.log(p / (1 - p)), (), ())
    # The rarer label weighs as much as the other in growing trees, so that its rules are found.
    weight = F.when(F.col("label") == 1, 0.5 / share).otherwise(0.5 / (1 - share))
    vectors = known.select("label", weight.alias("weight"), array_to_vector(F.array(*STATISTICS)).alias("features"))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, subsamplingRate=0.5, featureSubsetStrategy="0.5",
                                    weightCol="weight", seed=SEED).fit(vectors)
    rules = sorted({r for tree in forest.trees for r in tree_rules(tree.toDebugString)},
                   key=lambda r: (len(r), repr(r)))
    edges = known.agg(*[F.percentile_approx(s, [0.025, 0.975]).alias(s) for s in STATISTICS]).first()
    linear = [(s, *map(float, edges[s])) for s in STATISTICS]
    inputs = F.array(*[_holds(r).cast("double") for r in rules], *[_clipped(*x) for x in linear])
    lasso = LogisticRegression(regParam=PENALTY, elasticNetParam=1.0, maxIter=60, featuresCol="inputs").fit(
        known.select("label", array_to_vector(inputs).alias("inputs")))
    weights = [float(w) for w in lasso.coefficients]
    return Model(float(lasso.intercept),
                 tuple((r, w) for r, w in zip(rules, weights, strict=False) if w),
                 tuple((*x, w) for x, w in zip(linear, weights[len(rules):], strict=True) if w))


def score(docs: DataFrame, model: Model, columns: Sequence[str]) -> DataFrame:
    """``columns`` of ``docs`` (a column named score is replaced) and score; they may be named like a statistic."""
    own = [c for c in columns if c != "score"]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("_row"), "text")
    return with_statistics(packed, ["_row"]).select("_row.*", model.score().alias("score"))


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``; same columns."""
    packed = docs.select(F.struct(*docs.columns).alias("_row"), "text")
    # The score stays a column of its own: a filter on the expression would be pushed below the statistics
    # and repeat each of them for every rule.
    scored = once(with_statistics(packed, ["_row"]), _score=model.score())
    return scored.where(F.col("_score") >= threshold).select("_row.*")
