"""Exact token totals for every context limit, from one histogram of encoded lengths.

Documents are encoded once, each to its length; the lengths are counted, and everything else comes
from the histogram. Its suffix sums are taken in two levels (blocks of lengths, then lengths in a
block), so no window holds more than one block, however long documents become.

Defined results: a null or empty text has length 0; repeated rows count as often as they occur; an
empty table gives an empty histogram; other columns are ignored. Control strings inside texts are
ordinary text. Lengths do not depend on the order of rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streamscreen.session import durable

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the word pattern that goes with the vocabulary.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLOCK = 4096
_ENCODERS: dict[tuple[int, str], object] = {}


def encoder(ranks: bytes, pattern: str):
    """The encoder of a rank file's bytes; one for each Python worker."""
    import tiktoken

    key = (hash(ranks), pattern)
    if key not in _ENCODERS:
        pairs = (line.split() for line in ranks.splitlines() if line)
        _ENCODERS[key] = tiktoken.Encoding(
            "ranks", pat_str=pattern, special_tokens={},
            mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in pairs})
    return _ENCODERS[key]


def token_length(spark: SparkSession, text: Column, path: str = RANKS, pattern: str = WORD_PATTERN) -> Column:
    """The number of tokens of ``text``. The rank file is read on the driver and broadcast (below 1 MB)."""
    with open(path, "rb") as file:
        ranks = spark.sparkContext.broadcast(file.read())

    @F.pandas_udf("long")
    def lengths(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder(ranks.value, pattern).encode_ordinary
        for texts in batches:
            yield pd.Series([len(encode(t)) if t else 0 for t in texts], dtype="int64")

    return lengths(text)


def length_histogram(docs: DataFrame, length: Column) -> DataFrame:
    """(n_tokens, n_docs): how many rows have each length."""
    return docs.select(length.alias("n_tokens")).groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def limit_totals(histogram: DataFrame, block: int = BLOCK) -> DataFrame:
    """For each length L that occurs: what a context limit of L keeps.

    n_docs (rows of exactly that length), docs_upto and tokens_upto (rows of at most L tokens),
    docs_longer, truncated_tokens (the sum of min(length, L)), quantile (docs_upto / all rows).
    """
    sums = [F.sum("n_docs").alias("_docs"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("_tokens")]
    counted = histogram.withColumn("_block", F.floor(F.col("n_tokens") / block))
    # Sums over the longer blocks: one row for each block, itself summed from the histogram.
    blocks = counted.groupBy("_block").agg(*sums)
    longer = Window.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    ahead = blocks.select(
        "_block", F.coalesce(F.sum("_docs").over(longer), F.lit(0)).alias("_docs_ahead"),
        F.coalesce(F.sum("_tokens").over(longer), F.lit(0)).alias("_tokens_ahead"))
    within = Window.partitionBy("_block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    suffix = counted.join(ahead, "_block").select(
        "n_tokens", "n_docs",
        (F.coalesce(F.sum("n_docs").over(within), F.lit(0)) + F.col("_docs_ahead")).alias("docs_longer"),
        (F.coalesce(F.sum(F.col("n_docs") * F.col("n_tokens")).over(within), F.lit(0))
         + F.col("_tokens_ahead")).alias("_tokens_longer"))
    whole = histogram.agg(*sums)
    return suffix.crossJoin(F.broadcast(whole)).select(  # one row
        "n_tokens", "n_docs", (F.col("_docs") - F.col("docs_longer")).alias("docs_upto"), "docs_longer",
        (F.col("_tokens") - F.col("_tokens_longer")).alias("tokens_upto"),
        (F.col("_tokens") - F.col("_tokens_longer") + F.col("docs_longer") * F.col("n_tokens")).alias("truncated_tokens"),
        ((F.col("_docs") - F.col("docs_longer")) / F.col("_docs")).alias("quantile"))


def truncated_total(totals: DataFrame, limit: int) -> DataFrame:
    """One row for any limit, also one that no document has: docs_longer, truncated_tokens."""
    below = totals.where(F.col("n_tokens") <= limit).agg(
        F.coalesce(F.max("tokens_upto"), F.lit(0)).alias("_upto"), F.coalesce(F.max("docs_upto"), F.lit(0)).alias("_docs"))
    every = totals.agg(F.coalesce(F.max("docs_upto"), F.lit(0)).alias("_all"))
    longer = F.col("_all") - F.col("_docs")
    return below.crossJoin(every).select(  # one row each
        F.lit(limit).cast("long").alias("limit"), longer.alias("docs_longer"),
        (F.col("_upto") + longer * limit).alias("truncated_tokens"))


def length_quantile(totals: DataFrame, q: float) -> DataFrame:
    """One row: the smallest length that at least the share ``q`` of the rows do not exceed."""
    return totals.where(F.col("quantile") >= q).agg(F.min("n_tokens").alias("n_tokens"))


def token_totals(docs: DataFrame, path: str = RANKS) -> DataFrame:
    """``limit_totals`` of the column ``text``. The histogram is written once: three sums read it."""
    histogram = length_histogram(docs, token_length(docs.sparkSession, docs["text"], path))
    return limit_totals(durable(histogram, "token-lengths"))
