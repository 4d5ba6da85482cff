"""The best documents for each query text: term-at-a-time scoring with a limited set of accumulators.

Terms are runs of letters, digits and non-ASCII characters, A-Z lower-cased. With N documents that hold a term, L terms in all, n terms of a
document, tf of a term in it and df documents that hold it, a term weighs w = floor(1000 ln((2N+2) / (2df+1))), a document
has m = 25 + (75 n N) div L, and each occurrence of a term in a query adds w * ((10^9 tf) div (1000 tf + 8 m)).

1. One scan writes, for each document, n and the tf of the terms that any query has; df, N and L are sums over it.
2. The documents are searched in blocks of some thousands, each task going through its own blocks. In a block every query
   takes its terms one at a time, rarest first, and adds to an accumulator per document. As soon as what the remaining terms could add at most
   (the largest contribution of each in this block) is below the k-th best score so far - of this block or of those the task has done -
   no new accumulators are made; the existing ones are still updated, so their scores are exact and no document of
   the first k is lost.
3. A task gives out at most k documents a query, and a window over those makes the ranking.

A term in every document is one posting list per block, never one task's work. Queries are sent to the tasks in groups of at most
about ``MAX_TERMS`` terms, each with a scan of its own, so what is broadcast has a bound.

Defined results: null texts have no terms; a query without a hit gives no rows; rows of one item_id are one query of all their different texts;
every row of the documents is a document of its own, a null doc_id ranks after others of the same score; other columns are ignored; empty
tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamscreen.session import durable

TOP = 10
#: Term occurrences of the queries that one scan serves.
MAX_TERMS = 400_000
#: Documents of a block, and characters of a text that are cut into terms at a time.
BLOCK, PIECE = 8192, 1 << 20
_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_TABLE = bytes.maketrans(_SEPARATORS + bytes(range(0x41, 0x5B)), b" " * len(_SEPARATORS) + bytes(range(0x61, 0x7B)))
_LARGEST = np.iinfo(np.int64).max


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, as lists of some hundred thousand."""
    flat = text.translate(_TABLE)
    at = 0
    while at < len(flat):
        end = flat.find(b" ", at + PIECE)
        end = len(flat) if end < 0 else end
        yield flat[at:end].split()
        at = end


@dataclass(frozen=True)
class Queries:
    """Query terms: numbers of the terms, and for each query its term numbers and how often it has them."""

    numbers: dict[bytes, int]
    items: list[tuple[int | None, np.ndarray, np.ndarray]]


def read_queries(rows: list) -> Queries:
    """Queries of rows (item_id, texts)."""
    numbers: dict[bytes, int] = {}
    items = []
    for row in sorted(rows, key=lambda r: (r["item_id"] is None, r["item_id"])):
        held: Counter = Counter()
        for text in row["texts"]:
            for part in terms(text.encode()):
                held.update(part)
        if held:
            own = [numbers.setdefault(t, len(numbers)) for t in held]
            items.append((row["item_id"], np.array(own), np.array(list(held.values()), dtype=np.int64)))
    return Queries(numbers, items)


def postings(docs: DataFrame, queries: Queries) -> DataFrame:
    """doc_id, n, and the numbers and frequencies of the query terms of each document that holds a term, written."""
    shared = docs.sparkSession.sparkContext.broadcast(queries.numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = shared.value
        for batch in batches:
            sizes, found, often, ends = [], [], [], [0]
            for text in batch.column("text"):
                n, own = 0, Counter()
                for part in terms(text.as_py() or b""):
                    n += len(part)
                    held = Counter(part)
                    for t in held.keys() & numbers.keys() if len(held) < len(numbers) else numbers.keys() & held.keys():
                        own[numbers[t]] += held[t]
                sizes.append(n)
                found += own.keys()
                often += own.values()
                ends.append(len(found))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(found, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(often, pa.int64()))], ["doc_id", "n", "terms", "tf"])

    made = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "doc_id bigint, n bigint, terms array<int>, tf array<bigint>")
    return durable(made.where("n > 0"), "postings")


class Block:
    """The posting lists of some documents, with what each posting adds to a score."""

    def __init__(self, sizes: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, weights: np.ndarray,
                 n_docs: int, n_terms: int):
        self.count = len(sizes)
        if len(sizes) and 75 * int(sizes.max()) * n_docs > _LARGEST:
            m = np.array([25 + 75 * int(n) * n_docs // n_terms for n in sizes], dtype=np.int64)
        else:
            m = 25 + 75 * sizes * n_docs // n_terms
        order = np.argsort(term, kind="stable")
        doc, term, tf = doc[order], term[order], tf[order]
        self.doc, self.added = doc, weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
        self.ends = np.searchsorted(term, np.arange(len(weights) + 1))
        self.most = np.zeros(len(weights), dtype=np.int64)
        np.maximum.at(self.most, term, self.added)

    def scores(self, own: np.ndarray, often: np.ndarray, top: int, least: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents with an accumulator, their exact scores, and how many terms made accumulators.

        ``own`` are term numbers, rarest first. Documents that cannot reach ``least``, or the ``top``-th best score of this
        block, may be missing.
        """
        total = np.zeros(self.count, dtype=np.int64)
        open_ = np.zeros(self.count, dtype=bool)
        most = self.most[own] * often
        remaining = int(most.sum())
        creating, made = True, 0
        for t, q, bound in zip(own.tolist(), often.tolist(), most.tolist(), strict=True):
            low, high = self.ends[t], self.ends[t + 1]
            if creating and made:
                creating = remaining >= self._kth(total, open_, top, least, remaining)
            remaining -= bound
            if low == high or not bound:
                continue
            docs, added = self.doc[low:high], self.added[low:high]
            if creating:
                open_[docs] = True
                made += 1
            else:
                kept = open_[docs]
                docs, added = docs[kept], added[kept]
            total[docs] += q * added
        found = np.flatnonzero(open_)
        return found, total[found], made

    @staticmethod
    def _kth(total: np.ndarray, open_: np.ndarray, top: int, least: int, remaining: int) -> int:
        """The larger of ``least`` and the ``top``-th best partial score, if that is above ``remaining``."""
        if least > remaining:
            return least
        partial = total[open_]
        partial = partial[partial > remaining]  # only these can stop it
        return int(np.partition(partial, -top)[-top]) if len(partial) >= top else least


def _best(found: list, top: int) -> list:
    """The first ``top`` of (score, doc_id) pairs: highest score, then lowest id, null last."""
    return sorted(found, key=lambda p: (-p[0], p[1] is None, p[1]))[:top]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows in blocks of at least ``BLOCK`` but for the last."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= BLOCK:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _search(posted: DataFrame, queries: Queries, top: int) -> DataFrame:
    """item_id, rank, doc_id, score of one group of queries."""
    n_docs, n_terms = posted.agg(F.count(F.lit(1)), F.sum("n")).first()
    spark = posted.sparkSession
    schema = "item_id bigint, doc_id bigint, score bigint"
    if not n_docs or not queries.items:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    df = np.zeros(len(queries.numbers), dtype=np.int64)
    # One row for each term of this group of queries.
    for row in posted.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[row["t"]] = row["count"]
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)
    rarest = [(i, *(a[np.lexsort((own, df[own]))] for a in (own, often))) for i, own, often in queries.items]
    shared = spark.sparkContext.broadcast((rarest, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = shared.value
        best: list[list] = [[] for _ in items]
        for table in _blocks(batches):
            lists = table.column("terms").chunk(0) if len(table) else pa.array([], pa.list_(pa.int32()))
            doc = np.repeat(np.arange(len(table)), np.diff(lists.offsets.to_numpy()))
            block = Block(table.column("n").to_numpy(), doc, lists.flatten().to_numpy(),
                          table.column("tf").chunk(0).flatten().to_numpy(), weights, n_docs, n_terms)
            ids = table.column("doc_id")
            for at, (_, own, often) in enumerate(items):
                least = best[at][-1][0] if len(best[at]) == top else 1
                found, scores, _ = block.scores(own, often, top, least)
                good = scores >= least
                found, scores = found[good], scores[good]
                if len(found) > top:  # all that tie with the top-th
                    good = scores >= np.partition(scores, -top)[-top]
                    found, scores = found[good], scores[good]
                if len(found):
                    named = zip(scores.tolist(), ids.take(pa.array(found)).to_pylist(), strict=True)
                    best[at] = _best(best[at] + list(named), top)
        rows = [(item[0], d, s) for item, own in zip(items, best, strict=True) for s, d in own]
        columns = zip(*rows, strict=True) if rows else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item_id", "doc_id", "score"])

    found = posted.mapInArrow(run, schema)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, max_terms: int = MAX_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of ``docs`` (doc_id, text) for each of ``items`` (item_id, text)."""
    texts = items.where(F.col("text").isNotNull()).select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    queries = texts.groupBy("item_id").agg(F.collect_set("text").alias("texts"))
    # A term and what parts it take two characters at least.
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, math.ceil(size / 2 / max_terms))
    if groups > 1:
        queries = durable(queries, "queries")
    made = None
    for number in range(groups):
        own = queries.where(F.pmod(F.xxhash64("item_id", F.lit(3)), F.lit(groups)) == number)
        read = read_queries(own.collect())  # a group of bounded size
        found = _search(postings(docs, read), read, top)
        made = found if made is None else made.unionByName(found)
    return made
