"""Benchmark passages in training documents.

The distinct windows of all benchmark items (``n`` consecutive words; a shorter item is one window) are a relation (hash, passage)
that is broadcast to the scan. Documents are read once: words, a hash for each window of words, a lookup in
the relation, and a comparison of the words where the hash is found, all in the scan's own stage. Only verified hits and a
row of counts for each document leave it; no document text is shuffled. Which items a document holds is found
afterwards, from its distinct passages.

The relation is measured in rows and bytes. A benchmark above ``MAX_PASSAGES`` or ``MAX_BYTES`` is dealt by hash to as many parts as
keep each below, and every part is another scan; the driver sees two numbers and the few distinct window lengths, never the windows.

Words: A-Z lower-cased, then runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``. Scan, hashes and comparison
all use these words: full lower-casing depends on what stands around a letter (Greek final sigma), so the same word would
differ between a text and an item.

Defined results: a null, empty or wordless text has no words, so no hits; items without words have no
windows; repeated items count once; rows of one doc_id are one document in ``contamination`` (the
union of their hits, the largest n_words), and ``clean`` judges them together and keeps or drops each; a null doc_id
is an id; an item without an id marks the words it hits but is not listed; empty tables give no rows or no hits; other
columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamscreen.functions.once import once
from streamscreen.llm.common import join_counted
from streamscreen.session import durable

WINDOW = 10
#: Passages, and bytes of them, that are broadcast to one scan.
MAX_PASSAGES, MAX_BYTES = 500_000, 64 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text, by the definition above."""
    lowered = F.translate(text, UPPER, LOWER)
    return F.array_remove(F.split(F.coalesce(lowered, F.lit("")), SEPARATORS), "")


def benchmark_windows(benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """(item_id, length, words as text, hash): the distinct windows of each item."""
    items = benchmark.select("item_id", words(F.col("text")).alias("_words")).where(F.size("_words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("_words") - n + 1, F.lit(1)))
    windows = items.select("item_id", F.least(F.size("_words"), F.lit(n)).alias("length"),
                           F.explode(F.transform(starts, lambda i: F.slice(F.col("_words"), i, n))).alias("_window"))
    return windows.select("item_id", "length", F.concat_ws(" ", "_window").alias("passage"),
                          F.xxhash64("_window").alias("hash")).distinct()


def _parts(windows: DataFrame, max_passages: int, max_bytes: int) -> list[DataFrame]:
    """The distinct (hash, passage) of written windows, dealt by hash to relations that may be broadcast."""
    passages = windows.select(F.col("hash").alias("_h"), F.col("passage").alias("_p")).distinct()
    rows, size = passages.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("_p")), F.lit(0))).first()
    parts = max(1, -(-rows // max_passages), -(-size // max_bytes))
    if parts == 1:
        return [passages]
    # Another hash deals them, so that every part holds its share.
    return [passages.where(F.pmod(F.xxhash64("_p", F.lit(parts)), F.lit(parts)) == k) for k in range(parts)]


def hits(docs: DataFrame, windows: DataFrame, keep: list[str], max_passages: int = MAX_PASSAGES, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``keep`` columns, n_words, and first, length and passage of every occurrence of a window; each document also has a row without."""
    lengths = sorted(r[0] for r in windows.select("length").distinct().collect())
    size = F.size("_words")
    # The row of counts; its place is never looked up, but has to be one.
    none = F.struct(F.lit(0).alias("first"), F.lit(0).alias("length"), F.lit(None).cast("bigint").alias("hash"))

    def windows_of(n: int) -> Column:
        hashed = F.transform(F.sequence(F.lit(1), size - (n - 1), F.lit(1)), lambda i: F.struct(
            i.alias("first"), F.lit(n).alias("length"), F.xxhash64(F.slice(F.col("_words"), i, n)).alias("hash")))
        return F.when(size >= n, hashed)

    nothing = F.slice(F.array(none), 1, 0)
    every = F.concat(F.array(none), *[F.coalesce(windows_of(n), nothing) for n in lengths])
    worded = once(docs.select(*keep, "text"), _words=words(F.col("text"))).drop("text")
    # The places are a column first: a generator of attributes alone is compiled into one loop with the lookup, in which a document's
    # words are read where they are instead of being copied for every window.
    placed = worded.select(*keep, size.cast("long").alias("n_words"), "_words", every.alias("_places")).select(
        *keep, "n_words", "_words", F.inline_outer("_places"))
    passage = F.concat_ws(" ", F.slice("_words", F.greatest("first", F.lit(1)), F.col("length")))
    # The words are compared above the join: as one of its keys, they would be put together for every window.
    found = [placed.join(F.broadcast(part), F.col("hash") == F.col("_h"), "left").where(
        (F.col("first") == 0) | (F.col("_p").isNotNull() & (passage == F.col("_p")))).select(*keep, "n_words", "first", "length", F.col("_p").alias("passage"))
        for part in _parts(windows, max_passages, max_bytes)]
    return reduce(DataFrame.unionByName, found)


def _covered(spans: Column) -> Column:
    """How many words the (first, end) spans, sorted by first, cover together."""
    begin = F.struct(F.lit(0).alias("to"), F.lit(0).alias("n"))

    def step(acc: Column, s: Column) -> Column:
        return F.struct(F.greatest(acc["to"], s["end"]).alias("to"),
                        (acc["n"] + F.greatest(s["end"] - F.greatest(acc["to"], s["first"] - 1), F.lit(0))).alias("n"))

    return F.aggregate(spans, begin, step, lambda acc: acc["n"])


def _marked(docs: DataFrame, windows: DataFrame, **limits: int) -> DataFrame:
    """doc_id, n_words, n_hit, spans (first and last word) and distinct passages of each document."""
    found = hits(docs, windows, ["doc_id"], **limits)
    span = F.when(F.col("passage").isNotNull(), F.struct("first", (F.col("first") + F.col("length") - 1).alias("end")))
    grouped = found.groupBy("doc_id").agg(
        F.max("n_words").alias("n_words"), F.array_sort(F.collect_set(span)).alias("spans"),
        F.collect_set("passage").alias("passages"))
    return grouped.select("doc_id", "n_words", _covered(F.col("spans")).cast("long").alias("n_hit"), "spans", "passages")


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, **limits: int) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (sorted as text), spans (first and last word, merged only in count).

    ``limits`` are ``max_passages`` and ``max_bytes``.
    """
    windows = durable(benchmark_windows(benchmark, n), "benchmark-windows")
    marked = durable(_marked(docs, windows, **limits), "marked-documents")
    hit, none = F.col("n_hit") > 0, F.array().cast("array<string>")
    held = marked.where(hit).select(F.col("doc_id").alias("_id"), F.explode("passages").alias("_passage"))
    items = join_counted(held, windows.select("item_id", "passage"), F.col("_passage") == F.col("passage"), "inner")
    listed = items.groupBy("_id").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    dirty = marked.where(hit).join(listed, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    both = dirty.select("doc_id", "n_words", "n_hit", F.coalesce("items", none).alias("items"), "spans").unionByName(
        marked.where(~hit).select("doc_id", "n_words", "n_hit", none.alias("items"), "spans"))
    return both.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", "spans")


def clean(docs: DataFrame, benchmark: DataFrame, mode: str = "documents", n: int = WINDOW, **limits: int) -> DataFrame:
    """``docs`` without what the benchmark contaminates; same columns.

    ``mode`` "documents" drops documents with a hit. "spans" keeps them and takes out every hit word with the separators
    up to the next word; n_chars, if there is such a column, follows the text.
    """
    columns = docs.columns
    windows = durable(benchmark_windows(benchmark, n), "benchmark-windows")
    found = _marked(docs, windows, **limits).where(F.col("n_hit") > 0)
    if mode == "documents":
        ids = durable(found.select(F.col("doc_id").alias("_hit_id")), "contaminated")
        return join_counted(docs, ids, F.col("doc_id").eqNullSafe(F.col("_hit_id")), "left_anti")
    if mode != "spans":
        raise ValueError(f"mode {mode!r}: documents or spans")
    spans = found.select(F.col("doc_id").alias("_hit_id"), F.col("spans").alias("_spans"))
    joined = docs.join(spans, F.col("doc_id").eqNullSafe(F.col("_hit_id")), "left")
    pieces = F.regexp_extract_all(F.col("text"), F.lit(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)" + _GAP), F.lit(0))
    lead = F.regexp_extract(F.col("text"), "^" + _GAP, 0)
    kept = F.filter(pieces, lambda p, i: ~F.exists("_spans", lambda s: (s["first"] <= i + 1) & (i + 1 <= s["end"])))
    text = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(F.concat(lead, F.concat_ws("", kept)))
    out = joined.withColumn("text", text)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.when(F.col("_spans").isNull(), F.col("n_chars"))
                             .otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*columns)


_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
