"""Documents that share most of their word n-grams: a Jaccard similarity join by MinHash bands.

1. One scan turns each text into its set of n-grams (``N`` lower-case words, hashed to 64 bits), a key of the whole set, and band
   hashes. Rows per band are as many as fit ``MAX_HASHES``, and bands as many as the wanted recall needs at the threshold.
2. Equal sets are one class with a representative: copies are counted, never paired.
3. Representatives that share a band hash are linked to the smallest of their bucket; buckets are aggregates, so no bucket is
   gathered and no pair is emitted. The components of these links are the candidate groups.
4. Within a candidate group every pair is verified on the full n-gram sets. Small groups are packed together; a large group
   is cut into blocks of about ``BLOCK`` representatives, and each pair of blocks is a task of its own, so one
   group spreads over the cluster. A task emits a row for each member (its number of links, and the smallest member
   it is connected to), never the pairs.
5. Classes are the components of the verified links.

Result: one row per document with class_id (the smallest doc_id it is connected to through links), representative (the smallest doc_id
with the same set) and n_links (how many other documents are at least as similar as the threshold).

Defined results: words are runs of letters, digits and underscores; a text of fewer than ``N`` words has one n-gram of
all its words; a text without words (also null and empty) is a class of its own; repeated rows of a doc_id count once, and
rows of a doc_id with different texts each follow their own text (classes are kept apart by their sets, not by ids); a row with a
null doc_id is returned unlinked; an empty table gives no rows; other columns are ignored, and ``deduplicate`` keeps them.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamscreen.llm.common import join_counted, remembered
from streamscreen.llm.components import components
from streamscreen.session import arrow_rows, durable

N, THRESHOLD, RECALL, MAX_HASHES = 5, 0.8, 0.9999, 128
BLOCK = 256
#: Members of small groups that are verified together.
PACK = 400
#: N-grams hashed at a time, and columns of a product.
STEP, COLUMNS = 1 << 15, 4096
CACHE = 300_000
_WORD = re.compile(r"\w+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def bands_and_rows(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """The most rows per band, and bands, such that a pair at the threshold shares a band with probability ``recall``."""
    best = None
    for rows in range(1, max_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))
        if bands * rows > max_hashes:
            break
        best = bands, rows
    if best is None:
        raise ValueError("max_hashes is too small for this recall")
    return best


class _Words(dict):
    """Hashes of words, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _words() -> _Words:
    return remembered("n-gram words", _Words)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def gram_set(text: str | None, n: int = N) -> np.ndarray:
    """The sorted, distinct hashes of a text's n-grams."""
    words = _WORD.findall(text.lower()) if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashed = np.fromiter(map(_words().__getitem__, words), dtype=np.uint64, count=len(words))
    n = min(n, len(words))
    grams = hashed[:len(words) - n + 1].copy()
    for k in range(1, n):
        grams = grams * _ODD + hashed[k:len(words) - n + 1 + k]
    return np.unique(_mixed(grams))


def signature(grams: np.ndarray, masks: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The smallest value of the set under each hash function."""
    low = np.full(len(masks), np.iinfo(np.uint64).max, dtype=np.uint64)
    step = max(1, STEP // 8)
    for at in range(0, len(grams), step):
        part = grams[at:at + step]
        np.minimum(low, ((part[None, :] ^ masks[:, None]) * factors[:, None]).min(axis=1), out=low)
    return low


def _functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    dice = np.random.Generator(np.random.PCG64(20))
    masks, factors = (dice.integers(0, 1 << 64, size=count, dtype=np.uint64) for _ in range(2))
    return masks, factors | np.uint64(1)


def _text_key() -> Column:
    """Tells the texts of one doc_id apart."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def scan(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """doc_id, a hash of the text, set_key (null without words) and bands of every document, written."""
    masks, factors = _functions(bands * rows)
    places = _mixed(np.arange(1, bands + 1, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, found = [], []
            for text in batch.column("text"):
                grams = gram_set(text.as_py(), n)
                if not len(grams):
                    keys.append(None)
                    found.append(None)
                    continue
                keys.append(xxhash.xxh128_digest(grams.tobytes()))
                own = signature(grams, masks, factors).reshape(bands, rows)
                hashed = places.copy()
                for k in range(rows):
                    hashed = _mixed(hashed * _ODD + own[:, k])
                found.append(hashed.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(keys, pa.binary()),
                 pa.array(found, pa.list_(pa.int64()))], ["doc_id", "text_key", "set_key", "bands"])
        _words().clear()  # the worker lives on, and later stages need its memory

    made = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _text_key().alias("text_key"), "text").mapInArrow(
        run, "doc_id bigint, text_key bigint, set_key binary, bands array<bigint>")
    with arrow_rows(docs.sparkSession):
        return durable(made, "near-scan")


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """How many n-grams each pair of sets shares; dense products over the n-grams that at least two sets hold."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    grams, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = count > 1
    place = np.cumsum(common) - 1
    kept = common[column]
    owner, column = owner[kept], place[column[kept]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for at in range(0, int(common.sum()), COLUMNS):
        low, high = np.searchsorted(column, [at, at + COLUMNS])
        held = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        held[owner[low:high], column[low:high] - at] = 1
        both += held @ held.T
    return both


def links(nodes: list[int], sets: list[np.ndarray], copies: list[int], sides: list[int], threshold: float
          ) -> list[tuple[int, int, int, int]]:
    """(node, smallest node connected to it, linked nodes, documents behind them) of every node with a link.

    With two ``sides``, only pairs across them count. Members are sorted by node.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    if len(nodes) == 2:
        shared = float(len(np.intersect1d(sets[0], sets[1], assume_unique=True)))
        both = np.array([[0.0, shared], [shared, 0.0]])
    else:
        both = _shared(sets).astype(np.float64)
    near = both * (1 + threshold) >= threshold * (sizes[:, None] + sizes[None, :]) - 1e-9
    side = np.array(sides)
    if len(set(sides)) > 1:
        near &= side[:, None] != side[None, :]
    own = np.array(nodes)
    near &= own[:, None] != own[None, :]
    label = np.arange(len(nodes))
    while True:
        lower = np.minimum(label, np.where(near, label[None, :], len(nodes)).min(axis=1))
        lower = lower[lower]
        if (lower == label).all():
            break
        label = lower
    degree, weight = near.sum(axis=1), near @ np.array(copies, dtype=np.int64)
    return [(nodes[i], nodes[label[i]], int(degree[i]), int(weight[i])) for i in np.flatnonzero(degree)]


def _verified(members: DataFrame, n: int, threshold: float) -> DataFrame:
    """Links of members (pack, low, high, root, block, node, copies, text): one row for each node of a group with a link."""
    def run(group: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int, int]] = []
        by_root: dict[int, dict[tuple[int, bytes], tuple]] = {}
        for row in zip(*(group.column(c).to_pylist() for c in ("root", "node", "block", "copies", "text")), strict=True):
            root, node, block, copies, text = row
            grams = gram_set(text, n)
            by_root.setdefault(root, {})[(node, grams.tobytes())] = (node, block, copies, grams)
        for own in by_root.values():
            if len(own) > 1:
                rows = sorted(own.values(), key=lambda r: r[0])
                found += links([r[0] for r in rows], [r[3] for r in rows], [r[2] for r in rows], [r[1] for r in rows], threshold)
        _words().clear()
        return pa.table({name: pa.array([f[i] for f in found], pa.int64())
                         for i, name in enumerate(("node", "parent", "linked", "linked_docs"))})

    return members.groupBy("pack", "low", "high").applyInArrow(
        run, "node bigint, parent bigint, linked bigint, linked_docs bigint")


def _groups(candidates: DataFrame) -> DataFrame:
    """(node, root) of the candidates (a, b), where b is the smallest of a bucket: the components.

    A node needs one link, to the smallest b it knows; that b is linked to the other ones, which a large group shares. Only the b's go
    through the rounds of ``components``: every other node goes with its own b.
    """
    known = durable(candidates.groupBy("a").agg(F.min("b").alias("b"), F.collect_set("b").alias("_all")), "near-candidates")
    heads = known.select("b", F.explode("_all").alias("_other")).where(F.col("b") != F.col("_other")).distinct()
    # A node that is the smallest of another bucket goes through the rounds, with its own link.
    least = durable(known.select(F.explode("_all").alias("_head")).distinct(), "near-heads")
    inner = known.join(least, F.col("a") == F.col("_head"), "left_semi").select("a", "b")
    roots = components(heads.select(F.col("b").alias("a"), F.col("_other").alias("b")).unionByName(inner))
    own = known.select(F.col("a").alias("node"), "b").unionByName(least.select(F.col("_head").alias("node"), F.col("_head").alias("b")))
    led = own.groupBy("node").agg(F.min("b").alias("_led"))
    named = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    return led.join(named, F.col("_led") == F.col("_node"), "left").select("node", F.coalesce("_root", "_led").alias("root"))


def _members(docs: DataFrame, classes: DataFrame, groups: DataFrame, block: int) -> DataFrame:
    """The members of candidate groups with their texts, dealt to the tasks that verify them."""
    sizes = groups.groupBy("root").agg(F.count(F.lit(1)).alias("_size"))
    blocks = F.ceil(F.col("_size") / block).cast("int")
    known = classes.select("node", "copies", F.col("representative").alias("_rep"), F.col("text_key").alias("_rep_key"))
    dealt = groups.join(sizes, "root").join(known, "node").select(
        "node", "root", "copies", "_rep", "_rep_key", blocks.alias("_blocks"), F.pmod(F.xxhash64("node"), blocks).cast("int").alias("block"))
    dealt = durable(dealt, "near-members")
    packs = max(1, dealt.count() // PACK)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("_id"), _text_key().alias("_key"), "text")
    rows = join_counted(texts, dealt, (F.col("_id") == F.col("_rep")) & (F.col("_key") == F.col("_rep_key")), "inner")
    small = F.col("_blocks") == 1
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return rows.select(
        F.when(small, F.pmod(F.xxhash64("root"), F.lit(packs)).cast("bigint")).otherwise(F.col("root")).alias("pack"),
        F.when(small, -1).otherwise(F.least("block", "_other")).alias("low"),
        F.when(small, -1).otherwise(F.greatest("block", "_other")).alias("high"),
        "root", "block", "node", "copies", "text")


def _classified(docs: DataFrame, n: int, threshold: float, recall: float, block: int) -> DataFrame:
    """doc_id, text_key, set_key and, for sets, node, root, class_id, representative and n_links of every row of ``docs``."""
    bands, rows = bands_and_rows(threshold, recall)
    scanned = scan(docs, n, bands, rows)
    usable = scanned.where(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
    first = F.min(F.struct("doc_id", "text_key"))
    classes = durable(usable.groupBy("set_key").agg(
        first.alias("_first"), F.countDistinct("doc_id").alias("copies"), F.first("bands").alias("bands")).select(
        "set_key", _node().alias("node"), F.col("_first.doc_id").alias("representative"),
        F.col("_first.text_key").alias("text_key"), "copies", "bands"), "near-classes")
    banded = classes.select(F.col("node").alias("a"), F.explode("bands").alias("_band"))
    buckets = banded.groupBy("_band").agg(F.min("a").alias("b"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    candidates = banded.join(buckets, "_band").where(F.col("a") != F.col("b")).select("a", "b").distinct()
    groups = _groups(candidates)
    members = _members(docs, classes, groups, block)
    with arrow_rows(docs.sparkSession):
        found = durable(_verified(members, n, threshold), "near-links")
    roots = components(found.select(F.col("node").alias("a"), F.col("parent").alias("b")).where(F.col("a") != F.col("b")))
    counts = found.groupBy("node").agg(F.sum("linked_docs").alias("linked_docs"))
    linked = classes.select("set_key", "node", "representative", "copies").join(counts.join(roots, "node", "left").withColumnRenamed(
        "node", "_linked"), F.col("node") == F.col("_linked"), "left").withColumn("root", F.coalesce("root", "node"))
    # A class goes by the smallest id of its sets; a root of a third of all rows is partly aggregated first.
    named = linked.groupBy(F.col("root").alias("_root")).agg(F.min(F.struct("representative", "node")).alias("_least"))
    final = durable(linked.join(named, F.col("root") == F.col("_root")).select(
        F.col("set_key").alias("_key"), "node", "representative", F.col("_least.representative").alias("class_id"),
        (F.col("_least.node") == F.col("node")).alias("least"),
        (F.col("copies") - 1 + F.coalesce("linked_docs", F.lit(0))).alias("n_links")), "near-result")
    same = (F.col("set_key") == F.col("_key")) & F.col("doc_id").isNotNull()
    return scanned.select("doc_id", "text_key", "set_key").join(final, same, "left").drop("_key")


def _node() -> Column:
    """A number for a set: the first 64 bits of its digest."""
    return F.conv(F.hex(F.substring("set_key", 1, 8)), 16, -10).cast("bigint")


def near_duplicates(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK
                    ) -> DataFrame:
    """doc_id, class_id, representative, n_links for every row of ``docs`` (doc_id, text)."""
    return _classified(docs, n, threshold, recall, block).select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("representative", "doc_id").alias("representative"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))


def deduplicate(docs: DataFrame, n: int = N, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each class, the one with the smallest doc_id; same columns.

    Rows are dropped by id and text, so another text of the same id stays if it is no copy of anything. Of repeated rows
    (also those that differ in other columns, or whose texts have the same n-grams) one stays.
    """
    marked = durable(_classified(docs, n, threshold, RECALL, BLOCK).where(F.col("doc_id").isNotNull()), "near-marked")
    survives = F.coalesce(F.col("least") & (F.col("doc_id") == F.col("representative")), F.col("set_key").isNull())
    # Of the texts of an id with one set, the one with the smallest hash.
    chosen = durable(marked.where(survives).groupBy(F.col("doc_id").alias("_id"), F.coalesce("set_key", F.lit(b"")).alias("_set")).agg(
        F.min("text_key").alias("_text")), "near-chosen")
    kept = marked.join(chosen, (F.col("doc_id") == F.col("_id")) & (F.coalesce("set_key", F.lit(b"")) == F.col("_set"))
                       & (F.col("text_key") == F.col("_text")) & survives, "left").select(
        "doc_id", "text_key", F.col("_id").isNotNull().alias("_stays"))
    counted = durable(kept.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(
        F.max("_stays").alias("_stays"), F.count(F.lit(1)).alias("_n")).where(~F.col("_stays") | (F.col("_n") > 1)), "near-dropped")
    same = (F.col("doc_id") == F.col("_id")) & (_text_key() == F.col("_key"))
    left = join_counted(docs, counted.select("_id", "_key"), same, "left_anti")
    again = counted.where("_stays").select("_id", "_key")
    if again.limit(1).count() == 0:
        return left
    one = join_counted(docs, again, same, "inner").groupBy("_id", "_key").agg(
        F.first(F.struct(*docs.columns)).alias("_row")).select("_row.*")
    return left.unionByName(one)
