"""Compressed vectors: product codes from integer codebooks, by exact products of limbs.

Components become integers floor(4096 x); vectors are cut into ``PARTS`` parts, each with a codebook of ``ENTRIES`` entries that starts as that part of
the vectors with the smallest ids. A round assigns every part to its nearest entry (squared distance, the first of equals) and moves each
entry to the floored mean of its parts. Everything is exact, so the result does not depend on how rows are dealt to tasks.

Distances come from matrix products. Integers are split into limbs so short that a float64 product of limbs stays below 2^53 and BLAS
adds without rounding; the products are put together in int64, and the first smallest |c|^2 - 2 x.c wins. Where a distance could pass
2^63 (components from about 2^29 on, x beyond some 100 000), the batch is done with Python's unbounded integers instead.

A round is one scan: each task adds up its parts per entry and gives out one row per entry, position and 60-bit limb of the sum; Spark sums
these, and only the codebooks (PARTS x ENTRIES x part length) reach the driver. Labels are totalled by an aggregate and joined back.

Defined results: rows whose vector is null or has a null or non-finite component are dropped; a shorter vector is filled up with zeros to the
longest, and all to a multiple of ``PARTS``; a null vec_id is coded but starts no entry; of several rows of a vec_id the smallest vector can
start an entry; with fewer than ENTRIES ids there are fewer entries, and with no id at all the null rows' smallest vectors start them; an error
beyond 64 bits is given as 2^63 - 1; repeated rows are repeated; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamscreen.llm.common import join_counted
from streamscreen.session import durable

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Bits that a sum of products of limbs may have, and bits of the limbs in which sums travel.
EXACT_BITS, SUM_BITS = 53, 60
_LARGEST = (1 << 63) - 1


def integers(vectors: pa.Array, length: int) -> np.ndarray:
    """floor(SCALE x) of every component, filled up to ``length``: int64, or Python integers where int64 is too short."""
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(vectors.offsets.to_numpy())
    rows = np.repeat(np.arange(len(sizes)), sizes)
    places = np.arange(len(values)) - np.repeat(vectors.offsets.to_numpy()[:-1] - vectors.offsets[0].as_py(), sizes)
    # Up to 2^52 the product is exact in float64; beyond, the float is an integer by itself or nearly so.
    wide = len(values) and np.abs(values).max() >= 2.0 ** 40
    made = np.zeros((len(sizes), length), dtype=object if wide else np.int64)
    if wide:
        made[rows, places] = [_floor(v) for v in values.tolist()]
    else:
        made[rows, places] = np.floor(values * SCALE).astype(np.int64)
    return made


def _floor(value: float) -> int:
    top, bottom = value.as_integer_ratio()
    return top * SCALE // bottom


def _bits(x: np.ndarray) -> int:
    """Bits of the largest magnitude, sign apart."""
    if not x.size:
        return 0
    return max(int(x.max()), -int(x.min())).bit_length()


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """Limbs of ``bits`` bits, lowest first, as float64: non-negative but for the last, which has the sign."""
    made = []
    while True:
        if _bits(x) <= bits:
            return [*made, x.astype(np.float64)]
        made.append((x & ((1 << bits) - 1)).astype(np.float64))
        x = x >> bits


def products(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """``x @ c.T`` in int64, exactly, provided the results fit."""
    bits = (EXACT_BITS - max(x.shape[1], 1).bit_length()) // 2
    total = np.zeros((len(x), len(c)), dtype=np.int64)
    own = limbs(c, bits)
    for i, a in enumerate(limbs(x, bits)):
        for j, b in enumerate(own):
            total += (a @ b.T).astype(np.int64) << (bits * (i + j))
    return total


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``x`` the first nearest row of ``book`` and the squared distance to it."""
    if 2 * max(_bits(x), _bits(book)) + max(x.shape[1], 1).bit_length() + 2 > 63 or object in (x.dtype, book.dtype):
        away = [((x.astype(object) - entry) ** 2).sum(axis=1) for entry in book.astype(object)]
        entry, least = np.zeros(len(x), dtype=np.int64), away[0]
        for number, d in enumerate(away[1:], 1):
            closer = (d < least).astype(bool)
            entry[closer], least = number, np.where(closer, d, least)
        return entry, least
    score = (book * book).sum(axis=1)[None, :] - 2 * products(x, book)
    entry = score.argmin(axis=1)
    return entry, score[np.arange(len(x)), entry] + (x * x).sum(axis=1)


def _cut(whole: np.ndarray, part: int, parts: int) -> np.ndarray:
    size = whole.shape[1] // parts
    return whole[:, part * size:(part + 1) * size]


def _sums(kept: DataFrame, books: list[np.ndarray], length: int) -> list[tuple]:
    """(part, entry, position, count, sum) over all vectors, for the entries that any part is nearest to."""
    shared = kept.sparkSession.sparkContext.broadcast(books)
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, size = shared.value, length // parts
        counts = [[0] * len(book) for book in books]
        sums = [np.zeros((len(book), size), dtype=object) for book in books]
        for batch in batches:
            whole = integers(batch.column("v"), length)
            for p, book in enumerate(books):
                own = _cut(whole, p, parts)
                entry, _ = nearest(own, book)
                for e in np.unique(entry).tolist():
                    chosen = own[entry == e]
                    counts[p][e] += len(chosen)
                    sums[p][e] += chosen.sum(axis=0).astype(object)
        rows = []
        for p in range(parts):
            for e, count in enumerate(counts[p]):
                for i in range(size if count else 0):
                    value, limb = int(sums[p][e][i]), 0
                    while True:
                        last = -(1 << SUM_BITS) <= value < 1 << SUM_BITS
                        rows.append((p, e, i, limb, count if limb == 0 else 0, value if last else value & ((1 << SUM_BITS) - 1)))
                        if last:
                            break
                        value, limb = value >> SUM_BITS, limb + 1
        names = ("part", "entry", "position", "limb", "count", "value")
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(6)], list(names))

    made = kept.select("v").mapInArrow(run, "part bigint, entry bigint, position bigint, limb bigint, count bigint, value bigint")
    totals: dict[tuple[int, int, int], list[int]] = {}
    for row in made.groupBy("part", "entry", "position", "limb").agg(
            F.sum("count").alias("n"), F.sum(F.col("value").cast("decimal(38,0)")).alias("s")).collect():
        own = totals.setdefault((row["part"], row["entry"], row["position"]), [0, 0])
        own[0] += row["n"]
        own[1] += int(row["s"]) << (SUM_BITS * row["limb"])
    return [(*key, n, s) for key, (n, s) in totals.items()]


def _as_array(rows: list[list[int]], size: int) -> np.ndarray:
    small = all(abs(v) <= _LARGEST for row in rows for v in row)
    return np.array(rows, dtype=np.int64 if small else object).reshape(len(rows), size)


def _starting(kept: DataFrame, entries: int) -> list[list[float]]:
    """The vectors of the ``entries`` smallest ids, ascending."""
    found: dict[int, list[float]] = {}
    rows = kept.where(F.col("vec_id").isNotNull())
    while len(found) < entries:
        later = rows if not found else rows.where(F.col("vec_id") > max(found))
        some = later.orderBy("vec_id", "v").select("vec_id", "v").limit(entries).collect()
        for row in some:
            found.setdefault(row["vec_id"], row["v"])
        if len(some) < entries:
            break
    if not found:
        return [r["v"] for r in kept.orderBy("v").select("v").limit(entries).collect()]
    return [found[i] for i in sorted(found)[:entries]]


def train(kept: DataFrame, length: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebook of each part, for vectors ``v`` of at most ``length`` components."""
    first = integers(pa.array(_starting(kept, entries), pa.list_(pa.float64())), length)
    books = [_cut(first, p, parts) for p in range(parts)]
    size = length // parts
    for _ in range(rounds):
        moved = [book.astype(object).tolist() for book in books]
        for p, e, i, n, s in _sums(kept, books, length):
            moved[p][e][i] = s // n
        books = [_as_array(m, size) for m in moved]
    return books


def encode(kept: DataFrame, books: list[np.ndarray], length: int) -> DataFrame:
    """vec_id, label, code and error of every vector."""
    shared = kept.sparkSession.sparkContext.broadcast(books)
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = integers(batch.column("v"), length)
            codes, errors = np.zeros((len(whole), parts), dtype=np.uint8), np.zeros(len(whole), dtype=object)
            for p, book in enumerate(shared.value):
                codes[:, p], away = nearest(_cut(whole, p, parts), book)
                errors += away
            text = [row.tobytes().hex() for row in codes]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(text, pa.string()),
                 pa.array([min(int(e), _LARGEST) for e in errors], pa.int64())], ["vec_id", "label", "code", "error"])

    label = kept.schema["label"].dataType.simpleString()
    return kept.select("vec_id", "label", "v").mapInArrow(run, f"vec_id bigint, label {label}, code string, error bigint")


def as_text(books: list[np.ndarray]) -> str:
    """All components by part, entry and position, joined by commas."""
    return ",".join(str(int(v)) for book in books for entry in book for v in entry)


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of ``vectors`` (vec_id, embedding, label)."""
    own = F.col("embedding")
    finite = F.forall(own, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    kept = vectors.where(own.isNotNull() & finite).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), "label", own.cast("array<double>").alias("v"))
    longest = kept.agg(F.max(F.size("v"))).first()[0]
    if longest is None:
        return kept.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"),
                           F.lit(0).cast("bigint").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    length = -(-longest // parts) * parts
    books = train(kept, length, parts, entries, rounds)
    coded = durable(encode(kept, books, length), "vector-codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_LARGEST).cast("decimal(38,0)")).cast("bigint")
    totals = coded.groupBy(F.col("label").alias("_label")).agg(total.alias("label_error"))
    digest = hashlib.sha256(as_text(books).encode()).hexdigest()
    return join_counted(coded, totals, F.col("label").eqNullSafe(F.col("_label")), "inner").select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
