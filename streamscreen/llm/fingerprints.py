"""Fingerprints of documents that add up: a homomorphic multiset hash of their paragraphs.

A text is cut into pieces (lines, cut further at sentence ends and at ``MAX_PIECE`` code points; marks of a sentence end
alone are a piece), each trimmed. A piece hashes to a wide vector of ``LEVELS`` levels of ``LANES`` lanes with one lane set to a 38-bit value, and a
fingerprint is the sum of its pieces' vectors modulo 2^38 with the number of pieces. Of all pieces, a share of 4^-k lies at
level k or above. Beside the lanes stands the sum of a second, independent 64-bit hash of the pieces modulo 2^64: it tells
texts apart that differ in one piece. So equal texts have equal fingerprints, the order of
pieces does not matter, and pieces are inserted or deleted by adding or subtracting vectors (``combined``).

Likeness: the lanes in which two fingerprints differ are those that the pieces of their difference fall
into; counting a level's lanes left alone estimates how many of its pieces differ (linear counting). The levels from the
finest one on that is not nearly full, times 4 for each finer level, give the number for the whole, however long the texts,
and with the two totals the Jaccard likeness of the multisets.

A fingerprint column is struct<pieces: bigint, sum: bigint, lanes: array<bigint>>: ``lanes`` are sorted (level * LANES + lane) * 2^38 + value, only lanes
that are set. ``as_text`` writes it. Everything is computed within a row.

``next_texts`` needs one shuffle: documents are dealt to ranges of ids, and the one
document at the end of each range is dealt to both of its ranges.

Defined results: a null text is ''; a text without pieces has no lanes; two empty fingerprints have likeness 1;
rows of one doc_id are ordered by text, so each has a next document; a single document is its own next; an
empty table gives no rows; other columns are ignored; a null doc_id comes last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LANES = 1024
#: With nine levels, one in 65 536 pieces is at the last, which some 3 000 different ones fill: more than a row can hold.
LEVELS = 9
#: Differing lanes (three pieces to a lane) above which a level is not counted.
FULL = 972
BITS = 38
SECOND = 8
MODULUS = 1 << BITS
MAX_PIECE = 40
#: Ranges of ids; what decides is that a range's texts can be sorted on one executor's disk.
MAX_RANGES = 4096
ROWS_A_RANGE = 4000


def pieces(text: Column) -> Column:
    cut = F.regexp_extract_all(text, F.lit(rf"[^.!?\n]{{1,{MAX_PIECE}}}+[.!?]*+|[.!?]++"), F.lit(0))
    return F.filter(F.transform(cut, lambda p: F.trim(p)), lambda p: p != "")


def _wrapped(values: Column) -> Column:
    """The sum of bigints modulo 2^64, in halves, as the session may refuse overflow."""
    zero = F.lit(0).cast("bigint")
    # One pass; the upper half takes the lower one's carry.
    return F.aggregate(
        values, F.struct(zero.alias("low"), zero.alias("high")),
        lambda acc, v: F.struct((acc["low"] + v.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
                                (acc["high"] + F.shiftrightunsigned(v, 32)).alias("high")),
        lambda acc: F.shiftleft(acc["high"] + F.shiftright(acc["low"], 32), 32).bitwiseOR(
            acc["low"].bitwiseAND(F.lit(0xFFFFFFFF))))


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also where lambdas repeat it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _negative(value: Column) -> Column:
    """-value modulo 2^64."""
    return _wrapped(F.array(F.bitwise_not(value), F.lit(1).cast("bigint")))


def _summed(keys: Column) -> Column:
    """Lane sums of sorted (lane * 2^38 + value) keys; one pass, as the keys of a lane lie together."""
    begin = F.struct(F.array().cast("array<bigint>").alias("done"), F.lit(-1).cast("bigint").alias("lane"),
                     F.lit(0).cast("bigint").alias("sum"))

    def close(acc: Column) -> Column:
        return F.when(acc["lane"] < 0, acc["done"]).otherwise(
            F.concat(acc["done"], F.array(acc["lane"] * MODULUS + acc["sum"])))

    def step(acc: Column, key: Column) -> Column:
        lane, value = F.shiftright(key, BITS), key.bitwiseAND(F.lit(MODULUS - 1))
        same = lane == acc["lane"]
        return F.when(same, F.struct(acc["done"].alias("done"), lane.alias("lane"),
                                     (acc["sum"] + value).bitwiseAND(F.lit(MODULUS - 1)).alias("sum"))).otherwise(
            F.struct(close(acc).alias("done"), lane.alias("lane"), value.alias("sum")))

    return F.aggregate(keys, begin, step, close)


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text (null: '')."""
    # The hash: 16 bits choose the level, 10 the lane, 38 are its value.
    def key(h: Column) -> Column:
        top = F.shiftrightunsigned(h, 48)
        level = F.when(top >= 1 << 14, 0)
        for k in range(1, LEVELS - 1):
            level = level.when(top >= 1 << (14 - 2 * k), k)
        return level.otherwise(LEVELS - 1) * F.lit(LANES * MODULUS) + h.bitwiseAND(F.lit(LANES * MODULUS - 1))

    def made(cut: Column) -> Column:
        keys = F.transform(F.transform(cut, lambda p: F.xxhash64(p)), key)
        # The number hashed first is another seed for the piece.
        second = F.transform(cut, lambda p: F.xxhash64(F.lit(SECOND), p))
        return F.struct(F.size(cut).cast("bigint").alias("pieces"), _wrapped(second).alias("sum"),
                        _summed(F.array_sort(keys)).alias("lanes"))

    return _once(pieces(F.coalesce(text, F.lit(""))), made)


def combined(a: Column, b: Column, sign: int = 1) -> Column:
    """The fingerprint of ``a`` with the pieces of ``b`` inserted (sign 1) or deleted (-1).

    A lane that comes to 0 is dropped, so deleting what was inserted gives the former fingerprint.
    """
    other = b["lanes"]
    if sign < 0:
        value = lambda k: k.bitwiseAND(F.lit(MODULUS - 1))
        other = F.transform(other, lambda k: k - value(k) + F.when(value(k) == 0, 0).otherwise(MODULUS - value(k)))
    lanes = _summed(F.array_sort(F.concat(a["lanes"], other)))
    added = b["sum"] if sign > 0 else _negative(b["sum"])
    return F.struct((a["pieces"] + sign * b["pieces"]).alias("pieces"), _wrapped(F.array(a["sum"], added)).alias("sum"),
                    F.filter(lanes, lambda k: k.bitwiseAND(F.lit(MODULUS - 1)) != 0).alias("lanes"))


def as_text(mark: Column) -> Column:
    """pieces, ':', 16 hexadecimal digits of the sum (none without pieces) and the set lanes, each 13 hexadecimal digits."""
    return F.concat(mark["pieces"].cast("string"), F.lit(":"),
                    F.when(mark["pieces"] == 0, "").otherwise(F.lpad(F.lower(F.hex(mark["sum"])), 16, "0")),
                    F.concat_ws("", F.transform(mark["lanes"], lambda k: F.lpad(F.lower(F.hex(k)), 13, "0"))))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness of the two multisets of pieces, 0 to 1; 1 for equal fingerprints."""
    lane = lambda k: F.shiftright(k, BITS)
    differing = F.array_union(F.transform(F.array_except(a["lanes"], b["lanes"]), lane),
                              F.transform(F.array_except(b["lanes"], a["lanes"]), lane))
    total = a["pieces"] + b["pieces"]

    def judged(differing: Column) -> Column:
        same = (a["pieces"] == b["pieces"]) & (a["sum"] == b["sum"]) & (F.size(differing) == 0)
        likely = _once(F.greatest(_apart(differing), F.lit(1.0)), lambda n: (total - n) / (total + n))
        return F.when(same, 1.0).when(total == 0, 0.0).otherwise(F.least(F.greatest(likely, F.lit(0.0)), F.lit(1.0)))

    return _once(differing, judged)


def _apart(differing: Column) -> Column:
    """Estimated number of pieces that set the ``differing`` lanes; levels are read from the coarsest to the finest that counts."""
    begin = F.struct(F.lit(0.0).alias("sum"), F.lit(float(4 ** LEVELS)).alias("scale"), F.lit(False).alias("full"))

    def step(acc: Column, level: Column) -> Column:
        # A variable for the count: filter runs once for each level.
        n = F.size(F.filter(differing, lambda k: F.shiftright(k, LANES.bit_length() - 1) == level))
        return _once(n, lambda n: counted(acc, n, level))

    def counted(acc: Column, n: Column, level: Column) -> Column:
        full = acc["full"] | ((n > FULL) & (level < LEVELS - 1))
        number = -LANES * F.log(1 - F.least(n.cast("double"), F.lit(LANES - 0.5)) / LANES)
        return F.when(full, F.struct(acc["sum"].alias("sum"), acc["scale"].alias("scale"), F.lit(True).alias("full"))).otherwise(
            F.struct((acc["sum"] + number).alias("sum"), (acc["scale"] / 4).alias("scale"), F.lit(False).alias("full")))

    levels = F.array(*[F.lit(k).cast("bigint") for k in reversed(range(LEVELS))])
    return F.aggregate(levels, begin, step, lambda acc: acc["sum"] * acc["scale"])


def _range_of(doc_id: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds lie below ``doc_id``: a balanced tree of comparisons."""
    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(doc_id > bounds[middle], tree(middle + 1, high)).otherwise(tree(low, middle))

    return tree(0, len(bounds))


def next_texts(docs: DataFrame, carried: list[str]) -> DataFrame:
    """doc_id, text, ``carried`` and next_text: that of the next document by descending doc_id; after the last, the first's."""
    low = -(1 << 63)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(low)).alias("_id"),
                       "doc_id", F.coalesce("text", F.lit("")).alias("text"), *carried)
    ids = rows.select("_id")
    count, top = ids.agg(F.count(F.lit(1)), F.max("_id")).first()
    if not count:
        return rows.select("doc_id", "text", *carried, F.col("text").alias("next_text"))
    ranges = max(1, min(MAX_RANGES, count // ROWS_A_RANGE))
    at = [i / ranges for i in range(1, ranges)]
    cuts = ids.agg(F.percentile_approx("_id", at or [0.5], 100 * ranges)).first()[0] if at else []
    bounds = sorted({b for b in cuts if b < top})
    # Range k holds the ids above bounds[k - 1] up to bounds[k]. Going down, range k is followed by the document bounds[k - 1],
    # and range 0 by the largest id of all.
    own = _range_of(F.col("_id"), bounds)
    placed = rows.withColumn("_own", own).withColumn("_in", F.explode(F.array_compact(F.array(
        F.struct(F.col("_own").alias("range"), F.lit(0).alias("guest")),
        F.when(F.col("_id").isin(*bounds) if bounds else F.lit(False), F.struct((F.col("_own") + 1).alias("range"), F.lit(1).alias("guest"))),
        F.when(F.col("_id") == top, F.struct(F.lit(0).alias("range"), F.lit(2).alias("guest")))))))
    order = Window.partitionBy("_in.range").orderBy("_in.guest", F.desc("_id"), "text")
    return placed.withColumn("next_text", F.lead("text").over(order)).where(F.col("_in.guest") == 0).select(
        "doc_id", "text", *carried, "next_text")


def edited(docs: DataFrame) -> DataFrame:
    """doc_id, text, next_text and edited_text: the last third of the text replaced by as much of the next one's start."""
    rows = next_texts(docs, [])
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    return rows.withColumn("edited_text", F.concat(F.left(F.col("text"), n - third), F.left(F.col("next_text"), third)))
