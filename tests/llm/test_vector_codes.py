import hashlib
import math
import random

import numpy as np
import pytest

from streamscreen.llm import vector_codes as vc

SCHEMA = "vec_id bigint, embedding array<float>, label int, code string, v int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1) for i, v, label in rows], SCHEMA)


def floor_of(value):
    top, bottom = float(np.float32(value)).as_integer_ratio()
    return top * 4096 // bottom


def brute(rows):
    """The contract in plain integers: sorted (vec_id, code, error, label_error) and the digest of the codebooks."""
    kept = [(i, [floor_of(x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    size = -(-max((len(v) for _, v, _ in kept), default=0) // 8)
    kept = [(i, v + [0] * (8 * size - len(v)), label) for i, v, label in kept]
    ids = sorted({i for i, *_ in kept if i is not None})[:16]
    firsts = [min(v for j, v, _ in kept if j == i) for i in ids] or sorted(v for _, v, _ in kept)[:16]
    part = lambda v, p: v[p * size:(p + 1) * size]
    books = [[part(v, p) for v in firsts] for p in range(8)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))

    for _ in range(6):
        for p in range(8):
            held = {}
            for _, v, _ in kept:
                held.setdefault(nearest(part(v, p), books[p])[1], []).append(part(v, p))
            for e, xs in held.items():
                books[p][e] = [sum(column) // len(xs) for column in zip(*xs, strict=True)]
    made, totals = [], {}
    for i, v, label in kept:
        found = [nearest(part(v, p), books[p]) for p in range(8)]
        error = min(sum(d for d, _ in found), 2 ** 63 - 1)
        totals[label] = totals.get(label, 0) + error
        made.append((i, "".join(f"{e:02x}" for _, e in found), error, label))
    text = ",".join(str(x) for book in books for c in book for x in c)
    return (sorted(((i, c, e, min(totals[label], 2 ** 63 - 1)) for i, c, e, label in made), key=repr),
            hashlib.sha256(text.encode()).hexdigest())


def check(spark, rows):
    got = vc.compress(frame(spark, rows).repartition(5)).collect()
    want, digest = brute(rows)
    assert sorted(((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got), key=repr) == want
    assert {r["codebooks_sha256"] for r in got} == ({digest} if want else set())


def vectors(seed, count, scale=1.0, length=16, labels=3):
    dice = random.Random(seed)
    return [(i, [dice.gauss(0, scale) for _ in range(length)], dice.choice([*range(labels), None])) for i in range(count)]


def test_codes_match_brute_force(spark):
    check(spark, vectors(1, 200))


@pytest.mark.parametrize("scale", [3e3, 1e6, 1e15, 1e35])
def test_large_components(spark, scale):
    """More than one limb, distances beyond 64 bits, and integers beyond 64 bits."""
    check(spark, vectors(2, 60, scale))


def test_odd_rows(spark):
    some = vectors(3, 30)
    nan, inf = float("nan"), float("inf")
    odd = [(40, None, 1), (41, [None] * 16, 1), (42, [nan] * 16, 0), (43, [inf] * 16, 0), (44, [-inf, *[0.0] * 15], 2),
           (None, some[3][1], None), (None, some[4][1], 5), (45, [0.5, -0.5, 1e-9], 1), (46, [], 1)]
    check(spark, [*some, *odd, *some[:4], *[(50 + i, *some[0][1:]) for i in range(5)]])


def test_ids_repeated_before_the_sixteenth(spark):
    some = vectors(4, 40)
    check(spark, [(i // 6 if i < 30 else i, v, label) for i, v, label in some])


def test_few_rows_and_none(spark):
    check(spark, vectors(5, 3))
    check(spark, [(None, v, 1) for _, v, _ in vectors(6, 20)])
    check(spark, [])
    check(spark, [(1, [], 1), (2, [], None)])


def test_products_are_exact():
    dice = random.Random(7)
    x, c = (np.array([[dice.randrange(-2 ** 30, 2 ** 30) for _ in range(4)] for _ in range(9)]) for _ in range(2))
    want = [[sum(int(p) * int(q) for p, q in zip(a, b, strict=True)) for b in c] for a in x]
    assert vc.products(x, c).tolist() == want
    limbs = vc.limbs(x, 11)
    assert len(limbs) == 3 and (sum(limb.astype(np.int64) << (11 * k) for k, limb in enumerate(limbs)) == x).all()


def test_ties_take_the_first_entry():
    book = np.array([[5, 0], [0, 0], [0, 0], [2, 0]])
    entry, away = vc.nearest(np.array([[1, 0], [0, 0]]), book)
    assert entry.tolist() == [1, 1] and away.tolist() == [1, 0]
    entry, away = vc.nearest(np.array([[1 << 40, 0]]), np.array([[-1, 0], [-1, 0]]))
    assert entry.tolist() == [0] and away.tolist() == [((1 << 40) + 1) ** 2]
