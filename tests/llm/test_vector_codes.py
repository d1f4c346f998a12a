import random
from hashlib import sha256

import numpy as np
import pytest

from fathomline.llm import exact_gemm as g
from fathomline.llm import vector_codes as v

SCHEMA = "vec_id long, embedding array<float>, label int"
INF, NAN = float("inf"), float("nan")


def test_exact_products_of_wide_numbers():
    r = np.random.default_rng(1)
    for width, top in ((1, 2**30), (8, 2**27), (64, 2**27), (64, 3), (100, 2**24)):
        a, b = (r.integers(-top, top + 1, (n, width)) for n in (7, 5))
        a[0], b[0] = -top, top
        want = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a]
        assert g.exact_dot(a, b).tolist() == want
    bits = g.limb_bits(64)
    assert 64 * 2 ** (2 * bits) <= 2**53
    assert len(g.limbs(np.array([[2**40, -(2**40)]]), bits)) == 2
    with pytest.raises(OverflowError):
        g.exact_dot(np.full((1, 8), 2**31), np.full((1, 8), 2**31))


def usable(x):
    return x is not None and all(c is not None and np.isfinite(c) for c in x)


def brute(rows, parts, entries, rounds):
    """Whole-number k-means in plain Python; rows (vec_id, vector, label)."""
    kept = sorted([r for r in rows if usable(r[1])], key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // parts
    cut = [[[int(np.floor(4096.0 * float(np.float32(c)))) for c in x[p * w : (p + 1) * w]] for p in range(parts)] for _, x, _ in kept]
    books = [[list(cut[k][p]) for k in range(min(entries, len(cut)))] for p in range(parts)]

    def near(x, book):
        far = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in book]
        return min(range(len(book)), key=lambda k: (far[k], k)), min(far)

    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for x in cut:
                held.setdefault(near(x[p], books[p])[0], []).append(x[p])
            for k, xs in held.items():
                books[p][k] = [sum(c) // len(xs) for c in zip(*xs)]
    out = []
    for (i, _, label), x in zip(kept, cut):
        found = [near(x[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for k, _ in found), sum(d for _, d in found), label))
    totals = {}
    for *_, e, label in out:
        totals[label] = totals.get(label, 0) + e
    digest = sha256(",".join(str(c) for p in books for e in p for c in e).encode()).hexdigest()
    return sorted(((i, c, e, totals[label], digest) for i, c, e, label in out), key=str)


def made(n, width=16, seed=3):
    r = random.Random(seed)
    rows = [(k, [r.choice([0.0, 0.25, -0.5, r.uniform(-2, 2)]) for _ in range(width)], r.choice([None, 0, 0, 1])) for k in range(n)]
    rows += [(n, rows[0][1], 1), (3, rows[n // 2][1], None), (3, rows[n // 2][1], None), (None, rows[n - 1][1], 2)]  # ties, repeats, a null id
    return rows + [(n + 1, None, 0), (n + 2, [None] * width, 0), (n + 3, [INF] + [0.0] * (width - 1), 0), (n + 4, [NAN] * width, 1)]


@pytest.mark.parametrize("n", [1, 10, 60])
def test_codes_equal_brute_force(spark, n):
    rows = made(n)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = [tuple(x) for x in v.op12_vector_codes(df).collect()]
    assert sorted(got, key=str) == brute(rows, 8, 16, 6)


def test_nothing_usable(spark):
    for rows in ([], [(1, None, 1)], [(1, [None], 1)]):
        assert v.op12_vector_codes(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_other_columns_and_clashes(spark):
    df = spark.createDataFrame([(1, [0.5] * 8, 1, "x", "c"), (2, [0.5] * 8, 1, "y", "d")], SCHEMA + ", row string, code string")
    books = v.fit(df, rounds=1)
    got = v.with_label_error(v.encode(df, books)).collect()
    assert [(r.row, r.code, r.error, r.label_error) for r in sorted(got)] == [("x", "00" * 8, 0, 0), ("y", "00" * 8, 0, 0)]


def test_entries_without_parts_stay():
    books = np.array([[[1], [9]]])
    assert v.moved(books, np.array([[[-7, 2], [0, 0]]])).tolist() == [[[-4], [9]]]


def test_lengths_that_differ_are_an_error(spark):
    df = spark.createDataFrame([(1, [0.5] * 8, 1), (2, [0.5] * 16, 1)], SCHEMA)
    with pytest.raises(Exception, match="components"):
        v.op12_vector_codes(df).collect()
