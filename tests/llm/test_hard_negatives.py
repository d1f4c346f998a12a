import random

import numpy as np
import pytest

from fathomline.llm import hard_negatives as h
from fathomline.llm.exact_gemm import exact_dot

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """Plain Python; rows (vec_id, vector, label), ids are unique."""
    ints = {}
    for i, x, label in rows:
        if label is not None and i is not None and x is not None and all(c is not None and np.isfinite(c) for c in x):
            ints[i] = ([int(np.floor(256.0 * float(np.float32(c)))) for c in x], (label + 1) % 10 if i % 7 == 0 else label)
    out = []
    for a in (i for i in ints if i % 100 == 0):
        scored = sorted(((-sum(p * q for p, q in zip(ints[a][0], x)), i, label == ints[a][1]) for i, (x, label) in ints.items() if i != a))
        for ps, p, _ in [s for s in scored if s[2]][:5]:
            found = [(-s, i) for s, i, same in scored if not same and 30 * -ps <= 100 * -s <= 90 * -ps][:10]
            out += [(a, p, k + 1, i, -ps, s) for k, (s, i) in enumerate(found)]
    return sorted(out)


def made(n, width, clusters, seed=5):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(clusters, width))
    pick = np.minimum(r.integers(0, clusters * 2, n), clusters - 1)  # half of all rows in one cluster
    x = (centres[pick] + 0.2 * r.normal(size=(n, width))).round(2)
    rows = [(int(i), [float(c) for c in x[i]], int(r.integers(0, 4))) for i in range(n)]
    rows += [(n + k, rows[100][1], k % 3) for k in range(30)]  # copies: equal scores
    rows += [(n + 30, [0.0] * width, 1), (n + 31, None, 1), (n + 32, [None] * width, 1), (n + 33, [float("nan")] * width, 1), (n + 34, rows[0][1], None)]
    return rows


@pytest.mark.parametrize("n, width, clusters", [(700, 6, 5), (500, 24, 2), (300, 2, 1)])
def test_equals_brute_force_over_many_parts(spark, monkeypatch, n, width, clusters):
    monkeypatch.setattr(h, "STRIPE_ROWS", 150)
    monkeypatch.setattr(h, "TILE_ROWS", 16)
    rows = made(n, width, clusters)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert sorted(tuple(r) for r in h.op11_hard_negatives(df).collect()) == brute(rows)


def test_bounds_hold_and_prune():
    r = np.random.default_rng(2)
    x = np.concatenate([np.round(300 * (c + 0.05 * r.normal(size=(200, 8)))) for c in r.normal(size=(6, 8))]).astype(np.int64)
    x[::50] = 0
    refs = h.directions(x[1:400:30])
    norm, angle = h.angles_to(x, refs)
    scores, skipped = exact_dot(x, x), 0
    for at in range(0, len(x), 100):
        t = slice(at, at + 100)
        low, high = h.score_bounds(angle, norm, angle[t].min(axis=0), angle[t].max(axis=0), norm[t].min(), norm[t].max())
        assert (scores[:, t].min(axis=1) >= low).all() and (scores[:, t].max(axis=1) <= high).all()
        skipped += ((high < scores.max() * 0.3) | (low > scores.max() * 0.9)).sum()
    assert skipped > len(x)


def test_windows_are_whole_scores():
    for score in (0, 1, 3, 10, 33, 100, 65543):
        low, high = h.window_of(np.array([score]), 30, 90)
        inside = [s for s in range(score + 1) if 30 * score <= 100 * s <= 90 * score]
        assert list(range(low[0], high[0] + 1)) == inside


def test_first_of_equal_scores():
    scores = np.array([[5, 7, 7, 7, 1], [2, 2, 2, 2, 2]])
    take, last = h.leading(scores, np.array([[True] * 5, [False, True, True, True, True]]), 2)
    assert take.tolist() == [[False, True, True, False, False], [False, True, True, False, False]] and last.tolist() == [7, 2]
    assert h.leading(scores, np.ones((2, 5), dtype=bool), 9)[0].all()


def test_repeated_rows_nulls_and_clashes(spark):
    rows = [(100, [1.0, 0.0], 1), (100, [1.0, 0.0], 1), (1, [0.8, 0.1], 2), (1, [0.8, 0.1], 2), (None, [0.8, 0.1], 2), (None, [1.0, 0.0], 1)]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA + ", row string, score int")
    got = [tuple(r) for r in h.op11_hard_negatives(df).collect()]
    # Each copy of the anchor has the other copy and the row without an id as positives, and each of these the same three negatives.
    assert sorted(got, key=str) == sorted([(100, p, k + 1, i, 65536, 52224) for _ in range(2) for p in (100, None) for k, i in enumerate((1, 1, None))], key=str)


def test_empty(spark):
    for rows in ([], [(100, None, 1)], [(101, [1.0], 1)], [(100, [1.0], None)], [(100, [1.0], 1)]):
        assert h.op11_hard_negatives(spark.createDataFrame(rows, SCHEMA)).collect() == []
