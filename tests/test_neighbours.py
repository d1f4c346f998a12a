"""Nearest neighbours and synthetic rows against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathomline.operators import neighbours


def brute(v, k):
    d = np.sqrt(((v[:, None, :] - v[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    return np.sort(d, axis=1)[:, :k]


@pytest.mark.parametrize("copies", [0, 120])
def test_knn_equals_brute_force(spark, copies):
    rng = np.random.default_rng(0)
    v = np.concatenate([rng.normal(c, 1.0, (80, 3)) for c in (0, 4, 30)])
    if copies:  # a third of all rows are copies of one point
        v = np.concatenate([v, np.repeat(v[:1], copies, axis=0)])
    df = spark.createDataFrame([(f"p{i:03d}", [float(x) for x in r]) for i, r in enumerate(v)], "id string, v array<double>")
    found = {r["id"]: [x["d"] for x in r["found"]] for r in neighbours.knn(df, 5, cell=20, pivots=6, queries=50).collect()}
    want = brute(v, 5)
    assert len(found) == len(v)
    for i, row in enumerate(want):
        assert np.allclose(found[f"p{i:03d}"], row, atol=1e-9)


def test_smote_rows_lie_between_neighbours(spark):
    rng = np.random.default_rng(1)
    rows = [(f"a{i}", 0, float(x), float(y)) for i, (x, y) in enumerate(rng.normal(0, 1, (60, 2)))]
    small = rng.normal(5, 1, (12, 2))
    rows += [(f"b{i}", 1, float(x), float(y)) for i, (x, y) in enumerate(small)]
    df = spark.createDataFrame(rows, "id string, label int, x double, y double")
    out = neighbours.smote(df, "label", ["x", "y"], "id", k=3).toPandas()
    assert (out["label"] == 1).sum() == 60 and (out["label"] == 0).sum() == 60
    d = np.sqrt(((small[:, None] - small[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    near = np.argsort(d, axis=1)[:, :3]
    for x, y in out.loc[out["synthetic"] == 1, ["x", "y"]].to_numpy():
        p = np.array([x, y])
        gaps = [
            np.linalg.norm(p - small[i]) + np.linalg.norm(p - small[j]) - np.linalg.norm(small[i] - small[j])
            for i in range(12)
            for j in near[i]
        ]
        assert min(gaps) < 1e-9


def test_smote_fills_every_class(spark):
    rows = [(f"a{i}", "a", float(i), 0.0) for i in range(20)] + [(f"b{i}", "b", 100.0 + i, 1.0) for i in range(7)]
    rows += [("c0", "c", 500.0, 2.0), ("n0", None, 9.0, 9.0), ("n1", None, None, 9.0)]
    df = spark.createDataFrame(rows, "id string, label string, x double, y double")
    out = neighbours.smote(df, "label", ["x", "y"], "id", k=3).toPandas()
    assert out.groupby("label").size().to_dict() == {"a": 20, "b": 20, "c": 20} and out["label"].isna().sum() == 2
    assert out["id"].is_unique and len(out) == 62
    b, c = (out[(out["label"] == x) & (out["synthetic"] == 1)] for x in "bc")
    assert b["x"].between(100, 106).all() and (c["x"] == 500).all() and (c["y"] == 2).all()
    assert neighbours.smote(df.limit(0), "label", ["x", "y"], "id").count() == 0
