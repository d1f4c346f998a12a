"""Joins, ranks and running totals give the same rows whether or not keys are hot."""

import pytest
from pyspark.sql import functions as F

from fathomline.operators import skew

COLUMNS = "id int, k string, v double"


@pytest.fixture(scope="module")
def fact(spark):
    # One key holds two thirds of the rows, a few rows have no key.
    rows = [(i, "hot" if i % 3 else (None if i % 12 == 0 else f"k{i % 7}"), float(i % 11)) for i in range(300)]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("k5", 4), ("other", 5), (None, 6)], "key string, x int")


def rows(df):
    return sorted(tuple(str(c) for c in r) for r in df.collect())


def test_hot_keys_are_few_and_found(fact):
    assert len(skew.hot_keys(fact, "k", share=2, min_rows=10)) == 1
    assert skew.hot_keys(fact, "k") == []
    assert len(skew.hot_keys(fact, "k", share=20, min_rows=1)) <= 20


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(fact, dim, how):
    hot = skew.hot_keys(fact, "k", share=20, min_rows=1)
    assert hot
    plain = fact.join(dim.withColumnRenamed("key", "_key"), F.col("k") == F.col("_key"), how).drop("_key")
    spread = skew.spread_join(fact, dim, "k", "key", how, hot=hot, parts=5)
    assert spread.columns == plain.columns
    assert rows(spread) == rows(plain)


def test_spread_join_null_safe(fact, dim):
    hot = skew.hot_keys(fact, "k", share=20, min_rows=1)
    want = fact.join(dim, F.col("k").eqNullSafe(F.col("key")), "left_semi")
    assert rows(skew.spread_join(fact, dim, "k", "key", "left_semi", hot=hot, parts=5, null_safe=True)) == rows(want)


def test_spread_join_needs_equal_types(fact, dim):
    with pytest.raises(TypeError):
        skew.spread_join(fact, dim, "id", "key")


@pytest.mark.parametrize("digits", [1, 4])
@pytest.mark.parametrize("partitions", [1, 7])
def test_hash_rank_is_the_whole_order(fact, digits, partitions):
    ranked = skew.hash_rank(fact.repartition(partitions), "id", 3, ["v"], digits=digits).toPandas()
    import hashlib

    ranked["h"] = [hashlib.md5(f"{i}:3".encode()).hexdigest() for i in ranked["id"]]
    want = ranked.sort_values("h").groupby("v").cumcount() + 1
    assert (ranked["rank"] == want.reindex(ranked.index)).all()


@pytest.mark.parametrize("side", [2, 32])
def test_running_totals(fact, side):
    counts = fact.groupBy("v").agg(F.count("*").alias("n"))
    out = skew.running_totals(counts, "v", ["n"], side=side).toPandas().sort_values("v")
    assert (out["before_n"] == out["n"].cumsum() - out["n"]).all() and len(out) == 11


def test_running_totals_per_group(fact):
    counts = fact.filter("k is not null").groupBy("k", "id").agg(F.count("*").alias("n"))
    out = skew.running_totals(counts, "id", ["n"], ["k"], side=3).toPandas().sort_values("id")
    assert (out["before_n"] == out.groupby("k")["n"].cumsum() - out["n"]).all() and len(out) == fact.filter("k is not null").count()


def test_list_parts_split_large_groups_only(fact):
    parts = skew.list_parts(fact.filter("k is not null"), "k", "id", 50).toPandas()
    assert len(parts) == fact.filter("k is not null").count()
    assert set(parts.loc[parts["k"] != "hot", "part"]) == {0}
    assert set(parts.loc[parts["k"] == "hot", "part"]) == {0, 1, 2, 3}


def test_first_per_key(fact):
    out = skew.first_per_key(fact, ["k"], [F.col("v"), F.col("id")])
    assert out.columns == fact.columns
    want = fact.toPandas().sort_values(["v", "id"]).drop_duplicates("k")
    assert sorted(out.toPandas()["id"]) == sorted(want["id"])
