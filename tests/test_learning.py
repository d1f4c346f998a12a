"""Sampling and model jobs keep what they promise."""

import pytest
from pyspark.sql import functions as F

from fathomline.operators import clusters, models, news, sampling
from fathomline.sources.fixtures import Bank


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(f"c{i}", int(i % 10 == 0), float(i % 10 == 0) * 3 + i % 4, "ab"[i % 2]) for i in range(200)], "cust_id string, label int, x double, kind string")


def test_undersample_is_balanced_and_disjoint_from_the_rest(rows):
    used = sampling.undersample(rows, "label", "cust_id", 1)
    assert {r["label"]: r["count"] for r in used.groupBy("label").count().collect()} == {0: 20, 1: 20}
    rest = sampling.undersample_rest(rows, "label", "cust_id", 1)
    assert rest.filter("part = 'unused'").join(used, "cust_id").count() == 0 and rest.count() == 200


def test_oversample_reaches_the_majority(rows):
    out = sampling.oversample(rows, "label", "cust_id", 1)
    assert {r["label"]: r["count"] for r in out.groupBy("label").count().collect()} == {0: 180, 1: 180}


@pytest.mark.parametrize("partitions", [1, 6])
def test_folds_keep_class_shares(rows, partitions):
    folds = sampling.kfold(rows.repartition(partitions), "label", 5, "cust_id")
    counts = {(r.fold, r.label): r["count"] for r in folds.groupBy("fold", "label").count().collect()}
    assert counts == {(f, c): n for f in range(5) for c, n in ((0, 36), (1, 4))}


def test_partition_count_does_not_change_a_split(rows):
    a = sampling.split(rows.repartition(1), 0.25, "cust_id", 7).filter("part = 'test'").select("cust_id")
    b = sampling.split(rows.repartition(9), 0.25, "cust_id", 7).filter("part = 'test'").select("cust_id")
    assert sorted(a.collect()) == sorted(b.collect()) and a.count() == 50


def test_grid_search_save_and_load(rows, tmp_path):
    model, table = models.grid_search(rows, models.tree(), {"maxDepth": [1, 4]}, 2)
    assert table.count() == 2 and table.agg(F.max("metric")).first()[0] > 0.9
    models.save_model(model, str(tmp_path / "m"))
    loaded = models.load_model(str(tmp_path / "m"))
    a, b = models.score(model, rows).collect(), models.score(loaded, rows).collect()
    assert sorted(a) == sorted(b)


def test_auc_equals_the_evaluator(rows):
    scored = models.score(models.fit(rows, models.tree(maxDepth=1)), rows)
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    other = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", numBins=0).evaluate(scored)
    assert models.auc_of(scored) == pytest.approx(other)


def test_inertia_falls(rows):
    table = {r.k: r.inertia for r in clusters.elbow(rows, ["x", "label"], (2, 4)).collect()}
    assert table[4] <= table[2]


def test_records_and_titles(spark):
    df = spark.createDataFrame([("{'Title': 'T', 'Text': 'x \"y\"'}",), ("{'Title': 'T', 'Text': 'it's'}",), (None,)], "`Extracted Data` string")
    parsed = news.parse_records(df)
    assert [tuple(r) for r in news.good_records(parsed).select("Title", "Text").collect()] == [("T", 'x "y"')]
    assert tuple(news.record_counts(parsed).first()) == (3, 1, 2)
    pages = spark.createDataFrame(
        [
            ("https://www.cbc.ca/news/1", '<h1 class="detailHeadline">A <b>B</b></h1><h1>no</h1><p>x</p><p class="c">y<i>z</i></p>'),
            ("https://other.org/", "<h1>A</h1>"),
        ],
        "url string, html string",
    )
    out = {r.url: r for r in news.article_text(news.titles(pages)).collect()}
    assert (out["https://www.cbc.ca/news/1"].Title, out["https://www.cbc.ca/news/1"].Text) == ("A B", "x\nyz")
    assert out["https://other.org/"].Title is None


def test_answers_and_matching(spark):
    df = spark.createDataFrame([("l", "t", "Police said John Smith met Ann Lee. The man charged was Ann Lee of Rome City.")], "Link string, Title string, Text string")
    found = news.match_answers(news.answers(news.mentions(df))).first()
    assert found.Criminal == "Ann Lee"


def test_permutation_drop_of_all_columns_in_one_pass(spark):
    import random

    from fathomline.operators.skew import hash_rank

    r = random.Random(3)
    data = [(f"c{i}", r.choice("xyz"), float(r.randrange(10)), r.randrange(50), 0) for i in range(300)]
    data = [(i, s, a, n, int(a + (s == "x") * 3 + r.random() > 6)) for i, s, a, n, _ in data]
    df = spark.createDataFrame(data, "cust_id string, s string, a double, n int, label int")
    model = models.fit(df, models.tree(maxDepth=4))
    got = {x.feature: x.auc_drop for x in models.permutation_drop(model, df).collect()}
    whole = models.auc_of(models.score(model, df))
    assert set(got) == {"s", "a", "n"}
    for c in got:  # one column at a time
        given = hash_rank(df.select("cust_id", c), "cust_id", 2, [], "there").select("there", F.col(c).alias("given"))
        mixed = hash_rank(df, "cust_id", 1, [], "here").join(given, F.col("here") == F.col("there")).withColumn(c, F.col("given"))
        assert got[c] == pytest.approx(whole - models.auc_of(models.score(model, mixed.select(*df.columns))), abs=1e-12)
    assert got["a"] > got["s"] > 0.01


def test_comparisons_have_both_settings(spark):
    """Two settings of three folds each, with one test between them."""
    from fathomline.operators import models

    names = ("setting string", "fold int", "auc double")
    first = spark.createDataFrame([("label", i, 0.7 + i / 100) for i in range(3)], ", ".join(names))
    second = spark.createDataFrame([("one hot", i, 0.8 + i / 50) for i in range(3)], ", ".join(names))
    got = {r["setting"]: r for r in models.compare(first, second).collect()}
    assert {s: r["n"] for s, r in got.items()} == {"label": 3, "one hot": 3}
    assert abs(got["label"]["median"] - 0.71) < 1e-12 and got["label"]["t"] == got["one hot"]["t"] < 0


def test_folds_are_fitted_on_all_cores(rows, monkeypatch):
    """A table that Spark would write as one file is dealt out evenly, so that a fit is not one task."""
    written, cut = [], models.cut_lineage
    monkeypatch.setattr(models, "cut_lineage", lambda df: written.append(cut(df)) or written[-1])
    models.nested_cv(rows, models.tree(), {"maxDepth": [2]}, 2, 2)
    cores = rows.sparkSession.sparkContext.defaultParallelism
    assert len(written) == 3 and all(len(w.inputFiles()) == cores and w.rdd.getNumPartitions() > 1 for w in written)
