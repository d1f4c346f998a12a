import corpus_pipeline
from conftest import prose
from fathomline.llm import decontamination, mixing

TABLES = "doc_id long, text string, lang string, source string, n_chars long"


def folder_of(spark, tmp_path, rows, items):
    spark.createDataFrame(rows, TABLES).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id int, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_each_stage_takes_effect(spark, tmp_path):
    item = prose(900, 25)
    near = prose(1, 200)
    rows = [(i, prose(i, 80), "en", "a") for i in range(20, 40)]
    rows += [(1, near, "en", "b"), (2, near + " tail", "en", "b"), (3, near.replace(" ", "  "), "en", "b"), (4, prose(2, 50) + " " + item, "en", "a")]
    rows += [(5, "123 !!", "en", "a"), (6, None, None, None), (None, prose(3, 40), None, None), (1, near, "en", "b"), (60, prose(60, 9000), "en", "b")]
    folder = folder_of(spark, tmp_path, [(*r, len(r[1] or "")) for r in rows], [(0, item)])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        ids[name] = [r["doc_id"] for r in docs.select("doc_id").collect()]
    clean = {*range(20, 40), 60, None}
    assert set(ids["language"]) == clean | {1, 2, 3, 4}
    assert set(ids["exact_dedup"]) == clean | {2, 3, 4}  # of 1, 1 and 3 the longest text stays
    assert sorted(ids["ngram_join"], key=str) == sorted(clean | {2, 4}, key=str)
    assert set(ids["decontamination"]) == clean | {2}
    out = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in out} == clean | {2} and all(r["taken"] <= 2 * r["size"] for r in out)


def test_empty_tables(spark, tmp_path):
    folder = folder_of(spark, tmp_path, [], [])
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_run_on_given_tables(spark):
    folder = "/root/testdata/sf0.001"
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, folder).collect()}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    items = [decontamination.plain(r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert len({"".join(texts[i].split()) for i in out}) == len(out)
    assert not any(item in decontamination.plain(texts[i]) for i in out for item in items)
    assert all(r["size"] == len(texts[i].split()) for i, r in out.items())
    assert mixing.BLOCK * 2 > abs(sum(r["taken"] for r in out.values()) - 1.5 * sum(r["size"] for r in out.values())) / 20
