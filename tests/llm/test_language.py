import zlib

import pytest

from fathomline.llm import language

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = {r["doc_id"]: r for r in language.op5_language_id(docs).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in out.items())
    held = [i for i, r in out.items() if r["held_out"]]
    assert sum(out[i]["lang_pred"] == truth[i] for i in held) / len(held) > 0.98
    assert all(0 <= r["score"] <= 1 for r in out.values())


def test_odd_texts(docs_of):
    rows = [(i, "the cat sat on the mat and the dog ran to the house", "en") for i in range(9)]
    rows += [(20 + i, "der Hund und die Katze sitzen auf dem Haus und schlafen", "de") for i in range(4)]
    odd = [(100, None), (101, ""), (102, "123 !! 456"), (103, "the dog and the cat " * 5000), (104, "der Hund schlaeft auf dem Haus"), (104, "½²")]
    known = language.fit(docs_of(rows + [(200, None, "xx"), (201, "ohne", None)]))
    assert [k for k, _ in known.known] == ["en", "de"]
    out = language.identify(docs_of(odd), known)
    got = {(r["doc_id"], r["text"]): r for r in out.collect()}
    assert {k: r["lang_pred"] for k, r in got.items()} == {
        (100, None): "und", (101, ""): "und", (102, "123 !! 456"): "und", (103, odd[3][1]): "en", (104, odd[4][1]): "de", (104, "½²"): "und",
    }
    assert all(r["rejected"] == (r["lang_pred"] == "und") for r in got.values())
    assert out.columns.count("found") == 1


@pytest.mark.parametrize("rows", [[], [(1, "text", None)]])
def test_nothing_learned(docs_of, rows):
    known = language.fit(docs_of(rows))
    assert known.known == ()
    assert {r["lang_pred"] for r in language.identify(docs_of([(1, "some text")]), known).collect()} == {"und"}
