import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import prose
from fathomline.llm import decontamination as d


def edit_in_text(item, text):
    """Least edits of the item against any part of the text, by the table."""
    last = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        now = [i]
        for j, b in enumerate(text, 1):
            now.append(min(last[j] + 1, now[j - 1] + 1, last[j - 1] + (a != b)))
        last = now
    return min(last)


@settings(max_examples=200, deadline=None)
@given(st.text("abc ", min_size=1, max_size=20), st.text("abc ", max_size=40))
def test_distance_is_the_tables(item, text):
    want = edit_in_text(item, text)
    got = d.distance(item, text, len(item))
    if text:
        assert got[0] == want and edit_in_text(item, text[got[1] : got[2]]) == want
    assert d.distance(item, text, want - 1) is None


@pytest.fixture
def benchmark(spark):
    rows = [(1, prose(1, 30)), (2, prose(2, 12)), (3, None), (4, ""), (5, "!!"), (1, prose(1, 30)), (None, prose(6, 20))]
    return spark.createDataFrame(rows, "item_id int, text string")


def test_edited_items_are_found_and_others_not(docs_of, benchmark):
    r = random.Random(3)
    items = {1: prose(1, 30), 2: prose(2, 12), None: prose(6, 20)}
    texts = [None, "", items[1], items[1].upper().replace(" ", " !!  "), prose(50, 100) + " " + items[2] + "\n" + prose(51, 3000)]
    for _ in range(40):
        key = r.choice(list(items))
        words = list(items[key])
        for _ in range(r.randrange(0, int(len(words) * 0.12))):
            at = r.randrange(len(words))
            words[at] = r.choice(["", "z", words[at] + "q"])
        texts.append(prose(r.randrange(1000), 20) + " " + "".join(words) + " " + prose(r.randrange(1000), 20))
    out = d.find_leaks(docs_of(list(enumerate(texts))), benchmark).collect()
    for row in out:
        plain = d.plain(row["text"])
        want = {}
        for key, item in items.items():
            errors = edit_in_text(d.plain(item), plain)
            if errors <= d.budget(d.plain(item)):
                want[key] = errors
        got = {x["item_id"]: x["distance"] for x in row["leaks"]}
        # A best place inside words is moved to whole words, so a distance may be larger, and one at the limit may go.
        assert set(got) <= set(want) and all(got[k] >= want[k] for k in got)
        assert {k for k, e in want.items() if e <= d.budget(d.plain(items[k])) - 2} <= set(got)
    whole = {r["doc_id"]: r["leaks"] for r in out}
    assert (whole[2][0]["start"], whole[2][0]["end"], whole[2][0]["distance"]) == (0, len(texts[2]), 0)
    assert whole[3][0]["distance"] == 0 and whole[4][0]["item_id"] == 2 and whole[0] == []


def test_every_item_within_the_budget_is_found():
    r = random.Random(7)
    item = "the quick brown fox jumps over the lazy dog"
    assert d.budget(item) == 2
    edited = [item + "s", "x" + item, item[:-1] + "x", "x" + item[1:], item[1:], item[:-1], "x" + item + "s", "xx" + item[2:], item[:-2] + "xx"]
    for long in (prose(8, 25), prose(9, 40)):
        for _ in range(150):
            letters = list(long)
            for _ in range(r.randrange(1, d.budget(long) + 2)):
                at = r.choice([0, len(letters) - 1, r.randrange(len(letters))])
                letters[at] = r.choice(["", "z", letters[at] + "q", "q" + letters[at]])
                letters = list("".join(letters))
            edited.append("".join(letters))
    items = d.Items(list(enumerate([item, prose(8, 25), prose(9, 40)])))
    for one in edited:
        for text in (one, f"some {one} more", f"some{one}more"):
            want = {i: e for i, body in items.items if (e := edit_in_text(body, d.plain(text))) <= d.budget(body)}
            found = d.hits(text, items)
            assert {i: e for i, _, _, e in found} == want, text
            for _, start, end, _ in found:
                assert (start == 0 or text[start - 1] == " ") and (end == len(text) or text[end] == " ") and text[start] != " "


def test_items_without_a_budget_are_whole_words():
    items = d.Items([(0, "cat"), (1, "a dog")])
    assert d.hits("concatenate a dogma", items) == []
    assert d.hits("concatenate Cat, a  dog", items) == [(0, 12, 15, 0), (1, 17, 23, 0)]


def test_empty_tables(docs_of, benchmark, spark):
    assert d.find_leaks(docs_of([]), benchmark).count() == 0
    none = spark.createDataFrame([], "item_id int, text string")
    assert [r["leaks"] for r in d.find_leaks(docs_of([(1, "a b")]), none).collect()] == [[]]
    assert d.op10_decontamination(docs_of([(1, prose(1, 30))] * 2), benchmark).count() == 2


def test_blocks_give_the_same(docs_of, benchmark, monkeypatch):
    docs = docs_of([(1, prose(1, 30)), (2, prose(2, 12))])
    one = sorted(map(str, d.op10_decontamination(docs, benchmark).collect()))
    monkeypatch.setattr(d, "BLOCK_CHARS", 10)
    assert sorted(map(str, d.op10_decontamination(docs, benchmark).collect())) == one
