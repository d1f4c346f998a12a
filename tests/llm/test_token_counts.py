from collections import Counter

from conftest import prose
from fathomline.llm import token_counts as t

ROWS = [(1, prose(1, 50), "en", "a"), (2, prose(2, 30), "en", "a"), (3, None, None, None), (4, "", "de", "a"), (None, "x  y\n\nz", None, "b"), (1, prose(1, 50), "en", "a"), (9, "w " * 30_000, "de", None)]


def totals(ledger):
    return {(r["source"], r["lang"], r["tokenizer"]): (r["docs"], r["tokens"]) for r in ledger.totals().collect()}


def brute(rows, version=t.VERSION):
    encoder = t.encoding(t.VOCABULARY)
    docs, tokens = Counter(), Counter()
    for _, text, lang, source in rows:
        docs[(source, lang, version)] += 1
        tokens[(source, lang, version)] += len(encoder.encode_ordinary(text or ""))
    return {k: (docs[k], tokens[k]) for k in docs}


def test_batches_add_up_and_repeat_without_effect(docs_of, spark, tmp_path):
    ledger = t.Ledger(spark, f"file://{tmp_path}/ledger")
    assert totals(ledger) == {}
    old = t.counted(docs_of(ROWS, extra=False))
    assert ledger.commit("load", t.inserts(old)) and not ledger.commit("load", t.inserts(old))
    assert totals(ledger) == brute(ROWS)
    # Deleting one row, then counting another anew with a changed text, language and tokenizer version.
    assert ledger.commit("gone", t.deletes(t.counted(docs_of(ROWS[1:2], extra=False))))
    changed = [(2, "new text", "fr", "a")]
    new = t.counted(docs_of(changed, extra=False), version="v2")
    assert ledger.commit("revised", t.revisions(t.counted(docs_of(ROWS[3:4], extra=False)), new))
    want = brute(ROWS[:1] + ROWS[2:3] + ROWS[4:]) | brute(changed, "v2")
    assert totals(ledger) == want
    # A write that was cut off has no marker: it does not count, and its batch can be committed.
    (tmp_path / "ledger" / "cut").mkdir()
    assert "cut" not in ledger.batches() and totals(ledger) == want
    assert ledger.commit("cut", t.deletes(new))
    assert totals(ledger) == brute(ROWS[:1] + ROWS[2:3] + ROWS[4:])


def test_query(docs_of):
    got = {(r["source"], r["lang"], r["tokenizer"]): (r["docs"], r["tokens"]) for r in t.op2_token_counts(docs_of(ROWS)).collect()}
    assert got == brute(ROWS)
    assert t.op2_token_counts(docs_of([])).count() == 0
