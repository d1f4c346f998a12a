import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from conftest import prose
from fathomline.llm import suffix_dedup as s


def brute(rows):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[p : p + s.LENGTH] for t in texts for p in range(len(t) - s.LENGTH + 1))
    out = []
    for (i, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for p in range(len(t) - s.LENGTH + 1):
            if seen[t[p : p + s.LENGTH]] > 1:
                gone[p : p + s.LENGTH] = b"\1" * s.LENGTH
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((str(i), len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def result(df):
    return sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect())


def made():
    r = random.Random(11)
    shared = [prose(1000 + k, 30 + 20 * k) for k in range(5)]
    texts = [None, "", "short", "é" * 200, "é" * 199 + "x", "a" * 399, "a" * 400, "a" * 401, "b" * 3000, "ab" * 900, "x" + "ab" * 700, prose(5, 3000)]
    texts += [prose(1, 60), prose(1, 60), prose(1, 60) + " end", "start " + prose(1, 60)]
    for k in range(40):
        parts = [prose(r.randrange(10**6), r.randrange(1, 60))]
        for _ in range(r.randrange(0, 3)):
            p = r.choice(shared)
            a = r.randrange(0, len(p) // 2)
            parts += [p[a : a + r.randrange(300, 900)], prose(r.randrange(10**6), r.randrange(0, 40))]
        texts.append(" ".join(parts))
    rows = list(enumerate(texts)) + [(None, texts[20]), (3, texts[21]), (25, texts[25])]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("segment", [1 << 20, 150])
def test_removed_bytes_equal_brute_force(docs_of, monkeypatch, segment):
    monkeypatch.setattr(s, "BUCKET_SAMPLES", 20)
    monkeypatch.setattr(s, "BUCKET_WINDOWS", 50)
    rows = made()
    if segment < 1000:  # texts cut into many segments; the functions run in this process
        monkeypatch.setattr(s, "SEGMENT", segment)
        data = s.as_bytes(prose(5, 600))
        low, high, _, _ = s.range_table(data)
        assert low[0] == 0 and high[-1] == len(data) - s.LENGTH and (low[1:] == high[:-1] + 1).all()
        return
    assert result(s.op7_suffix_dedup(docs_of(rows))) == brute(rows)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert result(s.op7_suffix_dedup(docs)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_names_stand_for_content():
    data = s.as_bytes(prose(1, 200) * 2)
    half, full = s.ranks(data)
    text = data.tobytes()
    for names, length in ((half, 200), (full, 400)):
        strings = [text[p : p + length] for p in range(len(names))]
        assert len(set(strings)) == len(set(names.tolist()))
        first = {}
        assert all(first.setdefault(x, n) == n for x, n in zip(strings, names.tolist()))


def test_smallest_takes_the_first_of_equals():
    names = np.array([5, 1, 9, 1, 1, 7, 3], dtype=np.uint64) << np.uint64(24)
    assert s.smallest(names, 3).tolist() == [1, 1, 3, 3, 4]


def test_empty_table(docs_of):
    assert s.repeated_spans(docs_of([])).count() == 0
    assert result(s.op7_suffix_dedup(docs_of([(1, None)]))) == brute([(1, None)])


def brute_passages(rows):
    texts = [t and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t).split() or [] for _, t in rows]
    held = {}
    for n, words in enumerate(texts):
        for p in range(len(words) - s.PASSAGE + 1):
            held.setdefault(tuple(words[p : p + s.PASSAGE]), set()).add(n)
    out = []
    for (i, _), words in zip(rows, texts):
        run = best = 0
        for p in range(len(words) - s.PASSAGE + 1):
            run = run + 1 if len(held[tuple(words[p : p + s.PASSAGE])]) > 1 else 0
            best = max(best, run)
        out.append((str(i), best + s.PASSAGE - 1 if best else 0))
    return sorted(out)


def passages(df):
    return sorted((str(r["doc_id"]), r["longest_shared"]) for r in df.collect())


def test_shared_passages_under_400_bytes(docs_of):
    """A passage of over 50 short words counts, with other white space and case too; what one row alone repeats does not."""
    short = " ".join(f"w{k}" for k in range(60))
    assert len(short) < s.LENGTH
    rows = [(1, f"{prose(1, 80)} {short} {prose(2, 9)}"), (2, f"{prose(3, 30)}\n{short.upper().replace(' ', chr(9))} {prose(4, 80)}")]
    rows += [(3, f"{prose(5, 100)} {prose(6, 9)} {prose(5, 100)}"), (4, " ".join(short.split()[:50])), (5, "a " * 300)]
    got = {r["doc_id"]: (r["longest_shared"], r["n_removed"] > 0) for r in s.op7_suffix_dedup(docs_of(rows)).collect()}
    assert got == {1: (60, False), 2: (60, False), 3: (0, True), 4: (0, False), 5: (0, True)}


def test_shared_passages_equal_brute_force(docs_of, monkeypatch):
    monkeypatch.setattr(s, "BUCKET_SAMPLES", 20)
    monkeypatch.setattr(s, "BUCKET_WINDOWS", 50)
    rows, shared = made(), prose(77, 150).split()
    r = random.Random(5)
    for k in range(60):  # pieces of one passage, also twice in a row
        a, b = r.randrange(0, 90), r.randrange(0, 90)
        pieces = [shared[a : a + r.randrange(45, 75)], shared[b : b + r.randrange(45, 75)]]
        rows.append((100 + k, " ".join([prose(2000 + k, 5), *pieces[0], prose(3000 + k, 7), *pieces[k % 2]])))
    want = brute_passages(rows)
    assert len({n for _, n in want}) > 20
    assert passages(s.op7_suffix_dedup(docs_of(rows))) == want


def test_shared_passages_of_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert passages(s.op7_suffix_dedup(docs)) == brute_passages(rows)
