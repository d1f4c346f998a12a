import hashlib
import re
from collections import defaultdict

from fathomline.llm.exact_dedup import exact_dedup

ROWS = [
    (5, "a b c"), (3, "abc"), (9, "a\tb  c"), (4, None), (8, ""), (2, " \n"), (None, "abc"), (7, "abd"), (7, "abd"), (1, "x" * 50_000),
    (6, "x" * 50_000), (11, "a b"), (12, "ab"), (13, "a\x0b\x0cb"),
]


def brute(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", "", t or "")
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append((i, t))
    out = []
    for n, members in groups.items():
        order = sorted(members, key=lambda m: (-len(m[1] or ""), m[0] is None, m[0] or 0))
        out += [(i, order[0][0], len(members), k == 0, hashlib.sha256(n.encode()).hexdigest()) for k, (i, _) in enumerate(order)]
    return out


def result(df):
    return [tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()]


def test_whole_and_split_groups_equal_brute_force(docs_of):
    for part_rows in (1000, 2, 1):  # small parts force the split path
        got = result(exact_dedup(docs_of(ROWS), part_rows=part_rows))
        assert sorted(map(str, got)) == sorted(map(str, brute(ROWS))), part_rows


def test_large_group_keeps_one(docs_of):
    rows = [(i % 7, "same text" + " " * (i % 3)) for i in range(300)]
    got = result(exact_dedup(docs_of(rows), part_rows=20))
    assert sum(r[3] for r in got) == 1 and {r[1] for r in got} == {0} and {r[2] for r in got} == {300}


def test_empty_table_and_clashing_columns(docs_of):
    out = exact_dedup(docs_of([]))
    assert out.count() == 0 and out.columns.count("kept") == 1 and "row" in out.columns
