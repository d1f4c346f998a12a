from collections import Counter

from fathomline.llm import line_dedup as d

ROWS = [
    (5, "one two three four five\nshort line\nown line of the fifth document"),
    (3, "ONE  two\tthree four FIVE \nshort line\n\nown line of the third document\n"),
    (9, None), (8, ""), (None, "one two three four five"), (4, "own line of the third document"),
    (7, "twice in one document here\n" * 3), (7, "twice in one document here"), (1, "a b c d e " * 20_000), (2, "a b c d e " * 20_000 + "\nx"),
    (6, "ÉÉ ÉÉ ÉÉ ÉÉ ÉÉ"), (10, "éé éé éé éé éé"), (11, "rr rr rr rr rr"), (11, "rr rr rr rr rr"),
]


def brute(rows):
    """Rows of one id have equal rank but for their texts here, so any of them may keep a line: compared as a whole."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    normal = [[" ".join(line.translate(d._LOWER).split()) for line in (text or "").split("\n")] for _, text in order]
    held = Counter(n for norms in normal for n in norms)
    seen, out = set(), []
    for (i, text), norms in zip(order, normal):
        kept, gone, at, run, longest = [], [], 0, 0, 0
        for line, norm in zip((text or "").split("\n"), norms):
            if len(norm.split(" ")) >= d.LEAST_WORDS:
                run = run + len(norm.split(" ")) if held[norm] > 1 else 0
                longest = max(longest, run)
            if len(norm.split(" ")) >= d.LEAST_WORDS and norm in seen:
                gone.append(f"{at}:{at + len(line)}")
            else:
                kept.append(line)
                seen.add(norm)
            at += len(line) + 1
        out.append((i, (text or "").count("\n") + 1, len(gone), ",".join(gone), longest, "\n".join(kept)))
    return out


def test_lines(docs_of):
    got = [tuple(r) for r in d.op9_line_dedup(docs_of(ROWS)).collect()]
    want = brute(ROWS)
    assert Counter(r for r in got if r[0] != 7) == Counter(r for r in want if r[0] != 7)
    # Both rows 7 hold the line; one occurrence of the four stays.
    assert sum(r[2] for r in got if r[0] == 7) == 3 and len([r for r in got if r[0] == 7]) == 2


def test_operator_keeps_columns(docs_of):
    out = d.dedup_lines(docs_of(ROWS))
    assert {"row", "text", "removed", "text_kept", "start"} <= set(out.columns) and out.count() == len(ROWS)
    assert d.dedup_lines(docs_of([])).count() == 0


def test_runs_and_least_words(docs_of):
    """A short line does not break a run, an own line does; the document that keeps the lines has the run too."""
    one, two = "a b c d e f", "g h i j k"
    rows = [(1, f"{one}\n\n{two}\nown line of the first one"), (2, f"{one}\nown line of the second\n{two}"), (3, "x y\nq"), (4, "x y")]
    got = {r["doc_id"]: (r["longest_shared"], len(r["removed"])) for r in d.dedup_lines(docs_of(rows)).collect()}
    assert got == {1: (11, 0), 2: (6, 2), 3: (0, 0), 4: (0, 0)}
    got = {r["doc_id"]: (r["longest_shared"], len(r["removed"])) for r in d.dedup_lines(docs_of(rows), least_words=2).collect()}
    assert got[3] == (2, 0) and got[4] == (2, 1)
