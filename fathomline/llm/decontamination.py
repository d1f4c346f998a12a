"""Benchmark decontamination by pigeonhole edit matching.

An item with an error budget of e edits is split into e + 1 pieces: wherever the item occurs
with at most e edits, one piece occurs unchanged. Documents are searched for all pieces
at once, and every hit is verified with Myers' bit-parallel edit distance around it.
Texts are compared as lower-case words joined by single blanks. Every place within the budget
counts, also one that begins or ends inside a word; the reported span is widened to whole words.
Only items too short for an edit must stand there as whole words: 'cat' is not in 'concatenate'.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType

from fathomline.llm.common import col, packed, unpacked

ERRORS = 0.05  # edits allowed for each character of an item
BLOCK_CHARS = 2_000_000  # item text that one pass over the documents searches for
_WORDS = re.compile(r"\w+")

Hit = tuple[int, int, int, int]  # item, start, end, distance


def plain(text: str | None) -> str:
    return " ".join(_WORDS.findall(text or "")).lower()


def budget(item: str) -> int:
    return int(len(item) * ERRORS)


def split(item: str) -> list[tuple[int, str]]:
    """The item as budget + 1 even pieces with their offsets."""
    n = budget(item) + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def _ends(item: str, window: str, most: int) -> tuple[int, int] | None:
    """(distance, end) of the best place where the item ends in the window, the leftmost of equals; None above ``most``."""
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << len(item)) - 1, 1 << (len(item) - 1)
    up, down, score = full, 0, len(item)
    best = None
    for j, c in enumerate(window):
        eq = masks.get(c, 0)
        x = eq | down
        zero = (((x & up) + up) ^ up) | x
        plus, minus = down | ~(zero | up), up & zero
        score += 1 if plus & top else -1 if minus & top else 0
        plus, minus = plus << 1, minus << 1
        up = (minus | ~(zero | plus)) & full
        down = zero & plus & full
        if score <= most and (best is None or score < best[0]):
            best = (score, j + 1)
    return best


def distance(item: str, window: str, most: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the item in the window with at most ``most`` edits."""
    found = _ends(item, window, most)
    if found is None:
        return None
    errors, end = found
    back = _ends(item[::-1], window[:end][::-1], errors)
    return errors, end - back[1], end


class Items:
    """One block of items with the automaton of their pieces."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = items
        pieces: dict[str, list[tuple[int, int]]] = {}
        for i, (_, text) in enumerate(items):
            for at, piece in split(text):
                pieces.setdefault(piece, []).append((i, at))
        self.automaton = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.automaton.add_word(piece, (len(piece), places))
        if pieces:
            self.automaton.make_automaton()

    def places(self, text: str) -> dict[int, tuple[int, int, int]]:
        """item -> its best (distance, start, end) in a plain text, the leftmost of equals; items without a budget begin and end at words."""
        best: dict[int, tuple[int, int, int]] = {}
        if not self.items:
            return best
        tried: set[tuple[int, int]] = set()
        for last, (length, where) in self.automaton.iter(text):
            for i, at in where:
                item, start = self.items[i][1], last + 1 - length - at
                most = budget(item)
                if i in best and best[i][0] == 0 or (i, start) in tried:
                    continue
                tried.add((i, start))
                if start >= 0 and text.startswith(item, start):
                    found = (0, start, start + len(item))
                else:
                    low = max(0, start - most)
                    found = distance(item, text[low : start + len(item) + most], most)
                    found = found and (found[0], found[1] + low, found[2] + low)
                if found and (most or _whole(text, found[1], found[2])) and (i not in best or found < best[i]):
                    best[i] = found
        return best


def _whole(text: str, start: int, end: int) -> bool:
    return (start == 0 or text[start - 1] == " ") and (end == len(text) or text[end] == " ")


def hits(text: str | None, items: Items) -> list[Hit]:
    """All items in a text; starts and ends are code points of the original text, at whole words."""
    norm = plain(text)
    found = items.places(norm) if norm else {}
    if not found:
        return []
    begins, spans, at = [], [], 0
    for m in _WORDS.finditer(text):
        begins.append(at)
        spans.append(m.span())
        at += len(m.group().lower()) + 1
    out = []
    for i, (errors, start, end) in found.items():
        start += norm[start] == " "
        first, last = bisect_right(begins, start) - 1, bisect_right(begins, end - 1) - 1
        out.append((items.items[i][0], spans[first][0], spans[last][1], errors))
    return sorted(out)


def _searcher(block: list[tuple[int, str]]):
    @F.pandas_udf("array<struct<item: int, start: long, end: long, distance: int>>")
    def search(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        items = Items(block)
        for batch in texts:
            yield pd.Series([[dict(zip(("item", "start", "end", "distance"), h)) for h in hits(t, items)] for t in batch], dtype=object)

    return search.asNondeterministic()  # else a filter on the result searches a second time


def blocks_of(benchmark: DataFrame, text: str = "text", item_id: str = "item_id") -> list[list[tuple[object, str]]]:
    """The stated items (id, plain text) in blocks of at most ``BLOCK_CHARS``, so that what a task holds is bounded.

    Items without a word are never found. Repeated items are searched once per id.
    """
    items = benchmark.select(col(item_id), col(text)).distinct().toLocalIterator()
    blocks: list[list[tuple[object, str]]] = [[]]
    size = 0
    for one, body in items:
        if not (body := plain(body)):
            continue
        if blocks[-1] and size + len(body) > BLOCK_CHARS:
            blocks.append([])
            size = 0
        blocks[-1].append((one, body))
        size += len(body)
    return blocks


def _leaks(block: list[tuple[object, str]], text: Column, id_type: DataType) -> Column:
    hit = _searcher([(i, body) for i, (_, body) in enumerate(block)])(text)
    names = F.array(*[F.lit(one) for one, _ in block]).cast(ArrayType(id_type))
    return F.transform(
        hit, lambda h: F.struct(names[h["item"]].alias("item_id"), h["start"].alias("start"), h["end"].alias("end"), h["distance"].alias("distance"))
    )


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """Every row with ``leaks``: an array of (item_id, start, end, distance), the best place of each item.

    Null and empty texts have none; an empty benchmark gives empty arrays. Rows may repeat. Each block of items is one more
    expression over the same scan.
    """
    ids = benchmark.schema[item_id].dataType
    found = [_leaks(block, F.col(f"row.`{text}`"), benchmark.schema[item_id].dataType) for block in blocks_of(benchmark, item_text, item_id)]
    return unpacked(packed(docs), docs.columns, {"leaks": F.concat(*found)})


def op10_decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item found in it; documents without a leak have no row."""
    found = find_leaks(docs.select("doc_id", "text"), benchmark).filter(F.size("leaks") > 0)
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")
