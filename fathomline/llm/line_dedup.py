"""Substring dedup by line hashing.

A unit is a line of the text. Units are normalised (A-Z in lower case, white space as single blanks) and
their digests are grouped over all documents. The occurrence with the smallest (document, position) stays and
all later ones are removed. Offsets refer to the original text. The row that keeps a unit is marked too: the longest run of
units that also occur elsewhere is counted in words, in every document that holds it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import packed, unpacked
from fathomline.session import cut_lineage

LEAST_WORDS = 5  # default; shorter lines repeat by chance and stay

_SPACE = re.compile(r"[\x20\x09-\x0D]+")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def normal(line: str) -> str:
    return _SPACE.sub(" ", line.translate(_LOWER)).strip(" ")


def units(text: str | None, least_words: int = LEAST_WORDS) -> list[tuple[int, int, int, int, bytes]]:
    """(start, end, ordinal, words, digest) of the lines with ``least_words`` words; code points, the end is exclusive."""
    found, at = [], 0
    for line in (text or "").split("\n"):
        norm = normal(line)
        words = norm.count(" ") + 1
        if words >= least_words:
            found.append((at, at + len(line), len(found), words, blake2b(norm.encode("utf-8", "replace"), digest_size=16).digest()))
        at += len(line) + 1
    return found


def without(text: str | None, starts: set[int]) -> str:
    """The text without the lines that begin at the given places."""
    kept, at = [], 0
    for line in (text or "").split("\n"):
        if at not in starts:
            kept.append(line)
        at += len(line) + 1
    return "\n".join(kept)


def unit_finder(least_words: int = LEAST_WORDS):
    @F.pandas_udf("array<struct<start: long, end: long, ordinal: long, words: long, digest: binary>>")
    def find(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([[dict(zip(("start", "end", "ordinal", "words", "digest"), u)) for u in units(t, least_words)] for t in batch], dtype=object)

    return find


def remover():
    @F.pandas_udf("string")
    def remove(texts: pd.Series, starts: pd.Series) -> pd.Series:
        return pd.Series([without(t, set() if s is None else set(s)) for t, s in zip(texts, starts)], dtype=object)

    return remove


def longest_run(shared: Column) -> Column:
    """Most words in a run of units with consecutive ordinals; 0 without units."""
    zero = F.lit(0).cast("long")
    start = F.struct(F.lit(-2).cast("long").alias("last"), zero.alias("run"), zero.alias("best"))

    def step(acc: Column, u: Column) -> Column:
        run = u["words"] + F.when(u["ordinal"] == acc["last"] + 1, acc["run"]).otherwise(zero)
        return F.struct(u["ordinal"].alias("last"), run.alias("run"), F.greatest(acc["best"], run).alias("best"))

    return F.coalesce(F.aggregate(shared, start, step, lambda acc: acc["best"]), zero)


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least_words: int = LEAST_WORDS) -> DataFrame:
    """Every row with ``n_units, removed`` (array of start, end), ``longest_shared`` and ``text_kept``.

    ``longest_shared`` is the number of words in the longest run of lines that each occur more than once, the kept
    occurrence included; lines of fewer than ``least_words`` words neither count nor break a run. Texts of any length are
    read whole; an empty table gives an empty one; an input column with the name of an added one is replaced.

    Null counts as the empty text, which has one unit without words. Null ids rank last; rows with one id
    rank by a row number that is written down once, so of repeated rows one keeps its lines. Within a document the first of
    equal lines stays. A line in a third of all documents is one partial minimum per task, not a group in memory.
    """
    base = cut_lineage(packed(docs).withColumn("number", F.monotonically_increasing_id()))
    row_id = F.col(f"row.`{doc_id}`")
    found = base.select("number", row_id.alias("id"), F.explode(unit_finder(least_words)(F.col(f"row.`{text}`"))).alias("unit"))
    all_units = cut_lineage(found.select("number", "id", "unit.*"))
    place = F.struct(F.col("id").isNull().alias("none"), "id", "number", "start")
    repeated = cut_lineage(
        all_units.groupBy("digest")
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .select("digest", F.col("first.number").alias("first_number"), F.col("first.start").alias("first_start"))
    )
    shared = all_units.join(repeated, "digest")
    later = (F.col("number") != F.col("first_number")) | (F.col("start") != F.col("first_start"))
    held = F.struct("start", "end", "ordinal", "words", later.alias("later"))
    spans = shared.groupBy("number").agg(F.sort_array(F.collect_list(held)).alias("shared"))  # lines of one document
    spans = spans.select(
        "number",
        F.transform(F.filter("shared", lambda u: u["later"]), lambda u: F.struct(u["start"].alias("start"), u["end"].alias("end"))).alias("removed"),
        longest_run(F.col("shared")).alias("longest_shared"),
    )
    joined = base.join(spans, "number", "left")
    removed = F.coalesce("removed", F.array().cast("array<struct<start: bigint, end: bigint>>"))
    lines = F.length(F.coalesce(F.col(f"row.`{text}`"), F.lit(""))) - F.length(F.replace(F.coalesce(F.col(f"row.`{text}`"), F.lit("")), F.lit("\n"))) + 1
    kept = remover()(F.col(f"row.`{text}`"), F.transform(removed, lambda s: s["start"]))
    return unpacked(joined, docs.columns, {"n_units": lines.cast("long"), "removed": removed, "longest_shared": F.coalesce("longest_shared", F.lit(0).cast("long")), "text_kept": kept})


def op9_line_dedup(docs: DataFrame) -> DataFrame:
    """Per document its lines, the removed ones, the longest shared run in words and the text that is left."""
    found = dedup_lines(docs.select("doc_id", "text"))
    spans = F.array_join(F.transform("removed", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select("doc_id", "n_units", F.size("removed").cast("long").alias("n_removed"), spans.alias("removed"), "longest_shared", F.col("text_kept").alias("text"))


OP9_SQL = r"""
with lines as (
  select doc_id, unnest(parts) as line, unnest(range(1, len(parts) + 1)) as pos
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents)),
placed as (
  select *, sum(length(line) + 1) over (partition by doc_id order by pos) - length(line) - 1 as place,
         trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') as norm
  from lines),
ranked as (
  select *, words >= 5 as counts, words >= 5 and row_number() over (partition by norm order by doc_id, pos) > 1 as gone,
            words >= 5 and count(*) over (partition by norm) > 1 as shared
  from (select *, length(norm) - length(replace(norm, ' ', '')) + 1 as words from placed)),
runs as (
  select doc_id, max(n) as longest from (
    select doc_id, run, sum(words) as n from (
      select *, sum(case when shared then 0 else 1 end) over (partition by doc_id order by pos) as run from ranked where counts)
    where shared group by 1, 2) group by 1)
select r.doc_id, count(*) as n_units, count(*) filter (where gone) as n_removed,
       coalesce(string_agg(place || ':' || (place + length(line)), ',' order by pos) filter (where gone), '') as removed,
       coalesce(max(u.longest), 0)::bigint as longest_shared,
       coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '') as text
from ranked r left join runs u on u.doc_id = r.doc_id group by r.doc_id
"""
