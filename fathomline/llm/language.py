"""Language identification by compression.

Every language gets a zstandard raw-content dictionary from a bounded sample of labelled
texts. A text is reduced to lower-case letters, cut into pieces, and every piece is
encoded with each dictionary; the language with the fewest bytes over the whole text wins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from math import exp

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import col, packed, unpacked

SAMPLE_TEXTS = 256  # labelled texts per language at most
SAMPLE_CHARS = 300  # of each
DICTIONARY_BYTES = 64_000
PIECE_BYTES = 2048
LEVEL = 6
NARROW = 0.002  # share of the second best size by which the best must be smaller
UNKNOWN = "und"

_NO_LETTERS = re.compile(r"[\W\d_]+")
_LEAD = b" " * 64  # the same for all; makes the encoder use the dictionary for very short texts too


@dataclass(frozen=True)
class Languages:
    """(language, dictionary), the most frequent language first, so that it wins ties."""

    known: tuple[tuple[str, bytes], ...]


def letters(text: str | None) -> str:
    return _NO_LETTERS.sub(" ", (text or "").lower()).strip()


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Languages:
    """Dictionaries from rows with a language; null and blank texts teach nothing.

    The sample is bounded by ``SAMPLE_TEXTS`` and ``SAMPLE_CHARS`` per language and
    is drawn by hash from all rows: a coarse draw by the number of rows, then the smallest hash of each slot.
    """
    rows = labelled.filter(col(lang).isNotNull()).select(
        col(lang).alias("lang"), F.xxhash64(col(doc_id)).alias("draw"), F.coalesce(col(text), F.lit("")).alias("text")
    )
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return Languages(())
    step = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, max(1, n // (16 * SAMPLE_TEXTS)))])[F.col("lang")]
    slot = F.pmod(F.shiftright("draw", 20), F.lit(SAMPLE_TEXTS))
    first = (
        rows.filter(F.pmod(F.col("draw"), step) == 0)
        .groupBy("lang", slot.alias("slot"))
        .agg(F.min(F.struct("draw", F.substring("text", 1, SAMPLE_CHARS).alias("text"))).alias("first"))
        .select("lang", "first.draw", "first.text")
        .collect()
    )
    texts: dict[str, list[str]] = {}
    for r in sorted(first, key=lambda r: (r["draw"], r["text"])):
        if got := letters(r["text"]):
            texts.setdefault(r["lang"], []).append(got)
    order = sorted(texts, key=lambda k: (-counts[k], k))
    return Languages(tuple((k, " ".join(texts[k]).encode()[:DICTIONARY_BYTES]) for k in order))


def _encoders(languages: Languages) -> list[tuple[str, zstandard.ZstdCompressor]]:
    out = []
    for name, content in languages.known:
        primed = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primed.precompute_compress(level=LEVEL)
        options = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        out.append((name, zstandard.ZstdCompressor(level=LEVEL, dict_data=primed, **options)))
    return out


def judge(text: str | None, encoders: list[tuple[str, zstandard.ZstdCompressor]]) -> tuple[str, float, float]:
    """(language, score, margin) of one text."""
    plain = letters(text)
    if not encoders or not any(map(str.isalpha, plain)):
        return UNKNOWN, 0.0, 0.0
    data = plain.encode("utf-8", "replace")
    pieces = [_LEAD + data[i : i + PIECE_BYTES] for i in range(0, len(data), PIECE_BYTES)]
    sizes = [sum(len(e.compress(p)) for p in pieces) for _, e in encoders]
    best = min(range(len(sizes)), key=lambda i: (sizes[i], i))
    rest = sizes[:best] + sizes[best + 1 :]
    score = 1 / sum(exp(-(s - sizes[best]) / 2) for s in sizes)
    margin = (min(rest) - sizes[best]) / min(rest) if rest else 1.0
    return encoders[best][0], score, margin


def classifier(languages: Languages):
    @F.pandas_udf("lang string, score double, margin double")
    def classify(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoders = _encoders(languages)
        for batch in texts:
            yield pd.DataFrame([judge(t, encoders) for t in batch], columns=["lang", "score", "margin"])

    return classify


def identify(docs: DataFrame, languages: Languages, text: str = "text") -> DataFrame:
    """Every row with ``lang_pred, score, margin, rejected``.

    A text without a letter (also null or empty) is ``und`` with score 0 and is rejected, as is one whose two best sizes are
    closer than ``NARROW``. Ties go to the language with more labelled rows. Without labelled rows everything is ``und``.
    """
    named = packed(docs).select("row", classifier(languages)(F.col(f"row.`{text}`")).alias("found"))
    unsure = (F.col("found.lang") == UNKNOWN) | (F.col("found.margin") < NARROW)
    return unpacked(
        named,
        docs.columns,
        {"lang_pred": F.col("found.lang"), "score": F.col("found.score"), "margin": F.col("found.margin"), "rejected": unsure},
    )


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op5_language_id(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", "text", "lang")
    languages = fit(rows.filter(~is_held_out(F.col("doc_id"))))
    found = identify(rows.select("doc_id", "text"), languages)
    return found.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
