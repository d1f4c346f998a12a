"""Secret scans: fixed patterns, and strings that a primed zstandard encoder cannot shorten.

Every string of key characters near a sensitive word, on either side and over line breaks, is
measured by the bytes it adds to its surroundings when both are encoded with a dictionary of
identifiers: as it stands, and folded to the words it is made of. Words and identifiers repeat what
the dictionary or the surroundings hold; key material does not. The sizes alone decide.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import packed, unpacked

KINDS = ("assign", "access", "hex", "novel")  # in the order of the listing

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?((?-i:[A-Za-z0-9+/_.=-]+))""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of 24 or more is always taken whole
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

SENSITIVE = re.compile(
    r"pass(?:word|wd|phrase|code)|pwd|secret|token|credential|bearer|authorization|signature|(?:api|access|private|secret|auth|signing|encryption)[ _-]?key",
    re.I | re.A,
)
LEAST = 8  # characters of a string; shorter ones add too few bytes to be told from words
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")  # a run is always taken whole
REACH = 64  # characters between a sensitive word and a string in its context
AROUND = 256  # characters before and after that count as surroundings
ADDED = 13  # bytes a reported string adds at least
RATE, FOLDED_RATE = 0.9, 0.8  # added bytes for each character, as it stands and folded
LEVEL = 19

_FOLD = re.compile(r"(?<=[a-z])(?=[A-Z])|[^A-Za-z0-9+]+")

IDENTIFIERS = (
    "access account action address admin api application args array auth base batch begin body bool boolean buffer build byte cache call "
    "callback char check class client code collection column command comment commit config connection const content context control copy "
    "count create credential current data database date debug decode default define delete description destination device dictionary "
    "directory disable document domain double element else email enable encode end endpoint entity entry enum error event example "
    "exception execute export expression extends false field file filter final find first float folder format function generate get group "
    "handle handler hash header height hidden host html http https id identifier if image import index info init input insert instance "
    "int integer interface internal is item iterator javascript json key label last length level library limit line link list load local "
    "location lock log login main manager map match max memory message method min mode model module name namespace new next node none "
    "null number object offset open option order output override package page param parent parse password path pattern payload placeholder "
    "policy port position prefix print private process profile project property protected provider public query queue random range "
    "read record reference register release remove replace request reset resource response result return role root route row run "
    "sample save schema scope script search secret section select self send server service session set setting size sort source start "
    "state static status storage store stream string struct style switch system table tag target task template test text this thread "
    "time timeout title token total trace true type undefined update upload url user username utf8 util uuid valid value variable "
    "vector version view void volume warning width window worker write xml year "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 00000000 xxxxxxxx ffffffff 20240101 "
)

Span = tuple[str, int, int, float]


def base_spans(text: str) -> list[Span]:
    found = [("assign", m.start(), m.end(), 1.0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    found += [("access", m.start(), m.end(), 1.0) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    return found + [("hex", m.start(), m.end(), 1.0) for m in HEX.finditer(text)]


def encoder() -> zstandard.ZstdCompressor:
    primed = zstandard.ZstdCompressionDict((IDENTIFIERS + " ").encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    primed.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=primed, write_content_size=False)


def folded(string: str) -> str:
    """The words of an identifier in lower case, with blanks between them."""
    return _FOLD.sub(" ", string).lower()


def added_bytes(before: str, string: str, after: str, primed: zstandard.ZstdCompressor) -> tuple[int, int]:
    """Bytes that a string adds to its surroundings, as it stands and folded."""

    def size(middle: str) -> int:
        return len(primed.compress((before + middle + after).encode("utf-8", "replace")))

    alone = size("  ")
    return size(f" {string} ") - alone, size(f" {folded(string)} ") - alone


def novel_spans(text: str, taken: list[Span], primed: zstandard.ZstdCompressor) -> list[Span]:
    """Strings near sensitive words that overlap no base span and that the encoder cannot shorten. Linear in the text."""
    words = [m.span() for m in SENSITIVE.finditer(text)]
    if not words:
        return []
    starts = [s for s, _ in words]
    covered: list[list[int]] = []  # base spans, overlapping ones joined
    for s, e in sorted((s, e) for _, s, e, _ in taken):
        if covered and s < covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], e)
        else:
            covered.append([s, e])
    found, near = [], 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        word = bisect_right(starts, end + REACH) - 1  # the last one that begins in reach
        if word < 0 or words[word][1] < start - REACH:
            continue
        while near < len(covered) and covered[near][1] <= start:
            near += 1
        if near < len(covered) and covered[near][0] < end:
            continue
        plain, fold = added_bytes(text[max(0, start - AROUND) : start], m.group(), text[end : end + AROUND], primed)
        if min(plain, fold) >= ADDED and plain >= RATE * (end - start) and fold >= FOLDED_RATE * (end - start):
            found.append(("novel", start, end, plain / (end - start)))
    return found


def spans(text: str | None, primed: zstandard.ZstdCompressor) -> list[Span]:
    """All spans of a text by start, then by kind; starts and ends count code points."""
    base = base_spans(text or "")
    return sorted(base + novel_spans(text or "", base, primed), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scanner():
    @F.pandas_udf("array<struct<kind: string, start: long, end: long, added: double>>")
    def scan(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        primed = encoder()
        for batch in texts:
            yield pd.Series([[dict(zip(("kind", "start", "end", "added"), s)) for s in spans(t, primed)] for t in batch], dtype=object)

    return scan


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row with ``secrets``: an array of (kind, start, end, added), empty for null and empty texts.

    Texts of any length are read whole; only the surroundings of a string are encoded, so the work grows with the length. Repeated
    rows are scanned each on its own; an input column named ``secrets`` is replaced, other columns may have any names. An
    empty table gives an empty one.
    """
    scanned = packed(docs).select("row", scanner()(F.col(f"row.`{text}`")).alias("secrets"))
    return unpacked(scanned, docs.columns, {"secrets": F.col("secrets")})


def op1_secret_scan(docs: DataFrame) -> DataFrame:
    """Per document the numbers and digest of the base spans and all spans; null and empty texts have none."""
    found = find_secrets(docs.select("doc_id", "text")).select("doc_id", "secrets")

    def n(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(s):
        return F.array_join(F.transform(s, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("secrets", lambda s: s["kind"] != "novel")
    return found.select(
        "doc_id", n("assign"), n("access"), n("hex"), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"), n("novel"),
    )
