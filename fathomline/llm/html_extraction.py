"""Main text of web pages by consensus host paths.

Each page scores its containers by the running text they hold and names its best ones as
generalised paths (tag and first class, digits removed). The pages of a host vote; the path with
most votes is used to extract all pages of the host again. A page without that path uses its own best.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import col, packed, unpacked
from fathomline.session import cut_lineage

NAMED = 3  # containers a page votes for

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)
    |<(?P<raw>script|style|noscript|template|textarea|title|svg|math|iframe|object)(?=[\s>/])[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)
    |<(?P<close>/?)(?P<tag>[a-z][a-z0-9:-]*+)(?P<attrs>(?:[^<>"']++|"[^"]*+"|'[^']*+')*+|[^>]*+)>""",
    re.S | re.I | re.X,
)
_ATTRIBUTE = re.compile(r"""([a-z][a-z0-9:-]*)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|(?<![\w-])(hidden)(?![\w-])""", re.I)
_SPACES = re.compile(r"\s+")
_PARTS = re.compile(r"[a-z]+", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main menu nav ol p pre search section summary table tbody tfoot thead caption tr ul".split()
)
CELLS = frozenset(("td", "th", "br"))  # parted from what follows by white space
CONTAINERS = frozenset("body article main section div td center blockquote".split())
WHOLE = frozenset(("article", "main"))  # what lies in one of these counts for it
BOILERPLATE_TAGS = frozenset("head nav header footer aside form button select option label menu dialog search fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
BOILERPLATE_WORDS = frozenset(
    "nav navbar navigation menu menubar header masthead topbar footer bottombar sidebar aside rail ad ads adv advert adverts advertisement "
    "advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notification alert popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended recommendations comment comments "
    "commentlist reply replies respond discussion disqus breadcrumb breadcrumbs pagination pager toolbar widget widgets skip copyright "
    "disclaimer search form hidden".split()
)
SHAPE_WORDS = frozenset("with has no without".split())  # "with-sidebar" describes a layout, it is no sidebar
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


@dataclass
class Block:
    text: str
    linked: int  # characters of it inside links
    inside: tuple[int, ...]  # containers around it, the outermost first


@dataclass
class Page:
    paths: list[str] = field(default_factory=list)  # of the containers
    blocks: list[Block] = field(default_factory=list)


def _attributes(source: str) -> dict[str, str]:
    found = {}
    for m in _ATTRIBUTE.finditer(source):
        if m.group(3):
            found.setdefault("hidden", "")
        else:
            found.setdefault(m.group(1).lower(), unescape(m.group(2).strip("\"'")))
    return found


def _is_boilerplate(tag: str, attributes: dict[str, str]) -> bool:
    if tag in BOILERPLATE_TAGS:
        return True
    if not attributes or tag in ("html", "body"):
        return False
    style = attributes.get("style", "").replace(" ", "").lower()
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or "display:none" in style or "visibility:hidden" in style:
        return True
    if attributes.get("role", "").lower() in ROLES:
        return True
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = [w.lower() for w in _PARTS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", name))]
        if not SHAPE_WORDS.intersection(words) and BOILERPLATE_WORDS.intersection(words):
            return tag != "main" and not (tag == "article" and "comment" not in "".join(words))
    return False


def _step(tag: str, attributes: dict[str, str]) -> str:
    first = re.sub(r"\d+", "", (attributes.get("class", "").split() or [""])[0]).strip("-_")
    return f"{tag}.{first}" if first else tag


def parsed(html: str | None) -> Page:
    """The text blocks of a page outside boilerplate, with the containers around them."""
    page = Page()
    html = html or ""
    stack: list[tuple[str, bool, int]] = []  # tag, dropped, container or -1
    around: list[int] = []
    whole = 0  # open elements of WHOLE
    dropped = links = 0
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        text = _SPACES.sub(" ", unescape("".join(parts))).strip() if parts else ""
        if text:
            page.blocks.append(Block(text, linked, tuple(around)))
        parts.clear()
        linked = 0

    def pop() -> None:
        nonlocal dropped, links, whole
        tag, drop, container = stack.pop()
        if tag in BLOCK or container >= 0:
            flush()
        dropped -= drop
        links -= tag == "a"
        whole -= tag in WHOLE
        if container >= 0:
            around.pop()

    def say(text: str) -> None:
        nonlocal linked
        if text and not dropped:
            parts.append(text)
            if links:
                linked += len(text.strip())

    at = 0
    for m in _TAG.finditer(html):
        say(html[at : m.start()])
        at = m.end()
        if m.group("cdata"):
            say(m.group("cdata").replace("&", "&amp;"))
        if not m.group("tag"):
            continue
        tag = m.group("tag").lower()
        if m.group("close"):
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if depth is not None:
                while len(stack) > depth:
                    pop()
            elif tag in BLOCK:
                flush()
            continue
        if tag in CELLS:
            say(" ")
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        attributes = _attributes(m.group("attrs")) if m.group("attrs") else {}
        if tag in BLOCK:
            for i in range(len(stack) - 1, -1, -1):  # an open paragraph ends at the next block
                if stack[i][0] == "p":
                    while len(stack) > i:
                        pop()
                    break
                if stack[i][0] in BLOCK:
                    break
            flush()
        if tag in CLOSED_BY:
            last = len(stack)
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ("ul", "ol", "dl", "table", "select"):
                    break
                if stack[i][0] in CLOSED_BY[tag]:
                    last = i
            while len(stack) > last:
                pop()
        if m.group("attrs").endswith("/") and tag not in BLOCK:
            continue
        drop = _is_boilerplate(tag, attributes)
        container = -1
        if tag in CONTAINERS and not drop and not dropped and not whole:
            up = page.paths[around[-1]] if around else ""
            flush()
            container = len(page.paths)
            page.paths.append(f"{up}>{_step(tag, attributes)}" if up else _step(tag, attributes))
            around.append(container)
        stack.append((tag, drop, container))
        dropped += drop
        links += tag == "a"
        whole += tag in WHOLE
    say(html[at:])
    while stack:
        pop()
    flush()
    return page


def scores(page: Page) -> dict[str, float]:
    """Running text per path: a block counts in full for its container, by half for the next one out, and so on."""
    found: dict[str, float] = {}
    for b in page.blocks:
        weight = max(0, len(b.text) - 2 * b.linked)
        for up, container in enumerate(reversed(b.inside)):
            path = page.paths[container]
            bonus = 3.0 if path.rpartition(">")[2].partition(".")[0] in WHOLE else 1.0
            found[path] = found.get(path, 0.0) + bonus * weight / 2**up
    return found


def votes(html: str | None) -> list[tuple[str, float]]:
    """The page's best paths with their shares of its score."""
    found = scores(parsed(html))
    total = sum(found.values())
    best = sorted(found.items(), key=lambda x: (-x[1], x[0]))[:NAMED]
    return [(path, s / total) for path, s in best if s > 0]


def extracted(html: str | None, path: str | None) -> str:
    """The blocks under the path; under the page's best one if there are none, and all blocks of a page without containers."""
    page = parsed(html)

    def under(p: str | None) -> list[str]:
        return [b.text for b in page.blocks if any(page.paths[c] == p for c in b.inside)]

    got = under(path) if path is not None else []
    if not got and page.paths:
        found = scores(page)
        got = under(min(found, key=lambda p: (-found[p], p))) if found else []
    return "\n".join(got or [b.text for b in page.blocks])


def voter():
    @F.pandas_udf("array<struct<path: string, share: double>>")
    def vote(pages: pd.Series) -> pd.Series:
        return pd.Series([[{"path": p, "share": s} for p, s in votes(h)] for h in pages], dtype=object)

    return vote


def extractor():
    @F.pandas_udf("string")
    def extract_text(pages: pd.Series, paths: pd.Series) -> pd.Series:
        return pd.Series([extracted(h, p) for h, p in zip(pages, paths)], dtype=object)

    return extract_text


def host(url: Column) -> Column:
    """The lower-case host of a URL; a null or odd one is the empty host."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def host_paths(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """(host, path): the path with the largest sum of shares, the first by name of equals.

    A page sends a few short paths, and sums combine on the map side, so a host with a third of all pages costs no more.
    """
    named = pages.select(host(col(url)).alias("host"), F.explode(voter()(col(html))).alias("vote"))
    # Rounded, so that the order in which shares are added cannot decide between paths.
    sums = named.groupBy("host", F.col("vote.path").alias("path")).agg(F.round(F.sum("vote.share"), 6).alias("share"))
    best = sums.groupBy("host").agg(F.min(F.struct((-F.col("share")).alias("share"), "path")).alias("best"))
    return best.select("host", "best.path")


def extract(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """Every row with ``text``. A null or empty page has the empty text, as has one that holds boilerplate only; rows may repeat."""
    winners = cut_lineage(host_paths(pages, html, url)).withColumnRenamed("host", "of")
    rows = packed(pages)
    # One short row per host: sent to all tasks if the written table is small, else both sides are sorted and split where skewed.
    joined = rows.join(winners, host(F.col(f"row.`{url}`")) == F.col("of"), "left")
    done = joined.select("row", extractor()(F.col(f"row.`{html}`"), F.col("path")).alias("text"))
    return unpacked(done, pages.columns, {"text": F.col("text")})


def op4_html_extraction(pages: DataFrame) -> DataFrame:
    found = extract(pages.select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
