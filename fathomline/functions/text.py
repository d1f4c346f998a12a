"""Text expressions: tokens, names and markup. All stay inside the JVM."""

from __future__ import annotations

import re
from html.entities import name2codepoint
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fathomline.sources.lookups import NAME_PREFIXES

PUNCTUATION = r"[!-/:-@\[-`{-~]"  # the ASCII punctuation ranges
PERSON = r"[A-Z][a-z]+(?: [A-Z][a-z]+)+"  # two or more capitalised words


def tokens_clean(text: Column) -> Column:
    """Words of a message without ASCII punctuation, in lower case."""
    return F.filter(F.split(F.lower(F.regexp_replace(text, PUNCTUATION, "")), r"\s+"), lambda w: w != "")


def tokens_plain(text: Column) -> Column:
    """Words in lower case, punctuation kept; no message gives no words."""
    words = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")
    return F.coalesce(words, F.array().cast("array<string>"))


def flatten_tokens(lists: Column) -> Column:
    """One list of words out of a list of word lists, without nulls."""
    present = F.filter(lists, lambda x: x.isNotNull())
    return F.coalesce(F.filter(F.flatten(present), lambda w: w.isNotNull()), F.array().cast("array<string>"))


def count_words(words: Column, wanted: Sequence[str]) -> Column:
    """How many words are in the list, repeats counted."""
    return F.size(F.filter(words, lambda w: w.isin(list(wanted)))).cast("long")


def norm_name(name: Column) -> Column:
    """Upper case without one leading title."""
    titles = "|".join(re.escape(p) for p in NAME_PREFIXES)
    upper = F.upper(name)
    return F.when(upper.rlike(f"^({titles})"), F.trim(F.regexp_replace(upper, f"^({titles})", ""))).otherwise(upper)


def split_and(text: Column) -> Column:
    """Parts around " and " when the text mentions "and ", else the text alone."""
    return F.when(text.contains("and "), F.split(text, " and ")).otherwise(F.array(text))


def fold_names(names: Column) -> Column:
    """Keep the first of names that contain one another, in order of appearance."""

    def absorb(kept: Column, name: Column) -> Column:
        known = F.exists(kept, lambda k: k.contains(name) | name.contains(k))
        return F.when(known, kept).otherwise(F.concat(kept, F.array(name)))

    return F.aggregate(names, F.array().cast("array<string>"), absorb)


def name_with_answer(names: Column, answers: Column) -> Column:
    """First name that contains one of the answers."""
    return F.try_element_at(F.filter(names, lambda n: (n != "") & F.exists(answers, lambda a: n.contains(a))), F.lit(1))


def answer_in_name(name: Column, answers: Column) -> Column:
    """First answer the name contains."""
    return F.try_element_at(F.filter(answers, lambda a: name.contains(a)), F.lit(1))


def cut_after(name: Column, answer: Column) -> Column:
    """The name up to the end of the answer; an empty answer leaves the first character."""
    end = F.call_function("instr", name, answer) + F.greatest(F.length(answer), F.lit(1)) - 1
    return F.substring(name, F.lit(1), end)


def first_containing(names: Column, answers: Column) -> Column:
    """First name that contains an answer, cut after the first such answer; null if none does."""
    name = name_with_answer(names, answers)
    return cut_after(name, answer_in_name(name, answers))


def person_mentions(text: Column, pattern: str = PERSON) -> Column:
    """Runs of capitalised words, in order."""
    return F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))


_REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"


def decode_references(text: Column) -> Column:
    """Character references as characters, each once; unknown ones stay."""
    named = F.create_map(*[F.lit(x) for name, code in sorted(name2codepoint.items()) for x in (name, chr(code))], F.lit("apos"), F.lit("'"))

    def decoded(ref: Column) -> Column:
        name = F.substring(ref, F.lit(2), F.length(ref) - 2)
        hexed = F.lower(F.substring(name, 2, 1)) == "x"
        number = F.when(hexed, F.conv(F.substring(name, F.lit(3), F.length(name)), 16, 10)).otherwise(F.substring(name, F.lit(2), F.length(name)))
        number = number.cast("long")
        legal = (number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        return F.coalesce(F.when(name.startswith("#"), F.when(legal, char)).otherwise(F.try_element_at(named, name)), ref)

    parts = F.split(text, _REFERENCE, -1)
    found = F.transform(F.regexp_extract_all(text, F.lit(f"({_REFERENCE})"), F.lit(1)), decoded)
    return F.array_join(F.zip_with(parts, found, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")


def strip_tags(html: Column) -> Column:
    return decode_references(F.regexp_replace(html, r"(?s)<.*?>", ""))


def title_case(text: Column) -> Column:
    """A capital at the start of every run of letters, small letters in the rest."""
    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def paragraphs(html: Column) -> Column:
    """Text of all p elements, one per line; an unclosed p runs to the next closing tag."""
    found = F.regexp_extract_all(html, F.lit(r"(?is)<p(?:\s[^>]*)?>(.*?)</p\s*>"), F.lit(1))
    return F.array_join(F.transform(found, strip_tags), "\n")


def headline(html: Column, css_class: str = "") -> Column:
    """Text of the h1 elements with this class among theirs (any h1 if empty), one per line."""
    name = re.escape(css_class)
    quoted = "|".join(rf"{q}(?:[^{q}]*\s)?{name}(?:\s[^{q}]*)?{q}" for q in ('"', "'"))
    attrs = rf"\s(?:[^>]*\s)?class\s*=\s*(?:{quoted}|{name}(?=[\s>]))[^>]*" if css_class else r"(?:\s[^>]*)?"
    found = F.regexp_extract_all(html, F.lit(rf"(?is)<h1{attrs}>(.*?)</h1\s*>"), F.lit(1))
    return F.array_join(F.transform(found, strip_tags), "\n")
