"""News articles: links, text, similarity, people and offenders."""

from __future__ import annotations

import ast
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.functions.scalar import has_article_number, is_article
from fathomline.functions.text import (
    PERSON,
    answer_in_name,
    cut_after,
    fold_names,
    headline,
    name_with_answer,
    norm_name,
    paragraphs,
    person_mentions,
    split_and,
)
from fathomline.operators.skew import first_per_key
from fathomline.sources.lookups import TITLE_RULES

TRIGGERS = ("arrested", "charged", "accused", "sentenced", "convicted", "fined", "guilty")


def article_links(links: DataFrame, column: str = "link") -> DataFrame:
    """Distinct links that lead to an article."""
    return links.filter(is_article(F.col(column))).select(column).distinct()


def article_text(pages: DataFrame) -> DataFrame:
    """Paragraph text of each stored page."""
    return pages.withColumn("Text", paragraphs(F.col("html")))


def titles(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = TITLE_RULES, link: str = "url") -> DataFrame:
    """Headline of each page by the rule of its site; null where no rule applies."""
    tests = {
        "prefix": lambda v: F.col(link).startswith(v),
        "contains": lambda v: F.col(link).contains(v),
        "digits": lambda v: has_article_number(F.col(link)),
    }
    title = F.lit(None).cast("string")
    for how, value, css_class in reversed(rules):
        title = F.when(tests[how](value), headline(F.col("html"), css_class)).otherwise(title)
    return pages.withColumn("Title", title)


# A record of two plain strings, no escapes and nothing unusual: these need no Python.
_PLAIN = r"""^\{'Title': '([^'\\\r\n\x00]*)', 'Text': '([^'\\\r\n\x00]*)'\}$"""


def literal_fields(text: str) -> tuple[bool, str | None, str | None]:
    """Whether a text is a Python literal of a dict with both fields, and the fields as texts, None as null."""
    try:
        record = ast.literal_eval(text)
        fields = [record[name] for name in ("Title", "Text")]
    except (SyntaxError, TypeError, ValueError, KeyError, IndexError, MemoryError, RecursionError):
        return False, None, None
    # Lone surrogates of an escape have no UTF-8 form.
    return True, *[None if f is None else str(f).encode("utf-8", "replace").decode() for f in fields]


def _literal_reader():
    @F.pandas_udf("struct<ok: boolean, Title: string, Text: string>")
    def read(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(None, None, None) if t is None else literal_fields(t) for t in texts], columns=["ok", "Title", "Text"])

    return read


def parse_records(df: DataFrame, column: str = "Extracted Data") -> DataFrame:
    """Title, Text and ``Parsed`` of records stored as the text of a dict; Parsed is false for a malformed one and for null.

    What Python reads as a literal is well-formed: either kind of quotes, adjacent strings, escapes, a comma at the end, further
    fields, None. Records of two plain strings are read by a pattern; only the others are sent to Python, in Arrow batches.
    """
    text = F.col(f"`{column}`")
    marked = df.withColumn("_plain", F.coalesce(text.rlike(_PLAIN), F.lit(False)))
    read = marked.withColumn("_r", _literal_reader()(F.when(~F.col("_plain"), text)))

    def field(name: str, group: int) -> Column:
        return F.when(F.col("_plain"), F.regexp_extract(text, _PLAIN, group)).otherwise(F.col(f"_r.{name}"))

    parsed = F.col("_plain") | F.coalesce(F.col("_r.ok"), F.lit(False))
    return read.select(*[F.col(f"`{c}`") for c in df.columns], field("Title", 1).alias("Title"), field("Text", 2).alias("Text"), parsed.alias("Parsed"))


def good_records(parsed: DataFrame) -> DataFrame:
    return parsed.filter("Parsed")


def record_counts(parsed: DataFrame) -> DataFrame:
    """Number of records, of well-formed and of malformed ones."""
    good = F.col("Parsed")
    return parsed.agg(
        F.count(F.lit(1)).alias("total"), F.count(F.when(good, 1)).alias("successful"), F.count(F.when(~good, 1)).alias("failed")
    )


def similarity(df: DataFrame, anchor: Column, column: str = "embedding") -> DataFrame:
    """Add ``Score``, the inner product of a vector column with the anchor vector."""
    product = F.aggregate(
        F.zip_with(F.col(column), F.col("_anchor"), lambda a, b: a.cast("double") * b.cast("double")),
        F.lit(0.0),
        lambda s, x: s + x,
    )
    return df.withColumn("_anchor", anchor).withColumn("Score", product).drop("_anchor")


def similar_to(df: DataFrame, anchor: Column, threshold: float = 0.25, column: str = "embedding", ties: Sequence[str] = ()) -> DataFrame:
    """Rows whose inner product with the anchor vector reaches the threshold, best first, equal ones by ``ties``."""
    return similarity(df, anchor, column).filter(F.col("Score") >= threshold).orderBy(F.desc("Score"), *ties)


def mentions(articles: DataFrame, text: str = "Text", person: str = PERSON) -> DataFrame:
    """Person names of each article, folded: a name inside an earlier one, or around it, is absorbed."""
    return articles.withColumn("All_Names", fold_names(person_mentions(F.col(text), person)))


def after_trigger(text: Column, triggers: Sequence[str], person: str = PERSON) -> Column:
    """The first person named after a trigger word; empty when there is none."""
    words = "|".join(triggers)
    return F.regexp_extract(text, rf"(?s)(?:^|[^A-Za-z])(?:{words})[^A-Za-z].*?({person})", 1)


def answers(
    articles: DataFrame,
    criminal: Sequence[str] = TRIGGERS,
    suspect: Sequence[str] = ("suspect", "suspected", "alleged"),
    text: str = "Text",
    person: str = PERSON,
) -> DataFrame:
    """Two candidate answers per article, split where they name several people.

    The rule takes the person named next after a trigger word; no answer gives an empty list.
    """

    said = articles.withColumns(
        {f"_q{q}": after_trigger(F.col(text), words, person) for q, words in ((1, criminal), (2, suspect))}
    )
    split = {f"Q{q}_Name": F.filter(split_and(F.col(f"_q{q}")), lambda a: a != "") for q in (1, 2)}
    return said.withColumns(split).drop("_q1", "_q2")


def scored_answers(
    articles: DataFrame, scorer: Callable[[pd.DataFrame], pd.DataFrame], text: str = "Text"
) -> DataFrame:
    """The same with a model: ``scorer`` gets batches of (Link, text) and returns q1 and q2 texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = scorer(batch)
            yield pd.DataFrame({"Link": batch["Link"], "q1": found["q1"], "q2": found["q2"]})

    said = articles.select("Link", F.col(text)).mapInPandas(run, "Link string, q1 string, q2 string")
    return said.select("Link", split_and(F.col("q1")).alias("Q1_Name"), split_and(F.col("q2")).alias("Q2_Name"))


def match_answers(articles: DataFrame) -> DataFrame:
    """The named person an answer points to: by the first answers, else the second; unmatched articles are dropped."""
    names = F.col("All_Names")
    staged = articles.withColumns({f"_n{q}": name_with_answer(names, F.col(f"Q{q}_Name")) for q in (1, 2)})
    staged = staged.withColumns({f"_a{q}": answer_in_name(F.col(f"_n{q}"), F.col(f"Q{q}_Name")) for q in (1, 2)})
    cut = F.coalesce(*[cut_after(F.col(f"_n{q}"), F.col(f"_a{q}")) for q in (1, 2)])
    found = staged.withColumn("Criminal", cut).drop("_n1", "_n2", "_a1", "_a2")
    return found.filter(F.col("Criminal").isNotNull())


def offenders(matched: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Links, titles and name, one row per name: the first article in the given order."""
    rows = matched.select(F.col("Link").alias("Links"), F.col("Title").alias("Titles"), "Criminal", *[o.alias(f"_k{i}") for i, o in enumerate(order)])
    keys = [F.col(f"_k{i}") for i in range(len(order))]
    return first_per_key(rows, ["Criminal"], keys).select("Links", "Titles", "Criminal")


def found_offenders(table: DataFrame, names: DataFrame) -> DataFrame:
    """Offenders that are customers, in upper case, one row per name."""
    upper = table.withColumn("Criminal", F.upper("Criminal"))
    known = names.select(norm_name(F.col("name")).alias("_known")).distinct()
    hits = upper.join(known, F.col("Criminal") == F.col("_known"), "left_semi")
    return first_per_key(hits, ["Criminal"], [F.col("Links"), F.col("Titles")])


def confirmed_share(found: DataFrame, column: str = "manual_check") -> DataFrame:
    """Share of found names confirmed by hand."""
    return found.agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(column).cast("double")).alias("precision"))
