"""Scalar expressions: guarded arithmetic, flags, labels and vector helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.sources.lookups import ARTICLE_LINKS


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where it has no value."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def total_amount(emt: Column, wire: Column) -> Column:
    return F.coalesce(emt, F.lit(0.0)) + F.coalesce(wire, F.lit(0.0))


EXTERNAL_PREFIX = "E"


def is_external(party: Column) -> Column:
    """External parties have ids that begin with E."""
    return F.coalesce(party.startswith(EXTERNAL_PREFIX), F.lit(False))


def is_article(link: Column) -> Column:
    """Links of the seven news sites that lead to an article."""
    by_site = F.lit(False)
    for prefix, suffix in ARTICLE_LINKS:
        by_site = by_site | (link.startswith(prefix) & link.endswith(suffix))
    return F.coalesce(by_site | has_article_number(link), F.lit(False))


def has_article_number(link: Column) -> Column:
    """Characters 7 to 5 from the end are digits; short links have fewer of them."""
    return link.rlike(r"(?s)^(.*[0-9]{3}.{4}|[0-9]{2}.{4}|[0-9].{4})$")


def threshold_flag(value: Column, above: float) -> Column:
    return F.coalesce((value > F.lit(above)).cast("int"), F.lit(0))


def risk_percent(probability: Column) -> Column:
    return F.round(F.round(probability, 3) * 100, 2)


def risk_tier(probability: Column) -> Column:
    """1 below 30 percent, 2 below 70, else 3."""
    percent = risk_percent(probability)
    return F.when(percent < 30, 1).when(percent < 70, 2).otherwise(3)


def yes_no(flag: Column) -> Column:
    return F.when(flag == 1, "Yes").otherwise("No")


def fuzzy_score(a: Column, b: Column) -> Column:
    """0..100 from the edit distance of trimmed lower-case texts."""
    x, y = F.lower(F.trim(a)), F.lower(F.trim(b))
    longest = F.greatest(F.length(x), F.length(y))
    return 100.0 * (1.0 - F.coalesce(F.try_divide(F.levenshtein(x, y).cast("double"), longest.cast("double")), F.lit(0.0)))


def sorted_words(text: Column) -> Column:
    return F.array_join(F.sort_array(F.split(F.lower(F.trim(text)), r"\s+")), " ")


def sigmoid(value: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-value))


def softmax_vec(values: DataFrame, value: str = "value") -> DataFrame:
    """Softmax, linear share and sigmoid of a table of (name, value)."""
    top = values.agg(F.max(value)).scalar()
    shifted = values.withColumn("_e", F.exp(F.col(value) - top))
    sums = shifted.agg(F.sum("_e")).scalar(), values.agg(F.sum(value)).scalar()
    return shifted.select(
        *values.columns,
        (F.col("_e") / sums[0]).alias("softmax"),
        F.try_divide(F.col(value), sums[1]).alias("linear"),
        sigmoid(F.col(value)).alias("sigmoid"),
    )


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Column names without anything but letters, digits and underscores."""
    return df.toDF(*[re.sub(r"[^A-Za-z0-9_]+", "", c) for c in df.columns])
