"""Fixed lookup values: categories, countries, link rules and title rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

OCCUPATION_CATEGORIES = ("wildlife", "trafficking", "transportation", "media", "law")
WORD_CATEGORIES = ("wildlife", "transportation", "law", "trafficking", "accomodation")

# Country counters, one bucket for everything else.
COUNTRIES = ("AU", "CA", "CN", "GE", "IN", "MX", "RU", "SA", "UK", "US")
OTHER_COUNTRY = "NAN"
WILDLIFE_JURISDICTION = ("CN", "AU", "SA")
NORTH_AMERICA = ("CA",)

# Occupations of interest, in list order.
OCCUPATIONS_OF_INTEREST = (
    "Gamekeeper or Wildlife Ranger",
    "Customs Officer or Border Control Agent",
    "Traditional Medicine Practitioner",
    "Zoo or Aquarium Staff",
    "Pet Store Owner",
    "Shipping and Freight Forwarder",
    "Import/Export Business Owner",
    "Veterinary Technician",
    "Wildlife Farm Owner",
    "Fisheries Inspector",
    "Logistics Manager or Coordinator",
    "Legal Advisor or Consultant",
)

# Article links by site. (prefix, suffix)
ARTICLE_LINKS = (
    ("https://globalnews.ca/news/", ""),
    ("https://www.cbc.ca/news/", ""),
    ("https://www.saobserver.net/news/", ""),
    ("https://www.justice.gov/opa/pr/", ""),
    ("https://www.timminstoday.com/national-news/", ""),
    ("https://www.timminstoday.com/world-news/", ""),
    ("https://www.timminstoday.com/local-news/", ""),
    ("https://www.timminstoday.com/police-beat", ""),
    ("https://www.timminstoday.com/business-news/", ""),
    ("https://www.newswire.ca/news-releases/", ".html"),
)

# Class of the headline element by site, in the order the rules are tried.
# (how the link is tested, value, class; an empty class takes any h1)
TITLE_RULES = (
    ("prefix", "https://www.justice.gov/opa/pr/", "page-title"),
    ("prefix", "https://www.cbc.ca/", "detailHeadline"),
    ("prefix", "https://www.timminstoday.com/", "title details-title"),
    ("prefix", "https://globalnews.ca/", "l-article__title"),
    ("prefix", "https://www.saobserver.net", "title details-title"),
    ("prefix", "https://www.newswire.ca/news-releases/", ""),
    ("contains", "ctvnews", "c-title__text"),
    ("digits", "", "c-title__text"),
)

# Titles before a person's name.
NAME_PREFIXES = ("DR.", "MR.", "MRS.")


def lookup(spark: SparkSession, kind: str, values: Mapping[str, Sequence[str]]) -> DataFrame:
    """Category sheets as one long table (kind, category, value)."""
    rows = [(kind, category, value) for category, vs in values.items() for value in vs]
    return spark.createDataFrame(rows, "kind string, category string, value string")
