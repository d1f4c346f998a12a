"""The training-data pipeline: five stages over the documents table, each written and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fathomline.llm import decontamination, exact_dedup, language, mixing, ngram_join
from fathomline.llm.common import table
from fathomline.session import cut_lineage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, and those whose two best languages are too close, go."""
    return language.identify(docs, language.fit(docs)).filter("not rejected").select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts stays."""
    return exact_dedup.exact_dedup(docs).filter("kept").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of texts whose shingles are 75 % alike stays."""
    return ngram_join.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.find_leaks(docs, table(spark, sf_dir, "benchmark")).filter("size(leaks) = 0").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    return mixing.op8_mixing(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
]

ORACLE_SQL = None  # language models, block hashes and edit distances have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
