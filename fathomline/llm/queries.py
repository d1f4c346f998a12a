"""The named queries of the text operators, and the SQL they can be checked with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fathomline.llm import (
    decontamination,
    exact_dedup,
    hard_negatives,
    html_extraction,
    language,
    line_dedup,
    mixing,
    ngram_join,
    secrets,
    suffix_dedup,
    token_counts,
    url_filter,
    vector_codes,
)
from fathomline.llm.common import table


def _over(build: Callable[..., DataFrame], *names: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: build(*[table(spark, folder, n) for n in names])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": _over(secrets.op1_secret_scan, "documents"),
    "op2_token_counts": _over(token_counts.op2_token_counts, "documents"),
    "op3_ngram_join": _over(ngram_join.op3_ngram_join, "documents"),
    "op4_html_extraction": _over(html_extraction.op4_html_extraction, "pages"),
    "op5_language_id": _over(language.op5_language_id, "documents"),
    "op6_exact_dedup": _over(exact_dedup.op6_exact_dedup, "documents"),
    "op7_suffix_dedup": _over(suffix_dedup.op7_suffix_dedup, "documents"),
    "op8_mixing": _over(mixing.op8_mixing, "documents"),
    "op9_line_dedup": _over(line_dedup.op9_line_dedup, "documents"),
    "op10_decontamination": _over(decontamination.op10_decontamination, "documents", "benchmark"),
    "op11_hard_negatives": _over(hard_negatives.op11_hard_negatives, "embeddings"),
    "op12_vector_codes": _over(vector_codes.op12_vector_codes, "embeddings"),
    "op13_url_filter": _over(url_filter.op13_url_filter, "pages"),
}

ORACLE_SQL: dict[str, str] = {
    "op6_exact_dedup": exact_dedup.OP6_SQL,
    "op9_line_dedup": line_dedup.OP9_SQL,
    "op11_hard_negatives": hard_negatives.OP11_SQL,
    "op12_vector_codes": vector_codes.OP12_SQL,
}
