"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"  # the characters of [\x20\x09-\x0D]
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def col(name: str) -> Column:
    return F.col(f"`{name}`")


def packed(df: DataFrame, name: str = "row") -> DataFrame:
    """All columns in one struct, so that no column of the input can clash with a working column."""
    return df.select(F.struct(*[col(c) for c in df.columns]).alias(name))


def unpacked(df: DataFrame, columns: Iterable[str], added: dict[str, Column], name: str = "row") -> DataFrame:
    """The packed columns and the added ones; an added column takes the place of an input column of that name."""
    taken = {a.lower() for a in added}
    keep = [F.col(f"{name}.`{c}`") for c in columns if c.lower() not in taken]
    return df.select(*keep, *[v.alias(k) for k, v in added.items()])


BATCH_ROWS = 1000


def short_batches(spark: SparkSession) -> None:
    """Texts are long: tasks hand Python at most ``BATCH_ROWS`` of them at once, so that a worker holds a few megabytes."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
