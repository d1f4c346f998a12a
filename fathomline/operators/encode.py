"""Encoding and scaling of columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import PCA, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_CATEGORIES = 10_000


def label_encode(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Alphabetical category code from 0; null is -1."""
    index = StringIndexer(
        inputCol=column, outputCol="_code", stringOrderType="alphabetAsc", handleInvalid="keep"
    ).fit(df.select(column).filter(F.col(column).isNotNull()))
    coded = index.transform(df)
    code = F.when(F.col(column).isNull(), -1).otherwise(F.col("_code").cast("int"))
    return coded.withColumn(out or column, code).drop("_code")


def categories(df: DataFrame, column: str, limit: int = MAX_CATEGORIES) -> list[str]:
    """The distinct values of a category column, sorted. They become columns, so there is a limit that raises."""
    rows = df.select(column).filter(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{column} has more than {limit} categories: index it instead of widening the table")
    return sorted(str(r[0]) for r in rows)


def one_hot(df: DataFrame, columns: Sequence[str], values: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """One 0/1 column per category, the source column dropped; null is 0 everywhere."""
    flags = []
    for c in columns:
        for v in (values or {}).get(c) or categories(df, c):
            flags.append(F.coalesce((F.col(c) == v).cast("int"), F.lit(0)).alias(f"{c}_{v}"))
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in columns], *flags)


def zscore(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / population sd; a constant column becomes 0."""
    moments = df.agg(
        F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns]).alias("m")
    ).scalar()
    scaled = {
        c: F.coalesce(F.try_divide(F.col(c) - F.col(f"_m.{c}.m"), F.col(f"_m.{c}.s")), F.col(c) * 0.0) for c in columns
    }
    return df.withColumn("_m", moments).withColumns(scaled).drop("_m")


def minmax(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """(x - min) / (max - min); a constant column becomes 0."""
    bounds = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi")).alias("b")).scalar()
    scaled = F.coalesce(
        F.try_divide((F.col(column) - F.col("_b.lo")).cast("double"), (F.col("_b.hi") - F.col("_b.lo")).cast("double")),
        F.col(column) * 0.0,
    )
    return df.withColumn("_b", bounds).withColumn(out or column, scaled).drop("_b")


def assemble(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    """One vector column. A column listed twice counts twice."""
    unique = {f"_v{i}": F.col(c).cast("double") for i, c in enumerate(columns)}
    widened = df.withColumns(unique)
    return VectorAssembler(inputCols=list(unique), outputCol=out).transform(widened).drop(*unique)


def reduce_2d(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Two principal components dr1, dr2 of the standardised columns."""
    names = list(dict.fromkeys(columns))
    scaled = zscore(df.withColumns({f"_z_{c}": F.col(c).cast("double") for c in names}), [f"_z_{c}" for c in names])
    vectors = assemble(scaled, [f"_z_{c}" for c in columns], "_vector")
    model = PCA(k=2, inputCol="_vector", outputCol="_pc").fit(vectors)
    parts = vector_to_array(F.col("_pc"))
    return (
        model.transform(vectors)
        .withColumns({"dr1": parts[0], "dr2": parts[1]})
        .drop("_vector", "_pc", *[f"_z_{c}" for c in names])
    )
