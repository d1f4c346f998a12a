"""Profiles of a table: counts, shares, histograms and cross tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.operators.skew import spread_join


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """How often each value occurs, with its percentage; nulls are left out."""
    present = df.filter(F.col(column).isNotNull())
    total = present.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = present.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("percent", F.lit(100.0) * F.col("n") / total)


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every distinct value of each column, as text, with its count."""
    wide = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column", "value").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def profile(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """Number of distinct values of each column, null not counted."""
    columns = list(columns or df.columns)
    if approximate:
        wide = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
        return wide.unpivot([], columns, "column", "n_distinct")
    # Two aggregations over (column, value) rows: repeats disappear on the map side and
    # no column's values are gathered in one place.
    return (
        distinct_values(df, columns)
        .groupBy("column")
        .agg(F.count("value").alias("n_distinct"))
    )


def histogram(df: DataFrame, column: str, by: str, width: int = 2) -> DataFrame:
    """Counts per bin and label; bins start at the smallest value and the last one is closed."""
    bounds = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi")).alias("b"))
    low = F.floor(F.col("_b.lo"))
    edges = F.ceil((F.floor(F.col("_b.hi")) + 2 - low) / F.lit(width))  # edges start at low, end before hi + 2
    last = edges - 2
    inside = F.col(column) <= low + (edges - 1) * width
    return (
        df.filter(F.col(column).isNotNull())
        .withColumn("_b", bounds.scalar())
        .filter(inside)
        .withColumn("bin", F.least(F.floor((F.col(column) - low) / F.lit(width)), last))
        .withColumn("bin_start", low + F.col("bin") * width)
        .groupBy(by, "bin", "bin_start")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def crosstab_pct(df: DataFrame, row: str, col: str, values: Sequence) -> DataFrame:
    """Counts and row percentages of one column against the values of another."""
    counted = (
        df.filter(F.col(row).isNotNull() & F.col(col).isNotNull())
        .groupBy(row)
        .agg(*[F.count(F.when(F.col(col) == v, 1)).alias(f"n_{v}") for v in values], F.count(F.lit(1)).alias("_n"))
    )
    return counted.select(
        row,
        *[f"n_{v}" for v in values],
        *[(F.lit(100.0) * F.col(f"n_{v}") / F.col("_n")).alias(f"pct_{v}") for v in values],
    )


def top_k_minor_share(df: DataFrame, column: str, label: str, values: Sequence, k: int = 10) -> DataFrame:
    """The k values with the largest share of their smaller class."""
    table = crosstab_pct(df, column, label, values)
    minor = table.withColumn("minor_pct", F.least(*[F.col(f"pct_{v}") for v in values]))
    return minor.orderBy(F.desc("minor_pct"), column).limit(k)


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of key sets that occur more than once; two nulls count as equal."""
    often = (
        df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys])
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > 1)
        .drop("_n")
    )
    return spread_join(df, often, keys, [f"_{k}" for k in keys], "left_semi", null_safe=True)


def repeated(df: DataFrame, column: str = "Name") -> DataFrame:
    """Rows whose value of the column occurs more than once; nulls are no value."""
    return duplicates(df.filter(F.col(column).isNotNull()), [column])


def group_means(df: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    """Size and mean of numeric columns per group, as for clusters."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in columns])


def majority(df: DataFrame, label: str) -> DataFrame:
    """The most frequent label; of equally frequent ones the smallest."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), label).limit(1)
