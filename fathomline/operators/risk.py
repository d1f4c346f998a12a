"""The composite risk score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.functions.scalar import softmax_vec
from fathomline.operators.stats import corr_odds_expr, odds_expr, rate_ratio_expr

SIGNALS = ("OpenSanc_query", "similarity_score", "network_score", "criminal_cash")


def risk_weights(df: DataFrame) -> DataFrame:
    """Softmax of four odds: sanctions, occupation, network and cash. A missing ratio counts as 0."""
    parts = {
        "OpenSanc_query": odds_expr("Label_Filtered", "OpenSanc_query"),
        # The occupation odds weigh the similarity score they were derived from.
        "similarity_score": odds_expr("Label_Filtered", "Label_Filtered_By_Occupations"),
        "network_score": corr_odds_expr("network_score", "Label_Filtered"),
        "criminal_cash": rate_ratio_expr("criminal_cash", "Label_Filtered_network"),
    }
    row = df.agg(*[F.coalesce(F.nanvl(e, F.lit(None).cast("double")), F.lit(0.0)).alias(n) for n, e in parts.items()])
    long = row.unpivot([], list(parts), "signal", "value")
    return softmax_vec(long).select("signal", "value", F.col("softmax").alias("weight"))


def risk_score(df: DataFrame, weights: DataFrame) -> DataFrame:
    """Weighted sum of the four signals per customer, highest first."""
    packed = weights.agg(
        F.struct(*[F.max(F.when(F.col("signal") == s, F.col("weight"))).alias(s) for s in SIGNALS]).alias("w")
    ).scalar()
    total = F.lit(0.0)
    for s in SIGNALS:
        total = total + F.col(f"_w.{s}") * F.coalesce(F.col(s).cast("double"), F.lit(0.0))
    scored = df.withColumn("_w", packed).select("cust_id", "Name", total.alias("result"))
    return scored.orderBy(F.desc("result"), "cust_id")
