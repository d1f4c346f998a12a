"""Customer clusters on standardised features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.operators.encode import assemble, zscore
from fathomline.session import cut_lineage

# Inputs of the two-dimensional reduction. One column is listed twice and counts twice.
TRANSACTION_COLUMNS = (
    "no_wire_trxns_sent",
    "wire_total_amnt_sent",
    "wire_total_amnt_received",
    "no_wire_trxns_received",
    "no_emt_trxns_sent",
    "no_emt_trxns_received",
    "emt_total_amnt_sent",
    "emt_total_amnt_received",
    "total_cash_deposit",
    "no_cash_withdraws",
    "no_cash_deposits",
    "total_cash_deposit",
)
CASH_COLUMNS = ("total_cash_deposit", "no_cash_withdraws", "no_cash_deposits", "total_cash_deposit")


def _vectors(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    named = {f"_s_{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns}
    return assemble(zscore(df.withColumns(named), list(named)), list(named), "features").drop(*named)


def elbow(df: DataFrame, columns: Sequence[str], ks: Sequence[int] = tuple(range(2, 20)), seed: int = 1) -> DataFrame:
    """Sum of squared distances to the centres for each k. The loop is over k, each fit is a Spark job."""
    vectors = cut_lineage(_vectors(df, columns).select("features"))
    rows = [(k, float(KMeans(k=k, seed=seed).fit(vectors).summary.trainingCost)) for k in ks]
    return df.sparkSession.createDataFrame(rows, "k int, inertia double")


def kmeans(df: DataFrame, columns: Sequence[str], k: int, seed: int = 1) -> DataFrame:
    """Add the cluster of each row."""
    vectors = _vectors(df, columns)
    model = KMeans(k=k, seed=seed, predictionCol="Clusters").fit(vectors)
    return model.transform(vectors).drop("features")


def cluster_flag(df: DataFrame, columns: Sequence[str], k: int, cluster: int = 0, flag: str = "criminal_cash", seed: int = 1) -> DataFrame:
    """Add the cluster of each row and whether it is the given one."""
    return kmeans(df, columns, k, seed).withColumn(flag, (F.col("Clusters") == cluster).cast("int"))


def cluster_shares(flagged: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Size and means of each cluster, from which the cluster to flag is chosen."""
    means = [F.avg(F.col(c).cast("double")).alias(c) for c in columns]
    return flagged.groupBy("Clusters").agg(F.count(F.lit(1)).alias("n"), *means)
