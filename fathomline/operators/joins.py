"""Merges of customers, suspects, edges and labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.operators.skew import first_per_key, spread_join


def merge_suspects(kyc: DataFrame, suspects: DataFrame, types: Sequence[str] = ("buyer", "seller")) -> DataFrame:
    """Customers with a suspect flag and one 0/1 column per suspect type; one row per customer.

    A customer listed twice keeps the entry whose type comes first in the alphabet.
    """
    one = first_per_key(suspects.select("id", "Type"), ["id"], [F.col("Type")])
    joined = kyc.join(one, kyc["cust_id"] == one["id"], "left")
    return joined.select(
        "cust_id",
        "Name",
        F.col("label").alias("Label_Money_Laundry"),
        F.col("id").isNotNull().cast("int").alias("Label_Filtered_By_Wire_EMT"),
        *[F.coalesce((F.col("Type") == t).cast("int"), F.lit(0)).alias(f"type_{t}") for t in types],
    )


def mark_in(df: DataFrame, other: DataFrame, key: str, name: str) -> DataFrame:
    """1 for rows whose key the other table has too."""
    marks = other.select(key).distinct().withColumn(name, F.lit(1))
    return df.join(marks, key, "left").withColumn(name, F.coalesce(F.col(name), F.lit(0)))


def join_edges(a: DataFrame, b: DataFrame) -> DataFrame:
    """Edges with the values another edge table has for the same pair."""
    clash = {c: f"{c}_other" for c in b.columns if c in a.columns and c not in ("Source", "Target")}
    return a.join(b.withColumnsRenamed(clash), ["Source", "Target"], "left")


def join_names(names: DataFrame, edges: DataFrame) -> DataFrame:
    """Listed names with the edges they are the source of; names without edges stay."""
    return names.join(edges, "Source", "left")


def master(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Feature table with the label columns of each customer."""
    extra = [c for c in labels.columns if c == "cust_id" or c not in features.columns]
    return features.join(labels.select(*extra), "cust_id", "left")


def join_suffixed(a: DataFrame, b: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left join that keeps clashing columns as name_x and name_y."""
    clash = [c for c in a.columns if c in b.columns and c != left_key]
    left = a.withColumnsRenamed({c: f"{c}_x" for c in clash})
    right = b.withColumnsRenamed({c: f"{c}_y" for c in clash}).withColumn("_key", F.col(f"{right_key}_y" if right_key in clash else right_key))
    if left_key == right_key:
        right = right.drop(right_key)
    return left.join(right, left[left_key] == right["_key"], "left").drop("_key")


def network_score(df: DataFrame, weights: DataFrame) -> DataFrame:
    """Weight of each customer, 0 without one; of several weights the largest counts."""
    one = weights.groupBy(F.col("id").alias("_id")).agg(F.max("weight").alias("network_score"))
    joined = df.join(one, df["cust_id"] == F.col("_id"), "left").drop("_id")
    return joined.withColumn("network_score", F.coalesce(F.col("network_score"), F.lit(0.0)))


def name_members(communities: DataFrame, names: DataFrame) -> DataFrame:
    """Members of communities with every name they are known by. (id, name) pairs are distinct."""
    return spread_join(
        names.select(F.col("customer_id").alias("_customer"), "name"), communities, "_customer", "node", "inner", ["name"]
    ).select(F.col("_customer").alias("customer_id"), "name", "community")
