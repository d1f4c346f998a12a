"""Money flow between parties."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.functions.scalar import total_amount
from fathomline.operators.skew import hot_keys, spread_join

PAIR = ("id_sender", "id_receiver", "name_sender", "name_receiver")
HOPS = ("label_first_upward", "label_second_upward", "label_first_downward", "label_second_downward")


def transaction_network(wire: DataFrame, emt: DataFrame) -> DataFrame:
    """All transfers in one table: transfer_type 1 for wires, 0 for e-mail transfers."""
    parties = [F.col(c) for c in PAIR]
    w = wire.select(F.col("wire_trxn_id").alias("trxn_id"), *parties, F.col("wire_value").alias("value"), F.lit(1).alias("transfer_type"))
    e = emt.select(F.col("emt_trxn_id").alias("trxn_id"), *parties, F.col("emt_value").alias("value"), F.lit(0).alias("transfer_type"))
    return w.unionByName(e)


def combined(wire: DataFrame, emt: DataFrame) -> DataFrame:
    """Both channels stacked by column name, each with the other's value column empty."""
    return emt.withColumnRenamed("emt_trxn_id", "trxn_id").unionByName(
        wire.withColumnRenamed("wire_trxn_id", "trxn_id"), allowMissingColumns=True
    )


def hop_sum(tx: DataFrame) -> DataFrame:
    """Total amount per pair of parties; rows without a name belong to no pair."""
    named = tx
    for c in PAIR:
        named = named.filter(F.col(c).isNotNull())
    amount = total_amount(F.col("emt_value"), F.col("wire_value"))
    return named.groupBy(*PAIR).agg(F.sum(amount).alias("total_amount"))


def edges(tx: DataFrame, distinct: bool = False) -> DataFrame:
    """Number and amount of transfers per directed pair (Source, Target)."""
    rows = tx.distinct() if distinct else tx
    return (
        rows.filter(F.col("id_sender").isNotNull() & F.col("id_receiver").isNotNull())
        .groupBy(F.col("id_sender").alias("Source"), F.col("id_receiver").alias("Target"))
        .agg(F.count(F.lit(1)).alias("counts"), F.sum("value").alias("total_transaction_amount"))
    )


def two_hop(tx: DataFrame, seeds: DataFrame) -> DataFrame:
    """Pairs within two hops of the seeds, up and down the flow, each with the first hop it belongs to.

    All transfers are summed per pair once. Roles of the parties (seed, source of a seed,
    target of a seed) are worked out on the pairs and looked up for both ends.
    """
    hot = hot_keys(tx, "id_sender", "id_receiver")
    pairs = hop_sum(tx)
    marks = seeds.select(F.col("id").alias("_seed")).distinct().withColumn("_is_seed", F.lit(True))

    def is_seed(df: DataFrame, key: str, name: str) -> DataFrame:
        found = spread_join(df, marks, key, "_seed", "left", list(PAIR), hot)
        return found.withColumn(name, F.coalesce(F.col("_is_seed"), F.lit(False))).drop("_is_seed")

    ends = is_seed(is_seed(pairs, "id_receiver", "_into"), "id_sender", "_out")
    touching = ends.filter(F.col("_into") | F.col("_out"))
    # Neighbours that are no seeds themselves, with the side they are on.
    near = (
        touching.select(
            F.explode(
                F.array(
                    F.struct(F.col("id_sender").alias("id"), (F.col("_into") & ~F.col("_out")).alias("up"), F.lit(False).alias("down")),
                    F.struct(F.col("id_receiver").alias("id"), F.lit(False).alias("up"), (F.col("_out") & ~F.col("_into")).alias("down")),
                )
            ).alias("x")
        )
        .select("x.*")
        .groupBy(F.col("id").alias("_near"))
        .agg(F.max("up").alias("_up"), F.max("down").alias("_down"))
    )
    ups = near.filter("_up").select("_near", "_up")
    downs = near.filter("_down").select("_near", "_down")
    both = spread_join(ends, ups, "id_receiver", "_near", "left", list(PAIR), hot)
    both = spread_join(both, downs, "id_sender", "_near", "left", list(PAIR), hot)
    hop = (
        F.when(F.col("_into"), 0)
        .when(F.coalesce(F.col("_up"), F.lit(False)), 1)
        .when(F.col("_out"), 2)
        .when(F.coalesce(F.col("_down"), F.lit(False)), 3)
    )
    found = both.withColumn("_hop", hop).filter(F.col("_hop").isNotNull())
    return found.select(*PAIR, "total_amount", *[(F.col("_hop") == i).cast("int").alias(n) for i, n in enumerate(HOPS)])


def weights_to(tx: DataFrame, seeds: DataFrame) -> DataFrame:
    """Share of each sender's money that goes to seeds: a network weight in [0, 1]."""
    per_pair = tx.groupBy("id_sender", "id_receiver").agg(F.sum("value").alias("v"))
    marks = seeds.select(F.col("id").alias("_seed")).distinct().withColumn("_is_seed", F.lit(1))
    hot = hot_keys(tx, "id_receiver")
    marked = spread_join(per_pair, marks, "id_receiver", "_seed", "left", ["id_sender"], hot)
    to_seed = F.sum(F.when(F.col("_is_seed") == 1, F.col("v")).otherwise(0.0))
    return (
        marked.groupBy(F.col("id_sender").alias("id"))
        .agg(F.coalesce(F.try_divide(to_seed, F.sum("v")), F.lit(0.0)).alias("weight"))
        .filter(F.col("weight") > 0)
    )
