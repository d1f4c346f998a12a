"""Balancing and splitting by the rank of a hash: exact sizes, reproducible on any cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.operators.skew import hash_rank


def _classes(df: DataFrame, label: str) -> tuple[Column, Column]:
    """Majority label and number of rows of all other labels, as scalar subqueries."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(F.col(label).alias("l")).agg(F.count(F.lit(1)).alias("n"))
    # min over (-n, label): the most frequent, of equals the smallest label
    mode = counts.agg(F.min(F.struct(-F.col("n"), F.col("l").alias("l"))).getField("l").alias("l")).scalar()
    rest = counts.agg((F.sum("n") - F.max("n")).alias("n")).scalar()
    return mode, rest


def _marked(df: DataFrame, label: str, id_col: str, seed: int) -> DataFrame:
    mode, rest = _classes(df, label)
    ranked = hash_rank(df, id_col, seed, [label], "_rank")
    return ranked.withColumns({"_major": F.col(label) == mode, "_keep": F.col("_rank") <= rest})


def undersample(df: DataFrame, label: str, id_col: str, seed: int = 0) -> DataFrame:
    """All minority rows and as many majority rows, drawn without replacement."""
    marked = _marked(df, label, id_col, seed)
    return marked.filter(~F.col("_major") | F.col("_keep")).drop("_rank", "_major", "_keep")


def undersample_rest(df: DataFrame, label: str, id_col: str, seed: int = 0) -> DataFrame:
    """Every row with ``part``: used (in the balanced set) or unused (majority left over)."""
    marked = _marked(df, label, id_col, seed)
    used = ~F.col("_major") | F.col("_keep")
    return marked.withColumn("part", F.when(used, "used").otherwise("unused")).drop("_rank", "_major", "_keep")


def unused_majority(df: DataFrame, chosen: DataFrame, label: str, id_col: str) -> DataFrame:
    """Majority rows that are not in the chosen set."""
    mode, _ = _classes(df, label)
    return df.filter(F.col(label) == mode).join(chosen.select(id_col), id_col, "left_anti")


def oversample(df: DataFrame, label: str, id_col: str, seed: int = 0) -> DataFrame:
    """The majority once and, as often, minority rows drawn with replacement.

    The minority is replaced by as many draws as there are majority rows. Each majority row
    stands for one draw; the drawn minority rank is a hash of its number, so draws spread
    evenly over the minority.
    """
    mode, rest = _classes(df, label)
    ranked = hash_rank(df, id_col, seed, [label], "_rank").withColumn("_major", F.col(label) == mode)
    major = ranked.filter(F.col("_major"))
    # Minority labels together form the pool, ranked as one.
    pool = hash_rank(df.filter(F.col(label) != mode), id_col, seed, [], "_pool")
    code = F.conv(F.substring(F.md5(F.concat(F.col("_rank").cast("string"), F.lit(f":draw:{seed}"))), 1, 12), 16, 10)
    draws = major.select(
        F.col("_rank").alias("draw"), (F.pmod(code.cast("long"), rest) + 1).alias("_pick")
    )
    drawn = draws.join(pool, F.col("_pick") == F.col("_pool")).select(*df.columns, "draw")
    kept = major.select(*df.columns, F.lit(0).cast("long").alias("draw"))
    return kept.unionByName(drawn)


def split(df: DataFrame, fraction: float, id_col: str, seed: int | Column = 0, by: Sequence[str] = ()) -> DataFrame:
    """Every row with ``part``: test for round(fraction * n) rows, train for the others."""
    ranked = hash_rank(df, id_col, seed, by, "_rank")
    if by:
        sizes = df.groupBy(*[F.col(c).alias(f"_of_{c}") for c in by]).agg(F.count(F.lit(1)).alias("_n"))
        ranked = ranked.join(sizes, [F.col(c) == F.col(f"_of_{c}") for c in by]).drop(*[f"_of_{c}" for c in by])
    else:
        ranked = ranked.withColumn("_n", df.agg(F.count(F.lit(1)).alias("n")).scalar())
    test = F.col("_rank") <= F.round(F.lit(fraction) * F.col("_n"))
    return ranked.withColumn("part", F.when(test, "test").otherwise("train")).drop("_rank", "_n")


def kfold(df: DataFrame, label: str, k: int, id_col: str, seed: int = 0) -> DataFrame:
    """Add ``fold`` 0..k-1 with the class shares of the whole set in each fold."""
    ranked = hash_rank(df, id_col, seed, [label], "_rank")
    return ranked.withColumn("fold", F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int")).drop("_rank")


def mc_splits(df: DataFrame, n: int, fraction: float, id_col: str) -> DataFrame:
    """n independent random splits, as one row per row and seed."""
    seeded = df.withColumn("seed", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return split(seeded, fraction, id_col, F.col("seed"), ["seed"])


def fraction_sets(df: DataFrame, fractions: Sequence[float], label: str, id_col: str, seed: int = 0) -> DataFrame:
    """Nested training sets: a row belongs to every fraction at or above its rank in its class."""
    ranked = hash_rank(df, id_col, seed, [label], "_rank")
    sizes = df.groupBy(F.col(label).alias("_label")).agg(F.count(F.lit(1)).alias("_n"))
    sized = ranked.join(sizes, F.col(label) == F.col("_label")).drop("_label")
    wanted = F.array(*[F.lit(float(f)) for f in fractions])
    inside = F.filter(wanted, lambda f: F.col("_rank") <= F.round(f * F.col("_n")))
    return sized.withColumn("fraction", F.explode(inside)).drop("_rank", "_n")


def stack(frames: Sequence[DataFrame], zero: Sequence[str] = ()) -> DataFrame:
    """Rows of all frames by column name; listed columns are 0 where a frame lacks them."""
    whole = frames[0]
    for f in frames[1:]:
        whole = whole.unionByName(f, allowMissingColumns=True)
    return whole.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zero}) if zero else whole


def mega_test(folds: DataFrame, fold: int, label: str, id_col: str, seed: int = 0) -> DataFrame:
    """Test rows of one fold plus the majority rows that balancing the other folds left unused."""
    test = folds.filter(F.col("fold") == fold).withColumn("part", F.lit("test"))
    rest = undersample_rest(folds.filter(F.col("fold") != fold), label, id_col, seed)
    return test.unionByName(rest.filter(F.col("part") == "unused"))
