"""Building blocks that stay balanced when one key holds a large part of all rows.

Every other operator joins, ranks and accumulates through these, so that no task
ever has to hold or sort a whole hot group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_SHARE = 1000  # a key is hot above 1/1000 of all rows, so there are never more than 1000
HOT_ROWS = 100_000  # and only when it has this many rows, below that one task is cheap
HOT_PARTS = 256  # parts a hot key is spread over
LIST_PART = 10_000  # longest list kept in one row


def key_code(columns: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns])


def hot_keys(df: DataFrame, *keys: str | Sequence[str], share: int = HOT_SHARE, min_rows: int = HOT_ROWS) -> list[int]:
    """Hash codes of keys that hold more than 1/share of all rows.

    By construction there are at most ``share`` of them per key column, so the list can
    live in the plan as a literal. It only decides where rows go, never what a join returns. One pass
    over the key columns with partial counts; chained joins should share one list.
    """
    codes = [key_code([k] if isinstance(k, str) else k) for k in keys]
    coded = df.select(F.explode(F.array(*codes)) if len(codes) > 1 else codes[0]).toDF("code")
    counts = coded.groupBy("code").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > min_rows)
    # A key above the share is among the first share * len(keys), so no more need to be looked at.
    top = counts.orderBy(F.desc("n")).limit(share * len(codes)).collect()
    if not top:
        return []
    total = df.count()
    return [r["code"] for r in top if r["n"] * share > total]


def spread_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str | Sequence[str],
    dim_key: str | Sequence[str],
    how: str = "left",
    spread_by: Sequence[str] | None = None,
    hot: list[int] | None = None,
    parts: int = HOT_PARTS,
    null_safe: bool = False,
) -> DataFrame:
    """Equi-join of a large table whose key may be skewed.

    Without hot keys this is a plain join. Rows of a hot key get a part number from a hash
    of ``spread_by`` (default: all columns) and meet one copy of the other side's rows for
    that key per part; a frequent null is spread in the same way. A hash, not a random
    number, so a task that runs again sends every row to the same place.
    """
    fact_keys = [fact_key] if isinstance(fact_key, str) else list(fact_key)
    dim_keys = [dim_key] if isinstance(dim_key, str) else list(dim_key)
    types = [fact.schema[a].dataType == dim.schema[b].dataType for a, b in zip(fact_keys, dim_keys)]
    if not all(types):
        raise TypeError(f"join keys {fact_keys} and {dim_keys} must have the same types")
    hot = hot_keys(fact, fact_keys) if hot is None else hot
    right = dim
    if not null_safe:
        for k in dim_keys:
            right = right.filter(F.col(k).isNotNull())
    right = right.withColumnsRenamed({k: f"_dim_key{i}" for i, k in enumerate(dim_keys)})
    renamed = [f"_dim_key{i}" for i in range(len(dim_keys))]
    left, same = fact, []
    for a, b in zip(fact_keys, renamed):
        same.append(F.col(f"`{a}`").eqNullSafe(F.col(b)) if null_safe else F.col(f"`{a}`") == F.col(b))
    if hot:
        columns = [F.col(f"`{c}`") for c in (spread_by or fact.columns)]
        part = F.pmod(F.xxhash64(*columns), F.lit(parts)).cast("int")
        left = fact.withColumn("_part", F.when(key_code(fact_keys).isin(hot), part).otherwise(F.lit(0)))
        copies = F.when(key_code(renamed).isin(hot), F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
        right = right.withColumn("_dim_part", F.explode(copies))
        same.append(F.col("_part") == F.col("_dim_part"))
    return left.join(right, same, how).drop("_part", "_dim_part", *renamed)


def hash_order(id_col: str, seed: int | Column) -> Column:
    """A reproducible random order of ids."""
    text = seed.cast("string") if isinstance(seed, Column) else F.lit(str(seed))
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(":"), text))


def hash_rank(
    df: DataFrame, id_col: str, seed: int | Column = 0, by: Sequence[str] = (), out: str = "rank", digits: int = 4
) -> DataFrame:
    """Exact rank 1..n per group in the order of md5(id:seed), without sorting a group in one task.

    The first hex digits cut each group into 16**digits even slices. Slices are ranked
    on their own and shifted by the number of rows in the slices before them. A row
    whose group is null belongs to no group and gets no rank.
    """
    keyed = df.withColumn("_hash", hash_order(id_col, seed)).withColumn("_slice", F.substring("_hash", 1, digits))
    groups = [*by, "_slice"]
    sizes = keyed.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_slice")
    shifts = sizes.select(
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(groups)],
        (F.sum("_n").over(before) - F.col("_n")).alias("_before"),
    )
    inside = Window.partitionBy(*groups).orderBy("_hash", id_col)
    ranked = keyed.withColumn("_inside", F.row_number().over(inside))
    same = [F.col(c) == F.col(f"_g{i}") for i, c in enumerate(groups)]
    return (
        ranked.join(shifts, same)
        .withColumn(out, (F.col("_inside") + F.col("_before")).cast("long"))
        .drop("_hash", "_slice", "_inside", "_before", *[f"_g{i}" for i in range(len(groups))])
    )


def value_slices(df: DataFrame, col: str, side: int = 32) -> DataFrame:
    """Add ``_slice`` 0..side*side: an order-preserving cut of a numeric column into even slices.

    The cuts are approximate quantiles; only the balance depends on them, never a result.
    Two look-ups of ``side`` values replace one of side*side.
    """
    n = side * side
    fine = [i / n for i in range(1, n + 1)]
    coarse = [i / side for i in range(1, side)]
    cuts = df.agg(
        F.struct(
            F.percentile_approx(col, fine, n * 4).alias("fine"), F.percentile_approx(col, coarse, n * 4).alias("coarse")
        ).alias("cuts")
    ).scalar()
    step = df.withColumn("_cuts", cuts).withColumn(
        "_coarse", F.size(F.filter(F.col("_cuts.coarse"), lambda b: b < F.col(col)))
    )
    near = F.slice(F.col("_cuts.fine"), F.col("_coarse") * side + 1, F.lit(side))
    return step.withColumn("_slice", F.col("_coarse") * side + F.size(F.filter(near, lambda b: b < F.col(col)))).drop(
        "_cuts", "_coarse"
    )


def running_totals(df: DataFrame, order: str, values: Sequence[str], by: Sequence[str] = (), side: int = 32) -> DataFrame:
    """Add ``before_<v>`` = sum of v over rows of the group with a smaller ``order`` value.

    Rows must be unique on (by, order): aggregate first. The table is cut into slices
    of the order column; slices are summed on their own and shifted, so a group of any
    size is spread over many tasks.
    """
    sliced = value_slices(df.filter(F.col(order).isNotNull()), order, side)
    groups = [*by, "_slice"]
    sums = sliced.groupBy(*groups).agg(*[F.sum(v).alias(f"_s_{v}") for v in values])
    over_slices = Window.partitionBy(*by).orderBy("_slice")
    shifts = sums.select(
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(groups)],
        *[(F.sum(f"_s_{v}").over(over_slices) - F.col(f"_s_{v}")).alias(f"_s_{v}") for v in values],
    )
    inside = Window.partitionBy(*groups).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = sliced.select("*", *[(F.sum(v).over(inside) - F.col(v)).alias(f"_l_{v}") for v in values])
    same = [F.col(c) == F.col(f"_g{i}") for i, c in enumerate(groups)]
    joined = local.join(shifts, same)
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[(F.col(f"_l_{v}") + F.col(f"_s_{v}")).alias(f"before_{v}") for v in values],
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key set: the smallest in ``order``.

    A minimum over structs combines on the map side, so copies of one key never meet in one sort.
    """
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], *[F.col(f"`{c}`") for c in rest])
    best = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.min(packed).alias("_best"))
    return best.select(*[F.col(f"`{k}`") if c_is_key else F.col(f"_best.`{k}`") for k, c_is_key in [(c, c in keys) for c in df.columns]])


def list_parts(df: DataFrame, by: str, id_col: str, limit: int = LIST_PART, hot: list[int] | None = None) -> DataFrame:
    """Add ``part``: groups of up to ``limit`` rows are part 0, larger ones are cut by a hash of the id.

    Lists are collected per (group, part), so one row never grows without bound and no member is left out.
    """
    sizes = (
        df.groupBy(by)
        .agg(F.count(F.lit(1)).alias("_size"))
        .filter(F.col("_size") > limit)
        .select(F.col(by).alias("_by"), F.ceil(F.col("_size") / F.lit(limit)).alias("_parts"))
    )
    code = F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 8), 16, 10).cast("long")
    return (
        spread_join(df, sizes, by, "_by", "left", [id_col], hot)
        .withColumn("part", F.coalesce(F.pmod(code, F.col("_parts")), F.lit(0)).cast("int"))
        .drop("_parts")
    )
