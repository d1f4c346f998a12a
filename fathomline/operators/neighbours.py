"""Exact nearest neighbours in bounded tasks, and synthetic minority rows built on them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.operators.skew import hash_order, hash_rank
from fathomline.session import cut_lineage

CELL = 2000  # points compared with one another in one task
QUERIES = 20_000  # points sent to one cell in one task
PIVOTS = 256


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=float)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(((a[:, None, :] - b[None, :, :]) ** 2).sum(-1), 0.0))


def _best(d: np.ndarray, ids: np.ndarray, k: int) -> list[list[dict]]:
    """The k smallest entries of each row of distances, as (distance, id)."""
    out = []
    for row in d:
        ok = np.isfinite(row)
        order = np.lexsort((ids[ok], row[ok]))[:k]
        out.append([{"d": float(row[ok][i]), "id": str(ids[ok][i])} for i in order])
    return out


def knn(points: DataFrame, k: int, cell: int = CELL, pivots: int = PIVOTS, queries: int = QUERIES) -> DataFrame:
    """The k nearest other points of each point (id string, v array<double>), exactly.

    Points go to their nearest pivot and, within it, to cells of bounded size. A first pass
    finds neighbours inside the own cell. Their distance r tells which other pivots can
    hold a closer one: those with |point, pivot| - radius < r. Only these are visited, so
    the work follows the data and not the square of it. Copies of a point have r = 0 and
    visit nothing.
    """
    spark = points.sparkSession
    n = points.count()
    wanted = max(1, min(pivots, n // cell))
    centres = _matrix(
        pd.Series([r["v"] for r in points.orderBy(hash_order("id", 0), "id").limit(wanted).select("v").collect()])
    )
    shared = spark.sparkContext.broadcast(centres)

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            d = np.concatenate([_distances(c, shared.value) for c in np.array_split(_matrix(b["v"]), max(1, len(b) // 1000))])
            yield b.assign(block=d.argmin(1).astype("int32"), far=d.min(1))

    placed = cut_lineage(points.select("id", "v").mapInPandas(nearest, "id string, v array<double>, block int, far double"))
    blocks = placed.groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("radius")).collect()
    cells = {r["block"]: -(-r["n"] // cell) for r in blocks}
    radius = np.full(len(centres), -np.inf)
    for r in blocks:
        radius[r["block"]] = r["radius"]
    parts = F.element_at(F.create_map(*[F.lit(x) for kv in cells.items() for x in kv]), F.col("block"))
    placed = placed.withColumn("sub", F.pmod(F.xxhash64("id"), parts).cast("int"))

    found = "found array<struct<d:double,id:string>>"

    def inside(pdf: pd.DataFrame) -> pd.DataFrame:
        v, ids = _matrix(pdf["v"]), pdf["id"].to_numpy(str)
        d = _distances(v, v) if len(v) <= 500 else np.concatenate([_distances(c, v) for c in np.array_split(v, len(v) // 250)])
        np.fill_diagonal(d, np.inf)
        return pdf[["id", "v", "block", "sub"]].assign(found=_best(d, ids, k))

    first = cut_lineage(placed.groupBy("block", "sub").applyInPandas(inside, f"id string, v array<double>, block int, sub int, {found}"))

    def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            if len(b):
                v = _matrix(b["v"])
                lower = _distances(v, shared.value) - radius[None, :]
                for i, (pid, near, blk, sub) in enumerate(zip(b["id"], b["found"], b["block"], b["sub"])):
                    reach = near[k - 1]["d"] if len(near) >= k else np.inf
                    for t in np.flatnonzero(lower[i] < reach):
                        rows += [(pid, b["v"].iat[i], int(t), s) for s in range(cells.get(int(t), 0)) if (t, s) != (blk, sub)]
            yield pd.DataFrame(rows, columns=["id", "v", "block", "sub"])

    asked = cut_lineage(first.mapInPandas(visits, "id string, v array<double>, block int, sub int"))
    # Written, so that both sides below read it as a table of its own.
    load = cut_lineage(asked.groupBy("block", "sub").agg(F.ceil(F.count(F.lit(1)) / F.lit(queries)).cast("int").alias("chunks")))
    spread = load.select(F.col("block"), F.col("sub"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    asking = asked.join(load, ["block", "sub"]).withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")).drop("chunks")
    holding = placed.select("id", "v", "block", "sub").join(spread, ["block", "sub"])

    def across(ask: pd.DataFrame, hold: pd.DataFrame) -> pd.DataFrame:
        v, ids = _matrix(hold["v"]), hold["id"].to_numpy(str)
        out = []
        for piece in np.array_split(np.arange(len(ask)), max(1, len(ask) // 250)):
            if len(piece):
                out += _best(_distances(_matrix(ask["v"].iloc[piece]), v), ids, k)
        return pd.DataFrame({"id": ask["id"].to_numpy(), "found": out})

    keys = ("block", "sub", "chunk")
    second = asking.groupBy(*keys).cogroup(holding.groupBy(*keys)).applyInPandas(across, f"id string, {found}")
    either = first.select("id", "found").unionByName(second)
    ordered = F.array_sort(F.flatten(F.collect_list("found")))
    return either.groupBy("id").agg(F.slice(ordered, 1, k).alias("found"))


def smote(df: DataFrame, label: str, columns: Sequence[str], id_col: str, k: int = 5, seed: int = 0) -> DataFrame:
    """All rows plus synthetic rows of every smaller class, up to the size of the largest.

    A synthetic row lies between a row of its class and one of its k nearest rows of that class. Row, neighbour and place come from
    hashes of its number. A class of a single row is filled with copies of it. Rows without a label stay and are no class.
    """
    labelled = df.filter(F.col(label).isNotNull())
    counts = {r[label]: r["n"] for r in labelled.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a class
    rows = df.select(F.col(id_col).cast("string").alias("id"), F.col(label), F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns]).alias("v"))
    both = rows.select(F.col("id").alias(id_col), label, "v", F.lit(0).alias("synthetic"))
    most, first = max(counts.values(), default=0), 0
    for c in sorted(c for c in counts if counts[c] < most):
        made = _synthetic(rows.filter(F.col(label) == c), first, most - counts[c], counts[c], k, seed)
        both = both.unionByName(made.select(F.col("id").alias(id_col), F.lit(c).cast(df.schema[label].dataType).alias(label), "v", F.lit(1).alias("synthetic")))
        first += most - counts[c]
    return both.select(id_col, label, *[F.col("v")[i].alias(c) for i, c in enumerate(columns)], "synthetic")


def _synthetic(rows: DataFrame, first: int, missing: int, held: int, k: int, seed: int) -> DataFrame:
    """``missing`` rows (id, v) between the ``held`` rows of one class, numbered from ``first``."""
    pool = cut_lineage(hash_rank(rows, "id", seed, [], "rank"))
    near = knn(pool.select("id", "v"), k)

    def draw(name: str):
        text = F.concat(F.col("draw").cast("string"), F.lit(f":{name}:{seed}"))
        return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")

    draws = rows.sparkSession.range(first, first + missing).withColumnRenamed("id", "draw")
    picked = draws.withColumns({"pick": F.pmod(draw("row"), F.lit(held)) + 1, "u": draw("place") / F.lit(float(16**12))})
    base = picked.join(pool.select("id", "rank", "v"), F.col("pick") == F.col("rank")).join(near, "id", "left")
    some = F.coalesce(F.size("found"), F.lit(0)) > 0
    other = F.when(some, F.get(F.col("found"), F.pmod(draw("near"), F.greatest(F.size("found"), F.lit(1))).cast("int"))["id"]).otherwise(F.col("id"))
    ends = base.withColumn("other", other).join(pool.select(F.col("id").alias("other"), F.col("v").alias("w")), "other")
    mixed = F.zip_with("v", "w", lambda a, b: a + F.col("u") * (b - a))
    return ends.select(F.concat(F.lit("synthetic-"), F.col("draw").cast("string")).alias("id"), mixed.alias("v"))
