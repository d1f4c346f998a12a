"""Hard-negative mining: for an anchor and each of its best positives, the best other-label rows in a band of scores.

Vectors become integers once, and with them their norms and their angles to a few reference directions are stored. By the triangle
inequality the angles of two vectors to one reference bound the angle between them from both sides: that gives an interval of the
cosine, and times the norms, rounded outwards, one of the score. Rows are kept in stripes of neighbouring angles, so that the
interval holds for whole tiles of rows; a tile gets integer scores for an anchor only where its interval overlaps what
the anchor still looks for.

Anchors are the stated query set and meet all rows in cells of one stripe of rows and one band of anchors. Cells are Spark
groups of bounded size; each returns only its own first rows, and Spark ranks those of all cells. Stripes and bands whose
intervals cannot overlap are not sent to each other at all.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil, pi

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.llm.common import col
from fathomline.llm.exact_gemm import exact_dot, finite, whole
from fathomline.session import cut_lineage

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 10, 30, 90
REFERENCES = 16  # rows of the table, the first by a hash of their content; any choice gives the same result
STRIPE_ROWS = 4096  # rows, and anchors, of a cell
TILE_ROWS = 512
SLACK = 1e-6  # of the cosine: far above the rounding of arccos near 0, about 5e-8
_LEAST, _MOST = -(2**63), 2**63 - 1


def directions(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors of the different nonzero rows."""
    some = np.unique(vectors[(vectors != 0).any(axis=1)], axis=0).astype(np.float64)
    return some / np.linalg.norm(some, axis=1, keepdims=True)


def angles_to(vectors: np.ndarray, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and angles to the references; the angles of a zero vector don't matter, its scores are 0."""
    x = vectors.astype(np.float64)
    norms = np.linalg.norm(x, axis=1)
    cosines = (x @ refs.T) / np.where(norms > 0, norms, 1.0)[:, None]
    return norms, np.arccos(np.clip(cosines, -1.0, 1.0))


def score_bounds(angles, norms, low_angles, high_angles, low_norm, high_norm) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the scores of each vector (angles, norm) with any vector whose angles and norm lie in the given ranges.

    Arrays broadcast; references are the last axis of the angles.
    """
    apart = np.maximum(np.maximum(angles - high_angles, low_angles - angles), 0.0).max(axis=-1, initial=0.0)
    beyond = np.minimum(angles + high_angles, 2 * pi - angles - low_angles).min(axis=-1, initial=pi)
    above, below = np.cos(apart) + SLACK, np.cos(beyond) - SLACK
    high = norms * np.where(above > 0, above * high_norm, above * low_norm)
    low = norms * np.where(below > 0, below * low_norm, below * high_norm)
    return np.floor(low) - 1, np.ceil(high) + 1


def leading(scores: np.ndarray, ok: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Which columns of each row are its k highest allowed scores (earlier columns first among equals), and the kth score."""
    held = np.where(ok, scores, _LEAST)
    n = held.shape[1]
    last = np.partition(held, n - k, axis=1)[:, n - k] if n >= k else np.full(len(held), _LEAST)
    above = held > last[:, None]
    equal = ok & (held == last[:, None])
    return above | (equal & (np.cumsum(equal, axis=1) <= (k - above.sum(axis=1))[:, None])), last


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def _array(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def search(anchors: pa.Table, rows: pa.Table, low: np.ndarray, high: np.ndarray, same: bool, k: int) -> tuple[np.ndarray, ...]:
    """(anchor, window, row, score): per anchor and window [low, high] (anchors, windows) its first k rows of the same or of another label.

    Higher scores come first, then smaller ids, null ids last. Anchors and rows are places in the tables; a row is no partner of itself.
    """
    # Tiles hold neighbouring angles, and their rows are in order of the ids.
    by_id = np.empty(rows.num_rows, dtype=np.int64)
    by_id[pc.sort_indices(rows.select(["id", "row"]), [("id", "ascending"), ("row", "ascending")], null_placement="at_end").to_numpy()] = np.arange(rows.num_rows)
    theta, norm, q = _matrix(rows["angles"]), _array(rows["norm"]), _matrix(rows["q"])
    a_theta, a_norm, a_q = _matrix(anchors["angles"]), _array(anchors["norm"]), _matrix(anchors["q"])
    labels = pa.chunked_array([*anchors["label"].chunks, *rows["label"].chunks]).combine_chunks().dictionary_encode().indices.to_numpy()
    a_label, label = labels[: anchors.num_rows], labels[anchors.num_rows :]
    a_row, row = _array(anchors["row"]), _array(rows["row"])

    order = np.lexsort((theta[np.arange(len(row)), theta.argmin(axis=1)], theta.argmin(axis=1))) if theta.shape[1] else np.arange(len(row))
    tiles = [order[at : at + TILE_ROWS] for at in range(0, len(order), TILE_ROWS)]
    tiles = [t[np.argsort(by_id[t])] for t in tiles]
    reach = [score_bounds(a_theta, a_norm, theta[t].min(axis=0), theta[t].max(axis=0), norm[t].min(), norm[t].max()) for t in tiles]
    floor = np.full(low.shape, _LEAST)  # k rows at or above this score are known
    found: list[tuple[np.ndarray, ...]] = []
    for at in sorted(range(len(tiles)), key=lambda t: -reach[t][1].mean()):
        tile, (least, most) = tiles[at], reach[at]
        open_ = (low <= high) & (most[:, None] >= np.maximum(low, floor)) & (least[:, None] <= high)
        some = np.flatnonzero(open_.any(axis=1))
        if not len(some):
            continue
        scores = exact_dot(a_q[some], q[tile])
        partner = ((a_label[some][:, None] == label[tile]) == same) & (a_row[some][:, None] != row[tile])
        for w in range(low.shape[1]):
            here = np.flatnonzero(open_[some, w])
            if not len(here):
                continue
            mine = some[here]
            s = scores[here]
            ok = partner[here] & (s >= np.maximum(low[mine, w], floor[mine, w])[:, None]) & (s <= high[mine, w][:, None])
            take, last = leading(s, ok, k)
            floor[mine, w] = np.maximum(floor[mine, w], last)
            i, j = np.nonzero(take)
            found.append((mine[i], np.full(len(i), w), tile[j], s[i, j]))
    if not found:
        return tuple(np.empty(0, dtype=np.int64) for _ in range(4))
    anchor, window, at, score = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((by_id[at], -score, window, anchor))
    anchor, window, at, score = anchor[order], window[order], at[order], score[order]
    new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1])))
    starts = np.flatnonzero(new)
    rank = np.arange(len(anchor)) - np.repeat(starts, np.diff(np.append(starts, len(anchor))))
    keep = rank < k
    return anchor[keep], window[keep], at[keep], score[keep]


def _positive_finder(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def find(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        low, high = np.full((anchors.num_rows, 1), _LEAST), np.full((anchors.num_rows, 1), _MOST)
        anchor, _, at, score = search(anchors, rows, low, high, True, k) if anchors.num_rows and rows.num_rows else [np.empty(0, dtype=np.int64)] * 4
        return pa.table({"anchor": anchors["row"].take(anchor), "id": rows["id"].take(at), "row": rows["row"].take(at), "score": pa.array(score)})

    return find


def window_of(score: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole scores s with low * score <= 100 * s <= high * score."""
    return -((-low * score) // 100), (high * score) // 100


def _negative_finder(low: int, high: int, k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def find(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        positives = anchors["positives"].combine_chunks()
        counts = positives.value_lengths().to_numpy(zero_copy_only=False)
        first = np.cumsum(counts) - counts
        flat = positives.flatten()
        scores, ids = flat.field("score").to_numpy(zero_copy_only=False), flat.field("id")
        wide = int(counts.max(initial=0))
        lows, highs = np.full((len(counts), wide), _MOST), np.full((len(counts), wide), _LEAST)  # no window: empty
        i = np.repeat(np.arange(len(counts)), counts)
        j = np.arange(len(scores)) - np.repeat(first, counts)
        lows[i, j], highs[i, j] = window_of(scores, low, high)
        anchor, window, at, score = search(anchors, rows, lows, highs, False, k) if anchors.num_rows and rows.num_rows else [np.empty(0, dtype=np.int64)] * 4
        place = first[anchor] + window
        return pa.table(
            {
                "anchor": anchors["row"].take(anchor), "anchor_id": anchors["id"].take(anchor), "place": pa.array(window),
                "positive_id": ids.take(place), "positive_score": pa.array(scores[place]),
                "id": rows["id"].take(at), "row": rows["row"].take(at), "score": pa.array(score),
            }
        )

    return find


def _measurer(refs: np.ndarray, scale: int, width: int):
    @F.arrow_udf("struct<q: array<bigint>, norm: double, angles: array<double>, near: int, angle: double>")
    def measure(vectors: pa.Array) -> pa.Array:
        q = whole(vectors, scale, width)
        norms, angles = angles_to(q, refs)
        near = angles.argmin(axis=1) if len(refs) else np.zeros(len(q), dtype=np.int64)
        angle = angles[np.arange(len(q)), near] if len(refs) else np.zeros(len(q))

        def lists(x: np.ndarray) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))

        return pa.StructArray.from_arrays(
            [lists(q), pa.array(norms), lists(angles), pa.array(near, pa.int32()), pa.array(angle)], names=["q", "norm", "angles", "near", "angle"]
        )

    return measure


def _dealt(df: DataFrame, parts: int, name: str) -> DataFrame:
    """The rows in written parts of neighbouring angles, with the number of their part."""
    return cut_lineage(df.repartitionByRange(parts, "near", "angle", "row").withColumn(name, F.spark_partition_id()))


def _cells(anchors: DataFrame, rows: DataFrame, cells: DataFrame, of_anchor: list[str], of_row: list[str]):
    """Anchors and rows of each cell (band, stripe), together. A cell of a band and a stripe holds about ``STRIPE_ROWS`` of each."""
    left = anchors.join(cells, "band").select(*[F.col(c).alias(c) for c in ("band", "stripe", *of_anchor)])
    right = rows.join(cells, "stripe").select(*[F.col(c).alias(c) for c in ("band", "stripe", *of_row)])
    return left.groupBy("band", "stripe").cogroup(right.groupBy("band", "stripe"))


def _ranges(df: DataFrame, by: str, refs: int, *more: Column) -> DataFrame:
    """Ranges of angles and norms of each part."""
    low = F.array(*[F.min(F.col("angles")[k]) for k in range(refs)]).cast("array<double>")
    high = F.array(*[F.max(F.col("angles")[k]) for k in range(refs)]).cast("array<double>")
    return df.groupBy(by).agg(low.alias("low_angles"), high.alias("high_angles"), F.min("norm").alias("low_norm"), F.max("norm").alias("high_norm"), *more)


def _overlaps(refs: int):
    """Whether any score between two parts can lie in [least, most]."""

    @F.arrow_udf("boolean")
    def overlaps(a_low: pa.Array, a_high: pa.Array, a_norm: pa.Array, low: pa.Array, high: pa.Array, low_norm: pa.Array, high_norm: pa.Array, least: pa.Array, most: pa.Array) -> pa.Array:
        def wide(x: pa.Array) -> np.ndarray:
            return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), refs)

        def flat(x: pa.Array) -> np.ndarray:
            return x.to_numpy(zero_copy_only=False).astype(np.float64)

        # A range of anchor angles against a range of row angles: as one angle in the middle against the wider range.
        middle, half = (wide(a_low) + wide(a_high)) / 2, (wide(a_high) - wide(a_low)) / 2
        # The anchors' norms lie in [0, a_norm], so the bounds take in 0.
        lows, highs = score_bounds(middle, flat(a_norm), wide(low) - half, wide(high) + half, flat(low_norm), flat(high_norm))
        return pa.array((np.maximum(highs, 0) >= flat(least)) & (np.minimum(lows, 0) <= flat(most)))

    return overlaps


def mine(
    rows: DataFrame, anchor: Column, vector: str = "embedding", vec_id: str = "vec_id", label: str = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A row's score is the integer inner product of floor(scale * x) with the anchor's. Positives are the anchor's first ``positives`` other rows
    of its label; for each, the first ``negatives`` rows of other labels with low * positive_score <= 100 * score <= high * positive_score.
    Higher scores come first, ties by smaller id, null ids last.

    Rows with a null label, a null vector, or a null or non-finite component take no part; ``anchor`` chooses among the others, null
    counts as false. Repeated rows and ids are rows of their own: each is an anchor, positive or negative by itself. A zero vector scores 0 with all. An
    anchor without positives, and a positive without negatives (so every positive scored below 0), gives no row; an empty table gives an
    empty one. Only the named columns are read, so no other column clashes. Vectors of different lengths, and scores that may pass 62 bits, are errors.
    """
    kept = rows.filter(finite(col(vector)) & col(label).isNotNull()).select(
        col(vec_id).alias("id"), col(label).alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), col(vector).cast("array<double>").alias("vector")
    )
    id_type = kept.schema["id"].dataType.simpleString()
    out = f"anchor_id {id_type}, positive_id {id_type}, rank int, negative_id {id_type}, positive_score bigint, negative_score bigint"
    sample = kept.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(REFERENCES).toArrow().column(0).combine_chunks()
    if not len(sample):
        return rows.sparkSession.createDataFrame([], out)
    width = len(sample[0])
    refs = directions(whole(sample, scale, width))
    sizes = kept.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("anchor"), 1)).alias("anchors")).first()
    measured = kept.select("id", "label", "anchor", _measurer(refs, scale, width)("vector").alias("m")).select("id", "label", "anchor", "m.*")
    stored = _dealt(measured.withColumn("row", F.monotonically_increasing_id()), ceil(sizes.rows / STRIPE_ROWS), "stripe")
    asked = _dealt(stored.filter("anchor").drop("stripe"), max(1, ceil(sizes.anchors / STRIPE_ROWS)), "band")

    places = ["row", "id", "label", "q", "norm", "angles"]
    stripes = stored.select("stripe").distinct()
    bands = asked.select("band").distinct()
    met = _cells(asked, stored, bands.join(stripes, how="cross"), places, places)  # numbers of parts only
    best = met.applyInArrow(_positive_finder(positives), f"anchor bigint, id {id_type}, row bigint, score bigint")
    by_score = [F.desc("score"), F.asc_nulls_last("id"), "row"]
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("anchor").orderBy(*by_score))).filter(F.col("rank") <= positives)
    # A positive scored below 0 has an empty band.
    lists = best.filter("score >= 0").groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("positives"))
    lists = lists.withColumnRenamed("anchor", "row")
    wanted = cut_lineage(asked.join(lists, "row").select(*places, "band", "positives"))

    least = F.array_min(F.transform("positives", lambda p: F.ceil(p["score"] * low / F.lit(100.0)) - 1)).cast("double")
    most = F.array_max(F.transform("positives", lambda p: F.floor(p["score"] * high / F.lit(100.0)) + 1)).cast("double")
    looked = wanted.withColumns({"least": least, "most": most})
    a = _ranges(looked, "band", len(refs), F.min("least").alias("least"), F.max("most").alias("most")).withColumnsRenamed(
        {c: f"a_{c}" for c in ("low_angles", "high_angles", "low_norm", "high_norm")}
    )
    overlap = _overlaps(len(refs))("a_low_angles", "a_high_angles", "a_high_norm", "low_angles", "high_angles", "low_norm", "high_norm", "least", "most")
    cells = a.join(_ranges(stored, "stripe", len(refs)), how="cross").filter(overlap).select("band", "stripe")
    columns = f"anchor bigint, anchor_id {id_type}, place bigint, positive_id {id_type}, positive_score bigint, id {id_type}, row bigint, score bigint"
    near = _cells(wanted, stored, cells, [*places, "positives"], places).applyInArrow(_negative_finder(low, high, negatives), columns)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("anchor", "place").orderBy(*by_score))).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op11_hard_negatives(embeddings: DataFrame) -> DataFrame:
    """Every 100th embedding's hard negatives among all embeddings; labels of every 7th are moved on first. Edge cases as in ``mine``."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = embeddings.select("vec_id", "embedding", moved.alias("label"))
    return mine(rows, F.col("vec_id") % 100 == 0)


OP11_SQL = f"""
with ints as materialized (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as v
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
met as materialized (
  select a.vec_id as anchor_id, b.vec_id as other, a.label = b.label as same,
         list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::bigint as score
  from ints a join ints b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
positives as (
  select *, row_number() over (partition by anchor_id order by score desc, other) as place from met where same),
negatives as (
  select p.anchor_id, p.other as positive_id, n.other as negative_id, p.score as positive_score, n.score as negative_score,
         row_number() over (partition by p.anchor_id, p.other order by n.score desc, n.other)::int as rank
  from positives p join met n on p.anchor_id = n.anchor_id and not n.same
   and {LOW} * p.score <= 100 * n.score and 100 * n.score <= {HIGH} * p.score
  where p.place <= {POSITIVES})
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from negatives where rank <= {NEGATIVES}
"""
