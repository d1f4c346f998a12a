"""Vector code compression: product quantisation in whole numbers.

Components become integers, vectors are cut into equal parts, and each part position has a small codebook
that is refined in rounds. Distances to the entries come from exact products of limbs in float64 BLAS, joined in
int64, and the first smallest one is the code. All sums are integers, so no order of rows or tasks changes a result.

A round is one scan: every task adds its own sums per entry, Spark adds those of the tasks, and the new codebook
(parts x entries x components numbers, bounded by the parameters) goes out with the next round. Nothing else is shuffled,
written or kept between rounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import col, packed, unpacked
from fathomline.llm.exact_gemm import exact_dot, finite, whole
from fathomline.operators.skew import spread_join
from fathomline.session import cut_lineage

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096


def nearest(parts: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and squared distances (rows, parts) of parts (rows, parts, width) in books (parts, entries, width)."""
    codes = np.empty(parts.shape[:2], dtype=np.int64)
    errors = np.empty(parts.shape[:2], dtype=np.int64)
    for p in range(parts.shape[1]):
        x, book = np.ascontiguousarray(parts[:, p]), books[p]
        far = (x * x).sum(axis=1)[:, None] - 2 * exact_dot(x, book) + (book * book).sum(axis=1)
        codes[:, p] = far.argmin(axis=1)
        errors[:, p] = far[np.arange(len(x)), codes[:, p]]
    return codes, errors


def moved(books: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Books with each entry replaced by floor(sum / count); totals (parts, entries, width + 1) has the count last."""
    count = totals[..., -1:]
    return np.where(count > 0, totals[..., :-1] // np.maximum(count, 1), books)


def _cut(batch: pa.Array, scale: int, parts: int, width: int) -> np.ndarray:
    return whole(batch, scale, width).reshape(-1, parts, width // parts)


def _summer(books: np.ndarray, scale: int):
    parts, entries, width = books.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((parts, entries, width + 1), dtype=np.int64)
        for batch in batches:
            x = _cut(batch.column(0), scale, parts, parts * width)
            codes, _ = nearest(x, books)
            for p in range(parts):
                np.add.at(totals[p, :, :-1], codes[:, p], x[:, p])
                totals[p, :, -1] += np.bincount(codes[:, p], minlength=entries)
        slots = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(totals.ravel()[slots])], names=["slot", "total"])

    return add


def _coder(books: np.ndarray, scale: int):
    parts, _, width = books.shape

    @F.arrow_udf("struct<code: string, error: bigint>")
    def code(vectors: pa.Array) -> pa.Array:
        codes, errors = nearest(_cut(vectors, scale, parts, parts * width), books)
        text = ["".join(f"{c:02x}" for c in row) for row in codes.tolist()]
        return pa.StructArray.from_arrays([pa.array(text, pa.string()), pa.array(errors.sum(axis=1))], names=["code", "error"])

    return code


def _kept(df: DataFrame, vector: str) -> DataFrame:
    return df.filter(finite(col(vector)))


def fit(
    df: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> np.ndarray | None:
    """The codebooks (parts, entries, components of a part), None without a usable vector.

    They start as the parts of the ``entries`` smallest ids (null ids last, ties by the vector), fewer if there
    are fewer rows; entries that no part is nearest to stay as they are.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code of two hex digits needs 1 to 256 entries")
    vectors = _kept(df, vector).select(col(vector).cast("array<double>").alias("vector"), col(vec_id).alias("vec_id"))
    first = vectors.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).select("vector").toArrow()
    if not first.num_rows:
        return None
    start = first.column("vector").combine_chunks()
    width = len(start[0])
    if not width or width % parts:
        raise ValueError(f"{width} components can't be cut into {parts} equal parts")
    books = np.ascontiguousarray(_cut(start, scale, parts, width).transpose(1, 0, 2))
    for _ in range(rounds):
        sums = vectors.select("vector").mapInArrow(_summer(books, scale), "slot long, total long").groupBy("slot").agg(F.sum("total").alias("total"))
        totals = np.zeros((books.shape[0], books.shape[1], books.shape[2] + 1), dtype=np.int64)
        for row in sums.collect():  # at most parts x entries x (components + 1) rows
            totals.flat[row.slot] = row.total
        books = moved(books, totals)
    return books


def books_digest(books: np.ndarray) -> str:
    return sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(df: DataFrame, books: np.ndarray | None, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """The rows with a usable vector, with ``code`` (two hex digits a part) and ``error`` (squared distances summed over parts).

    Rows whose vector is null or holds null or non-finite components are left out. Ties go to the first entry. Repeated rows and ids
    are coded row by row. ``code`` and ``error`` take the place of input columns of these names. An empty table gives an empty one.
    Vectors of other lengths than the first one's and scaled components above 2**53 are errors, never silently wrong.
    """
    rows = packed(_kept(df, vector))
    if books is None:
        books = np.zeros((1, 1, 1), dtype=np.int64)  # no row is left that could be coded
    coded = rows.withColumn("coded", _coder(books, scale)(F.col(f"row.`{vector}`").cast("array<double>")))
    return unpacked(coded, df.columns, {"code": F.col("coded.code"), "error": F.col("coded.error")})


def with_label_error(coded: DataFrame, label: str = "label") -> DataFrame:
    """Add ``label_error``: the error summed over equal labels, nulls together. A label may hold most of the rows."""
    row = packed(coded).withColumns({"of": F.col(f"row.`{label}`"), "spread": F.xxhash64("row")})
    sums = coded.groupBy(col(label).alias("sum_of")).agg(F.sum(col("error")).alias("total"))
    joined = spread_join(row, sums, "of", "sum_of", "inner", ["spread"], null_safe=True)
    return unpacked(joined, coded.columns, {"label_error": F.col("total")})


def op12_vector_codes(embeddings: DataFrame) -> DataFrame:
    """Codes and errors of all usable embeddings, with the codebooks of the whole table. Edge cases as in ``fit`` and ``encode``."""
    books = fit(embeddings)
    coded = cut_lineage(encode(embeddings.select("vec_id", "label", "embedding"), books).select("vec_id", "label", "code", "error"))
    digest = F.lit(None if books is None else books_digest(books)).cast("string")
    return with_label_error(coded).select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))


def _sql() -> str:
    """The rounds written out: books, distances, first nearest entry, integer means rounded down."""
    steps = [
        f"""ints as materialized (
  select vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pieces as materialized (
  select vec_id, label, p, v[p * (len(v) // {PARTS}) + 1 : (p + 1) * (len(v) // {PARTS})] as x
  from ints, range({PARTS}) as r(p)),
book0 as materialized (
  select p, k, x as c from pieces join (select vec_id, row_number() over (order by vec_id) - 1 as k from ints order by vec_id limit {ENTRIES}) using (vec_id))"""
    ]
    for r in range(ROUNDS + 1):
        steps.append(
            f"""near{r} as materialized (
  select vec_id, label, p, x, (best).k as k, (best).d as d from (
    select vec_id, any_value(label) as label, q.p as p, any_value(x) as x,
           min({{'d': list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint, 'k': k}}) as best
    from pieces q join book{r} b on q.p = b.p group by vec_id, q.p))"""
        )
        if r < ROUNDS:
            steps.append(
                f"""book{r + 1} as materialized (
  select b.p, b.k, coalesce(m.c, b.c) as c from book{r} b left join (
    select p, k, list(((s - ((s % n) + n) % n) // n)::bigint order by i) as c from (
      select p, k, i, sum(x[i])::bigint as s, count(*) as n from near{r}, range(1, 1 + (select max(len(x)) from pieces)) as g(i) group by p, k, i) group by p, k) m
  on b.p = m.p and b.k = m.k)"""
            )
    steps.append(
        f"""coded as (
  select vec_id, any_value(label) as label, string_agg(printf('%02x', k), '' order by p) as code, sum(d)::bigint as error from near{ROUNDS} group by vec_id),
digest as (
  select sha256(string_agg(array_to_string(c, ','), ',' order by p, k)) as codebooks_sha256 from book{ROUNDS})"""
    )
    return (
        "with " + ",\n".join(steps) + "\nselect vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256 from coded, digest"
    )


OP12_SQL = _sql()
