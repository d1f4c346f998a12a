"""Exact duplicates by content sort, with DataFrame functions only.

Texts are equal when they are identical after deleting white space. Rows are dealt out in
ranges of (first bytes, hash) with splitters that Spark samples, sorted on disk where
needed, and neighbours are compared over the whole normalised text. Prefix and hash only decide
where a row goes and where it is sorted.

A text with more than ``PART_ROWS`` rows is cut into parts by a hash of the id, each sorted
on its own; the winner of the parts comes from an aggregate that combines on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.llm.common import SPACE, col, packed, unpacked
from fathomline.session import cut_lineage

PART_ROWS = 1000  # rows of one text that are sorted together
PREFIX = 16  # characters of the text that lead the sort


def squeezed(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACE, "")


def exact_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", part_rows: int = PART_ROWS) -> DataFrame:
    """Every row with ``keep_id, group_size, kept, text_sha256``.

    Of equal texts the row with the most code points in the original text stays, then the
    smallest id; null ids come last. Of repeated rows exactly one stays. Null and empty
    texts are equal to each other. An empty table gives an empty table; input columns
    with the names of added ones are replaced.
    """
    n_chars = F.length(F.coalesce(F.col(f"row.`{text}`"), F.lit("")))
    norm = squeezed(F.col(f"row.`{text}`"))
    row_id = F.col(f"row.`{doc_id}`")
    keyed = packed(docs).select("row", F.substring(norm, 1, PREFIX).alias("lead"), F.xxhash64(norm).alias("code"))

    frequent = keyed.groupBy("code").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > part_rows)
    parts = cut_lineage(frequent.select("code", F.ceil(F.col("n") / part_rows).alias("parts")))
    # Few codes as a rule: the written table is small enough for the optimizer to send it to all tasks, else it sorts.
    placed = keyed.join(parts, "code", "left").withColumn("part", F.pmod(F.xxhash64(row_id, n_chars), F.col("parts")))

    rank = [n_chars.desc(), row_id.asc_nulls_last()]
    equal = Window.partitionBy("lead", "code", "part", "norm")
    seen = (
        placed.repartitionByRange("lead", "code", "part")
        .withColumn("norm", norm)
        .withColumns(
            {
                "place": F.row_number().over(equal.orderBy(*rank)),
                "best": F.first(row_id).over(equal.orderBy(*rank)),
                "size": F.count(F.lit(1)).over(equal),
            }
        )
        .withColumn("sha", F.sha2(F.col("norm").cast("binary"), 256))
    )

    order = F.struct((-n_chars).alias("n"), row_id.isNull().alias("none"), row_id.alias("id"), F.col("part").alias("part"))
    split = (
        placed.filter(F.col("parts").isNotNull())
        .groupBy(norm.alias("norm"))
        .agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("total"))
    )
    merged = cut_lineage(split.select(F.sha2(F.col("norm").cast("binary"), 256).alias("of"), "first", "total"))

    joined = seen.join(merged, F.when(F.col("part").isNotNull(), F.col("sha")) == F.col("of"), "left")
    whole = F.col("of").isNull()
    return unpacked(
        joined,
        docs.columns,
        {
            "keep_id": F.when(whole, F.col("best")).otherwise(F.col("first.id")),
            "group_size": F.when(whole, F.col("size")).otherwise(F.col("total")).cast("long"),
            "kept": (F.col("place") == 1) & (whole | (F.col("part") == F.col("first.part"))),
            "text_sha256": F.col("sha"),
        },
    )


def op6_exact_dedup(docs: DataFrame) -> DataFrame:
    found = exact_dedup(docs.select("doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP6_SQL = r"""
with t as (
  select doc_id, length(coalesce(text, '')) as n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') as norm
  from documents),
r as (
  select *, row_number() over w as place, first_value(doc_id) over w as keep_id, count(*) over (partition by norm) as group_size
  from t window w as (partition by norm order by n desc, doc_id asc nulls last))
select doc_id, keep_id, group_size, place = 1 as kept, sha256(norm) as text_sha256 from r
"""
