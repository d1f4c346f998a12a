"""Mixing sources to target weights, with DataFrame functions only.

The words of a source are laid end to end and cut into blocks of ``BLOCK`` words. A source
takes as many slots as its target needs; every slot is drawn into one of the output shards
(multinomial counts, given the source's total), and the slots of a source run through
pseudorandom permutations of its blocks: the first pass uses each block once, a second
pass starts another permutation. Blocks and slots meet in a join on (source, block).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.llm.common import WORD, col
from fathomline.session import cut_lineage

BLOCK = 64  # words in a block
SHARD_SLOTS = 65_536  # slots of an output shard, about 4 million words
BUCKET_ROWS = 1000  # documents of a source that one task lays end to end
TASK_SLOTS = 131_072  # slots a task maps to blocks
CHUNK = 8192  # slots one row is expanded to
ROUNDS = 12  # of the permutation
WEIGHTS = (5, 2, 1)  # by the rank of the source, repeating


@dataclass(frozen=True)
class Mix:
    """``sources``: source, source_size, target, blocks, slots. ``slots``: source, shard, slot, block.
    ``pieces``: source, doc_id, size, start, block, words: what each document puts into each block."""

    sources: DataFrame
    slots: DataFrame
    pieces: DataFrame


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size) with ``weight`` and ``target``.

    Ranks are by code point with null last. Targets above ``most`` times the size are
    cut to that and the excess is dealt anew by weight until none is above; the loop only carries sums.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))  # one row per source
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.pmod(rank - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    ranked = cut_lineage(sizes.select("source", "source_size", weight.alias("weight")))
    cap = F.col("source_size") * most
    left, level, full = 0.0, 0.0, -1
    while True:
        above = F.lit(level) * F.col("weight") >= cap if full >= 0 else F.lit(False)
        sums = ranked.agg(
            F.sum(F.when(above, 1).otherwise(0)).alias("n"),
            F.sum(F.col("source_size")).alias("all"),
            F.sum(F.when(above, cap).otherwise(0.0)).alias("capped"),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("weights"),
        ).first()
        if sums["n"] is None or sums["n"] == full or not sums["weights"]:
            break
        full = sums["n"]
        level = (sums["all"] * share - sums["capped"]) / sums["weights"]
    return ranked.withColumn("target", F.least(F.lit(level) * F.col("weight"), cap))


def permuted(index: Column, n: Column, *seeds: Column) -> Column:
    """A pseudorandom permutation of 0..n-1: in each round an index swaps with its partner or stays, as a hash of the larger one says."""

    def swap(x: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(F.lit("partner"), r, *seeds), n) - x, n)
        larger = F.greatest(x, partner)
        return F.when(F.pmod(F.xxhash64(F.lit("swap"), r, larger, *seeds), F.lit(2)) == 1, partner).otherwise(x)

    return F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), index.cast("long"), swap)


def laid_out(sized: DataFrame) -> DataFrame:
    """(source, doc_id, size, tie) with ``start``, the words of the source before the row.

    A source is cut into buckets by a hash; each is summed on its own and shifted by those before it.
    """
    per_source = sized.groupBy("source").agg(F.count(F.lit(1)).alias("rows"))
    buckets = cut_lineage(per_source.select("source", F.ceil(F.col("rows") / BUCKET_ROWS).alias("buckets")))
    dealt = sized.join(buckets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    dealt = dealt.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "tie"), F.col("buckets")))
    sums = dealt.groupBy("source", "bucket").agg(F.sum("size").alias("sum"))
    before = F.sum("sum").over(Window.partitionBy("source").orderBy("bucket")) - F.col("sum")
    shifts = cut_lineage(sums.select(F.col("source").alias("of"), F.col("bucket").alias("at"), before.alias("before")))
    inside = Window.partitionBy("source", "bucket").orderBy("doc_id", "tie", "size").rowsBetween(Window.unboundedPreceding, 0)
    running = dealt.withColumn("upto", F.sum("size").over(inside))
    same = F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("at"))
    return running.join(shifts, same).select("source", "doc_id", "size", (F.col("before") + F.col("upto") - F.col("size")).alias("start"))


def draw(sources: DataFrame, seed: int) -> DataFrame:
    """(source, shard, slot, block): the slots of every source, dealt to shards and mapped to blocks."""
    total = sources.agg(F.sum("slots")).first()[0] or 0
    shards = F.lit(max(1, -(-total // SHARD_SLOTS)))
    tasks = max(1, -(-total // TASK_SLOTS))  # stated, as a few short rows grow to many
    chunks = sources.filter(F.col("slots") > 0).select(
        "source", "blocks", "slots", F.explode(F.sequence(F.lit(0), F.floor((F.col("slots") - 1) / CHUNK))).alias("chunk")
    )
    ends = F.least((F.col("chunk") + 1) * CHUNK, F.col("slots")) - 1
    drawn = chunks.repartition(tasks, "source", "chunk").select(
        "source", "blocks", F.explode(F.sequence(F.col("chunk") * CHUNK, ends)).alias("draw")
    )
    shard = F.pmod(F.xxhash64(F.lit("shard"), F.lit(seed), "source", "draw"), shards)
    counts = drawn.groupBy("source", "blocks", shard.alias("shard")).agg(F.count(F.lit(1)).alias("n"))
    first = F.sum("n").over(Window.partitionBy("source").orderBy("shard")) - F.col("n")
    cells = counts.withColumn("first", first)
    slots = cells.repartition(tasks, "source", "shard").select(
        "source", "blocks", "shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("slot")
    )
    turn = F.floor(F.col("slot") / F.col("blocks"))
    block = permuted(F.col("slot") - turn * F.col("blocks"), F.col("blocks"), F.lit(seed), F.col("source"), turn)
    return slots.select("source", "shard", "slot", block.alias("block"))


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", seed: int = 8) -> Mix:
    """The mix of all documents.

    Null sources form one source, null and blank texts have no words and are never drawn. Rows
    may repeat, also with one id: each takes its own place in the source. Reruns give the same
    mix, whatever the partitions.
    """
    body = F.coalesce(col(text), F.lit(""))
    sized = cut_lineage(docs.select(col(source).alias("source"), col(doc_id).alias("doc_id"), words(body).alias("size"), F.xxhash64(body).alias("tie")))
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    blocks = F.ceil(F.col("source_size") / BLOCK)
    slots = F.when(F.col("source_size") > 0, F.round(F.col("target") * F.col("blocks") / F.col("source_size"))).otherwise(0)
    sources = cut_lineage(
        targets(sizes).withColumn("blocks", blocks.cast("long")).withColumn("slots", F.least(slots, F.col("blocks") * 2).cast("long"))
    )
    rows = cut_lineage(laid_out(sized))
    last = F.when(F.col("size") > 0, F.floor((F.col("start") + F.col("size") - 1) / BLOCK)).otherwise(F.floor(F.col("start") / BLOCK))
    pieces = rows.select("*", F.explode(F.sequence(F.floor(F.col("start") / BLOCK), last)).alias("block")).withColumn(
        "words",
        F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * BLOCK) - F.greatest(F.col("start"), F.col("block") * BLOCK),
    )
    return Mix(sources, draw(sources, seed), pieces)


def op8_mixing(docs: DataFrame) -> DataFrame:
    """Per row doc_id, size, source_size, target and taken: the words of it that the mix takes, repeats counted."""
    made = mix(docs)
    uses = made.slots.groupBy("source", "block").agg(F.count(F.lit(1)).alias("uses"))
    # Written, so that its size is known: the optimizer does not count what explode adds and would send it to all tasks.
    uses = cut_lineage(uses.select(F.col("source").alias("of"), F.col("block").alias("at"), "uses"))
    same = F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at"))
    taken = made.pieces.join(uses, same, "left").withColumn("took", F.col("words") * F.coalesce(F.col("uses"), F.lit(0)))
    per_row = taken.filter(F.col("size") > 0).groupBy("source", "start", "doc_id", "size").agg(F.sum("took").alias("taken"))
    blank = made.pieces.filter(F.col("size") == 0).select("source", "start", "doc_id", "size", F.lit(0).cast("long").alias("taken"))
    rows = per_row.unionByName(blank)
    per_source = made.sources.select(F.col("source").alias("of"), "source_size", "target")
    out = rows.join(per_source, F.col("source").eqNullSafe(F.col("of")))
    return out.select("doc_id", "size", "source_size", "target", "taken")
