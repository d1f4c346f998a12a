"""Communities in the transaction graph."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.operators import moves
from fathomline.operators.skew import HOT_PARTS, HOT_ROWS, hot_keys, key_code, list_parts, spread_join
from fathomline.session import AlternatingBuckets, cut_lineage

HELD_ROWS = 50_000  # rows of a part of the edges that are kept in place, at the least
FEW = 50  # below one in so many nodes changed, only those whose votes may differ vote anew
TASK_ROWS = 8_000_000  # nodes and edges of a level of Louvain that one task settles in arrays, at the most
SENT_ROWS = 100_000  # rows that such a task sends back together


def digraph(edges: DataFrame, weight: str = "Weight") -> DataFrame:
    """Sum of weights per directed pair."""
    return edges.groupBy(F.col("Source").alias("src"), F.col("Target").alias("dst")).agg(F.sum(weight).alias("w"))


def ugraph(edges: DataFrame, weight: str = "Weight") -> DataFrame:
    """Sum of weights per unordered pair (a <= b)."""
    a, b = F.least("Source", "Target"), F.greatest("Source", "Target")
    return edges.groupBy(a.alias("a"), b.alias("b")).agg(F.sum(weight).alias("w"))


def _nodes(edges: DataFrame, a: str, b: str) -> DataFrame:
    return edges.select(F.explode(F.array(a, b)).alias("node")).distinct()


def _codes(nodes: DataFrame) -> DataFrame:
    """A number (``id``) for every node, in the order of the names, so that the smallest number is the smallest name."""
    ordered = nodes.filter("node is not null").orderBy("node")
    return cut_lineage(ordered.select("node", F.monotonically_increasing_id().alias("id")))


def _coded(edges: DataFrame, codes: DataFrame, *ends: str) -> DataFrame:
    """The edges with the numbers of their ends; an end without a name has none."""
    hot = hot_keys(edges, *ends)
    for e in ends:
        others = [c for c in edges.columns if c != e]
        edges = spread_join(edges, codes.select(F.col("node").alias("_name"), F.col("id").alias("_id")), e, "_name", "left", others, hot)
        edges = edges.withColumn(e, F.col("_id")).drop("_id")
    return cut_lineage(edges)


def _named(found: DataFrame, codes: DataFrame) -> DataFrame:
    """Names for the numbers of nodes and communities."""
    for c in ("community", "node"):
        others = [x for x in found.columns if x != c]
        known = codes.select(F.col("id").alias("_number"), F.col("node").alias("_name"))
        found = spread_join(found, known, c, "_number", "left", others).withColumn(c, F.col("_name")).drop("_name")
    return cut_lineage(found.select("node", "community"))


def _parts(edges: DataFrame) -> int:
    """How many parts edges are kept in."""
    most = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(most, edges.count() // HELD_ROWS))


def _held(edges: DataFrame, end: str, hot: list[int], parts: int) -> DataFrame:
    """Edges kept split and sorted by one end, so that joins on it move and sort the other side only; as they are when some ends are hot."""
    if hot:
        return edges
    return edges.repartition(parts, end).sortWithinPartitions(end).persist()


def _spread(rows: DataFrame, key: str, by: str, hot: list[int]) -> tuple[DataFrame, list[str]]:
    """Rows placed by ``key`` in one shuffle, those of a hot key by a hash of ``by`` as well, and the columns that place them."""
    if not hot:
        return rows.repartition(key), [key]
    part = F.when(key_code([key]).isin(hot), F.pmod(F.xxhash64(by), F.lit(HOT_PARTS))).otherwise(F.lit(0))
    return rows.withColumn("_part", part).repartition(key, "_part"), [key, "_part"]


def _vote(seen: DataFrame, state: DataFrame, payers: list[int], parts: int) -> DataFrame:
    """The state after the votes ``seen`` (src, label): for each payer among them its out-neighbours' most frequent label, how many hold it (``n``),
    and how many its own (``kept``); all others keep theirs. Votes move to the state, which stays in its buckets."""
    if payers:
        # The own label stands for election with no vote, so one aggregate gives both counts; nodes without a vote drop out again.
        own = state.select(F.col("id").alias("src"), F.col("community").alias("label"), F.lit(0).alias("n"), F.lit(True).alias("own"))
        stood, by = _spread(seen.select("src", "label", F.lit(1).alias("n"), F.lit(False).alias("own")).unionByName(own), "src", "label", payers)
        counts = stood.groupBy(*by, "label").agg(F.sum("n").alias("n"), F.max("own").alias("own"))
        best = F.min(F.when(F.col("n") > 0, F.struct((-F.col("n")).alias("n"), "label")))
        per = counts.groupBy(*by).agg(best.alias("_best"), F.max(F.when(F.col("own"), F.col("n"))).alias("_own"))
        per = per.groupBy("src").agg(F.min("_best").alias("_best"), F.max("_own").alias("_own")).filter("_best is not null")
        voted = state.join(per.hint("merge"), F.col("id") == F.col("src"), "left")
    else:
        counts = seen.repartition(parts, "src").groupBy("src", F.col("label").alias("_vote")).agg(F.count(F.lit(1)).alias("_times"))
        met = state.join(counts.hint("merge"), F.col("id") == F.col("src"), "left")
        best = F.min(F.when(F.col("src").isNotNull(), F.struct((-F.col("_times")).alias("n"), F.col("_vote").alias("label"))))
        own = F.max(F.when(F.col("_vote").eqNullSafe(F.col("community")), F.col("_times")))
        voted = met.groupBy("id").agg(*[F.first(c).alias(c) for c in state.columns if c != "id"], best.alias("_best"), own.alias("_own"))
    anew = F.col("_best").isNotNull()
    return voted.select(
        "node", "id", "community", "changes", F.when(anew, F.col("_best.label")).otherwise(F.col("label")).alias("label"),
        F.when(anew, -F.col("_best.n")).otherwise(F.col("n")).alias("n"), F.when(anew, F.coalesce("_own", F.lit(0))).otherwise(F.col("kept")).alias("kept"),
    )


def label_propagation(edges: DataFrame, patience: int | None = 8, turn: str = "e") -> DataFrame:
    """Communities by repeated majority vote of the out-neighbours, until no node wants another label.

    The vote goes to the most frequent label, the smallest of equals. A node wants it when it is more frequent among the
    out-neighbours than its own label. The nodes whose hash of node and round begins with a hex digit below ``turn`` may change in a round
    ("8": half of them, "e": seven of eight), so that neighbours do not keep swapping labels. A node that pays nobody keeps its own id.

    Without ``patience`` votes go on until they are settled, which on a few graphs is never. With it, after ``patience`` changes of a node
    each further one asks for one more vote than the last. So a node changes fewer than ``patience`` times plus the number of its
    out-neighbours, and every graph comes to an end, but some nodes may keep a label that another one outnumbers.

    Nodes are numbered in the order of their names. Edges stay where they are, split by either end, and so does the state, in as many buckets: a
    round moves the votes only. When few nodes have changed, only their payers and they themselves vote anew. States are written in turn to two folders.
    """
    pairs = cut_lineage(edges.select(F.col("src"), F.col("dst")).distinct())
    codes = _codes(_nodes(pairs, "src", "dst"))
    coded = _coded(pairs, codes, "src", "dst")
    hot, payers = hot_keys(coded, "dst"), hot_keys(coded, "src")
    parts = _parts(coded)
    by_dst, by_src = _held(coded, "dst", hot, parts), _held(coded, "src", payers, parts)
    steps = AlternatingBuckets(edges.sparkSession, "id", parts)
    # At first every label is its own node's, so the smallest out-neighbour wins with one vote.
    first = coded.filter("src is not null").groupBy("src").agg(F.min(F.struct("dst")).alias("_d"), F.max(F.expr("int(src = dst)")).alias("_k"))
    start = first.join(codes, F.col("src") == F.col("id")).select(
        "node", "id", F.col("id").alias("community"), F.lit(0).alias("changes"), F.col("_d.dst").alias("label"),
        F.lit(1).cast("long").alias("n"), F.coalesce("_k", F.lit(0)).cast("long").alias("kept"),
    )
    state = steps.write(start)
    asked = F.lit(0) if patience is None else F.greatest(F.col("changes") - patience, F.lit(0))
    wants = F.col("n") > F.col("kept") + asked
    step = 0
    while True:
        step += 1
        moves = wants & (F.substring(F.md5(F.concat(F.col("node"), F.lit(f":{step}"))), 1, 1) < turn)
        count = state.agg(F.count_if(wants).alias("wants"), F.count_if(moves).alias("moves"), F.count(F.lit(1)).alias("nodes")).first()
        if not count.wants:
            break
        if not count.moves:
            continue
        after = state.select(
            "node", "id", F.when(moves, F.col("label")).otherwise(F.col("community")).alias("community"),
            (F.col("changes") + F.when(moves, 1).otherwise(0)).alias("changes"), "label", "n", "kept",
        )
        voting = by_dst
        if count.moves * FEW < count.nodes:
            moved = state.filter(moves).select(F.col("id").alias("_moved"))
            payers_of = spread_join(by_dst, moved.hint("merge"), "dst", "_moved", "left_semi", ["src"], hot).select("src")
            voters = payers_of.union(moved).toDF("_voter").repartition(parts, "_voter").distinct()
            voting = spread_join(by_src, voters.hint("merge"), "src", "_voter", "left_semi", ["dst"], payers).repartition(parts, "dst")
        labels = after.select(F.col("id").alias("_dst"), "community").hint("merge")
        seen = spread_join(voting, labels, "dst", "_dst", "left", ["src"], hot).select("src", F.coalesce("community", "dst").alias("label"))
        state = steps.write(_vote(seen, after, payers, parts))
    everyone = _nodes(coded, "src", "dst").join(state.select("id", "community").hint("merge"), F.col("node") == F.col("id"), "left")
    result = _named(everyone.select("node", F.coalesce("community", "node").alias("community")), codes)
    steps.close()
    by_dst.unpersist()
    by_src.unpersist()
    return result


def modularity(edges: DataFrame, communities: DataFrame, weight: str = "w") -> DataFrame:
    """Modularity of a partition of a weighted undirected graph (a, b, w)."""
    ends = _community_ends(edges.select("a", "b", F.col(weight).alias("w")), communities)
    total = ends.agg(F.sum("w").alias("m")).scalar()
    sides = ends.select(
        "w",
        (F.col("ca") == F.col("cb")).alias("inside"),
        F.explode(F.array("ca", "cb")).alias("community"),
    )
    # Each inner edge appears twice here, which is what a degree sum counts.
    per = sides.groupBy("community").agg(
        F.sum(F.when(F.col("inside"), F.col("w") / 2.0).otherwise(0.0)).alias("inner"), F.sum("w").alias("degree")
    )
    return per.agg(F.sum(F.col("inner") / total - (F.col("degree") / (2.0 * total)) ** 2).alias("modularity"))


def _community_ends(edges: DataFrame, communities: DataFrame) -> DataFrame:
    a = communities.select(F.col("node").alias("_a"), F.col("community").alias("ca"))
    b = communities.select(F.col("node").alias("_b"), F.col("community").alias("cb"))
    hot = hot_keys(edges, "a", "b")
    return spread_join(spread_join(edges, a, "a", "_a", "inner", ["b"], hot), b, "b", "_b", "inner", ["a"], hot)


def _proposals(both: DataFrame, placed: DataFrame, m2: float, hubs: list[int]) -> DataFrame:
    """Per node its community, the weight it has there (``inner``), the community's degree, and the best move with its gain.

    The gain is that of modularity times m2 / 2, so a move with a positive gain, made alone, raises modularity. The own community stands
    among the options without weight, so one shuffle of the edges gives all of them.
    """
    ends = placed.select(F.col("id").alias("_v"), F.col("community").alias("to"), F.col("own_tot").alias("tot")).hint("merge")
    seen = spread_join(both, ends, "v", "_v", "inner", ["u"], hubs).select("u", "k", "to", "tot", "w", F.lit(False).alias("own"))
    own = placed.select(F.col("id").alias("u"), "k", F.col("community").alias("to"), F.col("own_tot").alias("tot"), F.lit(0.0).alias("w"), F.lit(True).alias("own"))
    options, by = _spread(seen.unionByName(own), "u", "to", hubs)
    towards = options.groupBy(*by, "to").agg(F.sum("w").alias("w_in"), F.max("tot").alias("tot"), F.max("k").alias("k"), F.max("own").alias("own"))
    worth = F.col("w_in") - F.col("tot") * F.col("k") / m2
    per = towards.groupBy(*by).agg(
        F.min(F.when(~F.col("own"), F.struct((-worth).alias("loss"), F.col("to").alias("to")))).alias("best"),
        F.max(F.when(F.col("own"), F.col("w_in"))).alias("_inner"),
    )
    if hubs:
        per = per.groupBy("u").agg(F.min("best").alias("best"), F.max("_inner").alias("_inner"))
    inner = F.coalesce("_inner", F.lit(0.0))
    gain = -F.col("best.loss") - (inner - (F.col("own_tot") - F.col("k")) * F.col("k") / m2)
    joined = placed.join(per.hint("merge"), F.col("id") == F.col("u"), "left")
    return joined.select("node", "id", "k", "community", "own_tot", inner.alias("inner"), F.col("best.to").alias("to"), F.coalesce(gain, F.lit(0.0)).alias("gain"))


def _alone(wanted: DataFrame) -> DataFrame:
    """Moves (node, to) that share no community: each is the best of all that leave or enter either of its two communities.

    Degrees and weights they count with are touched by no other of them, so their gains add up. There always is one, the best of all.
    """
    rank = F.struct("gain", F.col("id").alias("by"))
    claims = wanted.select(F.explode(F.array("community", "to")).alias("claimed"), rank.alias("rank"))
    first = claims.groupBy("claimed").agg(F.max("rank").alias("rank"))
    won = first.groupBy(F.col("rank.by").alias("by")).agg(F.count(F.lit(1)).alias("won")).filter("won = 2")
    return wanted.join(won, F.col("id") == F.col("by"), "left_semi").select(F.col("id").alias("_id"), F.col("to").alias("_to"))


def _in_one_task(m2: float):
    """The rounds of ``_local_moves`` on rows (a, b, w) of edges and (id, hash of the name, degree) of nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = ([], [])
        for batch in batches:
            is_node = batch.column(3).to_numpy(zero_copy_only=False)
            columns = [batch.column(i).to_numpy() for i in range(3)]
            for kind, rows in zip(kinds, (~is_node, is_node)):
                kind.append([c[rows] for c in columns])
        if not kinds[1]:
            return
        ids, seeds, k = (np.concatenate(c) for c in zip(*kinds[1]))
        order = np.argsort(ids)
        ids, seeds, k = ids[order], seeds[order], k[order]
        kinds[0][:] = [(*(np.searchsorted(ids, end).astype(np.int32) for end in part[:2]), part[2]) for part in kinds[0]]
        options = moves.Options(*(np.concatenate(c) for c in zip(*kinds[0])), len(ids))
        kinds[0].clear()
        found = ids[moves.settle(options, k, seeds, m2)]
        for at in range(0, len(ids), SENT_ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(c[at : at + SENT_ROWS]) for c in (ids, found)], ["node", "community"])

    return run


def _local_moves(edges: DataFrame, codes: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """Move nodes to the neighbouring community with the best gain until none gains by moving.

    All nodes decide at the same time and half of them, drawn by a hash of node and round, move. If that has not raised modularity, it is taken
    back and the moves that share no community are made instead, which always raises it. So modularity rises with
    every round kept, no partition comes twice, and an end comes without a bound on rounds.

    A level of up to ``task_rows`` nodes and edges makes these rounds in one task, in arrays; a larger one makes each over all tasks.
    """
    sides = edges.filter("a <> b").select(
        F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v"), "w"), F.struct(F.col("b").alias("u"), F.col("a").alias("v"), "w"))).alias("x")
    ).select("x.*")
    degrees = edges.select(F.explode(F.array("a", "b")).alias("_id"), "w").groupBy("_id").agg(F.sum("w").alias("k"))
    nodes = cut_lineage(degrees.join(codes, F.col("_id") == F.col("id"), "left").select("node", "id", "k"))
    sums = nodes.agg(F.sum("k").alias("m2"), F.count(F.lit(1)).alias("n")).first()
    m2, many = sums.m2, sums.n > HOT_ROWS
    if not m2:
        return nodes.select(F.col("id").alias("node"), F.col("id").alias("community"))
    if sums.n + edges.count() <= task_rows:
        ends = edges.filter("a <> b").select("a", "b", "w", F.lit(False).alias("is_node"))
        rows = ends.unionAll(nodes.filter("id is not null").select("id", F.xxhash64("node"), "k", F.lit(True)))
        return rows.repartition(1).mapInArrow(_in_one_task(m2), "node long, community long")
    hubs = hot_keys(sides, "u")  # also those of v, as every edge is there both ways
    weighed = cut_lineage(spread_join(sides, nodes.select(F.col("id").alias("_u"), "k"), "u", "_u", "inner", ["v"], hubs))
    both = _held(weighed, "v", hubs, _parts(weighed))
    kept, score, step, careful = None, float("-inf"), 0, False
    state = nodes.withColumn("community", F.col("id"))
    while True:
        step += 1
        large = hot_keys(state, "community") if many else []  # up to HOT_ROWS nodes no community can be hot
        totals = state.groupBy(F.col("community").alias("_c")).agg(F.sum("k").alias("own_tot")).hint("merge")
        placed = cut_lineage(spread_join(state, totals, "community", "_c", "inner", ["id"], large))
        found = cut_lineage(_proposals(both, placed, m2, hubs))
        gains = F.col("gain") > 1e-9 * m2
        # Modularity times m2, without loops: they stay inside whatever moves. own_tot over its nodes weighed by k sums up squares of degrees.
        sums = found.agg(F.sum(F.col("inner") - F.col("own_tot") * F.col("k") / m2).alias("now"), F.count_if(gains).alias("wanted")).first()
        if kept is None or sums.now > score + 1e-9 * abs(m2):
            kept, score, careful = found, sums.now, False
            if not sums.wanted:
                break
        elif careful:  # gains no larger than rounding
            break
        else:
            careful = True
        if careful:
            chosen = _alone(kept.filter(gains))
            state = kept.join(chosen, F.col("id") == F.col("_id"), "left").select("node", "id", "k", F.coalesce("_to", "community").alias("community"))
        else:
            moves = gains & (F.pmod(F.xxhash64("node", F.lit(step)), F.lit(2)) == 0)
            state = kept.select("node", "id", "k", F.when(moves, F.col("to")).otherwise(F.col("community")).alias("community"))
    both.unpersist()
    return kept.select(F.col("id").alias("node"), "community")


def louvain(edges: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """Modularity communities of a weighted undirected graph (a, b, w): local moves, then contraction, until a level moves nothing.

    Every level but the last joins communities, so there are at most as many levels as nodes; modularity rises with each.
    Nodes are numbered in the order of their names; a community bears the name of one of its nodes.
    """
    weighted = cut_lineage(edges.filter(F.col("w") > 0).select("a", "b", F.col("w").cast("double").alias("w")))
    names = _nodes(weighted, "a", "b")
    codes = _codes(names)
    level = _coded(weighted, codes, "a", "b")
    members = cut_lineage(_nodes(level, "a", "b")).withColumn("community", F.col("node"))
    while True:
        moved = cut_lineage(_local_moves(level, codes, task_rows))
        if moved.filter("node <> community").isEmpty():
            break
        step = moved.select(F.col("node").alias("_old"), F.col("community").alias("_new"))
        joined = spread_join(members, step, "community", "_old", "inner", ["node"])
        members = cut_lineage(joined.select("node", F.col("_new").alias("community")))
        ends = _community_ends(level, moved)
        # Inner weight becomes a loop, which counts once in w and twice in a degree.
        level = cut_lineage(
            ends.groupBy(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).agg(F.sum("w").alias("w"))
        )
    return _named(members, codes)


def community_stats(pairs: DataFrame, communities: DataFrame) -> DataFrame:
    """Density, expansion and conductance per community on simple undirected pairs (a < b).

    The degree sum of a community is 2 * inner + cut edges, so one pass over the edges
    gives all three.
    """
    ends = _community_ends(pairs.filter("a <> b").select("a", "b").distinct(), communities)
    sides = ends.select((F.col("ca") == F.col("cb")).alias("inside"), F.explode(F.array("ca", "cb")).alias("community"))
    per = cut_lineage(
        sides.groupBy("community").agg(F.sum(F.col("inside").cast("long")).alias("_inner"), F.sum((~F.col("inside")).cast("long")).alias("cut"))
    )
    total = per.agg(F.coalesce(F.sum(F.col("_inner") + F.col("cut")), F.lit(0)).alias("d")).scalar()  # every edge has two sides
    sizes = communities.groupBy("community").agg(F.count(F.lit(1)).alias("n"))
    joined = sizes.join(per, "community", "left").withColumns(
        {"_inner": F.coalesce("_inner", F.lit(0)), "cut": F.coalesce("cut", F.lit(0))}
    )
    inside = (F.col("_inner") + F.col("cut")).cast("double")
    outside = total.cast("double") - inside

    def guarded(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    n = F.col("n").cast("double")
    return joined.select(
        "community",
        "n",
        (F.col("_inner") / 2).cast("long").alias("m"),
        "cut",
        guarded(F.col("_inner").cast("double"), n * (n - 1)).alias("density"),
        guarded(inside, outside).alias("expansion"),
        F.when(outside > 0, guarded(F.col("cut").cast("double"), 2 * outside + F.col("cut"))).otherwise(0.0).alias("conductance"),
    )


def quality(stats: DataFrame) -> DataFrame:
    """Mean density, expansion and conductance over communities."""
    return stats.agg(
        F.count(F.lit(1)).alias("communities"),
        *[F.avg(c).alias(c) for c in ("density", "expansion", "conductance")],
    )


def flag_members(members: DataFrame, risk_ids: DataFrame) -> DataFrame:
    """Add Risk = 1 for members on the risk list."""
    marks = risk_ids.select(F.col("id").alias("_risk")).distinct().withColumn("Risk", F.lit(1))
    joined = members.join(marks, F.col("customer_id") == F.col("_risk"), "left").drop("_risk")
    return joined.withColumn("Risk", F.coalesce("Risk", F.lit(0)))


def community_means(members: DataFrame, risk: str = "Risk") -> DataFrame:
    """Mean risk and number of named members per community, risky ones only."""
    per = members.groupBy("community").agg(F.avg(risk).alias("Average_Risk"), F.count("name").alias("Num_Members"))
    return per.filter(F.col("Average_Risk") != 0)


def community_risk(members: DataFrame, risk: str = "Risk", limit: int = 10_000) -> DataFrame:
    """Risky communities with their members, most risky first.

    A community of more than ``limit`` members takes several rows (part 0, 1, ...), each with
    the mean and size of the whole, so that no member is left out and no row is unbounded.
    """
    means = community_means(members, risk).select(F.col("community").alias("_c"), "Average_Risk", "Num_Members")
    large = hot_keys(members, "community")
    inside = spread_join(members, means, "community", "_c", "inner", ["customer_id", "name"], large)
    keyed = list_parts(inside.withColumn("_id", F.concat_ws("|", "customer_id", "name")), "community", "_id", limit, large)
    entry = F.sort_array(F.collect_list(F.struct("name", "customer_id")))
    lists = keyed.groupBy("community", "part", "Average_Risk", "Num_Members").agg(entry.alias("_m"))
    return lists.select(
        "community",
        "part",
        "Average_Risk",
        F.array_join(F.col("_m.name"), ", ").alias("Members"),
        F.array_join(F.col("_m.customer_id"), ", ").alias("IDs"),
        "Num_Members",
    ).orderBy(F.desc("Average_Risk"), "community", "part")


def combined_risk(members: DataFrame) -> DataFrame:
    """Risk of a member is its own flag or its sanctions result, whichever is larger."""
    return members.withColumn("Combined_Result", F.greatest("Risk", "OS_Results"))


def risky_members(members: DataFrame) -> DataFrame:
    """Members with a risk or sanctions flag, with the combined mean risk of their community."""
    means = community_means(members, "Combined_Result").select(F.col("community").alias("_c"), "Average_Risk")
    flagged = members.filter((F.col("Risk") == 1) | (F.col("OS_Results") == 1))
    joined = spread_join(flagged, means, "community", "_c", "inner", ["customer_id", "name"])
    return joined.select("customer_id", "name", "community", "Average_Risk")


def subgraph(edges: DataFrame, communities: DataFrame, community: str, names: DataFrame) -> DataFrame:
    """Edges with either end in one community, with a name for both ends where one is known."""
    chosen = communities.filter(F.col("community") == F.lit(community)).select(F.col("node").alias("_in"))
    hot = hot_keys(edges, "src", "dst")
    from_here = spread_join(edges, chosen, "src", "_in", "left_semi", ["dst"], hot)
    to_here = spread_join(edges, chosen, "dst", "_in", "left_semi", ["src"], hot)
    touching = from_here.union(to_here).distinct()
    known = names.groupBy("customer_id").agg(F.min("name").alias("_name"))

    def label(df: DataFrame, end: str) -> DataFrame:
        joined = spread_join(df, known, end, "customer_id", "left", ["src", "dst"], hot)
        return joined.withColumn(f"{end}_label", F.coalesce("_name", end)).drop("_name")

    return label(label(touching, "src"), "dst")


def report(members: DataFrame, community: str, kyc: DataFrame, features: DataFrame, drop: list[str]) -> DataFrame:
    """Members of one community with customer data and features, reduced to the columns to read."""
    from fathomline.operators.joins import join_suffixed

    chosen = members.filter(F.col("community") == F.lit(community))
    joined = join_suffixed(join_suffixed(chosen, kyc, "customer_id", "cust_id"), features, "customer_id", "cust_id")
    return joined.drop(*drop)
