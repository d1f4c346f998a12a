from pyspark.sql import functions as F

from conftest import prose
from fathomline.llm import mixing


def targets(sizes, share=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    full, total = set(), sum(sizes.values()) * share
    while True:
        rest = [s for s in sizes if s not in full]
        level = (total - sum(most * sizes[s] for s in full)) / max(1, sum(weight[s] for s in rest))
        above = {s for s in rest if level * weight[s] > most * sizes[s]}
        if not above:
            return {s: most * sizes[s] if s in full else level * weight[s] for s in sizes}
        full |= above


def rows():
    made = [(i, prose(i, 30 + i % 300), None, f"s{i % 4}" if i % 5 else None) for i in range(200)]
    return made + [(500, None, None, "s1"), (501, "", None, "s9"), (None, "  \n", None, "s0"), (None, "two words", None, "s0"), (7, "two words", None, "s0")]


def test_mix(docs_of):
    data = rows() + [rows()[3]] * 2
    out = [r.asDict() for r in mixing.op8_mixing(docs_of(data)).collect()]
    assert len(out) == len(data)
    sizes = {}
    for _, t, _, s in data:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = targets(sizes)
    by = {}
    for r in out:
        assert 0 <= r["taken"] <= 2 * r["size"]
        by.setdefault((r["source_size"], round(r["target"], 6)), []).append(r["taken"])
    assert {k for k in by} == {(sizes[s], round(want[s], 6)) for s in sizes}
    for (size, target), taken in by.items():
        assert abs(sum(taken) - target) <= mixing.BLOCK, (size, target, sum(taken))


def test_reruns_agree_on_other_partitions(docs_of):
    key = lambda df: sorted(map(str, mixing.op8_mixing(df).collect()))
    assert key(docs_of(rows())) == key(docs_of(rows()).repartition(7))


def test_blocks_are_used_evenly(docs_of):
    made = mixing.mix(docs_of(rows()))
    counts = {(r["source"], r["block"]): r["count"] for r in made.slots.groupBy("source", "block").count().collect()}
    for s in made.sources.collect():
        got = [counts.get((s["source"], b), 0) for b in range(s["blocks"])]
        assert sum(got) == s["slots"] and max(got, default=0) - min(got, default=0) <= 1


def test_permutation_is_one(spark):
    for n in (1, 2, 7, 1000):
        df = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3)).alias("p"))
        assert sorted(r["p"] for r in df.collect()) == list(range(n))


def test_empty_table(docs_of):
    assert mixing.op8_mixing(docs_of([])).count() == 0
    assert [r["taken"] for r in mixing.op8_mixing(docs_of([(1, None)])).collect()] == [0]
