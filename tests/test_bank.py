"""Hand-made rows for the rules that are easy to get wrong."""

import math
import re

import pytest
from pyspark.sql import functions as F

from fathomline.functions import scalar, text
from fathomline.operators import encode, evaluate, explore, features, filters, flow, graph, joins, matching, news, quality, risk, skew, stats
from fathomline.plans import network
from fathomline.sources import schemas, tables

KYC = [
    ("C1", "DR.ANN", "female", "ZOO", 30, 5, 0),
    ("C2", "BOB", "male", "LAW", None, 1, 1),
    ("C3", "MRS. EVE", "other", None, 41, 2, 0),
]
WIRE = [
    ("W1", "C1", "C2", "ANN", "BOB", 10.0, "CA", "CN"),
    ("W2", "C1", "EXTERNAL1", "ANN", "X", 5.0, "CA", None),
    ("W3", "C2", "C1", "BOB", "ANN", 7.0, "ZZ", "ZZ"),
]
EMT = [
    ("E1", "C2", "C1", "BOB", "ANN", "Ivory, ivory ring", 3.0),
    ("E2", "C2", "C1", "BOB", "ANN", None, 4.0),
]
CASH = [("X1", "C1", 100.0, "deposit"), ("X2", "C1", 30.0, "withdrawal"), ("X3", "EXTERNAL1", 1.0, "deposit")]
JOBS = {"wildlife": ["ZOO"], "trafficking": [], "transportation": [], "media": [], "law": ["LAW"]}
WORDS = {"wildlife": ["ivory", "ivory,"], "transportation": [], "law": [], "trafficking": ["ring"], "accomodation": []}


@pytest.fixture(scope="module")
def bank(spark):
    names = {"kyc": KYC, "wire_trxns": WIRE, "emt_trxns": EMT, "cash_trxns": CASH}
    return {n: spark.createDataFrame(r, schemas.TABLES[n]) for n, r in names.items()}


def by_id(df, key="cust_id"):
    return {r[key]: r for r in df.collect()}


def test_feature_view(bank):
    out = by_id(features.kyc_features(bank["kyc"], bank["wire_trxns"], bank["emt_trxns"], bank["cash_trxns"]))
    a = out["C1"]
    assert (a.no_wire_trxns_sent, a.wire_total_amnt_sent) == (2, 15.0)
    assert a.no_international_wire_trxns_sent == 1  # a missing country does not count
    assert (a.no_emt_trxns_received, a.emt_total_amnt_received) == (2, 7.0)
    assert (a.cash_balance, a.wire_trxn_balance) == (70.0, -8.0)
    assert out["C3"].total_no_wire_trxns == 0 and out["C3"].wire_trxn_balance == 0.0
    assert len(out) == 3


def test_profile_counts(bank):
    out = by_id(features.customer_profile(bank["kyc"], bank["wire_trxns"], bank["emt_trxns"], bank["cash_trxns"], JOBS, WORDS))
    a, b, c = out["C1"], out["C2"], out["C3"]
    assert a.no_wire_law_occupation_sent == 1 and b.no_emt_wildlife_occupation_sent == 2
    assert a.no_external_wire_trxn_sent == 1 and a.no_wire_sent_wildlife_jurisdiction == 1
    assert b.no_emt_wildlife_msg_sent == 2 and a.no_emt_trafficking_msg_received == 1
    assert (a.wildlife_occupation, c.wildlife_occupation) == (1, 0)  # no occupation is in no list
    assert (a.average_wire_sent, c.average_wire_sent) == (7.5, 0.0)
    assert b.Age == 0


def test_country_counters(bank):
    out = by_id(features.country_counters(bank["kyc"], bank["wire_trxns"]))
    assert (out["C1"].send_CA, out["C1"].receive_NAN, out["C2"].send_NAN, out["C2"].receive_CN) == (2, 1, 1, 1)


def test_lists_stay_whole_in_parts(bank):
    lists = features.counterparty_lists(bank["kyc"], bank["wire_trxns"], bank["emt_trxns"])
    packed = features.packed_lists(lists, limit=1).filter("cust_id = 'C1' and channel = 'emt' and field = 'id'")
    assert [v for r in packed.collect() for v in r["values"]] == ["C2", "C2"]


def test_counterparties_keep_customers_without_rows(bank):
    out = features.counterparties(bank["kyc"], bank["emt_trxns"], "received")
    assert sorted((r.cust_id, r.emt_trxn_id) for r in out.collect() if r.emt_trxn_id) == [("C1", "E1"), ("C1", "E2")]
    assert out.count() == 4


def test_csv_with_byte_order_mark(spark, tmp_path):
    (tmp_path / "w.csv").write_text(
        "﻿trxn_id,id sender,id receiver,name sender,name receiver,wire value,country sender,country receiver\n"
        'W1,C1,C2,"A, ""B""",B,1.5,CA,\n',
        encoding="utf-8",
    )
    row = tables.read_table(spark, "wire_trxns", str(tmp_path / "w.csv")).first()
    assert (row.wire_trxn_id, row.name_sender, row.wire_value, row.country_receiver) == ("W1", 'A, "B"', 1.5, None)


def test_keys(bank, spark):
    twice = bank["kyc"].union(bank["kyc"].limit(1))
    assert quality.pk_violations(twice, "cust_id").count() == 1
    assert [r.id for r in quality.fk_orphans(bank["wire_trxns"], "id_receiver", bank["kyc"], "cust_id").collect()] == ["EXTERNAL1"]


def test_two_hops_and_first_label(spark):
    pairs = [("A", "S"), ("B", "A"), ("S", "C"), ("C", "D"), ("S", "S2"), ("C", "S"), ("X", "Y")]
    rows = [(f"t{i}", s, r, f"n{s}", f"n{r}", 1.0, None) for i, (s, r) in enumerate(pairs)]
    rows += [("t9", "A", "S", "nA", "nS", None, 2.0), ("t10", "Q", "S", None, "nS", 1.0, None)]
    tx = spark.createDataFrame(rows, "trxn_id string, id_sender string, id_receiver string, name_sender string, name_receiver string, emt_value double, wire_value double")
    seeds = spark.createDataFrame([("S",), ("S2",)], "id string")
    out = {(r.id_sender, r.id_receiver): r for r in flow.two_hop(tx, seeds).collect()}
    hop = {p: [i for i, n in enumerate(flow.HOPS) if r[n]][0] for p, r in out.items()}
    # S -> C is also into a first sender (C pays S), which has priority; S -> S2 is into a seed.
    assert hop == {("A", "S"): 0, ("C", "S"): 0, ("S", "S2"): 0, ("B", "A"): 1, ("S", "C"): 1, ("C", "D"): 3}
    assert out[("A", "S")].total_amount == 3.0


def test_label_propagation_ties_and_sinks(spark):
    edges = spark.createDataFrame([("b", "a"), ("c", "a"), ("c", "b"), ("d", "c"), ("e", "z"), ("e", "y")], "src string, dst string")
    out = {r.node: r.community for r in graph.label_propagation(edges).collect()}
    assert out["a"] == "a" and out["b"] == "a" and out["c"] == "a" and out["d"] == "a" and out["e"] == "y"


def circling():
    """39 pairs on which plain votes go round for ever: three nodes in a ring, each turned by a gate that swaps two labels in passing."""
    ring = ["v1", "v2", "v3"]
    pairs, fixed = [], {}
    for i, (w, p) in enumerate([("L1", "L3"), ("L2", "L1"), ("L3", "L2")]):
        v, before = ring[i], ring[i - 1]
        pairs += [(v, before), (v, f"f{i}"), (f"f{i}", before)]
        for k, label in enumerate([w] * 3 + [p] * 2):
            node = f"k{i}{k}"
            fixed[node] = label
            pairs += [(v, node), (node, label)]
    return pairs


def settled(pairs, patience=8):
    """The rule in plain Python."""
    from collections import Counter
    from hashlib import md5

    out = {}
    for a, b in pairs:
        out.setdefault(a, []).append(b)
    label, changes, step = {n: n for p in pairs for n in p}, Counter(), 0
    while True:
        step += 1
        wants = {}
        for a, ends in out.items():
            votes = Counter(label[b] for b in ends)
            best = min(votes, key=lambda x: (-votes[x], x))
            if votes[best] > votes[label[a]] + max(changes[a] - patience, 0):
                wants[a] = best
        if not wants:
            return label
        for a, best in wants.items():
            if md5(f"{a}:{step}".encode()).hexdigest()[0] < "e":
                label[a] = best
                changes[a] += 1


def random_pairs(seed, nodes, n):
    import random

    r = random.Random(seed)
    return sorted({(f"n{r.randrange(nodes)}", f"n{min(r.randrange(nodes), r.randrange(nodes))}") for _ in range(n)})


@pytest.mark.parametrize("pairs", [circling(), random_pairs(1, 30, 60), random_pairs(2, 60, 200)])
def test_label_propagation_ends_and_equals_plain_python(spark, pairs):
    edges = spark.createDataFrame(pairs, "src string, dst string")
    assert {r.node: r.community for r in graph.label_propagation(edges).collect()} == settled(pairs)


def test_communities_are_settled_by_plain_votes(spark, monkeypatch):
    """A chain of payers: all end with the label of its last node, however often the first ones have to change."""
    chain = [f"c{i:02d}" for i in range(19)]
    pairs = list(zip(chain, chain[1:]))
    assert set(settled(pairs).values()) != {"c18"}  # growing majorities stop some nodes on the way
    edges = spark.createDataFrame([(a, b, 1.0) for a, b in pairs], "Source string, Target string, Weight double")
    monkeypatch.setattr(network, "weighted_edges", lambda b: edges)
    assert {r.node: r.community for r in network.communities(None).collect()} == dict.fromkeys(chain, "c18")


def test_a_round_of_votes_leaves_the_state_in_its_buckets(spark, monkeypatch):
    """Of a round only votes and voters move: no plan deals the state out by its nodes once more."""
    plans = []
    write = graph.AlternatingBuckets.write
    monkeypatch.setattr(graph.AlternatingBuckets, "write", lambda self, df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(self, df))[1])
    monkeypatch.setattr(graph, "HELD_ROWS", 50)
    pairs = random_pairs(2, 60, 200)
    for few in (0, 10**9):  # 0: in every round few have changed, else in none
        monkeypatch.setattr(graph, "FEW", few)
        plans.clear()
        edges = spark.createDataFrame(pairs, "src string, dst string")
        assert {r.node: r.community for r in graph.label_propagation(edges).collect()} == settled(pairs)
        assert len(plans) > 2
        assert not [p for p in plans[1:] if re.search(r"hashpartitioning\((id|_dst|_moved)#", p)], plans[-1]


@pytest.mark.parametrize("seed", [1, 2])
def test_votes_with_hot_ends(spark, monkeypatch, seed):
    """Every end is taken for hot, so rows are spread and copied; the communities are the same."""
    monkeypatch.setattr(graph, "hot_keys", lambda df, *keys: skew.hot_keys(df, *keys, min_rows=0))
    pairs = random_pairs(seed, 20, 60)
    edges = spark.createDataFrame(pairs, "src string, dst string")
    assert {r.node: r.community for r in graph.label_propagation(edges).collect()} == settled(pairs)


def modularity_of(edges, label):
    """Plain Python; edges (a, b, w)."""
    m2 = 2 * sum(w for *_, w in edges)
    inner, degree = {}, {}
    for a, b, w in edges:
        for x in (a, b):
            degree[label[x]] = degree.get(label[x], 0) + w
        if label[a] == label[b]:
            inner[label[a]] = inner.get(label[a], 0) + 2 * w
    return sum(inner.get(c, 0) / m2 - (d / m2) ** 2 for c, d in degree.items())


def one_by_one(edges):
    """Nodes move one after the other until none gains."""
    label = {x: x for a, b, _ in edges for x in (a, b)}
    while True:
        before = dict(label)
        for x in sorted(label):
            near = {label[b if a == x else a] for a, b, _ in edges if x in (a, b)}
            label[x] = max(sorted(near | {label[x]}), key=lambda c: (round(modularity_of(edges, label | {x: c}), 12), c == label[x]))
        if label == before:
            return label


def test_louvain_is_settled_and_as_good_as_one_by_one(spark):
    import random

    r = random.Random(4)
    edges = [(f"n{a:02d}", f"n{b:02d}", float(r.randrange(1, 4))) for a in range(24) for b in range(a + 1, 24) if r.random() < (0.7 if a % 3 == b % 3 else 0.08)]
    edges.append(("n00", "n00", 1.5))  # a loop
    found = graph.louvain(spark.createDataFrame(edges, "a string, b string, w double"))
    label = {x.node: x.community for x in found.collect()}
    best = modularity_of(edges, label)
    assert graph.modularity(spark.createDataFrame(edges, "a string, b string, w double"), found).first().modularity == pytest.approx(best)
    assert best >= modularity_of(edges, one_by_one(edges)) - 0.02
    # Communities as a whole are settled; single nodes are after the last level when communities are as here.
    for x in label:
        for c in set(label.values()):
            assert modularity_of(edges, label | {x: c}) <= best + 1e-6


def test_louvain_finds_two_cliques(spark):
    clique = [(f"{g}{i}", f"{g}{j}", 1.0) for g in "pq" for i in range(5) for j in range(i + 1, 5)]
    edges = spark.createDataFrame([*clique, ("p0", "q0", 0.5)], "a string, b string, w double")
    found = graph.louvain(edges)
    groups = {}
    for r in found.collect():
        groups.setdefault(r.community, set()).add(r.node[0])
    assert sorted(map(sorted, groups.values())) == [["p"], ["q"]] and found.count() == 10
    assert graph.modularity(edges, found).first().modularity > 0.4


def test_louvain_takes_few_jobs_where_one_task_holds_a_level(spark, monkeypatch):
    """Rounds on a level of few nodes and edges write nothing; the result is that of rounds over all tasks."""
    import random

    r = random.Random(7)
    edges = [(f"n{a:02d}", f"n{b:02d}", r.randrange(1, 9) + r.random()) for a in range(50) for b in range(a + 1, 50) if r.random() < (0.6 if a % 5 == b % 5 else 0.1)]
    edges += [("n03", "n03", 2.5), ("alone", "alone", 1.0), (None, None, 1.0)]
    table = spark.createDataFrame(edges, "a string, b string, w double")
    cuts, cut = [], graph.cut_lineage
    monkeypatch.setattr(graph, "cut_lineage", lambda df: (cuts.append(1), cut(df))[1])
    found = {x.node: x.community for x in graph.louvain(table).collect()}
    few = len(cuts)
    assert found == {x.node: x.community for x in graph.louvain(table, task_rows=0).collect()}
    assert few < 30 < len(cuts) - few
    assert len(set(found.values())) < 12 and found["alone"] == "alone"


def test_draws_are_those_of_spark(spark):
    import numpy as np

    from fathomline.operators import moves

    rows = spark.range(200).select(F.xxhash64(F.concat(F.lit("C"), "id")).alias("h"), *[(F.pmod(F.xxhash64(F.concat(F.lit("C"), "id"), F.lit(s)), F.lit(2)) == 0).alias(f"s{s}") for s in (1, 70_000)]).collect()
    for s in (1, 70_000):
        assert moves.drawn(np.array([x.h for x in rows]), s).tolist() == [x[f"s{s}"] for x in rows]


def test_slots_follow_any_moves(monkeypatch):
    """Weights summed anew for some nodes, in a table or after a sort, in one part or many, are those of all edges."""
    import numpy as np

    from fathomline.operators import moves

    r = np.random.default_rng(5)
    a, b = np.triu_indices(40, 1)
    some = r.random(len(a)) < 0.2
    a, b, n = a[some].astype(np.int32), b[some].astype(np.int32), 41  # node 40 has no edge
    w = r.integers(1, 5, len(a)).astype(float)
    for block, dense in ((1 << 20, 8), (16, 8), (16, 0)):
        monkeypatch.setattr(moves, "BLOCK", block)
        monkeypatch.setattr(moves, "DENSE", dense)
        options, k = moves.Options(a, b, w, n), np.bincount(a, w, n) + np.bincount(b, w, n)
        for _ in range(4):
            community = r.integers(0, 12, n).astype(np.int32)
            options.follow(community)
            total = np.bincount(community, k, n)
            inner, to, worth = options.best(community, total, k, k.sum())
            for x in range(n):
                towards = {}
                for i, j, weight in [*zip(a, b, w), *zip(b, a, w)]:
                    if i == x:
                        towards[community[j]] = towards.get(community[j], 0.0) + weight
                assert inner[x] == towards.pop(community[x], 0.0)
                gains = {c: g - total[c] * k[x] / k.sum() for c, g in towards.items()}
                assert to[x] == min(gains, key=lambda c: (-gains[c], c), default=-1) and (not gains or worth[x] == gains[to[x]])


def test_community_measures(spark):
    pairs = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d")], "a string, b string")
    groups = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "2"), ("d", "3")], "node string, community string")
    out = by_id(graph.community_stats(pairs, groups), "community")
    assert (out["1"].density, out["1"].expansion, out["1"].conductance) == (1.0, 1.0, 1 / 7)
    assert (out["3"].density, out["3"].n) == (0.0, 1)


def test_community_risk_keeps_all_members(spark):
    members = spark.createDataFrame([(f"C{i}", f"N{i}", "x", int(i == 0)) for i in range(25)] + [("D", "M", "y", 0)], "customer_id string, name string, community string, Risk int")
    out = graph.community_risk(members, limit=10).collect()
    assert len(out) > 1 and {r.community for r in out} == {"x"} and {r.Num_Members for r in out} == {25}
    assert sorted(m for r in out for m in r.IDs.split(", ")) == sorted(f"C{i}" for i in range(25))


def test_names(spark):
    df = spark.createDataFrame([("DR.ANN",), ("Mrs. Eve ",), (" Dr. X",)], "n string")
    assert [r[0] for r in df.select(text.norm_name(F.col("n"))).collect()] == ["ANN", "EVE", " DR. X"]


@pytest.mark.parametrize(
    "names, answers, want",
    [
        (["John Smith Jr", "Smith"], ["Smith"], "John Smith"),
        (["Ann"], ["Ann"], "Ann"),
        (["", "Ann"], [""], "A"),
        (["Bob"], ["Ann"], None),
        (["Bob", "Ann Lee"], ["Lee", "Ann"], "Ann Lee"),
    ],
)
def test_containment(spark, names, answers, want):
    df = spark.createDataFrame([(names, answers)], "n array<string>, a array<string>")
    assert df.select(text.first_containing(F.col("n"), F.col("a"))).first()[0] == want


def test_fold_and_split(spark):
    df = spark.createDataFrame([(["Ann Lee", "Ann", "Bob", "Mr Bob"], "A and B", "sand dune")], "n array<string>, a string, b string")
    row = df.select(text.fold_names(F.col("n")), text.split_and(F.col("a")), text.split_and(F.col("b"))).first()
    assert list(row) == [["Ann Lee", "Bob"], ["A", "B"], ["sand dune"]]


def test_fuzzy_cutoff_is_inclusive(spark):
    df = spark.createDataFrame([("abcde",), ("abcd",), (None,)], "Occupation string")
    out = {r.Occupation: r for r in matching.fuzzy_match(df, ["abcdX", "abcdY"]).collect()}
    assert out["abcde"].closest_match == "abcdX" and out["abcde"].match_score == pytest.approx(80.0)  # the first of equals
    assert out["abcd"].Label_Filtered_By_Occupations == 1 and out[None].Label_Filtered_By_Occupations == 0


def test_sanctions_values(spark):
    df = spark.createDataFrame([("Ann",), ("Bob",), (None,), ("  ",)], "name string")
    listed = spark.createDataFrame([("ANN ",)], "name string")
    assert [r.OS_Results for r in matching.sanctions(df, listed).orderBy(F.col("name").desc_nulls_last()).collect()] == [0, 1, -1, -1]


def test_thresholds_and_tiers(spark):
    df = spark.createDataFrame([(0.2, 0.2994), (0.21, 0.3), (None, 0.7)], "s double, p double")
    rows = df.select(scalar.threshold_flag(F.col("s"), 0.2), scalar.risk_tier(F.col("p"))).collect()
    assert [tuple(r) for r in rows] == [(0, 1), (1, 2), (0, 3)]


def test_article_number(spark):
    df = spark.createDataFrame([("x-1.6754907",), ("http://a.b/123.html",), ("12345",), ("abc",)], "l string")
    assert [r[0] for r in df.select(scalar.has_article_number(F.col("l"))).collect()] == ["x-1.6754907"[-7:-4].isdigit(), "http://a.b/123.html"[-7:-4].isdigit(), "12345"[-7:-4].isdigit(), False]


def test_scaling_of_a_constant(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 4.0)], "a double, b double")
    assert [tuple(r) for r in encode.zscore(df, ["a", "b"]).orderBy("b").collect()] == [(0.0, -1.0), (0.0, 1.0)]
    assert {r.a for r in encode.minmax(df, "a").collect()} == {0.0}


def test_auc_and_welch(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.5), (1, 0.5), (0, 0.1)], "label int, score double")
    assert evaluate.auc(df, "label", "score").first().auc == pytest.approx(0.875)
    assert evaluate.auc(df.filter("label = 1"), "label", "score").first().auc is None
    row = spark.createDataFrame([(1.0, 0.0, 1.0, 1.0, 10, 10)], "m1 double, m2 double, s1 double, s2 double, n1 int, n2 int")
    got = stats.welch(row, "m1", "m2", "s1", "s2", "n1", "n2").first()
    assert got.df == pytest.approx(18.0) and got.t == pytest.approx(math.sqrt(5.0))
    assert got.p == pytest.approx(0.0382, abs=2e-4)


def test_student_p_known_values():
    import pandas as pd

    p = stats.student_p(pd.Series([0.0, 2.228139, 12.7062, 3.0]), pd.Series([5.0, 10.0, 1.0, 1e6]))
    assert list(p.round(4)) == [1.0, 0.05, 0.05, 0.0027]


def test_odds_with_an_empty_cell(spark):
    df = spark.createDataFrame([(1, 1), (0, 0)], "a int, b int")
    assert stats.odds_ratio(df, "a", "b").first().odds_ratio is None


def test_weights_sum_to_one(spark):
    rows = [(f"c{i}", "n", i % 2, i % 3 % 2, i / 10, i % 2, i % 4 % 2, 0.5, 1) for i in range(12)]
    df = spark.createDataFrame(rows, "cust_id string, Name string, Label_Filtered int, OpenSanc_query int, network_score double, Label_Filtered_By_Occupations int, criminal_cash int, similarity_score double, Label_Filtered_network int")
    weights = risk.risk_weights(df)
    assert sum(r.weight for r in weights.collect()) == pytest.approx(1.0)
    scores = [r.result for r in risk.risk_score(df, weights).collect()]
    assert scores == sorted(scores, reverse=True) and len(scores) == 12


def test_histogram_last_bin_is_closed(spark):
    df = spark.createDataFrame([(10, 0), (11, 0), (13, 0), (14, 0), (None, 0)], "Age int, label int")
    assert sorted((r.bin_start, r.n) for r in explore.histogram(df, "Age", "label").collect()) == [(10, 2), (12, 2)]


def test_duplicates_and_modes(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, None), (4, "b")], "id int, k string")
    assert explore.duplicates(df, ["k"]).count() == 4 and explore.repeated(df, "k").count() == 2
    assert explore.majority(df, "id").first().id == 1


def test_edges_are_not_deduplicated(spark):
    df = spark.createDataFrame([("a", "b", 1.0), ("a", "b", 1.0)], "id_sender string, id_receiver string, value double")
    assert flow.edges(df).first().counts == 2 and flow.edges(df, distinct=True).first().counts == 1


def test_suffixes(spark):
    a = spark.createDataFrame([("x", 1)], "id string, n int")
    b = spark.createDataFrame([("x", 2)], "id string, n int")
    assert joins.join_suffixed(a, b, "id", "id").columns == ["id", "n_x", "n_y"]


def test_display(spark):
    row = filters.present(spark.createDataFrame([("DR.ANN LEE", 1)], "Name string, label int")).first()
    assert tuple(row) == ("Dr.Ann Lee", "Yes")


@pytest.mark.parametrize("cutoff", [60.0, 80.0, 95.0, 100.0])
def test_edit_join_equals_all_pairs(spark, cutoff):
    import random

    r = random.Random(cutoff)
    words = ["", "a", "ab", "aé", "clerk", "cleric", "clerks", "shop clerk", "x" * 30]
    for _ in range(60):
        w = list(r.choice(["import owner", "pet store owner", "zoo staff", "customs officer"]))
        for _ in range(r.randrange(6)):
            at = r.randrange(len(w))
            w[at : at + r.randrange(2)] = r.choice(["", "e", "st", " "])
        words.append("".join(w).strip())
    texts, choices = [None, *words[::2], *words[:8]], [None, *words[1::2], *words[:8]]

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for k, y in enumerate(b, 1):
                row.append(min(last[k] + 1, row[-1] + 1, last[k - 1] + (x != y)))
        return row[-1]

    want = set()
    for a in filter(lambda t: t is not None, texts):
        for b in filter(lambda t: t is not None, choices):
            score = 100.0 * (1.0 - (distance(a, b) / max(len(a), len(b)) if a or b else 0.0))
            if score >= cutoff:
                want.add((a, b, round(score, 6)))
    x = spark.createDataFrame([(t,) for t in texts], "_x string")
    y = spark.createDataFrame([(t,) for t in choices], "_y string")
    got = matching.edit_join(x, y, cutoff).collect()
    assert len(got) == len(want) and {(g._x, g._y, round(g.score, 6)) for g in got} == want


def test_table_match_ties_nulls_and_sorted_words(spark):
    df = spark.createDataFrame([(1, " Clerk shop"), (2, None), (3, "clerkz"), (4, "pilot")], "id int, Occupation string")
    choices = spark.createDataFrame([("Clerks",), ("CLERKY",), ("shop clerk",), (None,), ("shop clerk",)], "choice string")
    plain = {r.id: (r.closest_match, r.Label_Filtered_By_Occupations) for r in matching.fuzzy_table_match(df, choices).collect()}
    assert plain == {1: (None, 0), 2: (None, 0), 3: ("CLERKY", 1), 4: (None, 0)}
    words = {r.id: r.closest_match for r in matching.fuzzy_table_match(df, choices, token_sort=True).collect()}
    assert words[1] == "shop clerk"


def test_all_declared_keys_in_one_pass(spark):
    Key = quality.Key
    kyc = spark.createDataFrame([("a",), ("b",), ("b",), (None,), (None,)], "cust_id string")
    wire = spark.createDataFrame([(1, 1, "a", "x"), (1, 2, "x", "x"), (1, 2, None, "b"), (None, 3, "y", None)], "k int, l int, s string, r string")
    to = ("kyc", ("cust_id",))
    keys = [Key("kyc", ("cust_id",)), Key("wire", ("k", "l")), Key("wire", ("l",)), Key("wire", ("s",), to), Key("wire", ("r",), to), Key("kyc", ("cust_id",), ("wire", ("s",)))]
    got = {r.key: tuple(r)[1:] for r in quality.check_keys({"kyc": kyc, "wire": wire}, keys).collect()}
    assert got == {
        "kyc(cust_id)": ("primary", 2, 4), "wire(k, l)": ("primary", 2, 3), "wire(l)": ("primary", 1, 2), "wire(s) -> kyc(cust_id)": ("foreign", 2, 2),
        "wire(r) -> kyc(cust_id)": ("foreign", 1, 2), "kyc(cust_id) -> wire(s)": ("foreign", 1, 2),
    }
    empty = {r.key: r.bad_values for r in quality.check_keys({"kyc": kyc.limit(0), "wire": wire.limit(0)}, keys).collect()}
    assert set(empty.values()) == {0} and len(empty) == 6


def test_customers_with_the_same_names_are_alike(spark):
    names = [("1", "DR.ANN LEE"), ("2", "Ann  Lee"), ("3", "ANN LEE"), ("3", "BOB"), ("4", "bob"), ("4", "ann lee"), (None, "Bob"), ("5", None), ("6", "--")]
    df = matching.alike(spark.createDataFrame(names, "customer_id string, name string"))
    groups = {}
    for r in df.collect():
        groups.setdefault(r.alike, set()).add(r.customer_id)
    assert sorted(map(sorted, (map(str, g) for g in groups.values()))) == [["1", "2"], ["3", "4"], ["None"]]


def test_pairs_of_texts_and_customers_are_not_shuffled(spark, capsys):
    """Two texts under one link and names in several spellings give every pair once, with no aggregate over the pairs."""
    texts = spark.createDataFrame([("L", "Ann Lee met Bob."), ("L", "ann lee"), (None, "Bob"), (None, "bob")], "Link string, Text string")
    names = spark.createDataFrame([("1", "DR.ANN LEE"), ("1", "Ann Lee"), ("2", "Ann Lee"), (None, "BOB")], "customer_id string, name string")
    found = matching.names_in_texts(texts, names)
    rows = [(r.Link, r.customer_id, r.name) for r in found.collect()]
    pairs = {("L", "1", "DR.ANN LEE"), ("L", "1", "Ann Lee"), ("L", "2", "Ann Lee"), ("L", None, "BOB"), (None, None, "BOB")}
    assert len(rows) == len(pairs) and set(rows) == pairs
    found.explain()
    plan = capsys.readouterr().out
    assert "Join" in plan and not any("Aggregate" in line for line in plan[: plan.index("Join")].splitlines())


def test_only_runs_that_may_be_names_are_joined(spark, monkeypatch):
    """Texts are cut into words and written down to the few runs that begin like a name, before anything counts or joins them."""
    texts = spark.createDataFrame([(k, " ".join(f"w{k}x{i}" for i in range(300)) + f". Ann Lee met Bob{k}, ann!") for k in range(20)], "Link int, Text string")
    names = spark.createDataFrame([("1", "Ann Lee"), ("2", "BOB3"), ("3", "Lee Met Ann")], "customer_id string, name string")
    facts, join = [], matching.spread_join
    monkeypatch.setattr(matching, "spread_join", lambda fact, *rest, **more: (facts.append(fact), join(fact, *rest, **more))[1])
    found = matching.names_in_texts(texts, names)
    assert {(r.Link, r.customer_id) for r in found.collect()} == {(k, "1") for k in range(20)} | {(3, "2")}
    assert "Generate" not in facts[0]._jdf.queryExecution().optimizedPlan().toString()
    assert facts[0].count() < 500


@pytest.mark.parametrize("bits", [64, 1 << 20])
def test_names_in_texts_as_searched_one_by_one(spark, monkeypatch, bits):
    """Marks that are shared by many words, and texts and names with signs at their ends, change nothing."""
    import random
    import re

    monkeypatch.setattr(matching, "FIRST_BITS", bits)
    r = random.Random(bits)
    parts = ["ann", "Lee", "BOB", "o'hara", "Straße", "7", "é", "zu", "ten", "x"]

    def drawn(n):
        return r.choice(["", " ", "-", "("]) + "".join(r.choice(parts) + r.choice([" ", "  ", "-", "; ", ".\n"]) for _ in range(n)) + r.choice(["", "!"])

    texts = [(k, drawn(r.randrange(12))) for k in range(40)]
    names = [(str(k), drawn(r.randrange(1, 4))) for k in range(30)]

    def flat(text):
        return " " + " ".join(w for w in re.split(r"[\W_]+", text.upper()) if w) + " "

    want = {(t, c, n) for t, text in texts for c, n in names if flat(n) in flat(text)}
    found = matching.names_in_texts(spark.createDataFrame(texts, "Link int, Text string"), spark.createDataFrame(names, "customer_id string, name string"))
    rows = [tuple(x) for x in found.collect()]
    assert len(rows) == len(want) > 20 and set(rows) == want


def test_known_names_in_texts(spark):
    texts = [
        (1, "Yesterday ann-lee (of O'Hara Ltd.) met Dr. Smith."), (2, None), (3, ""), (4, "JOANN LEE, Ann; Lee Annlee"), (5, "Ann Lee Smith! ann lee"),
        (6, "émile Zoë saw 42"), (7, "lee"), (1, "a second text of one: bob 7"),
    ]
    names = [("c1", "Dr.Ann Lee"), ("c2", "Ann Lee Smith"), ("c3", "Émile  zoë"), ("c4", None), ("c5", " ."), ("c6", "MR.42"), ("c7", "O'Hara"), ("c8", "Bob 7"), ("c9", "ANN LEE"), ("c9", "ANN LEE")]
    df = spark.createDataFrame(texts, "Link int, Text string")
    got = {(r.Link, r.customer_id) for r in matching.names_in_texts(df, spark.createDataFrame(names, "customer_id string, name string")).collect()}
    assert got == {(1, "c1"), (1, "c9"), (1, "c7"), (1, "c8"), (4, "c1"), (4, "c9"), (5, "c1"), (5, "c2"), (5, "c9"), (6, "c3"), (6, "c6")}
    nobody = spark.createDataFrame([("c4", None), ("c5", "!")], "customer_id string, name string")
    assert matching.names_in_texts(df, nobody).collect() == []
    share = matching.named_share(matching.names_in_texts(df, spark.createDataFrame(names, "customer_id string, name string")), df)
    assert {r.customer_id: (r.texts, round(r.share, 4)) for r in share.collect()}["c9"] == (3, round(3 / 7, 4))


def test_literal_records_as_python_reads_them(spark):
    import ast

    texts = [
        None, "", "{}", "[]", "{'Title': 'a', 'Text': 'b'}", "{'Title': '', 'Text': ''}", "{'Title': 'a', 'Text': None}", "{'Title': 'a' 'b', 'Text': 'c'}",
        "{'Title': 'a', 'Text': 'b',}", "{'Title': '\\U0001F600 \\xe9 \\u00df', 'Text': 'x\\\\xe9'}", '{"Title": "it\'s", "Text": \'say "x"\'}', "{'Text': 'b', 'Title': 'a', 'n': [1, {}]}",
        "{'Title': 'it's', 'Text': 'b'}", "{'Title': 'a'}", "{'Title': 'a', 'Text': 'b'", "{'Title': 'a', 'Text': 'b\nc'}", "{'Title': 'a', 'Text': \'\'\'b\nc\'\'\'}", " {'Title': 1, 'Text': 2.5}",
        "{'Title': 'a', 'Text': open('x')}", "{'Title': r'\\d', 'Text': b'b'}", "{'Title': 'a', 'Text': 'b'} # end", "{'Title': 'é', 'Text': '" + "long " * 50_000 + "'}", "[" * 500,
    ]
    rows = news.parse_records(spark.createDataFrame(list(enumerate(texts)), "id int, `Extracted Data` string")).collect()
    for r in rows:
        try:
            record = ast.literal_eval(texts[r.id])
            want = (*[None if record[f] is None else str(record[f]) for f in ("Title", "Text")], True)
        except Exception:
            want = (None, None, False)
        assert (r.Title, r.Text, r.Parsed) == want, texts[r.id]
    assert sum(r.Parsed for r in rows) == 13


def test_summaries_of_many_columns(spark, monkeypatch):
    """Marks of every column and group as numpy gives them: by missed brackets, and with sliced brackets and hot groups."""
    import numpy as np

    rng = np.random.default_rng(5)
    size = {"a": 2500, "b": 1, None: 1200}
    rows = [(g, float(x), None if i % 3 else float(i % 7), None) for g, n in size.items() for i, x in enumerate(rng.lognormal(0, 3, n))]
    df = spark.createDataFrame(rows, "g string, `x.y` double, z double, empty double")
    for slack, hot in ((-0.01, stats.HOT_ROWS), (stats.SLACK, 5)):
        monkeypatch.setattr(stats, "SLACK", slack)
        monkeypatch.setattr(stats, "HOT_ROWS", hot)
        got = {(r["g"], r["column"]): r for r in stats.five_nums(df, ["x.y", "z", "empty"], ["g"]).collect()}
        assert len(got) == 2 * len(size)
        for g in size:
            for name, at in (("x.y", 1), ("z", 2)):
                values = [r[at] for r in rows if r[0] == g and r[at] is not None]
                want = [*np.quantile(values, [0, 0.25, 0.5, 0.75, 1]), len(values), np.mean(values), np.std(values)]
                r = got[g, name]
                assert [r[c] for c in ("min", "q1", "median", "q3", "max", "n", "mean", "sd")] == pytest.approx(want)
    whole = stats.five_nums(df, ["empty", "z"]).collect()
    assert {r["column"]: r["n"] for r in whole} == {"empty": 0, "z": sum(r[2] is not None for r in rows)}
    assert stats.five_nums(df.limit(0), ["z"], ["g"]).collect() == []


def test_csv_of_one_line_a_row(spark, tmp_path):
    """Line breaks, backslashes and codes that look like breaks come back from files that are split by lines."""
    rows = [(1, "a\nb\r\nc"), (2, "back\\slash \\n \\\\n \\\\"), (3, 'quote " and, comma'), (4, None), (5, "\\\n"), (6, "plain")]
    df = spark.createDataFrame(rows, "id int, `a.b` string")
    path = str(tmp_path / "lines")
    tables.write_csv(df.coalesce(1), path, one_line=True)
    assert sorted(map(tuple, tables.read_csv(spark, path, df.schema, one_line=True).collect())) == rows
    lines = [line for f in (tmp_path / "lines").glob("part-*.csv") for line in f.read_text().split("\n") if line]
    assert len(lines) == len(rows) + 1


def test_offenders_by_score(spark):
    rows = [("l1", "t1", "Ann", 0.2), ("l2", "t2", "Ann", 0.9), ("l3", "t3", "Ann", None), ("l4", "t4", "Bob", None)]
    df = spark.createDataFrame(rows, "Link string, Title string, Criminal string, Score double")
    order = [F.coalesce(-F.col("Score"), F.lit(float("inf"))), F.col("Link")]
    assert sorted(map(tuple, news.offenders(df, order).collect())) == [("l2", "t2", "Ann"), ("l4", "t4", "Bob")]


def test_cluster_flag(spark):
    """Every row has a cluster, the flag marks one cluster, and equal rows share it."""
    from fathomline.operators import clusters

    df = spark.createDataFrame([(i, float(i % 4 * 100), None if i % 2 else 1.0) for i in range(80)], "id int, x double, y double")
    flagged = clusters.cluster_flag(df, ["x", "y"], 4).cache()
    got = flagged.collect()
    assert all(r["criminal_cash"] == (r["Clusters"] == 0) for r in got) and len({r["Clusters"] for r in got}) == 4
    assert len({(r["x"], r["Clusters"]) for r in got}) == 4
    shares = clusters.cluster_shares(flagged, ["x", "y"]).collect()
    assert sum(r["n"] for r in shares) == 80 and all(r["n"] == 20 for r in shares)
