"""Graph operators against brute force on seeded random graphs, some with a hub."""

from collections import Counter

import pytest

from tests import graphs as G
from trellis.operators import centrality, community, match, paths

CASES = [(30, 60, 1, 0.0), (40, 120, 2, 0.4)]


@pytest.fixture(params=CASES, ids=["plain", "hub"])
def case(request, spark):
    n, m, seed, hub = request.param
    edges = G.random_edges(n, m, seed, hub)
    frame = spark.createDataFrame([(a, b, w, str(i)) for i, (a, b, w) in enumerate(edges)], "src bigint, dst bigint, w bigint, edge_id string")
    return range(n), edges, spark.range(n), frame


def column(df, name):
    return {r["id"]: r[name] for r in df.collect()}


def test_distances(case):
    nodes, edges, n, e = case
    got = column(paths.sssp(n, e, 0, "w"), "distance")
    want = G.distances(edges, 0)
    assert got == {v: want.get(v) for v in nodes}


def test_predecessors_lie_on_cheapest_paths(case):
    _, edges, n, e = case
    best = G.distances(edges, 0)
    light = {}
    for a, b, w in edges:
        light[a, b] = min(w, light.get((a, b), w))
    for r in paths.shortest_path_tree(n, e, 0, "w").collect():
        if r["predecessor"] is not None:
            assert best[r["predecessor"]] + light[r["predecessor"], r["id"]] == r["distance"]


def test_k_shortest_paths(case):
    _, edges, _, e = case
    target = max(G.distances(edges, 0).items(), key=lambda x: x[1])[0]
    got = [(r["cost"], r["path"]) for r in paths.ksssp(e, 0, target, 4, "w", 8).orderBy("rank").collect()]
    assert got == G.simple_paths(edges, 0, target, 4, 8)


def test_components(case):
    nodes, edges, n, e = case
    assert column(community.connected_components(n, e), "component") == G.components(nodes, edges)


def test_long_chain_component(spark):
    chain = spark.range(200).selectExpr("id as src", "id + 1 as dst")
    got = community.connected_components(spark.range(201), chain)
    assert got.select("component").distinct().collect()[0][0] == 0


def test_betweenness(case):
    nodes, edges, n, e = case
    got, want = column(centrality.betweenness_centrality(n, e), "betweenness"), G.betweenness(nodes, edges)
    assert all(abs(got[v] - want[v]) < 1e-9 for v in nodes)


def test_triangles_and_clustering(case):
    nodes, edges, n, e = case
    want = G.triangles(edges)
    assert community.triangle_count(e).first()[0] == len(want)
    per = Counter(v for t in want for v in t)
    assert column(community.local_clustering_coefficient(n, e), "triangles") == {v: per.get(v, 0) for v in nodes}


def test_core(case):
    nodes, edges, n, e = case
    for k in (1, 2, 3):
        kept = {v for v, x in column(community.k_core(n, e, k), "in_core").items() if x}
        assert kept == {v for v in G.core(nodes, edges, k)}


def test_truss_edges_have_support(case):
    _, _, _, e = case
    left = {(r["a"], r["b"]) for r in community.k_truss(e, 3).collect()}
    found = G.triangles([(a, b, 1) for a, b in left])
    for a, b in left:
        assert any({a, b} <= set(t) for t in found)


def test_two_hop_counts(case):
    _, edges, n, e = case
    want = Counter()
    for (a, _), k in G.open_two_hops(edges).items():
        want[a] += k
    got = column(match.two_hop_not_direct(e, n.selectExpr("id", "1L as paths"), ["paths"]).filter("paths <> 0"), "paths")
    assert got == dict(want)


@pytest.mark.parametrize("hot", [2, 1000])
def test_shared_neighbours(case, hot, monkeypatch):
    monkeypatch.setattr(match, "HOT_NEIGHBOUR", hot)
    _, edges, _, e = case
    near = G.adjacency(edges)
    for least in (1, 2, 3):
        got = {(r["left"], r["right"]): r["shared"] for r in match.shared_neighbor_pairs(e, "src", "dst", least).collect()}
        want = {(a, b): len(near[a] & near[b]) for a in near for b in near if a < b and len(near[a] & near[b]) >= least}
        assert got == want


def test_pairs_of_a_hot_group_are_all_there(spark):
    rows = spark.range(60).selectExpr("'g' as g", "id as m")
    got = {(r["left"], r["right"]) for r in match.pairs_within(rows, ["g"], "m", block=7).collect()}
    assert got == {(a, b) for a in range(60) for b in range(a + 1, 60)}


def test_tasks_follow_the_number_of_pairs(spark, monkeypatch):
    """By the bytes of 400 rows one task would list all 3,900 pairs."""
    monkeypatch.setattr(match, "PIECE_PAIRS", 100)
    rows = spark.range(400).selectExpr("id % 20 as g", "id as m")
    pairs = match.pairs_within(rows, ["g"], "m")
    assert pairs.rdd.getNumPartitions() == 38 and pairs.count() == 20 * 190


def test_cycles_agree_with_counts(case):
    _, edges, _, e = case
    counts = match.closed_walk_counts(e, "w", 3)
    assert (counts.agg({"cycles": "sum"}).first()[0] or 0) == match.cycle_match(e, "w", 3).count()


def test_walks_follow_edges(case):
    _, edges, n, e = case
    near = G.adjacency(edges)
    for walks in (paths.random_walks(e, n, 4, 2), paths.random_walks(e, n, 3, 1, 0.25, 2.0)):
        rows = walks.collect()
        for r in rows:
            assert r["path"][0] == r["root"]
            assert all(b in near[a] for a, b in zip(r["path"], r["path"][1:]))
            assert len(r["path"]) == 1 + (3 if len(rows) == len(n.collect()) else 4) or not near.get(r["path"][-1])
    again = {(r["root"], r["walk"]): r["path"] for r in paths.random_walks(e, n.repartition(3), 4, 2).collect()}
    assert again == {(r["root"], r["walk"]): r["path"] for r in paths.random_walks(e, n, 4, 2).collect()}


def test_louvain_finds_planted_groups(spark):
    import random

    draw = random.Random(5)
    edges = [(a, b) for a in range(24) for b in range(a + 1, 24) if draw.random() < (0.8 if a // 8 == b // 8 else 0.03)]
    e, n = spark.createDataFrame(edges, "src bigint, dst bigint"), spark.range(25)
    found = column(community.louvain(n, e), "community")
    assert found[24] == 24
    assert len({found[v] for v in range(24)}) == 3
    assert all(len({found[v] for v in range(8 * g, 8 * g + 8)}) == 1 for g in range(3))
    parts = n.selectExpr("id").join(community.louvain(n, e), "id")
    whole = community.connected_components(n, e, "community")
    assert community.modularity(e, parts).first()[0] >= community.modularity(e, whole).first()[0]


def test_label_propagation_is_synchronous(case):
    nodes, edges, n, e = case
    label = {v: v for v in nodes}
    for _ in range(3):
        votes = {v: Counter() for v in nodes}
        for a, b, _ in edges:
            votes[a][label[b]] += 1
            votes[b][label[a]] += 1
        label = {v: min(c, key=lambda x: (-c[x], x)) if (c := votes[v]) else label[v] for v in nodes}
    assert column(community.label_propagation(n, e, 3), "label") == label


def test_fuzzy_names_lose_no_pair(spark):
    import random

    draw = random.Random(8)
    words = {"".join(draw.choice("abc") for _ in range(draw.randrange(1, 9))) for _ in range(120)}
    rows = spark.createDataFrame([(i, w) for i, w in enumerate(sorted(words))], "id int, w string")

    def edits(a, b):
        last = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = [i]
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
            last = row
        return last[-1]

    for threshold in (0.5, 0.7, 0.8):
        got = {(r["left"], r["right"]) for r in match.fuzzy_name_join(rows, "id", "w", threshold).collect()}
        want = {(a, b) for a in words for b in words if a < b and 1.0 - edits(a, b) / max(len(a), len(b)) > threshold}
        assert got == want


def test_a_list_of_a_hot_key_is_one_row(spark):
    from trellis.operators.ordering import collect_lists

    rows = spark.range(25).selectExpr("if(id < 20, 'hot', 'cold') as k", "id as v")
    got = {r["k"]: r["l"] for r in collect_lists(rows, ["k"], ["v"], "l").collect()}
    assert got == {"hot": list(range(20)), "cold": list(range(20, 25))}
