"""Iterations run to their end or raise, null groups count, no walk and no row is lost."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from trellis.operators import centrality, community, mutate, ordering, paths
from trellis.plans import usecases
from trellis.session import NotConverged, clear_scratch


def chain(spark, n):
    nodes = spark.range(n).select("id")
    return nodes, spark.range(n - 1).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))


def test_exhausted_limits_raise(spark):
    nodes, edges = chain(spark, 40)
    for call in (
        lambda: community.connected_components(nodes, edges, max_iterations=1),
        lambda: community.k_core(nodes, edges, 2, max_iterations=2),
        lambda: community.k_truss(edges.unionAll(spark.createDataFrame([(0, 2), (1, 3)], "src long, dst long")), 4, max_iterations=1),
    ):
        with pytest.raises(NotConverged):
            call()
    assert community.connected_components(nodes, edges).select("component").distinct().count() == 1
    assert community.k_core(*chain(spark, 12), 2).agg(F.sum("in_core")).first()[0] == 0


def test_betweenness_of_a_chain_goes_to_its_end(spark):
    nodes, edges = chain(spark, 12)
    assert centrality.betweenness_centrality(nodes, edges).agg(F.sum("betweenness")).first()[0] == pytest.approx(220)


def test_every_walk_stays(spark):
    star = [(0, i) for i in range(1, 51)] + [(i, 0) for i in range(1, 51)]
    edges = spark.createDataFrame(star, "src long, dst long")
    roots = spark.range(51).select("id")
    walks = paths.random_walks(edges, roots, 4, 4, backward_probability=0.01, forward_probability=2.0, max_turns=1).collect()
    assert Counter((r.root, r.walk) for r in walks) == Counter((i, w) for i in range(51) for w in range(4))
    known = set(star)
    assert all(len(r.path) == 5 and all(step in known for step in zip(r.path, r.path[1:])) for r in walks)


def test_null_groups_over_several_ranges(spark):
    rows = [(None, i) for i in range(3000)] + [(f"g{i % 3}", i) for i in range(300)]
    table = spark.createDataFrame(rows, "g string, v long").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = ordering.row_number_within(table, ["g"], ["v"]).collect()
        assert sorted(r.rn for r in numbered if r.g is None) == list(range(1, 3001))
        assert sorted(r.rn for r in numbered if r.g == "g1") == list(range(1, 101))
        medians = {r.g: r.m for r in ordering.exact_quantiles(table, ["g"], "v", {"m": 0.5}).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert medians[None] == 1499.5 and len(medians) == 4


def test_repeated_keys_do_not_multiply_rows(spark):
    table = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    batch = spark.createDataFrame([(1, "z"), (1, "y"), (3, "c"), (3, "d")], "id long, v string")
    assert sorted(map(tuple, mutate.graph_upsert(table, batch, ["id"], order_by=["v"]).collect())) == [(1, "y"), (2, "b"), (3, "c")]
    assert sorted(map(tuple, mutate.graph_update(table, batch, ["id"], order_by=["v"]).collect())) == [(1, "y"), (2, "b")]
    with pytest.raises(mutate.DuplicateKeys):
        mutate.graph_upsert(table, batch, ["id"], on_duplicate="fail")


def test_paths_and_cores_go_to_their_end(spark):
    nodes, edges = chain(spark, 30)
    assert paths.sssp(nodes, edges, 0).agg(F.max("distance")).first()[0] == 29
    assert paths.bfs(nodes, edges, 0).filter("level is null").count() == 0
    assert paths.sssp(nodes, edges, 0, max_iterations=5).filter("distance is not null").count() == 6
    clique = [(a, b) for a in range(100, 106) for b in range(a + 1, 106)]
    both = edges.unionAll(spark.createDataFrame([*clique, (29, 100)], "src long, dst long"))
    ends = both.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    core = {r.id for r in community.k_core(ends, both, 4).filter("in_core = 1").collect()}
    assert core == set(range(100, 106))
    assert {(r.a, r.b) for r in community.k_truss(both, 5).collect()} == set(clique)


def test_louvain_ends_by_its_own_rule(spark):
    cliques = [(g * 10 + a, g * 10 + b) for g in range(4) for a in range(6) for b in range(a)]
    edges = spark.createDataFrame([*cliques, *[(g * 10, g * 10 + 10) for g in range(3)]], "src long, dst long")
    nodes = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    found = community.louvain(nodes, edges)
    groups = {}
    for r in found.collect():
        groups.setdefault(r.community, set()).add(r.id // 10)
    assert len(groups) == 4 and all(len(g) == 1 for g in groups.values())
    spreading = community.label_propagation(nodes, edges).withColumnRenamed("label", "community")
    quality = [community.modularity(edges, parts).first()[0] for parts in (found, spreading)]
    assert quality[0] >= quality[1]


def test_any_subset_of_equal_names_counts(spark):
    accounts = spark.createDataFrame([(1, "x", "y", "p"), (2, "x", "y", "q"), (3, "z", "z", "z")], "id long, a string, b string, c string")
    links = spark.createDataFrame([(1, "l"), (2, "l"), (3, "l")], "id long, link string")
    got = {r.id: r.cluster for r in usecases.entity_resolution_clusters(accounts, "id", links, "link", ["a", "b", "c"]).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_derived_graphs_are_built_anew_after_a_clearing(spark):
    from trellis.plans.graphs import hand_over
    from trellis.plans.registry import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    before = hand_over(t).count()
    clear_scratch(spark)
    assert hand_over(t).count() == before
