"""Known answers on the small graphs."""

import pytest
from pyspark.sql import functions as F

from tests.graphs import AIRPORTS, SMALL_AIRPORTS, supply_chain
from trellis.model import PropertyGraph
from trellis.operators import centrality, match, mutate, paths
from trellis.sources.frames import add_reverse_edges, edges_from_dataframe, nodes_from_dataframe


def frames(spark, edges, nodes=None):
    e = spark.createDataFrame(edges, "src string, dst string, miles bigint")
    names = nodes or sorted({x for a, b, *_ in edges for x in (a, b)})
    return spark.createDataFrame([(n,) for n in names], "id string"), e


def as_dict(df, key="id"):
    value = [c for c in df.columns if c != key][0]
    return {r[key]: r[value] for r in df.collect()}


def test_small_airports_betweenness(spark):
    n, e = frames(spark, SMALL_AIRPORTS)
    assert as_dict(centrality.betweenness_centrality(n, e)) == {"ORD": 4, "DEN": 2, "MKE": 0, "SJC": 0}


def test_small_airports_distances(spark):
    n, e = frames(spark, SMALL_AIRPORTS)
    assert as_dict(paths.sssp(n, e, "MKE")) == {"MKE": 0, "ORD": 1, "DEN": 2, "SJC": 3}
    assert as_dict(paths.sssp(n, e, "MKE", "miles")) == {"MKE": 0, "ORD": 66, "DEN": 952, "SJC": 1900}
    assert as_dict(paths.bfs(n, e, "MKE", 2)) == {"MKE": 0, "ORD": 1, "DEN": 2, "SJC": None}


def test_projection_keeps_distances(spark):
    n, e = frames(spark, SMALL_AIRPORTS)
    nodes = nodes_from_dataframe(n, "id", "airport", "Airport", property_columns=[]).unionByName(
        nodes_from_dataframe(spark.createDataFrame([("PAP",)], "id string"), "id", "food", "Restaurant", property_columns=[])
    )
    edges = edges_from_dataframe(e, "src", "dst", "airport", "airport", "FLIES_TO", ["miles"], ["src", "dst"])
    visit = spark.createDataFrame([("SJC", "PAP")], "src string, dst string")
    edges = edges.unionByName(
        edges_from_dataframe(visit, "src", "dst", "airport", "food", "EATS_AT", key_columns=["src"]), allowMissingColumns=True
    )
    g = PropertyGraph(nodes, edges).project(["Airport"], ["FLIES_TO"])
    assert g.edges.filter("dst = 'PAP'").count() == 0
    assert as_dict(paths.sssp(g.nodes, g.edges, "MKE", "miles")) == {"MKE": 0, "ORD": 66, "DEN": 952, "SJC": 1900}


def test_null_weights(spark):
    n, e = frames(spark, [*SMALL_AIRPORTS, ("MKE", "SJC", None)])
    assert as_dict(paths.sssp(n, e, "MKE", "miles"))["SJC"] == 1900
    with pytest.raises(ValueError):
        paths.sssp(n, e, "MKE", "miles", null_weights="fail")


def test_negative_weight_is_refused(spark):
    n, e = frames(spark, [("A", "B", -1)])
    with pytest.raises(paths.NegativeWeight):
        paths.sssp(n, e, "A", "miles")


def test_path_listing(spark):
    _, e = frames(spark, SMALL_AIRPORTS)
    ids = e.withColumn("edge_id", F.concat("src", "dst"))
    one = lambda x: spark.createDataFrame([(x,)], "id string")
    rows = match.path_listing(ids, one("SJC"), 3, one("MKE"))
    assert {r["path"] for r in rows.collect()} == {"SJC>ORD>MKE", "SJC>DEN>ORD>MKE"}


def test_larger_airports_pagerank(spark):
    n, e = frames(spark, AIRPORTS)
    got = as_dict(centrality.pagerank(n, e, 30))
    want = {"DEN": 1.6237, "ORD": 1.4870, **dict.fromkeys(["MSP", "MSN", "GRB", "MKE"], 0.8946),
            **dict.fromkeys(["EGE", "COS", "SJC", "PUB", "ASE", "FNL"], 0.8848)}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 2e-3 for k in want)
    assert abs(sum(got.values()) - 12) < 1e-2


def test_pagerank_with_split_hubs(spark):
    n, e = frames(spark, AIRPORTS)
    whole = as_dict(centrality.pagerank(n, e, 5, tolerance=None))
    split = as_dict(centrality.pagerank(n, e, 5, tolerance=None, hub_size=2))
    assert all(abs(whole[k] - split[k]) < 1e-12 for k in whole)


def test_larger_airports_betweenness(spark):
    n, e = frames(spark, AIRPORTS)
    got = as_dict(centrality.betweenness_centrality(n, e))
    assert got["DEN"] == 85 and got["ORD"] == 68
    assert sum(v for k, v in got.items() if k not in ("DEN", "ORD")) == 0


def test_supply_chain_betweenness(spark):
    nodes, edges = supply_chain()
    n, e = frames(spark, [(a, b, 1) for a, b in edges], nodes)
    got = as_dict(centrality.betweenness_centrality(n, e))
    want = {"I_103": 21, "I_102": 16, "I_101": 12, "I_104": 9, "O_107": 6.5, "O_103": 6, "O_106": 4.5, "O_102": 4.5,
            "O_108": 3.5, "O_105": 3.5, "O_101": 3.5, "O_104": 3}
    assert {k: v for k, v in got.items() if v} == want


def test_edges_imported_both_ways_keep_the_resolving_half(spark):
    nodes, edges = supply_chain()
    space = {"P": "person", "O": "order", "I": "item", "S": "store", "D": "dist", "R": "reviewer"}
    node_frames, edge_frames = [], []
    for letter, name in space.items():
        rows = spark.createDataFrame([(x,) for x in nodes if x[0] == letter], "id string")
        node_frames.append(nodes_from_dataframe(rows, "id", name, name.title(), property_columns=[]))
    for a, b in {(a[0], b[0]) for a, b in edges}:
        part = spark.createDataFrame([x for x in edges if (x[0][0], x[1][0]) == (a, b)], "s string, d string")
        for s, d in (("s", "d"), ("d", "s")):
            edge_frames.append(edges_from_dataframe(part, s, d, space[a], space[b], "T", key_columns=[s, d]))
    g = PropertyGraph.of(node_frames, edge_frames)
    assert g.edges.count() == 84
    counts = g.resolved().counts().first()
    assert (counts["num_nodes"], counts["num_edges"]) == (24, 42)
    assert g.unresolved_edges().count() == 42


def test_supply_chain_reach(spark):
    _, edges = supply_chain()
    back = spark.createDataFrame([(b, a) for a, b in edges], "src string, dst string")
    places = spark.createDataFrame([("S_104",), ("D_102",), ("R_102",)], "id string")
    reached = {r["id"] for r in match.reachable_set(back, places, 10).collect()}
    assert {x for x in reached if x.startswith("P")} == {"P_101", "P_102", "P_103", "P_104"}


def test_order_totals_count_parallel_edges(spark):
    price = {401: 2, 402: 7, 403: 7}
    lines = [(101, 402), (101, 402), (101, 402), (102, 401), (102, 401), (102, 402), *[(103, 403)] * 4]
    orders = nodes_from_dataframe(spark.createDataFrame([(101,), (102,), (103,), (104,)], "id int"), "id", "o", "Order", property_columns=[])
    products = nodes_from_dataframe(spark.createDataFrame(list(price.items()), "id int, unit_price int"), "id", "p", "Product", property_columns=["unit_price"])
    edges = edges_from_dataframe(spark.createDataFrame(lines, "s int, d int"), "s", "d", "o", "p", "CONTAINS")
    rows = mutate.set_from_aggregate(orders, edges, products, "unit_price", "total")
    assert {r["id"]: r["total"] for r in rows.collect()} == {"101": 21, "102": 11, "103": 28, "104": None}


def test_reverse_edges_have_null_properties(spark):
    spokes = spark.createDataFrame([(x, "ORD", 5) for x in "ABCDE"], "s string, d string, hops int")
    e = edges_from_dataframe(spokes, "s", "d", "a", "a", "FLIES_TO", ["hops"], ["s"])
    both = mutate.create_reverse_edges(e)
    assert both.count() == 10 and both.filter("hops is null").count() == 5
    assert add_reverse_edges(e).filter("hops is null").count() == 0
