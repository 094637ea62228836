"""Acceptance runs over small made-up data sets: accounts and transfers, purchases and fraud."""

import random

import pytest
from pyspark.sql import functions as F

from trellis.model import PropertyGraph
from trellis.operators import match, mutate
from trellis.operators.match import Hop, Node
from trellis.plans import usecases as U
from trellis.sources.frames import edges_from_dataframe, nodes_from_dataframe


@pytest.fixture(scope="module")
def transfers():
    """Two pairs with many transfers just below 10000, one cycle of five equal amounts, noise."""
    draw = random.Random(12)
    rows = []

    def add(sender, receiver, amount, day):
        rows.append((f"t{len(rows)}", str(sender), str(receiver), float(amount), f"20{day:02d}-06-01"))

    for sender, receiver in ((256, 324), (753, 919)):
        for i in range(7):
            add(sender, receiver, 9400 + 10 * i + (3 if sender == 256 else 0), 19)
    for a, b in zip((753, 11, 12, 13, 14), (11, 12, 13, 14, 753)):
        add(a, b, 777.0, 20)
    for i in range(300):
        add(1000 + draw.randrange(80), 2000 + draw.randrange(80), 1000 + i * 1.01, 18 + draw.randrange(3))
    add(256, 324, 9990, 25)
    return rows


@pytest.fixture(scope="module")
def bank(spark, transfers):
    sent = spark.createDataFrame(transfers, "tx string, sender string, receiver string, amount double, day string")
    sent = sent.withColumn("dot", F.to_timestamp("day").cast("timestamp_ntz"))
    accounts = sent.select(F.col("sender").alias("id")).unionAll(sent.select("receiver")).distinct()
    nodes = [
        nodes_from_dataframe(accounts, "id", "account", "ACCOUNT", property_columns=[]),
        nodes_from_dataframe(accounts, "id", "customer", "CUSTOMER", property_columns=[]),
        nodes_from_dataframe(sent, "tx", "tx", "TRANSACTION", property_columns=["amount", "dot"]),
    ]
    edges = [
        edges_from_dataframe(sent, "sender", "tx", "account", "tx", "TRANSACTION_SENDER", key_columns=["tx"]),
        edges_from_dataframe(sent, "tx", "receiver", "tx", "account", "TRANSACTION_RECEIVER", key_columns=["tx"]),
        edges_from_dataframe(accounts, "id", "id", "account", "customer", "HAS_CUSTOMER", key_columns=["id"]),
    ]
    return PropertyGraph.of(nodes, edges), sent


def test_lookup_and_single_customer(bank):
    g, _ = bank
    assert match.match_nodes(g, Node("a", ("ACCOUNT",), F.col("id") == "753")).count() == 1
    linked = match.match_path(g, Node("a", ("ACCOUNT",), F.col("id") == "753"), Hop("h", Node("c", ("CUSTOMER",)), ("HAS_CUSTOMER",)))
    assert linked.count() == 1


def test_radar_cycle_and_their_meeting(bank, spark):
    g, sent = bank
    path = match.match_path(
        g, Node("a", ("ACCOUNT",)), Hop("s", Node("t", ("TRANSACTION",), None, ("amount", "dot")), ("TRANSACTION_SENDER",)),
        Hop("r", Node("b", ("ACCOUNT",)), ("TRANSACTION_RECEIVER",)),
    )
    radar = U.under_the_radar(path, "a_id", "b_id", "t_amount", "t_dot", "2018-01-01", "2022-01-01")
    assert sorted((r["sender"], r["receiver"], r["n"]) for r in radar.collect()) == [("256", "324", 7), ("753", "919", 7)]
    moved = sent.select(F.col("sender").alias("src"), F.col("receiver").alias("dst"), "amount", F.col("tx").alias("edge_id"))
    cycles = match.cycle_match(moved, "amount", 5)
    rows = cycles.collect()
    assert len(rows) == 5 and all(r["nodes"][0] == r["nodes"][-1] and len(set(r["nodes"])) == 5 for r in rows)
    assert any("753" in r["nodes"] for r in rows)
    assert U.equal_amount_cycle(moved, "amount", 5).first()["cycles"] == 5
    on_cycle = [r["edge_id"] for r in U.suspicious_in_cycles(moved, "amount", 5, moved.filter("src = '753'")).collect()]
    assert len(on_cycle) == 1


def test_alert_and_flag(bank):
    g, _ = bank
    tx = g.nodes_with("TRANSACTION").filter("id = 't3'")
    customer = g.nodes_with("CUSTOMER").filter("id = '256'")
    new = mutate.flag_and_alert(g, tx, customer, "High value")
    alert = new.nodes_with("ALERT").collect()
    assert len(alert) == 1 and alert[0]["DESCRIPTION"] == "High value"
    assert new.edges_of("HAS_ALERT").count() == 1
    assert [r["id"] for r in new.nodes.filter("SUSPICIOUS = 'true'").collect()] == ["256"]
    before, after = g.counts().first(), new.counts().first()
    assert (after["num_nodes"], after["num_edges"]) == (before["num_nodes"] + 1, before["num_edges"] + 1)


def test_shared_store_before_fraud(spark):
    rows = [
        (1, 10, "2022-01-01", 0), (1, 11, "2022-01-05", 1), (1, 12, "2022-01-06", 0), (2, 10, "2022-02-01", 0), (2, 13, "2022-02-03", 1),
        (2, 14, "2022-02-03", 0), (2, 13, "2022-02-04", 1), (3, 10, "2022-03-01", 0), (4, 10, "2022-03-01", 1),
    ]
    bought = spark.createDataFrame(rows, "person int, store int, day string, fraud int")
    got = {r["store"]: (r["pairs"], r["persons"]) for r in U.prior_common_store(bought, "person", "store", "day", "fraud").collect()}
    want = {}
    for p, s, d, _ in rows:
        later = sum(1 for q, _, e, f in rows if f and q == p and d < e)
        if later:
            pairs, persons = want.get(s, (0, set()))
            want[s] = (pairs + later, persons | {p})
    assert got == {s: (n, len(p)) for s, (n, p) in want.items()}


def test_risk_drops_accounts_without_a_bad_or_unverified_friend(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (2, 4), (5, 2), (5, 3), (6, 7), (7, 8)], "src bigint, dst bigint")
    accounts = spark.createDataFrame(
        [(1, False, False, 1.0), (2, False, False, 2.0), (3, True, False, 4.0), (4, False, True, None), (5, False, False, 0.0),
         (6, False, False, 0.0), (7, False, False, 0.0), (8, True, False, 1.0)], "id bigint, bad boolean, unverified boolean, score double",
    )
    rows = U.friend_of_friend_risk(edges, accounts, F.col("bad"), F.col("unverified"), "score").collect()
    assert [(r["id"], r["avg_score"], r["bad_share"], r["unverified_share"]) for r in rows] == [(1, 4.0, 0.5, 0.5)]
