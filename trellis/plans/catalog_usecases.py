"""Named queries: composite use cases on the input tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from trellis.model import PropertyGraph
from trellis.operators import community
from trellis.operators.match import Hop, Node, match_path, reachable_set
from trellis.plans import usecases as U
from trellis.plans.catalog_joins import TWO_HOP
from trellis.plans.graphs import HAND_OVER, customers, hand_over, supply
from trellis.plans.registry import query
from trellis.sources.frames import edges_from_dataframe, promote_column_to_nodes, relational_to_graph

C = F.col


@query("friend_of_friend_risk", f"""WITH {TWO_HOP}, j AS (SELECT a, c_acctbal AS v, c_acctbal < 0 AS bad, c_mktsegment = 'MACHINERY' AS unv FROM two JOIN customer ON c_custkey = c),
  g AS (SELECT a, avg(v) AS s, count(*) AS n, count(*) FILTER (bad) AS b, count(*) FILTER (unv) AS u FROM j GROUP BY 1)
  SELECT a AS id, round(s + 1e-9, 5) AS avg_score, round(b / n::DOUBLE, 8) AS bad_share, round(u / n::DOUBLE, 8) AS unverified_share FROM g WHERE b > 0 AND u > 0""")
def _(t):
    accounts = t.customer.select(C("c_custkey").alias("id"), "c_acctbal", "c_mktsegment")
    rows = U.friend_of_friend_risk(
        hand_over(t), accounts, C("c_acctbal") < 0, C("c_mktsegment") == "MACHINERY", "c_acctbal"
    )
    return rows.select(
        "id", F.round(C("avg_score") + 1e-9, 5).alias("avg_score"), F.round("bad_share", 8).alias("bad_share"),
        F.round("unverified_share", 8).alias("unverified_share"),
    )


@query("blacklisted_second_degree", f"""WITH {TWO_HOP} SELECT a AS id, count(*) AS flagged FROM two JOIN customer ON c_custkey = c WHERE c_acctbal < 0 GROUP BY 1""")
def _(t):
    accounts = t.customer.select(C("c_custkey").alias("id"), "c_acctbal")
    return U.flagged_second_degree(hand_over(t), accounts, C("c_acctbal") < 0)


@query("under_the_radar", """SELECT o_custkey AS sender, l_suppkey AS receiver, count(*) AS n, round(avg(l_extendedprice), 6) AS average FROM lineitem JOIN orders ON o_orderkey = l_orderkey
  WHERE l_shipdate > TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '2001-01-01' AND l_extendedprice < 60000 GROUP BY ALL HAVING avg(l_extendedprice) > 45000 AND count(*) > 2""")
def _(t):
    sent = t.lineitem.join(t.orders, C("l_orderkey") == C("o_orderkey"))
    rows = U.under_the_radar(
        sent, "o_custkey", "l_suppkey", "l_extendedprice", "l_shipdate", "1996-01-01", "2001-01-01", 60000, 45000, 2
    )
    return rows.withColumn("average", F.round("average", 6))


@query("equal_amount_cycle", f"""WITH {HAND_OVER}, e AS (SELECT src, dst, qty FROM hand_over WHERE src <> dst),
  c AS (SELECT a.qty, a.src FROM e a JOIN e b ON a.dst = b.src AND a.qty = b.qty JOIN e c ON b.dst = c.src AND c.qty = a.qty
  JOIN e d ON c.dst = d.src AND d.qty = a.qty JOIN e f ON d.dst = f.src AND f.qty = a.qty AND f.dst = a.src)
  SELECT qty, count(*) AS cycles, count(DISTINCT src) AS accounts FROM c GROUP BY 1""")
def _(t):
    return U.equal_amount_cycle(hand_over(t), "qty", 5)


@query("suspicious_in_cycles", f"""WITH {HAND_OVER}, k AS (SELECT *, CAST(row_number() OVER () AS BIGINT) AS id FROM hand_over WHERE src <> dst),
  c AS (SELECT a.id AS i, b.id AS j, c.id AS k FROM k a JOIN k b ON a.dst = b.src AND a.qty = b.qty JOIN k c ON b.dst = c.src AND c.qty = a.qty AND c.dst = a.src),
  ids AS (SELECT i AS id FROM c UNION SELECT j FROM c UNION SELECT k FROM c)
  SELECT count(*) AS edges FROM ids JOIN k USING (id) WHERE price > 30000""")
def _(t):
    moved = hand_over(t).withColumn("edge_id", F.concat_ws(":", "eid", "price"))
    rows = U.suspicious_in_cycles(moved, "qty", 3, moved.filter("price > 30000"))
    return rows.agg(F.count("*").alias("edges"))


@query("account_vs_peer_average", f"""WITH {HAND_OVER}, s AS (SELECT src AS a, dst AS p, qty FROM hand_over UNION ALL SELECT dst, src, qty FROM hand_over),
  top AS (SELECT a, p FROM (SELECT a, p, count(*) AS n FROM s GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY a ORDER BY n DESC, p) = 1)
  SELECT s.a AS account, top.p AS excluded, round(avg(qty) FILTER (s.p <> top.p), 6) AS average_without FROM s JOIN top ON top.a = s.a GROUP BY ALL""")
def _(t):
    rows = U.account_vs_peer_average(hand_over(t), "src", "dst", "qty")
    return rows.withColumn("average_without", F.round("average_without", 6))


@query("common_claim_graph")
def _(t):
    bought = t.lineitem.join(t.orders, C("l_orderkey") == C("o_orderkey")).select(
        C("o_custkey").alias("c"), C("l_partkey").alias("p")
    )
    return U.common_claim_graph(bought, "c", "p", 4)


@query("prior_common_store", """WITH p AS (SELECT o_custkey AS person, l_suppkey AS store, l_shipdate AS ts, l_returnflag = 'R' AND l_quantity >= 49 AS fraud FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
  SELECT b.store, count(*) AS pairs, count(DISTINCT b.person) AS persons FROM p a JOIN p b ON a.person = b.person AND b.ts < a.ts WHERE a.fraud GROUP BY 1""")
def _(t):
    fraud = ((C("l_returnflag") == "R") & (C("l_quantity") >= 49)).alias("fraud")
    bought = t.lineitem.join(t.orders, C("l_orderkey") == C("o_orderkey")).select(
        C("o_custkey").alias("person"), C("l_suppkey").alias("store"), C("l_shipdate").alias("ts"), fraud
    )
    return U.prior_common_store(bought, "person", "store", "ts", "fraud")


@query("supply_chain_reach", f"""WITH RECURSIVE {HAND_OVER}, r AS (SELECT c_custkey AS id, 0 AS level FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_acctbal > 9800
  UNION SELECT src, level + 1 FROM r JOIN hand_over ON dst = id WHERE level < 4)
  SELECT c_name, CAST(min(level) AS BIGINT) AS hops FROM r JOIN customer ON c_custkey = id GROUP BY 1""")
def _(t):
    targets = t.customer.filter((C("c_mktsegment") == "MACHINERY") & (C("c_acctbal") > 9800)).select(C("c_custkey").alias("id"))
    backward = hand_over(t).select(C("dst").alias("src"), C("src").alias("dst"))
    reached = reachable_set(backward, targets, 4)
    return reached.join(t.customer, C("id") == C("c_custkey")).select("c_name", C("level").alias("hops"))


@query("orders_not_shipped", """SELECT count(*) FILTER (shipped IS NULL) AS missing, count(*) FILTER (length(shipped) < 1) AS empty FROM (
  SELECT CASE WHEN o_orderstatus = 'O' THEN '' WHEN o_orderstatus = 'P' THEN '1998' END AS shipped FROM orders)""")
def _(t):
    shipped = F.when(C("o_orderstatus") == "O", "").when(C("o_orderstatus") == "P", "1998").alias("shipped")
    return t.orders.select(shipped).agg(
        F.count(F.when(C("shipped").isNull(), 1)).alias("missing"), F.count(F.when(F.length("shipped") < 1, 1)).alias("empty")
    )


@query("entity_resolution_clusters", """WITH RECURSIVE m AS (SELECT DISTINCT o_custkey AS c, l_partkey AS p, c_mktsegment AS f, c_nationkey AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey),
  pairs AS (SELECT a.c AS x, b.c AS y FROM m a JOIN m b ON a.p = b.p AND a.c < b.c GROUP BY ALL
    HAVING count(*) + max(CASE WHEN a.f = b.f THEN 1 ELSE 0 END) + max(CASE WHEN a.n = b.n THEN 1 ELSE 0 END) > 5),
  u AS MATERIALIZED (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs),
  r(id, l) AS (SELECT c_custkey, c_custkey FROM customer UNION SELECT u.y, r.l FROM r JOIN u ON u.x = r.id WHERE r.l < u.y)
  SELECT id, min(l) AS cluster FROM r GROUP BY 1""")
def _(t):
    bought = t.lineitem.join(t.orders, C("l_orderkey") == C("o_orderkey")).select(
        C("o_custkey").alias("c"), C("l_partkey").alias("p")
    )
    people = t.customer.select(C("c_custkey").alias("c"), C("c_mktsegment").alias("f"), C("c_nationkey").alias("n"))
    return U.entity_resolution_clusters(people, "c", bought, "p", ["f", "n"], 5)


@query("customer_nation_graph", "SELECT n_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1")
def _(t):
    nodes, edges = relational_to_graph(
        {"customer": (t.customer.select("c_custkey", "c_acctbal", "c_nationkey"), "c_custkey", "Customer"),
         "nation": (t.nation.select("n_nationkey", "n_name"), "n_nationkey", "Nation")},
        [("customer", "c_nationkey", "nation", "FROM_NATION")],
    )
    rows = match_path(
        PropertyGraph(nodes, edges).resolved(), Node("c", ("Customer",), None, ("c_acctbal",)),
        Hop("r", Node("n", ("Nation",), None, ("n_name",)), ("FROM_NATION",)),
    )
    return rows.groupBy(C("n_n_name").alias("n_name")).agg(
        F.count("*").alias("customers"), F.round(F.sum("c_c_acctbal"), 2).alias("balance")
    )


@query("order_totals", "SELECT o_custkey, round(sum(p_retailprice), 2) AS total FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey GROUP BY 1")
def _(t):
    from trellis.operators.mutate import set_from_aggregate

    g = supply(t)
    orders = set_from_aggregate(g.nodes_with("Order"), g.edges_of("CONTAINS"), g.nodes_with("Part"), "p_retailprice", "total")
    placed = g.edges_of("PLACED").select(C("src").cast("bigint").alias("o_custkey"), C("dst").alias("id"))
    return placed.join(orders.filter("total is not null").select("id", "total"), "id").groupBy("o_custkey").agg(
        F.round(F.sum("total"), 2).alias("total")
    )


@query("case_taxonomy_graph", """SELECT 'event_type' AS kind, count(DISTINCT event_type) AS nodes, count(event_type) AS edges FROM events
  UNION ALL SELECT 'user_id', count(DISTINCT user_id), count(user_id) FROM events UNION ALL SELECT 'day', count(DISTINCT CAST(ts AS DATE)), count(ts) FROM events""")
def _(t):
    cases = t.events.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    out = None
    for column in ("event_type", "user_id", "day"):
        nodes, edges = promote_column_to_nodes(cases, "event_id", column, "case", column, column, f"HAS_{column}".upper())
        row = nodes.agg(F.lit(column).alias("kind"), F.count("*").alias("nodes")).withColumn("k", F.lit(1)).join(
            edges.agg(F.count("*").alias("edges")).withColumn("k", F.lit(1)), "k"
        ).drop("k")
        out = row if out is None else out.unionByName(row)
    return out


@query("drug_target_counts", """SELECT count(*) AS n FROM part JOIN lineitem ON l_partkey = p_partkey JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey WHERE p_type = 'ECONOMY' AND l_quantity > 25 AND o_totalprice >= 199000 AND n_regionkey = 2""")
def _(t):
    rows = match_path(
        supply(t), Node("b", ("Part",), C("p_type") == "ECONOMY"),
        Hop("l", Node("o", ("Order",), C("o_totalprice") >= 199000), ("CONTAINS",), "in", C("l_quantity") > 25),
        Hop("p", Node("c"), ("PLACED",), "in"), Hop("i", Node("n"), ("IN_NATION",)),
        Hop("r", Node("z", ("Region",), C("id") == "2"), ("IN_REGION",)),
    )
    return rows.agg(F.count("*").alias("n"))


@query("essential_gene_chain", """WITH e AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity >= 49 AND l_returnflag = 'R'),
  m AS (SELECT DISTINCT l_partkey, l_suppkey FROM e JOIN lineitem USING (l_partkey) WHERE l_discount < 0.02)
  SELECT l_suppkey, l_partkey FROM m WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 8000)""")
def _(t):
    return U.essential_chain(
        t.lineitem.filter((C("l_quantity") >= 49) & (C("l_returnflag") == "R")),
        t.lineitem.filter("l_discount < 0.02").select("l_partkey", "l_suppkey"),
        t.supplier.filter("s_acctbal > 8000").select(C("s_suppkey").alias("l_suppkey")), "l_partkey", "l_suppkey",
    )


# Events stand for facts about a user on a day; the props number names the fact.
FACTS = "facts AS (SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type AS kind, CAST(CAST(json_extract(props, '$.k') AS BIGINT) % 20 AS VARCHAR) AS name FROM events)"


def facts(t):
    k = F.from_json("props", "k bigint")["k"]
    return t.events.select(
        "user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), C("event_type").alias("kind"),
        (k % 20).cast("string").alias("name"),
    )


@query("patient_journey", "WITH " + FACTS + " SELECT * FROM " + " JOIN ".join(
    f"(SELECT user_id, day, string_agg(DISTINCT name, ',' ORDER BY name) AS {k}s, count(DISTINCT name) AS num_{k}s FROM facts WHERE kind = '{k}' GROUP BY ALL)"
    + (" USING (user_id, day)" if i else "") for i, k in enumerate(("click", "view", "purchase", "error"))))
def _(t):
    rows = facts(t)
    kinds = [(rows.filter(C("kind") == k), f"{k}s") for k in ("click", "view", "purchase", "error")]
    return U.patient_journey(kinds, "user_id", "day")


# Purchases stand for prescriptions: customer, day, part name, brand, quantity.
RX = "rx AS (SELECT o_custkey AS patient, strftime(o_orderdate, '%Y-%m-%d') AS day, p_name AS drug, p_brand AS code, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ' mg' AS strength, l_returnflag AS relation FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey)"


def rx(t):
    return (
        t.lineitem.join(t.orders, C("l_orderkey") == C("o_orderkey")).join(t.part, C("l_partkey") == C("p_partkey"))
        .select(
            C("o_custkey").alias("patient"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), C("p_name").alias("drug"),
            C("p_brand").alias("code"), F.concat(C("l_quantity").cast("bigint").cast("string"), F.lit(" mg")).alias("strength"),
            C("l_returnflag").alias("relation"),
        )
    )


@query("prescriptions_of_patient", f"WITH {RX} SELECT patient, day, drug, code, string_agg(DISTINCT strength || '(' || relation || ')', ' ' ORDER BY strength || '(' || relation || ')') AS details FROM rx WHERE patient = 21 GROUP BY ALL")
def _(t):
    return U.prescriptions_of_patient(rx(t).withColumnRenamed("strength", "detail"), C("patient") == 21)


@query("drug_users", f"WITH {RX} SELECT DISTINCT patient, day, drug, code FROM rx WHERE contains(drug, 'red w')")
def _(t):
    return U.drug_users(rx(t), "red w")


@query("drug_in_date_range", f"WITH {RX} SELECT DISTINCT patient, day, drug FROM rx WHERE drug IN ('red widget', 'blue bolt') AND day >= '1996-05-01' AND day < '1997-05-01'")
def _(t):
    return U.drug_in_date_range(rx(t), ["red widget", "blue bolt"], "1996-05-01", "1997-05-01")


@query("strength_at_least", f"WITH {RX} SELECT DISTINCT patient, day, drug, strength FROM rx WHERE contains(lower(drug), 'small ring') AND try_cast(left(strength, 1) AS INTEGER) >= 4")
def _(t):
    return U.strength_at_least(rx(t), "small ring", 4)


@query("drug_combination", f"""WITH {RX}, l AS (SELECT patient, string_agg(DISTINCT drug, ',' ORDER BY drug) AS listed, count(DISTINCT drug) AS num_listed FROM rx WHERE contains(drug, 'widget') OR contains(drug, 'gear') GROUP BY 1)
  SELECT DISTINCT patient, drug AS other_drug, day, listed, num_listed FROM rx JOIN l USING (patient) WHERE contains(drug, 'blue bolt')""")
def _(t):
    return U.drug_combination(rx(t), ["widget", "gear"], "blue bolt")


@query("co_occurring_facts", f"""WITH {FACTS} SELECT DISTINCT a.user_id, a.day, a.name AS first, b.name AS second FROM facts a JOIN facts b USING (user_id, day) WHERE a.kind = 'error' AND b.kind = 'purchase'""")
def _(t):
    return U.co_occurring_facts(facts(t), ["user_id", "day"], C("kind") == "error", C("kind") == "purchase", "name")


@query("northwind_graph", """SELECT 'CONTAINS' AS type, count(*) AS n FROM lineitem UNION ALL SELECT 'PLACED', count(*) FROM orders UNION ALL SELECT 'IN_NATION', count(*) FROM customer
  UNION ALL SELECT 'IN_REGION', count(*) FROM nation UNION ALL SELECT 'SUPPLIES_FROM', count(*) FROM supplier""")
def _(t):
    lines = t.lineitem.select(F.concat_ws(":", "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice").alias("line"), "l_orderkey")
    _, edges = relational_to_graph(
        {"region": (t.region, "r_regionkey", "Region"), "nation": (t.nation, "n_nationkey", "Nation"),
         "customer": (t.customer, "c_custkey", "Customer"), "supplier": (t.supplier, "s_suppkey", "Supplier"),
         "order": (t.orders, "o_orderkey", "Order"), "line": (lines, "line", "Line")},
        [("nation", "n_regionkey", "region", "IN_REGION"), ("customer", "c_nationkey", "nation", "IN_NATION"),
         ("supplier", "s_nationkey", "nation", "SUPPLIES_FROM"), ("order", "o_custkey", "customer", "PLACED"),
         ("line", "l_orderkey", "order", "CONTAINS")],
    )
    return edges.groupBy("type").agg(F.count("*").alias("n"))


@query("clinical_enrichment_graph", """WITH e AS (SELECT conv_id, 'e' || (turn % 4) AS entity, role FROM conversations)
  SELECT 'entity_edges' AS what, count(*) AS n FROM (SELECT DISTINCT conv_id, entity FROM e) UNION ALL SELECT 'code_edges', count(*) FROM (SELECT DISTINCT entity, role FROM e)
  UNION ALL SELECT 'missing_root', count(*) FROM conversations WHERE turn = 0 UNION ALL SELECT 'bad_json', count(*) FROM conversations WHERE turn = 1""")
def _(t):
    from trellis.sources.files import nested_json_to_graph

    entity = F.concat(F.lit("e"), (C("turn") % 4).cast("string"))
    body = F.to_json(F.struct(F.array(F.struct(entity.alias("entityId"), F.array("role").alias("vocabularyCodes"))).alias("entities")))
    notes = t.conversations.select(C("conv_id"), body.alias("json")).unionAll(
        t.conversations.filter("turn = 0").select("conv_id", F.lit('{"other": 1}'))
    ).unionAll(t.conversations.filter("turn = 1").select("conv_id", F.lit('{"entities": [')))
    entities, codes, report = nested_json_to_graph(notes, "conv_id", "json")
    return (
        entities.agg(F.lit("entity_edges").alias("what"), F.count("*").alias("n"))
        .unionAll(codes.agg(F.lit("code_edges"), F.count("*")))
        .unionAll(report.select(F.lit("missing_root"), "missing_root"))
        .unionAll(report.select(F.lit("bad_json"), "bad_json"))
    )


@query("ranked_clusters", None)
def _(t):
    nodes, edges = customers(t), hand_over(t)
    parts = community.label_propagation(nodes, edges, 10, "cluster")
    return U.ranked_clusters(nodes, edges, parts, 10)


@query("document_source_graph", "SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL")
def _(t):
    e = edges_from_dataframe(t.documents, "source", "lang", "source", "lang", "WRITES_IN", key_columns=["doc_id"])
    return e.groupBy(C("src").alias("source"), C("dst").alias("lang")).agg(F.count("*").alias("n"))
