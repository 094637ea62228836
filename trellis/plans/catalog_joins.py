"""Named queries: pattern matching, joins and aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from trellis.operators import clean, match, stats
from trellis.operators.match import Hop, Node
from trellis.operators.ordering import collect_lists
from trellis.plans.graphs import HAND_OVER, HAND_OVER_IDS, customers, hand_over, supply
from trellis.plans.registry import query

C = F.col


@query("hop_directed", """SELECT c_name AS customer, count(*) AS orders, round(sum(o_totalprice), 2) AS total
  FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING' GROUP BY 1""")
def _(t):
    rows = match.match_path(
        supply(t), Node("c", ("Customer",), C("c_mktsegment") == "BUILDING", ("c_name",)),
        Hop("r", Node("o", ("Order",), None, ("o_totalprice",)), ("PLACED",)),
    )
    return rows.groupBy(C("c_c_name").alias("customer")).agg(
        F.count("*").alias("orders"), F.round(F.sum("o_o_totalprice"), 2).alias("total")
    )


@query("hop_reverse", """SELECT n_name AS nation, count(*) AS customers FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY 1""")
def _(t):
    rows = match.match_path(
        supply(t), Node("n", ("Nation",), None, ("n_name",)), Hop("r", Node("c", ("Customer",)), ("IN_NATION",), "in")
    )
    return rows.groupBy(C("n_n_name").alias("nation")).agg(F.count("*").alias("customers"))


@query("hop_undirected", f"""WITH {HAND_OVER} SELECT a, count(*) AS n, count(DISTINCT b) AS partners FROM (
  SELECT src AS a, dst AS b FROM hand_over UNION ALL SELECT dst, src FROM hand_over WHERE src <> dst) GROUP BY 1""")
def _(t):
    e = hand_over(t).select(C("src"), C("dst"), F.lit("c").alias("src_space"), F.lit("c").alias("dst_space"))
    return match.directed(e, "both").groupBy(C("src").alias("a")).agg(
        F.count("*").alias("n"), F.count_distinct("dst").alias("partners")
    )


@query("match_path", """SELECT r_name AS region, p_brand AS brand, count(*) AS n FROM region JOIN nation ON n_regionkey = r_regionkey
  JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
  JOIN part ON p_partkey = l_partkey WHERE p_size >= 45 AND o_orderpriority = '1-URGENT' GROUP BY ALL""")
def _(t):
    rows = match.match_path(
        supply(t), Node("p", ("Part",), C("p_size") >= 45, ("p_brand",)),
        Hop("l", Node("o", ("Order",), C("o_orderpriority") == "1-URGENT"), ("CONTAINS",), "in"),
        Hop("pl", Node("c"), ("PLACED",), "in"),
        Hop("i", Node("n"), ("IN_NATION",)),
        Hop("ir", Node("r", ("Region",), None, ("r_name",)), ("IN_REGION",)),
    )
    return rows.groupBy(C("r_r_name").alias("region"), C("p_p_brand").alias("brand")).agg(F.count("*").alias("n"))


@query("match_star", """SELECT o_orderstatus AS status, count(*) AS n FROM orders JOIN lineitem a ON a.l_orderkey = o_orderkey
  JOIN lineitem b ON b.l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey WHERE a.l_returnflag = 'R' AND b.l_quantity >= 45 GROUP BY 1""")
def _(t):
    rows = match.match_star(
        supply(t), Node("o", ("Order",), None, ("o_orderstatus",)),
        Hop("x", Node("p"), ("CONTAINS",), where=C("l_returnflag") == "R"),
        Hop("y", Node("s"), ("SUPPLIED_BY",), where=C("l_quantity") >= 45),
        Hop("z", Node("c", ("Customer",)), ("PLACED",), "in"),
    )
    return rows.groupBy(C("o_o_orderstatus").alias("status")).agg(F.count("*").alias("n"))


TWO_HOP = f"""{HAND_OVER}, e AS (SELECT src, dst FROM hand_over),
two AS (SELECT x.src AS a, y.dst AS c FROM e x JOIN e y ON x.dst = y.src
        WHERE x.src <> x.dst AND y.src <> y.dst AND NOT EXISTS (SELECT 1 FROM e z WHERE z.src = x.src AND z.dst = y.dst))"""


@query("two_hop_not_direct", f"WITH {TWO_HOP} SELECT a AS id, count(*) AS paths FROM two GROUP BY 1")
def _(t):
    ones = customers(t).withColumn("paths", F.lit(1).cast("bigint"))
    return match.two_hop_not_direct(hand_over(t), ones, ["paths"]).filter("paths > 0")


@query("shared_neighbor_pairs", """WITH m AS (SELECT DISTINCT o_custkey AS c, l_partkey AS p FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
  SELECT a.c AS "left", b.c AS "right", count(*) AS shared FROM m a JOIN m b ON a.p = b.p AND a.c < b.c GROUP BY ALL HAVING count(*) >= 4""")
def _(t):
    bought = t.lineitem.join(t.orders, C("l_orderkey") == C("o_orderkey")).select(
        C("o_custkey").alias("c"), C("l_partkey").alias("p")
    )
    return match.shared_neighbor_pairs(bought, "c", "p", 4)


@query("anti_pattern", """SELECT c_custkey AS id FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)""")
def _(t):
    g = supply(t)
    dear = match.semi_pattern(
        g.edges_of("PLACED"), g.nodes_with("Order").filter("o_totalprice > 300000").select(C("id").alias("dst")), ["dst"]
    )
    return match.anti_pattern(g.nodes_with("Customer"), dear).select(C("id").cast("bigint").alias("id"))


@query("semi_pattern", """SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal < 0)""")
def _(t):
    flagged = t.customer.filter("c_acctbal < 0").select(C("c_custkey").alias("o_custkey"))
    return match.semi_pattern(t.orders, flagged, ["o_custkey"]).select("o_orderkey")


@query("optional_match", """SELECT c_custkey, coalesce(list_aggregate(list_sort(list(o_orderkey) FILTER (o_orderkey IS NOT NULL)), 'string_agg', ','), '') AS orders
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > 450000 GROUP BY 1""")
def _(t):
    dear = t.orders.filter("o_totalprice > 450000").select(C("o_custkey").alias("c_custkey"), "o_orderkey")
    rows = match.optional_match(t.customer.select("c_custkey"), dear, ["c_custkey"], "o_orderkey", "orders")
    return rows.withColumn("orders", F.array_join(C("orders").cast("array<string>"), ","))


@query("left_join", """SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)""")
def _(t):
    return t.documents.select("doc_id", "lang").join(t.labels.select("doc_id", "quality"), "doc_id", "left")


@query("correlated_chain", """SELECT d AS day, user_id, clicks, views, buys FROM
  (SELECT CAST(ts AS DATE)::VARCHAR d, user_id, count(*) clicks FROM events WHERE event_type = 'click' GROUP BY ALL)
  JOIN (SELECT CAST(ts AS DATE)::VARCHAR d, user_id, count(*) views FROM events WHERE event_type = 'view' GROUP BY ALL) USING (d, user_id)
  JOIN (SELECT CAST(ts AS DATE)::VARCHAR d, user_id, count(*) buys FROM events WHERE event_type = 'purchase' GROUP BY ALL) USING (d, user_id)""")
def _(t):
    day = F.date_format("ts", "yyyy-MM-dd").alias("day")
    facts = [
        t.events.filter(C("event_type") == kind).groupBy(day, "user_id").agg(F.count("*").alias(name))
        for kind, name in (("click", "clicks"), ("view", "views"), ("purchase", "buys"))
    ]
    return match.correlated_chain(facts, ["day", "user_id"])


@query("cartesian_match", """SELECT c_nationkey AS nation, count(*) AS pairs FROM customer JOIN supplier ON c_nationkey = s_nationkey GROUP BY 1""")
def _(t):
    # grouped on both sides first: the pairs of a nation are counted, not listed
    c = t.customer.groupBy("c_nationkey").agg(F.count("*").alias("a"))
    s = t.supplier.groupBy("s_nationkey").agg(F.count("*").alias("b"))
    rows = match.cartesian_match(c, s, [("c_nationkey", "s_nationkey")])
    return rows.select(C("c_nationkey").alias("nation"), (C("a") * C("b")).alias("pairs"))


@query("theta_join", """SELECT a.l_partkey, a.l_orderkey AS earlier, b.l_orderkey AS later, a.l_quantity FROM lineitem a JOIN lineitem b
  ON a.l_partkey = b.l_partkey AND a.l_quantity = b.l_quantity AND a.l_shipdate < b.l_shipdate AND a.l_suppkey <> b.l_suppkey""")
def _(t):
    lines = t.lineitem.select("l_partkey", "l_orderkey", "l_quantity", "l_shipdate", "l_suppkey")
    rows = match.theta_join(
        lines, lines, [("l_partkey", "l_partkey"), ("l_quantity", "l_quantity")],
        (C("l.l_shipdate") < C("r.l_shipdate")) & (C("l.l_suppkey") != C("r.l_suppkey")),
    )
    return rows.select("l.l_partkey", C("l.l_orderkey").alias("earlier"), C("r.l_orderkey").alias("later"), "l.l_quantity")


@query("cycle_match", f"""WITH {HAND_OVER}, e AS (SELECT * FROM hand_over WHERE src <> dst)
  SELECT a.qty, a.src || '>' || b.src || '>' || c.src AS nodes, count(*) AS cycles FROM e a
  JOIN e b ON a.dst = b.src AND a.qty = b.qty JOIN e c ON b.dst = c.src AND c.dst = a.src AND c.qty = a.qty GROUP BY ALL""")
def _(t):
    rows = match.cycle_match(hand_over(t).withColumnRenamed("eid", "edge_id"), "qty", 3)
    path = F.array_join(F.slice(C("nodes").cast("array<string>"), 1, 3), ">")
    return rows.groupBy("qty", path.alias("nodes")).agg(F.count("*").alias("cycles"))


@query("rematch_chain", """WITH essential AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity = 50 AND l_returnflag = 'R')
  SELECT p_brand, count(*) AS suppliers FROM (SELECT DISTINCT p_brand, l_suppkey FROM essential JOIN lineitem USING (l_partkey)
  JOIN part ON p_partkey = l_partkey WHERE l_discount > 0.05) GROUP BY 1""")
def _(t):
    essential = t.lineitem.filter((C("l_quantity") == 50) & (C("l_returnflag") == "R"))
    discounted = t.lineitem.filter("l_discount > 0.05").select("l_partkey", "l_suppkey")
    first = match.rematch_chain(essential, ["l_partkey"], discounted, ["l_partkey"])
    brands = t.part.select(C("p_partkey").alias("l_partkey"), "p_brand")
    second = match.rematch_chain(first, ["l_partkey", "l_suppkey"], brands, ["l_partkey"])
    return second.select("p_brand", "l_suppkey").distinct().groupBy("p_brand").agg(F.count("*").alias("suppliers"))


# Few starts and ends, chosen by their balance, on the whole hand-over graph.
ENDS = "ends AS (SELECT c_custkey AS id FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_acctbal > 9800)"
STARTS = "starts AS (SELECT c_custkey AS id FROM customer WHERE c_acctbal < 0)"
LOWEST = "lowest AS (SELECT c_custkey AS id FROM customer WHERE c_acctbal < -950)"
HOPS = f"""{HAND_OVER_IDS}, {ENDS}, {LOWEST},
  p1 AS (SELECT id AS start, dst AS tip, [id, dst] AS nodes, [eid] AS eids FROM lowest JOIN hand_over_ids ON src = id),
  p2 AS (SELECT start, dst AS tip, list_append(nodes, dst) AS nodes, list_append(eids, eid) AS eids FROM p1 JOIN hand_over_ids ON src = tip WHERE NOT list_contains(eids, eid)),
  p3 AS (SELECT start, dst AS tip, list_append(nodes, dst) AS nodes, list_append(eids, eid) AS eids FROM p2 JOIN hand_over_ids ON src = tip
    WHERE NOT list_contains(eids, eid) AND dst IN (SELECT id FROM ends)),
  walk AS (SELECT 1 AS hops, start, tip, nodes FROM p1 UNION ALL SELECT 2, start, tip, nodes FROM p2 UNION ALL SELECT 3, start, tip, nodes FROM p3)"""


def _path_ends(t):
    starts = t.customer.filter("c_acctbal < -950").select(C("c_custkey").alias("id"))
    ends = t.customer.filter((C("c_mktsegment") == "MACHINERY") & (C("c_acctbal") > 9800)).select(C("c_custkey").alias("id"))
    return starts, ends


@query("variable_length_paths", f"""WITH {HOPS} SELECT start, tip AS "end", CAST(hops AS BIGINT) AS hops, count(*) AS paths
  FROM walk WHERE tip IN (SELECT id FROM ends) GROUP BY ALL""")
def _(t):
    starts, ends = _path_ends(t)
    rows = match.variable_length_paths(hand_over(t).withColumnRenamed("eid", "edge_id"), starts, 3, ends)
    return rows.groupBy("start", "end", "hops").agg(F.count("*").alias("paths"))


@query("path_listing", f"""WITH {HOPS} SELECT start, tip AS "end", CAST(hops AS BIGINT) AS hops, array_to_string(nodes, '>') AS path
  FROM walk WHERE tip IN (SELECT id FROM ends)""")
def _(t):
    starts, ends = _path_ends(t)
    return match.path_listing(hand_over(t).withColumnRenamed("eid", "edge_id"), starts, 3, ends)


@query("reachable_set", f"""WITH RECURSIVE {HAND_OVER}, {STARTS}, r AS (SELECT id, 0 AS level FROM starts
  UNION SELECT dst, level + 1 FROM r JOIN hand_over ON src = id WHERE level < 12), first AS (SELECT id, CAST(min(level) AS BIGINT) AS level FROM r GROUP BY 1)
  SELECT * FROM first WHERE CASE WHEN (SELECT max(level) FROM first) < 12 THEN true ELSE error('not at its end') END""")
def _(t):
    return match.reachable_set(hand_over(t), t.customer.filter("c_acctbal < 0").select(C("c_custkey").alias("id")))


@query("merge_left_indicator", """SELECT merge_flag, count(*) AS n FROM (SELECT CASE WHEN d.doc_id IS NOT NULL AND l.doc_id IS NOT NULL THEN 'both'
  WHEN d.doc_id IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS merge_flag FROM (SELECT doc_id FROM documents WHERE lang = 'en') d FULL JOIN labels l USING (doc_id)) GROUP BY 1""")
def _(t):
    rows = match.merge_left_indicator(t.documents.filter("lang = 'en'").select("doc_id"), t.labels.select("doc_id"), ["doc_id"])
    return rows.groupBy("merge_flag").agg(F.count("*").alias("n"))


@query("isin_other_table", """SELECT n_name, n_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal < 500) AS has_poor FROM nation""")
def _(t):
    return match.isin_other_table(t.nation, "n_nationkey", t.supplier.filter("s_acctbal < 500"), "s_nationkey", "has_poor").select("n_name", "has_poor")


@query("inner_join_small", """SELECT r_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1""")
def _(t):
    places = t.nation.join(t.region, C("n_regionkey") == C("r_regionkey"))
    return t.customer.join(places, C("c_nationkey") == C("n_nationkey")).groupBy("r_name").agg(
        F.count("*").alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance")
    )


@query("join_feature_tables", """SELECT o_orderkey, c_acctbal, n_name, lines, quantity FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN (SELECT l_orderkey, count(*) AS lines, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def _(t):
    lines = t.lineitem.groupBy(C("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"))
    return (
        t.orders.select("o_orderkey", "o_custkey").join(t.customer, C("o_custkey") == C("c_custkey"))
        .join(t.nation, C("c_nationkey") == C("n_nationkey")).join(lines, "o_orderkey")
        .select("o_orderkey", "c_acctbal", "n_name", "lines", "quantity")
    )


@query("point_in_time_features", """SELECT p.event_id, p.user_id, f.value AS feature FROM (SELECT * FROM events WHERE event_type = 'purchase') p
  ASOF LEFT JOIN (SELECT user_id, ts, value FROM events WHERE event_type = 'view') f ON p.user_id = f.user_id AND p.ts >= f.ts""")
def _(t):
    buys = t.events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    views = t.events.filter("event_type = 'view'").select("user_id", C("ts").alias("seen"), C("value").alias("feature"))
    return match.point_in_time_features(buys, views, "user_id", "ts", "seen", ["feature"]).select("event_id", "user_id", "feature")


@query("fuzzy_name_join", """WITH n AS (SELECT p_name AS name, count(*) AS n FROM part GROUP BY 1), p AS (
  SELECT a.name AS l, b.name AS r, 1.0 - levenshtein(a.name, b.name) / greatest(length(a.name), length(b.name))::DOUBLE AS ratio, a.n AS ln, b.n AS rn
  FROM n a JOIN n b ON a.name < b.name)
  SELECT l AS "left", r AS "right", round(ratio, 6) AS ratio, ln AS left_rows, rn AS right_rows FROM p WHERE ratio > 0.55""")
def _(t):
    return match.fuzzy_name_join(t.part, "p_partkey", "p_name", 0.55).withColumn("ratio", F.round("ratio", 6))


@query("blocked_pair_scoring", """WITH r AS (SELECT concat_ws(':', CAST(l_partkey AS VARCHAR), CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_extendedprice AS VARCHAR)) AS id, * FROM lineitem),
  f AS (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1), total AS (SELECT count(*) AS big FROM lineitem),
  p AS (SELECT a.*, b.l_suppkey AS s2, b.l_returnflag AS f2, b.l_discount AS d2 FROM r a JOIN r b ON a.l_partkey = b.l_partkey AND a.l_quantity = b.l_quantity AND a.id < b.id)
  SELECT p.l_partkey % 100 AS bucket, count(*) AS pairs, round(sum(
    CASE WHEN l_suppkey = s2 THEN log2(0.9 / (n / big)) ELSE log2(0.1 / 0.99) END
    + CASE WHEN l_returnflag = f2 THEN log2(0.8 / 0.33) ELSE log2((1 - 0.8) / (1 - 0.33)) END
    + CASE WHEN l_discount = d2 THEN log2(0.7 / 0.1) ELSE log2((1 - 0.7) / (1 - 0.1)) END), 4) AS weight
  FROM p JOIN f USING (l_suppkey), total GROUP BY 1""")
def _(t):
    key = F.concat_ws(":", "l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice").alias("id")
    records = t.lineitem.select(key, "l_partkey", "l_quantity", "l_suppkey", "l_returnflag", "l_discount")
    pairs = match.blocked_pair_scoring(
        records, "id", ["l_partkey", "l_quantity"],
        [("l_suppkey", 0.9, 0.01), ("l_returnflag", 0.8, 0.33), ("l_discount", 0.7, 0.1)], ["l_suppkey"],
    )
    part = F.split("left", ":")[0].cast("bigint")
    return pairs.groupBy((part % 100).alias("bucket")).agg(
        F.count("*").alias("pairs"), F.round(F.sum("match_weight"), 4).alias("weight")
    )


@query("watchlist_match", """SELECT c_custkey FROM customer WHERE c_acctbal < 0 AND c_mktsegment || ' ' || c_nationkey IN (SELECT upper(e) || ' ' || k FROM (VALUES ('building', 3), ('machinery', 7), ('furniture', 11)) v(e, k))""")
def _(t):
    listed = t.nation.filter(C("n_nationkey").isin(3, 7, 11)).select(
        F.concat_ws(" ", F.element_at(F.create_map(
            F.lit(3), F.lit("BUILDING"), F.lit(7), F.lit("MACHINERY"), F.lit(11), F.lit("FURNITURE")), C("n_nationkey")),
            "n_nationkey").alias("name")
    )
    return match.watchlist_match(t.customer.filter("c_acctbal < 0"), "c_mktsegment", "c_nationkey", listed, "name").select("c_custkey")


# --- aggregations -----------------------------------------------------------------------------


@query("count_all_and_col", """SELECT count(*) AS num_rows, count(nullif(l_discount, 0)) AS discounted FROM lineitem""")
def _(t):
    return t.lineitem.agg(F.count("*").alias("num_rows"), F.count(F.nullif(C("l_discount"), F.lit(0.0))).alias("discounted"))


@query("graph_counts", """SELECT (SELECT count(*) FROM customer) + (SELECT count(*) FROM orders) + (SELECT count(*) FROM part) + (SELECT count(*) FROM supplier) + 30 AS num_nodes,
  (SELECT count(*) FROM orders) + 2 * (SELECT count(*) FROM lineitem) + (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier) + 25 AS num_edges""")
def _(t):
    return supply(t).counts()


@query("count_distinct", """SELECT count(DISTINCT l_partkey) AS parts, count(DISTINCT l_returnflag || l_linestatus) AS lists FROM lineitem""")
def _(t):
    return t.lineitem.agg(
        F.count_distinct("l_partkey").alias("parts"), F.count_distinct(F.array("l_returnflag", "l_linestatus")).alias("lists")
    )


@query("implicit_group_by", """SELECT c_mktsegment AS segment, n_name AS nation, count(*) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL""")
def _(t):
    return t.customer.join(t.nation, C("n_nationkey") == C("c_nationkey")).groupBy(
        C("c_mktsegment").alias("segment"), C("n_name").alias("nation")
    ).agg(F.count("*").alias("n"))


@query("sum_avg_min_max", """SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_price,
  round(avg(l_discount), 8) AS avg_disc, min(l_extendedprice) AS low, max(l_extendedprice) AS high FROM lineitem GROUP BY ALL""")
def _(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"), F.round(F.sum("l_extendedprice"), 2).alias("sum_price"),
        F.round(F.avg("l_discount"), 8).alias("avg_disc"), F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high"),
    )


@query("collect", """SELECT o_custkey, string_agg(strftime(o_orderdate, '%Y-%m-%d') || ':' || CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderdate, o_orderkey) AS orders FROM orders GROUP BY 1""")
def _(t):
    lists = collect_lists(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "l")
    text = F.transform("l", lambda s: F.concat_ws(":", F.date_format(s["o_orderdate"], "yyyy-MM-dd"), s["o_orderkey"]))
    return lists.select("o_custkey", F.array_join(text, ",").alias("orders"))


@query("collect_distinct", """SELECT p_brand, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS types, count(DISTINCT p_size) AS sizes FROM part GROUP BY 1""")
def _(t):
    return t.part.groupBy("p_brand").agg(
        F.array_join(F.sort_array(F.collect_set("p_type")), ",").alias("types"), F.count_distinct("p_size").alias("sizes")
    )


@query("string_agg", """SELECT conv_id, string_agg(role, ' ' ORDER BY turn, role) AS roles FROM conversations GROUP BY 1""")
def _(t):
    lists = collect_lists(t.conversations, ["conv_id"], ["turn", "role"], "l")
    return lists.select("conv_id", F.array_join(F.transform("l", lambda s: s["role"]), " ").alias("roles"))


@query("unwind", """SELECT word, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) GROUP BY 1""")
def _(t):
    return t.part.select(F.explode(F.split("p_name", " ")).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


@query("label_histogram", """SELECT 'Customer' AS label, count(*) AS n FROM customer UNION ALL SELECT 'Order', count(*) FROM orders UNION ALL SELECT 'Part', count(*) FROM part
  UNION ALL SELECT 'Supplier', count(*) FROM supplier UNION ALL SELECT 'Nation', 25 UNION ALL SELECT 'Region', 5 UNION ALL SELECT 'Debtor', count(*) FROM customer WHERE c_acctbal < 0""")
def _(t):
    g = supply(t)
    debtor = F.when(C("c_acctbal") < 0, F.array_append("labels", F.lit("Debtor"))).otherwise(C("labels"))
    return stats.label_histogram(g.nodes.withColumn("labels", debtor))


@query("type_histogram", """SELECT 'PLACED' AS type, count(*) AS n FROM orders UNION ALL SELECT 'CONTAINS', count(*) FROM lineitem UNION ALL SELECT 'SUPPLIED_BY', count(*) FROM lineitem
  UNION ALL SELECT 'IN_NATION', count(*) FROM customer UNION ALL SELECT 'SUPPLIER_IN', count(*) FROM supplier UNION ALL SELECT 'IN_REGION', count(*) FROM nation""")
def _(t):
    return supply(t).edges.groupBy("type").agg(F.count("*").alias("n"))


@query("type_key_histogram", """SELECT type, keys, count(*) AS n FROM (SELECT 'CONTAINS' AS type, CASE WHEN l_discount > 0 THEN 'discount,' ELSE '' END || 'quantity' AS keys FROM lineitem
  UNION ALL SELECT 'PLACED', '' FROM orders) GROUP BY ALL""")
def _(t):
    from trellis.model import stack

    e = stack([
        t.lineitem.select(F.lit("CONTAINS").alias("type"), F.when(C("l_discount") > 0, C("l_discount")).alias("discount"), C("l_quantity").alias("quantity")),
        t.orders.select(F.lit("PLACED").alias("type")),
    ])
    return stats.type_key_histogram(e, ["discount", "quantity"])


@query("graph_schema", """SELECT 'node' AS kind, l AS name, p AS property, n FROM (
  SELECT 'Nation' l, 'n_name' p, count(n_name) n FROM nation UNION ALL SELECT 'Region', 'r_name', count(r_name) FROM region
  UNION ALL SELECT 'Supplier', 's_name', count(s_name) FROM supplier UNION ALL SELECT 'Supplier', 's_acctbal', count(s_acctbal) FROM supplier)
  UNION ALL SELECT 'edge', 'CONTAINS', p, (SELECT count(*) FROM lineitem) FROM (VALUES ('l_quantity'), ('l_extendedprice'), ('l_returnflag')) v(p)""")
def _(t):
    g = supply(t).project(None, ["CONTAINS", "IN_REGION"])
    table = type(g)(g.nodes_with("Nation", "Region", "Supplier"), g.edges).schema_table()
    return table.drop("data_type")


@query("having", """SELECT l_suppkey, count(*) AS n, round(avg(l_quantity), 6) AS avg_qty FROM lineitem GROUP BY 1 HAVING count(*) > 500 AND avg(l_quantity) > 25.5""")
def _(t):
    g = t.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.avg("l_quantity").alias("a"))
    return g.filter((C("n") > 500) & (C("a") > 25.5)).select("l_suppkey", "n", F.round("a", 6).alias("avg_qty"))


@query("multi_stage_agg", """WITH a AS (SELECT o_custkey, count(*) AS total FROM orders GROUP BY 1), b AS (SELECT o_custkey, count(*) AS urgent FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
  SELECT o_custkey, total, urgent, round(urgent / total, 6) AS share FROM a JOIN b USING (o_custkey)""")
def _(t):
    a = t.orders.groupBy("o_custkey").agg(
        F.count("*").alias("total"), F.count(F.when(C("o_orderpriority") == "1-URGENT", 1)).alias("urgent")
    )
    return a.filter("urgent > 0").withColumn("share", F.round(C("urgent") / C("total"), 6))


@query("value_counts", "SELECT p_brand, count(*) AS count FROM part GROUP BY 1")
def _(t):
    return clean.value_counts(t.part, "p_brand")


@query("groupby_agg_dict", """SELECT c_mktsegment, count(c_custkey) AS n, round(sum(c_acctbal), 2) AS total, max(c_acctbal) AS top FROM customer GROUP BY 1""")
def _(t):
    return t.customer.groupBy("c_mktsegment").agg(
        F.count("c_custkey").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total"), F.max("c_acctbal").alias("top")
    )


@query("mode_value", "SELECT p_size FROM part GROUP BY 1 ORDER BY count(*) DESC, p_size LIMIT 1")
def _(t):
    return clean.mode_value(t.part, "p_size")


@query("custom_aggregation", """WITH g AS (SELECT avg(l_quantity) AS gm FROM lineitem) SELECT l_shipmode AS flag, round(count(*) * pow(sum(q) / count(*) - max(gm), 2), 6) AS spread
  FROM (SELECT l_returnflag AS l_shipmode, l_quantity AS q FROM lineitem), g GROUP BY 1""")
def _(t):
    lines = t.lineitem.select(C("l_returnflag").alias("flag"), C("l_quantity").alias("q"))
    grand = lines.agg((F.sum("q") / F.count("q")).alias("gm")).first()[0]
    return stats.chunk_combine_finalize(
        lines, ["flag"], {"n": F.count("q"), "s": F.sum("q")},
        {"spread": F.round(C("n") * F.pow(C("s") / C("n") - F.lit(grand), 2), 6)},
    )


@query("foldby_count", "SELECT CAST(l_linenumber AS BIGINT) AS score, count(*) AS n FROM lineitem GROUP BY 1")
def _(t):
    return stats.chunk_combine_finalize(
        t.lineitem.select(C("l_linenumber").cast("bigint").alias("score")), ["score"], {"c": F.count("*")}, {"n": C("c")}
    )


@query("frequencies_filter", """SELECT l_orderkey, l_linenumber, n AS frequency FROM lineitem JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 8) USING (l_orderkey)""")
def _(t):
    return clean.frequencies_filter(t.lineitem.select("l_orderkey", "l_linenumber"), "l_orderkey", 8)


@query("distributed_reduce", "SELECT round(sum(value), 2) AS total, max(value) AS maximum, min(value) AS minimum FROM events")
def _(t):
    return stats.distributed_reduce(t.events, "value").withColumn("total", F.round("total", 2))


@query("partition_profile")
def _(t):
    from trellis.sources.files import partition_profile

    return partition_profile(t.lineitem.select("l_orderkey"))
