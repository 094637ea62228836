"""Named queries: paths, communities, centrality, similarity and mutation."""

from __future__ import annotations

from pyspark.sql import functions as F

from trellis.functions.text import tokenize
from trellis.model import PropertyGraph
from trellis.operators import centrality, community, mutate, paths, similarity
from trellis.operators.match import Hop, Node, match_path
from trellis.plans.graphs import HAND_OVER, customers, hand_over, supply
from trellis.plans.registry import query
from trellis.sources.frames import edges_from_dataframe, nodes_from_dataframe

C = F.col


def busiest(edges):
    """The customer with the most outgoing hand-overs, smallest id on a tie."""
    return edges.groupBy("src").agg(F.count("*").alias("n")).orderBy(C("n").desc(), "src").first()[0]


def busiest_sql(edges: str = "hand_over") -> str:
    return f"start AS (SELECT src AS id FROM {edges} GROUP BY src ORDER BY count(*) DESC, src LIMIT 1)"


def unchanged(before: str, after: str) -> str:
    """An error should the last round of an unrolled iteration still change something."""
    return f"CASE WHEN (SELECT count(*) FROM (FROM {after} EXCEPT FROM {before})) = 0 THEN true ELSE error('not at its fixpoint') END"


def relax(rounds: int, weight: str, edges: str = "hand_over") -> str:
    """Bellman-Ford rounds as CTEs d0..dN over the edges."""
    steps = f"w AS MATERIALIZED (SELECT src, dst, min({weight}) AS w FROM {edges} GROUP BY ALL), d0 AS MATERIALIZED (SELECT id, CAST(0 AS BIGINT) AS d FROM start)"
    for i in range(rounds):
        steps += f""", d{i + 1} AS MATERIALIZED (SELECT id, min(d) AS d FROM (SELECT id, d FROM d{i}
  UNION ALL SELECT dst, d + w FROM d{i} JOIN w ON src = id) GROUP BY id)"""
    return steps


@query("project_graph", """SELECT 'nodes' AS what, (SELECT count(*) FROM customer) + 25 AS n UNION ALL SELECT 'IN_NATION', (SELECT count(*) FROM customer)""")
def _(t):
    g = supply(t).project(["Customer", "Nation"], ["IN_NATION", "IN_REGION", "PLACED"])
    return g.nodes.agg(F.lit("nodes").alias("what"), F.count("*").alias("n")).unionAll(
        g.edges.groupBy("type").agg(F.count("*"))
    )


# Enough rounds for all inputs here, which the last one proves.
ROUNDS = 24
AT_END = unchanged(f"d{ROUNDS - 1}", f"d{ROUNDS}")


@query("sssp_hops", f"WITH {HAND_OVER}, {busiest_sql()}, {relax(ROUNDS, '1')} SELECT c_custkey AS id, CAST(d AS BIGINT) AS distance FROM customer LEFT JOIN d{ROUNDS} ON id = c_custkey WHERE {AT_END}")
def _(t):
    return paths.sssp(customers(t), hand_over(t), busiest(hand_over(t)))


@query("sssp_weighted", f"WITH {HAND_OVER}, {busiest_sql()}, {relax(ROUNDS, 'qty')} SELECT c_custkey AS id, CAST(d AS BIGINT) AS distance FROM customer LEFT JOIN d{ROUNDS} ON id = c_custkey WHERE {AT_END}")
def _(t):
    return paths.sssp(customers(t), hand_over(t), busiest(hand_over(t)), "qty")


@query("sssp_null_weights", f"""WITH {HAND_OVER}, dear AS (SELECT * FROM hand_over WHERE price >= 30000), {busiest_sql()}, {relax(ROUNDS, 'qty', 'dear')}
  SELECT c_custkey AS id, CAST(d AS BIGINT) AS distance FROM customer LEFT JOIN d{ROUNDS} ON id = c_custkey WHERE {AT_END}""")
def _(t):
    partly = hand_over(t).withColumn("w", F.when(C("price") >= 30000, C("qty")))
    return paths.sssp(customers(t), partly, busiest(hand_over(t)), "w")


@query("shortest_path_tree", f"""WITH {HAND_OVER}, {busiest_sql()}, {relax(ROUNDS, 'qty')},
  p AS (SELECT w.dst AS id, min(w.src) AS predecessor FROM w JOIN d{ROUNDS} a ON a.id = w.src JOIN d{ROUNDS} b ON b.id = w.dst
        WHERE a.d + w.w = b.d AND w.dst <> (SELECT id FROM start) GROUP BY 1)
  SELECT c_custkey AS id, CAST(d AS BIGINT) AS distance, predecessor FROM customer LEFT JOIN d{ROUNDS} e ON e.id = c_custkey LEFT JOIN p ON p.id = c_custkey WHERE {AT_END}""")
def _(t):
    return paths.shortest_path_tree(customers(t), hand_over(t), busiest(hand_over(t)), "qty")


@query("bfs", f"WITH {HAND_OVER}, {busiest_sql()}, {relax(ROUNDS, '1')} SELECT c_custkey AS id, CAST(d AS BIGINT) AS level FROM customer LEFT JOIN d{ROUNDS} ON id = c_custkey WHERE {AT_END}")
def _(t):
    return paths.bfs(customers(t), hand_over(t), busiest(hand_over(t)))


# The target is the largest id at the greatest number of hops. Walks are pruned by the distance to go (n0..nN, over reversed edges) and a
# bound of ``SLACK`` above the cheapest cost, within which there must be five paths.
FAR = f"far AS (SELECT id FROM d{ROUNDS} WHERE d = (SELECT max(d) FROM d{ROUNDS}) ORDER BY id DESC LIMIT 1)"
SLACK = 12


def to_go(rounds: int) -> str:
    steps = "light AS MATERIALIZED (SELECT src, dst, min(qty) AS q FROM hand_over WHERE src <> dst GROUP BY ALL), n0 AS MATERIALIZED (SELECT id, CAST(0 AS BIGINT) AS n FROM far)"
    for i in range(rounds):
        steps += f""", n{i + 1} AS MATERIALIZED (SELECT id, min(n) AS n FROM (SELECT id, n FROM n{i}
  UNION ALL SELECT src, n + q FROM n{i} JOIN light ON dst = id) GROUP BY id)"""
    return steps


@query("ksssp", f"""WITH RECURSIVE {HAND_OVER}, {busiest_sql()}, {relax(ROUNDS, '1')}, {FAR}, {to_go(ROUNDS)},
  cheapest AS (SELECT n FROM n{ROUNDS} JOIN start USING (id)),
  walk AS (SELECT id AS tip, CAST(0 AS BIGINT) AS cost, [id] AS nodes FROM start
    UNION ALL SELECT dst, cost + q, list_append(nodes, dst) FROM walk JOIN light ON src = tip JOIN n{ROUNDS} g ON g.id = dst
    WHERE cost + q + g.n <= (SELECT n FROM cheapest) + {SLACK} AND NOT list_contains(nodes, dst) AND tip <> (SELECT id FROM far)),
  done AS (SELECT CAST(cost AS BIGINT) AS cost, CAST(len(nodes) - 1 AS BIGINT) AS hops, array_to_string(nodes, '>') AS path FROM walk WHERE tip = (SELECT id FROM far))
  SELECT row_number() OVER (ORDER BY cost, path) AS rank, * FROM done
  WHERE CASE WHEN (SELECT count(*) FROM done) >= 5 THEN true ELSE error('fewer than five paths within the bound') END ORDER BY cost, path LIMIT 5""")
def _(t):
    start = busiest(hand_over(t))
    levels = paths.bfs(customers(t), hand_over(t), start)
    far = levels.filter("level is not null").orderBy(C("level").desc(), C("id").desc()).first()[0]
    return paths.ksssp(hand_over(t), start, far, 5, "qty")


@query("random_walks")
def _(t):
    walks = paths.random_walks(hand_over(t), customers(t), 5, 2)
    return walks.select("root", "walk", F.array_join("path", ">").alias("path"))


@query("random_walks_biased")
def _(t):
    roots = hand_over(t).select(C("src").alias("id")).distinct()
    walks = paths.random_walks(hand_over(t), roots, 3, 1, backward_probability=0.5, forward_probability=2.0)
    return walks.select("root", "walk", F.array_join("path", ">").alias("path"))


# --- communities ------------------------------------------------------------------------------

def spread(rounds: int) -> str:
    """Smallest-label rounds as CTEs l0..lN over ``hand_over``; each round also jumps a pointer."""
    sql = "u AS MATERIALIZED (SELECT src AS a, dst AS b FROM hand_over UNION SELECT dst, src FROM hand_over), l0 AS MATERIALIZED (SELECT c_custkey AS id, c_custkey AS l FROM customer)"
    for i in range(rounds):
        sql += f""", m{i} AS MATERIALIZED (SELECT id, min(l) AS l FROM (SELECT id, l FROM l{i} UNION ALL SELECT b, l FROM l{i} JOIN u ON a = id) GROUP BY id),
  l{i + 1} AS MATERIALIZED (SELECT m{i}.id, least(m{i}.l, k.l) AS l FROM m{i} JOIN m{i} k ON k.id = m{i}.l)"""
    return sql


@query("connected_components", f"WITH {HAND_OVER}, {spread(20)} SELECT id, l AS component FROM l20 WHERE {unchanged('l19', 'l20')}")
def _(t):
    return community.connected_components(customers(t), hand_over(t))


def lpa(rounds: int) -> str:
    sql = "u AS MATERIALIZED (SELECT src AS a, dst AS b FROM hand_over UNION ALL SELECT dst, src FROM hand_over), l0 AS MATERIALIZED (SELECT c_custkey AS id, c_custkey AS l FROM customer)"
    for i in range(rounds):
        sql += f""", v{i} AS MATERIALIZED (SELECT b AS id, l, count(*) AS n FROM l{i} JOIN u ON a = id GROUP BY ALL),
  l{i + 1} AS MATERIALIZED (SELECT l{i}.id, coalesce(x.l, l{i}.l) AS l FROM l{i} LEFT JOIN (SELECT id, l FROM v{i} QUALIFY row_number() OVER (PARTITION BY id ORDER BY n DESC, l) = 1) x ON x.id = l{i}.id)"""
    return sql


@query("label_propagation", f"WITH {HAND_OVER}, {lpa(10)} SELECT id, l AS label FROM l10")
def _(t):
    return community.label_propagation(customers(t), hand_over(t), 10)


@query("louvain")
def _(t):
    return community.louvain(customers(t), hand_over(t), "qty", threshold=1e-3)


@query("modularity", f"""WITH {HAND_OVER}, a AS (SELECT src AS i, dst AS j, qty AS w FROM hand_over UNION ALL SELECT dst, src, qty FROM hand_over),
  x AS (SELECT ci.c_nationkey AS c, sum(w) AS tot, sum(CASE WHEN ci.c_nationkey = cj.c_nationkey THEN w ELSE 0 END) AS ins
        FROM a JOIN customer ci ON ci.c_custkey = i JOIN customer cj ON cj.c_custkey = j GROUP BY 1)
  SELECT round(sum(ins) / sum(tot) - sum(tot * tot) / (sum(tot) * sum(tot)), 8) AS modularity FROM x""")
def _(t):
    nations = t.customer.select(C("c_custkey").alias("id"), C("c_nationkey").alias("community"))
    return community.modularity(hand_over(t), nations, "qty").select(F.round("modularity", 8).alias("modularity"))


SIMPLE = f"{HAND_OVER}, u AS MATERIALIZED (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM hand_over WHERE src <> dst)"


@query("triangle_count", f"WITH {SIMPLE} SELECT count(*) AS triangles FROM u x JOIN u y ON x.b = y.a JOIN u z ON z.a = x.a AND z.b = y.b")
def _(t):
    return community.triangle_count(hand_over(t))


@query("local_clustering_coefficient", f"""WITH {SIMPLE}, tri AS MATERIALIZED (SELECT x.a AS p, x.b AS q, y.b AS r FROM u x JOIN u y ON x.b = y.a JOIN u z ON z.a = x.a AND z.b = y.b),
  per AS (SELECT id, count(*) AS t FROM (SELECT p AS id FROM tri UNION ALL SELECT q FROM tri UNION ALL SELECT r FROM tri) GROUP BY 1),
  deg AS (SELECT id, count(*) AS d FROM (SELECT a AS id FROM u UNION ALL SELECT b FROM u) GROUP BY 1)
  SELECT c_custkey AS id, coalesce(t, 0) AS triangles, coalesce(d, 0) AS degree, CASE WHEN d > 1 THEN round(2.0 * coalesce(t, 0) / (d * (d - 1)), 8) ELSE 0 END AS coefficient
  FROM customer LEFT JOIN deg ON deg.id = c_custkey LEFT JOIN per ON per.id = c_custkey""")
def _(t):
    rows = community.local_clustering_coefficient(customers(t), hand_over(t))
    return rows.withColumn("coefficient", F.round("coefficient", 8))


def peel(rounds: int, k: int) -> str:
    sql = "p0 AS MATERIALIZED (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM hand_over WHERE src <> dst)"
    for i in range(rounds):
        sql += f""", g{i} AS MATERIALIZED (SELECT id FROM (SELECT a AS id FROM p{i} UNION ALL SELECT b FROM p{i}) GROUP BY id HAVING count(*) >= {k}),
  p{i + 1} AS MATERIALIZED (SELECT a, b FROM p{i} WHERE a IN (SELECT id FROM g{i}) AND b IN (SELECT id FROM g{i}))"""
    return sql


@query("k_core", f"WITH {HAND_OVER}, {peel(30, 40)} SELECT c_custkey AS id, CAST(CASE WHEN c_custkey IN (SELECT a FROM p30 UNION SELECT b FROM p30) THEN 1 ELSE 0 END AS BIGINT) AS in_core FROM customer WHERE {unchanged('p30', 'p29')}")
def _(t):
    return community.k_core(customers(t), hand_over(t), 40)


def truss(rounds: int, k: int) -> str:
    sql = "p0 AS MATERIALIZED (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM hand_over WHERE src <> dst)"
    for i in range(rounds):
        sql += f""", t{i} AS MATERIALIZED (SELECT x.a AS p, x.b AS q, y.b AS r FROM p{i} x JOIN p{i} y ON x.b = y.a JOIN p{i} z ON z.a = x.a AND z.b = y.b),
  p{i + 1} AS MATERIALIZED (SELECT a, b FROM (SELECT p AS a, q AS b FROM t{i} UNION ALL SELECT q, r FROM t{i} UNION ALL SELECT p, r FROM t{i}) GROUP BY ALL HAVING count(*) >= {k - 2})"""
    return sql


# Twelve rounds, and an error should one more still change something.
@query("k_truss", f"""WITH {HAND_OVER}, {truss(13, 4)} SELECT a, b FROM p13
  WHERE CASE WHEN (SELECT count(*) FROM p12) = (SELECT count(*) FROM p13) THEN true ELSE error('not at its fixpoint') END""")
def _(t):
    return community.k_truss(hand_over(t), 4)


@query("cluster_summary", """SELECT c_nationkey AS cluster, count(*) AS size, round(avg(c_acctbal), 6) AS avg_score, round(sum(c_acctbal), 2) AS sum_score FROM customer GROUP BY 1 HAVING count(*) >= 2""")
def _(t):
    rows = community.cluster_summary(t.customer.withColumnRenamed("c_nationkey", "cluster"), "cluster", "c_acctbal")
    return rows.withColumns({"avg_score": F.round("avg_score", 6), "sum_score": F.round("sum_score", 2)})


# --- centrality and similarity ----------------------------------------------------------------


def ranks(rounds: int, alpha: float, edges: str) -> str:
    sql = f"o AS MATERIALIZED (SELECT src, count(*) AS o FROM {edges} GROUP BY 1), e AS MATERIALIZED (SELECT src, dst, count(*) AS n FROM {edges} GROUP BY ALL), r0 AS MATERIALIZED (SELECT c_custkey AS id, CAST(1 AS DOUBLE) AS r FROM customer)"
    for i in range(rounds):
        sql += f""", r{i + 1} AS MATERIALIZED (SELECT r{i}.id, {1 - alpha} + {alpha} * coalesce(g, 0) AS r FROM r{i} LEFT JOIN
  (SELECT dst, sum(n * r / o) AS g FROM e JOIN o USING (src) JOIN r{i} ON r{i}.id = e.src GROUP BY 1) ON dst = r{i}.id)"""
    return sql


@query("pagerank", f"WITH {HAND_OVER}, {ranks(6, 0.15, 'hand_over')} SELECT id, round(r, 6) AS rank FROM r6")
def _(t):
    r = centrality.pagerank(customers(t), hand_over(t), 6, tolerance=None)
    return r.withColumn("rank", F.round("rank", 6))


@query("pagerank_damping_85", f"WITH {HAND_OVER}, {ranks(9, 0.85, 'hand_over')} SELECT id, round(r, 6) AS rank FROM r9")
def _(t):
    r = centrality.pagerank(customers(t), hand_over(t), 9, alpha=0.85, tolerance=None)
    return r.withColumn("rank", F.round("rank", 6))


def brandes(levels: int, sources: int) -> str:
    """Forward levels f0..fN and backward sums b0..bN over ``hand_over``, as CTEs."""
    sql = f"""s AS (SELECT c_custkey AS s FROM customer ORDER BY md5(CAST(c_custkey AS VARCHAR)), c_custkey LIMIT {sources}),
  e AS MATERIALIZED (SELECT DISTINCT src AS v, dst AS w FROM hand_over WHERE src <> dst), f0 AS MATERIALIZED (SELECT s, s AS v, CAST(1 AS DOUBLE) AS p, 0 AS d FROM s), all0 AS MATERIALIZED (SELECT s, v FROM f0)"""
    for i in range(levels):
        sql += f""", f{i + 1} AS MATERIALIZED (SELECT s, w AS v, sum(p) AS p FROM f{i} JOIN e USING (v) WHERE (s, w) NOT IN (SELECT (s, v) FROM all{i}) GROUP BY ALL),
  all{i + 1} AS MATERIALIZED (SELECT * FROM all{i} UNION ALL SELECT s, v FROM f{i + 1})"""
    sql += f", b{levels} AS MATERIALIZED (SELECT s, v, p, CAST(0 AS DOUBLE) AS x FROM f{levels})"
    for i in range(levels - 1, -1, -1):
        sql += f""", b{i} AS MATERIALIZED (SELECT f{i}.s, f{i}.v, f{i}.p, coalesce(y, 0) AS x FROM f{i} LEFT JOIN
  (SELECT g.s, g.v, sum(g.p / b{i + 1}.p * (1 + x)) AS y FROM f{i} g JOIN e ON e.v = g.v JOIN b{i + 1} ON b{i + 1}.s = g.s AND b{i + 1}.v = e.w GROUP BY ALL) q ON q.s = f{i}.s AND q.v = f{i}.v)"""
    rest = " UNION ALL ".join(f"SELECT v, x FROM b{i}" for i in range(1, levels + 1))
    return sql + f", total AS (SELECT v, sum(x) AS x FROM ({rest}) GROUP BY 1)"


@query("betweenness_centrality", f"""WITH {HAND_OVER}, {brandes(12, 20)} SELECT c_custkey AS id, round(coalesce(x, 0), 6) AS betweenness
  FROM customer LEFT JOIN total ON v = c_custkey WHERE CASE WHEN (SELECT count(*) FROM f12) = 0 THEN true ELSE error('not at its last level') END""")
def _(t):
    rows = centrality.betweenness_centrality(customers(t), hand_over(t), 20)
    return rows.withColumn("betweenness", F.round("betweenness", 6))


@query("degree_centrality", f"""WITH {HAND_OVER} SELECT c_custkey AS id, coalesce(i, 0) AS in_degree, coalesce(o, 0) AS out_degree, coalesce(i, 0) + coalesce(o, 0) AS degree FROM customer
  LEFT JOIN (SELECT src, count(*) AS o FROM hand_over GROUP BY 1) ON src = c_custkey LEFT JOIN (SELECT dst, count(*) AS i FROM hand_over GROUP BY 1) ON dst = c_custkey""")
def _(t):
    return centrality.degree_centrality(customers(t), hand_over(t))


@query("neighbour_labels", f"""WITH {HAND_OVER}, p AS (SELECT DISTINCT a.c_mktsegment AS x, b.c_mktsegment AS y FROM hand_over JOIN customer a ON a.c_custkey = src JOIN customer b ON b.c_custkey = dst)
  SELECT x AS label, 'out' AS direction, y AS neighbour_label FROM p UNION ALL SELECT y, 'in', x FROM p""")
def _(t):
    nodes = t.customer.select(C("c_custkey").alias("id"), C("c_mktsegment").alias("label"))
    return centrality.neighbour_labels(nodes, hand_over(t))


@query("jaccard_similarity", f"""WITH {HAND_OVER}, {busiest_sql()}, m AS (SELECT DISTINCT src, dst FROM hand_over), own AS (SELECT dst FROM m WHERE src = (SELECT id FROM start))
  SELECT src AS id, count(*) FILTER (dst IN (SELECT dst FROM own)) AS shared,
  round(count(*) FILTER (dst IN (SELECT dst FROM own)) / (count(*) + (SELECT count(*) FROM own) - count(*) FILTER (dst IN (SELECT dst FROM own)))::DOUBLE, 8) AS similarity
  FROM m WHERE src <> (SELECT id FROM start) GROUP BY 1""")
def _(t):
    rows = similarity.jaccard_similarity(hand_over(t), busiest(hand_over(t)))
    return rows.withColumn("similarity", F.round("similarity", 8))


@query("jaccard_summary", """WITH m AS (SELECT DISTINCT o_custkey AS c, l_partkey AS p FROM lineitem JOIN orders ON l_orderkey = o_orderkey), own AS (SELECT p FROM m WHERE c = 1),
  s AS (SELECT c, count(*) FILTER (p IN (SELECT p FROM own)) / (count(*) + (SELECT count(*) FROM own) - count(*) FILTER (p IN (SELECT p FROM own)))::DOUBLE AS x FROM m WHERE c <> 1 GROUP BY 1)
  SELECT round(max(x), 8) AS max_similarity, round(min(x), 8) AS min_similarity, round(avg(x), 8) AS avg_similarity FROM s""")
def _(t):
    bought = t.lineitem.join(t.orders, C("l_orderkey") == C("o_orderkey")).select("o_custkey", "l_partkey")
    summary = similarity.similarity_summary(similarity.jaccard_similarity(bought, 1, "o_custkey", "l_partkey"))
    return summary.select(*[F.round(c, 8).alias(c) for c in summary.columns])


WORDS = r"list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'))"


@query("tanimoto_topk", f"""WITH q AS (SELECT {WORDS} AS q FROM benchmark WHERE item_id = 0), d AS (SELECT doc_id, {WORDS} AS w FROM documents)
  SELECT doc_id, round(len(list_intersect(w, q)) / (len(w) + len(q) - len(list_intersect(w, q)))::DOUBLE, 8) AS similarity FROM d, q ORDER BY similarity DESC, doc_id LIMIT 20""")
def _(t):
    wanted = t.benchmark.filter("item_id = 0").select(F.array_distinct(tokenize("text"))).first()[0]
    docs = t.documents.select("doc_id", F.array_distinct(tokenize("text")).alias("words"))
    rows = similarity.tanimoto_topk(docs, "doc_id", "words", wanted, 20)
    return rows.withColumn("similarity", F.round("similarity", 8))


@query("lsh_similarity_search", f"""WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents), q AS (SELECT item_id, {WORDS} AS q FROM benchmark),
  s AS (SELECT item_id, doc_id, len(list_intersect(w, q)) AS i, len(w) + len(q) AS t FROM d, q)
  SELECT item_id, doc_id, round(i / (t - i)::DOUBLE, 8) AS similarity FROM s WHERE i / (t - i)::DOUBLE >= 0.3""")
def _(t):
    docs = t.documents.select("doc_id", tokenize("text").alias("words"))
    asked = t.benchmark.select("item_id", tokenize("text").alias("words"))
    rows = similarity.lsh_similarity_search(docs, "doc_id", asked, "item_id", "words", 0.3)
    return rows.withColumn("similarity", F.round("similarity", 8))


CENTROID = "x AS (SELECT label, generate_subscripts(embedding, 1) AS p, unnest(embedding)::DOUBLE AS v FROM embeddings), m AS (SELECT label, p, avg(v) AS a FROM x GROUP BY ALL), c AS (SELECT label AS q, list(a ORDER BY p) AS cv FROM m GROUP BY 1)"


@query("embedding_topk", f"""WITH {CENTROID} SELECT q AS label, vec_id, round(s, 6) AS score, rank FROM (SELECT q, vec_id, s, row_number() OVER (PARTITION BY q ORDER BY s DESC, vec_id) AS rank FROM
  (SELECT q, vec_id, list_cosine_similarity(embedding::DOUBLE[], cv) AS s FROM embeddings, c)) WHERE rank <= 5""")
def _(t):
    from trellis.operators.models import class_centroids

    centres = class_centroids(t.embeddings, "label", "embedding").withColumnRenamed("centroid", "embedding")
    rows = similarity.embedding_topk(t.embeddings, centres, 5, "vec_id", "label", "embedding")
    return rows.withColumn("score", F.round("score", 6))


# --- mutation ---------------------------------------------------------------------------------


@query("create_nodes", "SELECT label, count(*) AS n FROM (SELECT 'Nation' AS label FROM nation UNION ALL SELECT 'Segment' FROM (SELECT DISTINCT c_mktsegment FROM customer)) GROUP BY 1")
def _(t):
    g = supply(t).project(["Nation"])
    rows = nodes_from_dataframe(t.customer.select("c_mktsegment").distinct(), "c_mktsegment", "segment", "Segment", property_columns=[])
    return mutate.create_nodes(g, rows).nodes.groupBy(C("labels")[0].alias("label")).agg(F.count("*").alias("n"))


@query("create_edges_from_match", """SELECT 'IN_NATION' AS type, count(*) AS n FROM customer UNION ALL
  SELECT 'LIVES_NEAR', count(*) FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_regionkey = 1 AND c_acctbal > 5000""")
def _(t):
    g = supply(t).project(None, ["IN_NATION", "IN_REGION"])
    found = match_path(
        g, Node("c", ("Customer",), C("c_acctbal") > 5000), Hop("i", Node("n"), ("IN_NATION",)),
        Hop("r", Node("z", ("Region",), C("id") == "1"), ("IN_REGION",)),
    )
    rows = edges_from_dataframe(found, "c_id", "z_id", "customer", "region", "LIVES_NEAR", key_columns=["c_id"])
    new = mutate.create_edges_from_match(PropertyGraph(g.nodes, g.edges_of("IN_NATION")), rows)
    return new.edges.groupBy("type").agg(F.count("*").alias("n"))


@query("create_reverse_edges", f"""WITH {HAND_OVER} SELECT src, dst, count(*) AS n, count(q) AS with_qty FROM (SELECT src, dst, qty AS q FROM hand_over UNION ALL SELECT dst, src, NULL FROM hand_over) GROUP BY ALL""")
def _(t):
    e = edges_from_dataframe(hand_over(t), "src", "dst", "c", "c", "HANDS", ["qty"], ["eid"])
    both = mutate.create_reverse_edges(e)
    return both.groupBy(C("src").cast("bigint").alias("src"), C("dst").cast("bigint").alias("dst")).agg(
        F.count("*").alias("n"), F.count("qty").alias("with_qty")
    )


@query("change_edge_type", "SELECT 'LOCATED_IN' AS type, count(*) AS n FROM customer UNION ALL SELECT 'IN_REGION', count(*) FROM nation")
def _(t):
    e = supply(t).edges_of("IN_NATION", "IN_REGION")
    return mutate.change_edge_type(e, "IN_NATION", "LOCATED_IN").groupBy("type").agg(F.count("*").alias("n"))


@query("set_property", "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'true' END AS suspicious FROM customer")
def _(t):
    rows = mutate.set_property(t.customer, "suspicious", F.lit("true"), C("c_acctbal") < 0)
    return rows.select("c_custkey", "suspicious")


@query("set_from_aggregate", """SELECT CAST(o_orderkey AS VARCHAR) AS id, round(sum(p_retailprice), 2) AS total FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1""")
def _(t):
    g = supply(t)
    rows = mutate.set_from_aggregate(g.nodes_with("Order"), g.edges_of("CONTAINS"), g.nodes_with("Part"), "p_retailprice", "total")
    return rows.select("id", F.round("total", 2).alias("total"))


@query("remove_property", """SELECT 'Customer' AS label, 0 AS n, true AS found, false AS absent FROM (SELECT 1) UNION ALL SELECT 'Supplier', count(s_acctbal), true, false FROM supplier""")
def _(t):
    nodes = supply(t).project(["Customer", "Supplier"]).nodes.withColumn("balance", F.coalesce("c_acctbal", "s_acctbal"))
    cut, found = mutate.remove_property(nodes, "balance", "Customer")
    _, absent = mutate.remove_property(nodes, "no_such_property")
    return cut.groupBy(C("labels")[0].alias("label")).agg(F.count("balance").alias("n")).withColumns(
        {"found": F.lit(found), "absent": F.lit(absent)}
    )


@query("detach_delete", """SELECT (SELECT count(*) FROM customer WHERE c_acctbal >= 0) AS customers, (SELECT count(*) FROM customer WHERE c_acctbal >= 0) AS in_nation,
  (SELECT count(*) FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_acctbal >= 0) AS placed""")
def _(t):
    g = supply(t).project(None, ["IN_NATION", "PLACED"])
    left = mutate.detach_delete(g, g.nodes_with("Customer").filter("c_acctbal < 0"))
    e = left.edges.agg(
        F.count(F.when(C("type") == "IN_NATION", 1)).alias("in_nation"), F.count(F.when(C("type") == "PLACED", 1)).alias("placed")
    )
    n = left.nodes_with("Customer").agg(F.count("*").alias("customers"))
    return n.withColumn("k", F.lit(1)).join(e.withColumn("k", F.lit(1)), "k").drop("k")


@query("delete_isolated_nodes", """SELECT count(*) AS kept FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)""")
def _(t):
    from trellis.operators.match import anti_pattern

    g = supply(t)
    dear = t.orders.filter("o_totalprice > 300000")
    edges = edges_from_dataframe(dear, "o_custkey", "o_orderkey", "customer", "order", "PLACED", key_columns=["o_orderkey"])
    some = PropertyGraph(g.nodes_with("Customer"), edges)
    return mutate.delete_nodes(some, anti_pattern(some.nodes, some.edges)).nodes.agg(F.count("*").alias("kept"))


@query("delete_edges", "SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_quantity >= 10 GROUP BY 1")
def _(t):
    g = supply(t).project(None, ["CONTAINS"])
    small = g.edges.filter("l_quantity < 10")
    return mutate.delete_edges(g, small).edges.groupBy("l_returnflag").agg(F.count("*").alias("n"))


@query("delete_with_count", "SELECT count(*) FILTER (p_size < 10) AS deleted, count(*) FILTER (p_size >= 10) AS kept FROM part")
def _(t):
    g = supply(t).project(["Part"])
    left, gone = mutate.delete_with_count(PropertyGraph(g.nodes, g.edges), g.nodes.filter("p_size < 10"))
    return left.nodes.agg(F.lit(gone).cast("bigint").alias("deleted"), F.count("*").alias("kept"))


@query("merge_nodes", """SELECT source, count(*) AS n FROM (SELECT DISTINCT s_nationkey AS k, 'old' AS source FROM supplier UNION ALL
  SELECT DISTINCT c_nationkey, 'new' FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier)) GROUP BY 1""")
def _(t):
    old = nodes_from_dataframe(t.supplier.select("s_nationkey").distinct(), "s_nationkey", "nation", "Nation", property_columns=[])
    new = nodes_from_dataframe(t.customer, "c_nationkey", "nation", "Nation", property_columns=[])
    rows = mutate.merge_nodes(old.withColumn("source", F.lit("old")), new, {"source": F.lit("new")})
    return rows.groupBy("source").agg(F.count("*").alias("n"))


@query("merge_edges", f"""WITH {HAND_OVER} SELECT src, dst, count(*) AS n FROM (SELECT src, dst FROM hand_over WHERE qty >= 45
  UNION ALL (SELECT src, dst FROM hand_over EXCEPT SELECT src, dst FROM hand_over WHERE qty >= 45)) GROUP BY ALL""")
def _(t):
    e = edges_from_dataframe(hand_over(t), "src", "dst", "c", "c", "HANDS", ["qty"], ["eid"])
    merged = mutate.merge_edges(e.filter("qty >= 45"), e)
    return merged.groupBy(C("src").cast("bigint").alias("src"), C("dst").cast("bigint").alias("dst")).agg(F.count("*").alias("n"))


@query("foreach_create", "SELECT 'Word' AS what, count(DISTINCT w) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part) UNION ALL SELECT 'NAMED', count(*) FROM (SELECT unnest(string_split(p_name, ' ')) FROM part)")
def _(t):
    empty = supply(t).project(["Part"], ["NAMED"])
    lists = t.part.select(C("p_partkey").cast("string").alias("k"), F.split("p_name", " ").alias("words"))
    g = mutate.foreach_create(
        empty, lists, "words",
        {"id_space": F.lit("word"), "id": C("element"), "labels": F.array(F.lit("Word"))},
        {"src_space": F.lit("part"), "src": C("k"), "dst_space": F.lit("word"), "dst": C("element"),
         "type": F.lit("NAMED"), "edge_id": F.concat_ws(":", "k", "element")},
    )
    words = g.nodes_with("Word").agg(F.lit("Word").alias("what"), F.count("*").alias("n"))
    return words.unionAll(g.edges_of("NAMED").agg(F.lit("NAMED"), F.count("*")))


@query("flag_and_alert", """SELECT (SELECT count(*) FROM orders WHERE o_totalprice > 490000) AS alerts,
  (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_totalprice > 490000) AS suspicious""")
def _(t):
    g = supply(t).project(["Customer", "Order"], ["PLACED"])
    dear = g.nodes_with("Order").filter("o_totalprice > 490000").select("id_space", "id")
    buyers = g.edges.join(dear.select(C("id_space").alias("dst_space"), C("id").alias("dst")), ["dst_space", "dst"]).select(
        C("src_space").alias("id_space"), C("src").alias("id")
    )
    new = mutate.flag_and_alert(g, dear, buyers, "High value")
    return new.nodes.agg(
        F.count(F.when(F.array_contains("labels", "ALERT"), 1)).alias("alerts"),
        F.count(F.when(C("SUSPICIOUS") == "true", 1)).alias("suspicious"),
    )


def _orders(t, condition: str):
    return t.orders.filter(condition).select(C("o_orderkey").alias("id"), C("o_orderstatus").alias("status"), C("o_totalprice").alias("price"))


@query("graph_insert", "SELECT status, count(*) AS n, round(sum(price), 2) AS total FROM (SELECT CASE WHEN o_totalprice < 300000 THEN o_orderstatus ELSE 'NEW' END AS status, o_totalprice AS price FROM orders) GROUP BY 1")
def _(t):
    new = _orders(t, "o_totalprice >= 200000").withColumn("status", F.lit("NEW"))
    rows = mutate.graph_insert(_orders(t, "o_totalprice < 300000"), new, ["id"])
    return rows.groupBy("status").agg(F.count("*").alias("n"), F.round(F.sum("price"), 2).alias("total"))


@query("graph_update", "SELECT CASE WHEN o_totalprice >= 200000 THEN 'NEW' ELSE o_orderstatus END AS status, count(*) AS n, count(CASE WHEN o_totalprice >= 200000 THEN 1 END) AS noted FROM orders WHERE o_totalprice < 300000 GROUP BY 1")
def _(t):
    new = _orders(t, "o_totalprice >= 200000").select("id", F.lit("NEW").alias("status"), F.lit("seen").alias("note"))
    rows = mutate.graph_update(_orders(t, "o_totalprice < 300000"), new, ["id"])
    return rows.groupBy("status").agg(F.count("*").alias("n"), F.count("note").alias("noted"))


@query("graph_upsert", "SELECT CASE WHEN o_totalprice >= 200000 THEN 'NEW' ELSE o_orderstatus END AS status, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def _(t):
    new = _orders(t, "o_totalprice >= 200000").withColumn("status", F.lit("NEW"))
    rows = mutate.graph_upsert(_orders(t, "o_totalprice < 300000"), new, ["id"])
    return rows.groupBy("status").agg(F.count("*").alias("n"), F.round(F.sum("price"), 2).alias("total"))


@query("graph_delete", """SELECT (SELECT count(*) FROM part WHERE p_size <> 7) AS nodes, (SELECT count(*) FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size <> 7) AS edges""")
def _(t):
    g = supply(t)
    g = PropertyGraph(g.nodes_with("Part"), g.edges_of("CONTAINS"))
    left = mutate.graph_delete(g, g.nodes.filter("p_size = 7")).counts()
    return left.select(C("num_nodes").alias("nodes"), C("num_edges").alias("edges"))
