"""Named queries: features, models, evaluation, user functions and streams."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from trellis.functions import udf as D
from trellis.model import stack
from trellis.operators import evaluation as V
from trellis.operators import features as E
from trellis.functions.scalar import hash_bucket
from trellis.operators import models as M
from trellis.operators import vocabulary as W
from trellis.plans.catalog_tables import BUCKET, TOKENS
from trellis.plans.graphs import HAND_OVER, customers, hand_over
from trellis.plans.registry import query
from trellis.session import Scratch
from trellis.sources.frames import edges_from_dataframe, nodes_from_dataframe
from trellis.sources.store import GraphStore
from trellis.streaming import streams as S

C = F.col


def vectors(t):
    """Embeddings as ML vectors with a label; the label is 0/1 for even and odd classes."""
    rows = M.as_vectors(t.embeddings, "embedding")
    return rows.withColumn("binary", (C("label") % 2).cast("double"))


# --- features ---------------------------------------------------------------------------------


@query("assemble_features", "SELECT p_partkey, CAST(p_size AS VARCHAR) || '|' || CAST(CAST(p_retailprice AS BIGINT) AS VARCHAR) AS features FROM (SELECT p_partkey, p_size, trunc(p_retailprice) AS p_retailprice FROM part)")
def _(t):
    rows = E.assemble_features(t.part.withColumn("price", F.floor("p_retailprice")), ["p_size", "price"])
    return rows.select("p_partkey", F.array_join(F.transform("features", lambda x: x.cast("bigint").cast("string")), "|").alias("features"))


@query("standard_scale", "SELECT c_custkey, round((c_acctbal - m) / s, 6) AS c_acctbal_z FROM customer, (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS s FROM customer)")
def _(t):
    rows = E.standard_scale(t.customer, ["c_acctbal"])
    return rows.select("c_custkey", F.round("c_acctbal_z", 6).alias("c_acctbal_z"))


@query("minmax_scale", "SELECT p_partkey, round(-1 + (p_retailprice - lo) / (hi - lo) * 2, 6) AS scaled FROM part, (SELECT min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part)")
def _(t):
    rows = E.minmax_scale(t.part, ["p_retailprice"], -1.0, 1.0)
    return rows.select("p_partkey", F.round("p_retailprice_scaled", 6).alias("scaled"))


@query("one_hot", "SELECT event_id, " + ", ".join(f"CAST(event_type = '{e}' AS INTEGER) AS event_type_{e}" for e in ("click", "error", "purchase", "signup", "view")) + " FROM events")
def _(t):
    return E.one_hot(t.events.select("event_id", "event_type"), "event_type").drop("event_type")


@query("pad_vector", "SELECT vec_id, 70 AS size, round(list_sum(embedding::DOUBLE[]), 5) AS total FROM embeddings")
def _(t):
    padded = E.pad_vector(C("embedding").cast("array<double>"), 70)
    return t.embeddings.select("vec_id", padded.alias("p")).select(
        "vec_id", F.size("p").alias("size"), F.round(F.aggregate("p", F.lit(0.0), lambda a, x: a + x), 5).alias("total")
    )


@query("encode_by_descriptor", """WITH w AS (SELECT unnest(regexp_extract_all(lower(p_name), '[\\p{L}\\p{N}_]+')) AS token, p_partkey FROM part),
  d AS (SELECT token, row_number() OVER (ORDER BY token) - 1 AS i FROM (SELECT DISTINCT token FROM w)),
  c AS (SELECT p_type, row_number() OVER (ORDER BY p_type) - 1 AS i FROM (SELECT DISTINCT p_type FROM part)),
  k AS (SELECT (SELECT count(*) FROM c) AS cats, (SELECT count(*) FROM d) AS words),
  t AS (SELECT p_partkey, count(DISTINCT token) AS n, sum(2 + cats + i) AS at, count(*) AS words FROM w JOIN d USING (token), k GROUP BY 1),
  z AS (SELECT p_partkey, p_type, (p_size - avg(p_size) OVER ()) / stddev(p_size) OVER () + (p_retailprice - avg(p_retailprice) OVER ()) / stddev(p_retailprice) OVER () AS s FROM part)
  SELECT z.p_partkey, CAST(2 + cats + k.words AS BIGINT) AS width, CAST(3 + n AS BIGINT) AS n_set, CAST(1 + 2 + c.i + t.at AS BIGINT) AS places,
    round(s + 1 + t.words, 6) AS total FROM z JOIN c USING (p_type) JOIN t USING (p_partkey), k""")
def _(t):
    rows, width = W.encode_by_descriptor(
        t.part, "p_partkey", [("p_size", "number"), ("p_retailprice", "number"), ("p_type", "category"), ("p_name", "text")]
    )
    places = F.aggregate(F.zip_with("indices", "values", lambda i, v: F.when(i < 2, i).otherwise(i * v.cast("bigint"))), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return rows.select(
        "p_partkey", F.lit(width).cast("bigint").alias("width"), F.size("indices").cast("bigint").alias("n_set"), places.alias("places"),
        F.round(F.aggregate("values", F.lit(0.0), lambda a, x: a + x), 6).alias("total"),
    )


SPLIT = f"CASE WHEN {BUCKET.format(seed=0, key='vec_id', n=1000)} < 700 THEN 'train' WHEN {BUCKET.format(seed=0, key='vec_id', n=1000)} < 800 THEN 'val' ELSE 'test' END"


@query("hash_split", f"WITH s AS (SELECT {SPLIT} AS split FROM embeddings) SELECT split, count(*) AS num_rows, round(count(*) / (SELECT count(*) FROM s)::DOUBLE, 6) AS share FROM s GROUP BY 1")
def _(t):
    rows = E.hash_split(t.embeddings.select("vec_id"), "vec_id", {"train": 0.7, "val": 0.1, "test": 0.2})
    return E.split_shares(rows).withColumn("share", F.round("share", 6))


@query("supervised_pairs", f"WITH {HAND_OVER} SELECT src AS source, dst AS target, CAST(price > 30000 AS INTEGER) AS label FROM hand_over")
def _(t):
    return E.supervised_pairs(hand_over(t), "price", 30000)


@query("neighbour_feature_aggregate", f"""WITH {HAND_OVER}, one AS (SELECT dst AS id, round(avg(c_acctbal) + 1e-9, 6) AS bal_mean1, max(c_acctbal) AS bal_max1, min(c_acctbal) AS bal_min1, round(stddev_pop(c_acctbal) + 1e-9, 6) AS bal_std1, avg(c_acctbal) AS raw
    FROM hand_over JOIN customer ON c_custkey = src GROUP BY 1), two AS (SELECT dst AS id, round(avg(raw) + 1e-9, 6) AS bal_mean2 FROM hand_over JOIN one ON one.id = src GROUP BY 1)
  SELECT c_custkey AS id, bal_mean1, bal_max1, bal_min1, bal_std1, bal_mean2 FROM customer LEFT JOIN one ON one.id = c_custkey LEFT JOIN two ON two.id = c_custkey""")
def _(t):
    nodes = t.customer.select(C("c_custkey").alias("id"), C("c_acctbal").alias("bal"))
    rows = E.neighbour_feature_aggregate(nodes, hand_over(t), ["bal"], "in", 2)
    # means of cents often end in a 5: a tiny shift keeps both engines on the same side
    rounded = {c: F.round(C(c) + 1e-9, 6) for c in ("bal_mean1", "bal_std1", "bal_mean2")}
    return rows.withColumns(rounded).select("id", "bal_mean1", "bal_max1", "bal_min1", "bal_std1", "bal_mean2")


def _sampled(hop: int, fan: int, before: str) -> str:
    return f"SELECT seed_id, {hop} AS hop, src, dst FROM (SELECT b.seed_id, e.src, e.dst, row_number() OVER (PARTITION BY b.seed_id, e.src ORDER BY md5(concat_ws(':', '0', CAST(b.seed_id AS VARCHAR), CAST(e.src AS VARCHAR), CAST(e.dst AS VARCHAR))), e.dst) AS rn FROM ({before}) b JOIN e ON e.src = b.src) WHERE rn <= {fan}"


@query("sample_neighbourhood", f"""WITH {HAND_OVER}, e AS MATERIALIZED (SELECT DISTINCT src, dst FROM hand_over),
  h1 AS MATERIALIZED ({_sampled(1, 3, "SELECT c_custkey AS seed_id, c_custkey AS src FROM customer WHERE c_acctbal < 0")}),
  h2 AS MATERIALIZED ({_sampled(2, 2, "SELECT DISTINCT seed_id, dst AS src FROM h1")})
  SELECT CAST(hop AS BIGINT) AS hop, seed_id, src, dst FROM (SELECT * FROM h1 UNION ALL SELECT * FROM h2)""")
def _(t):
    seeds = t.customer.filter("c_acctbal < 0").select(C("c_custkey").alias("id"))
    return E.sample_neighbourhood(hand_over(t), seeds, [3, 2])


@query("graph_feature_columns")
def _(t):
    return E.graph_feature_columns(customers(t), hand_over(t), 5, 3)


@query("baseline_vs_enhanced")
def _(t):
    ranks = E.graph_feature_columns(customers(t), hand_over(t), 5, 3)
    rows = t.customer.withColumn("label", (C("c_acctbal") > 5000).cast("int")).join(ranks, C("id") == C("c_custkey"))
    return M.baseline_vs_enhanced(rows, "c_custkey", "label", ["c_nationkey"], ["pagerank", "betweenness"])


# --- models -----------------------------------------------------------------------------------


@query("nearest_centroid", """WITH x AS (SELECT label, generate_subscripts(embedding, 1) AS p, unnest(embedding)::DOUBLE AS v FROM embeddings), m AS (SELECT label, p, avg(v) AS a FROM x GROUP BY ALL), c AS (SELECT label AS q, list(a ORDER BY p) AS cv FROM m GROUP BY 1)
  SELECT vec_id, label, q AS prediction FROM (SELECT vec_id, label, q, row_number() OVER (PARTITION BY vec_id ORDER BY list_distance(embedding::DOUBLE[], cv), q) AS rn FROM embeddings, c) WHERE rn = 1""")
def _(t):
    return M.nearest_centroid(t.embeddings, t.embeddings, "label", "embedding").select("vec_id", "label", "prediction")


def _knn(k: int) -> str:
    return f"""WITH n AS (SELECT a.vec_id, b.label, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), b.vec_id) AS rn FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
  v AS (SELECT vec_id, label, count(*) AS n FROM n WHERE rn <= {k} GROUP BY ALL)
  SELECT vec_id, label AS prediction FROM v QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY n DESC, label) = 1"""


@query("knn_classify_3", _knn(3))
def _(t):
    return M.knn_classify(t.embeddings, t.embeddings, "vec_id", "label", "embedding", 3, leave_one_out=True)


@query("knn_classify_7", _knn(7))
def _(t):
    return M.knn_classify(t.embeddings, t.embeddings, "vec_id", "label", "embedding", 7, leave_one_out=True)


def _scored(t, make, label: str = "label"):
    """Fit on the training rows, accuracy on the others."""
    rows = E.hash_split(vectors(t).withColumn("label", C(label).cast("double")), "vec_id", {"train": 0.7, "test": 0.3})
    model = make().fit(rows.filter("split = 'train'"))
    return model.transform(rows.filter("split = 'test'")).agg(
        F.count("*").alias("num_test"), F.avg((C("label") == C("prediction")).cast("double")).alias("accuracy")
    )


@query("naive_bayes_gaussian")
def _(t):
    return _scored(t, lambda: M.naive_bayes("gaussian"))


def _bayes_sql(kind: str) -> str:
    """Naive Bayes over all tokens with two folds: counts by fold left out, token and class; scores; accuracies."""
    if kind == "multinomial":
        # A token unknown to the training folds is not in g and counts for nothing.
        score = """SELECT x.fold, x.doc_id, x.y, k.c, ln((k.docs + 1) / (k.total + 2)) + coalesce(sum(n * (ln(g.t + 1) - ln(k.terms + k.v))), 0) AS s
          FROM x JOIN k ON k.fold = x.fold LEFT JOIN tok ON tok.doc_id = x.doc_id LEFT JOIN g ON g.fold = x.fold AND g.token = tok.token AND g.c = k.c
          GROUP BY x.fold, x.doc_id, x.y, k.c, k.docs, k.total"""
    else:
        score = """SELECT x.fold, x.doc_id, x.y, k.c, ln((k.docs + 1) / (k.total + 2)) + k.absent + coalesce(sum(ln(g.d + 1) - ln(k.docs - g.d + 1)), 0) AS s
          FROM x JOIN k ON k.fold = x.fold LEFT JOIN tok ON tok.doc_id = x.doc_id LEFT JOIN g ON g.fold = x.fold AND g.token = tok.token AND g.c = k.c
          GROUP BY x.fold, x.doc_id, x.y, k.c, k.docs, k.total, k.absent"""
    return f"""WITH x AS MATERIALIZED (SELECT doc_id, text, quality AS y, {BUCKET.format(seed=0, key="doc_id", n=2)} AS fold FROM documents JOIN labels USING (doc_id)),
  tok AS MATERIALIZED (SELECT doc_id, y, fold, token, count(*) AS n FROM (SELECT doc_id, y, fold, unnest({TOKENS}) AS token FROM x) GROUP BY ALL),
  f AS (SELECT DISTINCT fold FROM x),
  words AS (SELECT f.fold, token, sum(n) FILTER (y = 0) AS t0, sum(n) FILTER (y = 1) AS t1, count(*) FILTER (y = 0) AS d0, count(*) FILTER (y = 1) AS d1
    FROM f JOIN tok ON tok.fold <> f.fold GROUP BY ALL),
  g AS MATERIALIZED (SELECT fold, token, 0 AS c, coalesce(t0, 0) AS t, d0 AS d FROM words UNION ALL SELECT fold, token, 1, coalesce(t1, 0), d1 FROM words),
  sizes AS (SELECT f.fold, y AS c, count(*) AS docs FROM f JOIN x ON x.fold <> f.fold GROUP BY ALL),
  k AS MATERIALIZED (SELECT s.fold, s.c, s.docs, sum(s.docs) OVER (PARTITION BY s.fold) AS total, q.terms, q.v, q.absent FROM sizes s JOIN
    (SELECT g.fold, g.c, sum(t) AS terms, count(*) AS v, sum(ln((z.docs - d + 1) / (z.docs + 2))) AS absent FROM g JOIN sizes z ON z.fold = g.fold AND z.c = g.c GROUP BY ALL) q
    ON q.fold = s.fold AND q.c = s.c),
  score AS ({score}),
  best AS (SELECT fold, doc_id, y, c FROM score QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, c) = 1)
  SELECT CAST(fold AS BIGINT) AS fold, count(*) AS num_test, avg((y = c)::INT) AS accuracy FROM best GROUP BY 1"""


def _bayes(t, kind: str):
    rows = t.documents.join(t.labels, "doc_id").select("doc_id", "text", C("quality").alias("label"))
    return W.naive_bayes_folds(rows, "doc_id", "text", "label", hash_bucket("doc_id", 0, 2), 2, kind)


@query("naive_bayes_multinomial", _bayes_sql("multinomial"))
def _(t):
    return _bayes(t, "multinomial")


@query("naive_bayes_bernoulli", _bayes_sql("bernoulli"))
def _(t):
    return _bayes(t, "bernoulli")


@query("decision_tree")
def _(t):
    return _scored(t, M.decision_tree)


@query("random_forest")
def _(t):
    return stack([_scored(t, lambda n=n: M.random_forest(n)).withColumn("trees", F.lit(n)) for n in (5, 20)])


@query("linear_svm")
def _(t):
    return stack([_scored(t, lambda c=c: M.linear_svm(c, max_iterations=10), "binary").withColumn("c", F.lit(c)) for c in (0.1, 10.0)])


@query("logistic_regression")
def _(t):
    return stack([
        _scored(t, lambda p=p: M.logistic_regression(p, max_iterations=10), "binary").withColumn("penalty", F.lit(p)) for p in ("l1", "l2")
    ])


@query("mlp_classifier")
def _(t):
    return _scored(t, lambda: M.mlp_classifier([64, 16, 10], max_iterations=20))


@query("pca_reduce")
def _(t):
    return M.pca_reduce(t.embeddings, "embedding", 2).select("vec_id", C("components")[0].alias("x"), C("components")[1].alias("y"))


@query("kfold_eval")
def _(t):
    folds = M.kfold_eval(vectors(t), "vec_id", lambda: M.decision_tree(3), 3)
    return M.kfold_summary(folds)


@query("grid_search")
def _(t):
    lr = M.logistic_regression(max_iterations=5).setLabelCol("binary")
    return M.grid_search(vectors(t), "vec_id", lr, {lr.regParam: [0.0, 0.1]}, 2, "binary")


DICTIONARY = f"""tok AS MATERIALIZED (SELECT doc_id, token, count(*) AS n FROM (SELECT doc_id, unnest({TOKENS}) AS token FROM documents) GROUP BY ALL),
  d AS MATERIALIZED (SELECT token, count(*) AS documents, row_number() OVER (ORDER BY token) - 1 AS i FROM tok GROUP BY 1)"""


@query("bag_of_words_features", f"""WITH {DICTIONARY}, b AS (SELECT doc_id, sum(n) AS words, count(*) AS n, sum(i) AS places FROM tok JOIN d USING (token) GROUP BY 1)
  SELECT doc_id, CAST(coalesce(words, 0) AS DOUBLE) AS words, coalesce(n, 0) AS different_words, CAST(coalesce(places, 0) AS BIGINT) AS places FROM documents LEFT JOIN b USING (doc_id)""")
def _(t):
    rows, _words = W.bag_of_words(t.documents.select("doc_id", "text"), "doc_id", "text")
    return rows.select(
        "doc_id", F.aggregate("values", F.lit(0.0), lambda a, x: a + x).alias("words"), F.size("indices").cast("bigint").alias("different_words"),
        F.aggregate("indices", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("places"),
    )


@query("tfidf_features", f"""WITH {DICTIONARY}, b AS (SELECT doc_id, max(n * ln(((SELECT count(*) FROM documents) + 1) / (documents + 1))) AS top, sum(n * ln(((SELECT count(*) FROM documents) + 1) / (documents + 1))) AS total
  FROM tok JOIN d USING (token) GROUP BY 1)
  SELECT doc_id, round(top, 6) AS top_weight, round(coalesce(total, 0), 4) AS total_weight FROM documents LEFT JOIN b USING (doc_id)""")
def _(t):
    rows, _words = W.tfidf(t.documents.select("doc_id", "text"), "doc_id", "text")
    return rows.select(
        "doc_id", F.round(F.array_max("values"), 6).alias("top_weight"),
        F.round(F.aggregate("values", F.lit(0.0), lambda a, x: a + x), 4).alias("total_weight"),
    )


@query("text_classifier", f"""WITH {DICTIONARY}, x AS (SELECT doc_id, coalesce((lang = 'en')::INT, -1) AS y FROM documents),
  w AS MATERIALIZED (SELECT doc_id, token, n * ln(((SELECT count(*) FROM documents) + 1) / (documents + 1)) AS n FROM tok JOIN d USING (token)),
  words AS (SELECT token, coalesce(sum(n) FILTER (y = 0), 0) AS t0, coalesce(sum(n) FILTER (y = 1), 0) AS t1 FROM w JOIN x USING (doc_id) GROUP BY 1),
  g AS MATERIALIZED (SELECT token, 0 AS c, t0 AS t FROM words UNION ALL SELECT token, 1, t1 FROM words),
  k AS (SELECT c, docs, total, terms, v FROM (SELECT y AS c, count(*) AS docs, (SELECT count(*) FROM x) AS total FROM x GROUP BY 1) JOIN (SELECT c, sum(t) AS terms, count(*) AS v FROM g GROUP BY 1) USING (c)),
  score AS (SELECT x.doc_id, x.y, k.c, ln((k.docs + 1) / (k.total + 2)) + coalesce(sum(n * (ln(g.t + 1) - ln(k.terms + k.v))), 0) AS s
    FROM x CROSS JOIN k LEFT JOIN w ON w.doc_id = x.doc_id LEFT JOIN g ON g.token = w.token AND g.c = k.c GROUP BY x.doc_id, x.y, k.c, k.docs, k.total),
  best AS (SELECT doc_id, y, c FROM score QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, c) = 1)
  SELECT CAST(y AS BIGINT) AS label, CAST(c AS BIGINT) AS prediction, count(*) AS n FROM best GROUP BY 1, 2""")
def _(t):
    rows = t.documents.select("doc_id", "text", F.coalesce((C("lang") == "en").cast("bigint"), F.lit(-1)).cast("bigint").alias("label"))
    return W.text_classifier(rows, "doc_id", "text", "label").groupBy("label", "prediction").agg(F.count("*").alias("n"))


# --- evaluation -------------------------------------------------------------------------------

# a score per labelled document: its length against the longest; prediction is score above 0.05
SCORED = "scored AS (SELECT doc_id, quality AS y, toxic, least(n_chars / 4000.0::DOUBLE, 1) AS s, CASE WHEN n_chars > 400 THEN 1 ELSE 0 END AS p FROM documents JOIN labels USING (doc_id))"


def scored(t):
    rows = t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id")
    return rows.select(
        "doc_id", C("quality").alias("y"), "toxic", F.least(C("n_chars") / 4000.0, F.lit(1.0)).alias("s"), (C("n_chars") > 400).cast("int").alias("p")
    )


TALLY = "count(*) FILTER (y = 1 AND p = 1) AS tp, count(*) FILTER (y = 0 AND p = 0) AS tn, count(*) FILTER (y = 0 AND p = 1) AS fp, count(*) FILTER (y = 1 AND p = 0) AS fn"


@query("binary_tally", f"WITH {SCORED} SELECT toxic, {TALLY} FROM scored GROUP BY 1")
def _(t):
    return V.binary_tally(scored(t), "y", "p", ["toxic"])


@query("classification_metrics", f"""WITH {SCORED}, t AS (SELECT {TALLY} FROM scored), f AS (SELECT *, tp::DOUBLE AS a, tn::DOUBLE AS b, fp::DOUBLE AS c, fn::DOUBLE AS d, (tp + tn + fp + fn)::DOUBLE AS n FROM t)
  SELECT tp, tn, fp, fn, round((a + b) / n, 6) AS accuracy, round(a / (a + d), 6) AS tpr, round(b / (b + c), 6) AS tnr, round(a / (a + c), 6) AS ppv, round(b / (b + d), 6) AS npv,
  round(c / (b + c), 6) AS fpr, round(d / (a + d), 6) AS fnr, round(2 * a / (2 * a + c + d), 6) AS f1, round((a * b - c * d) / sqrt((a + c) * (a + d) * (b + c) * (b + d)), 6) AS mcc,
  round(((a + b) / n - ((a + c) * (a + d) + (b + d) * (b + c)) / (n * n)) / (1 - ((a + c) * (a + d) + (b + d) * (b + c)) / (n * n)), 6) AS kappa,
  round(a / (a + d) + b / (b + c) - 1, 6) AS informedness, round(a / (a + c) + b / (b + d) - 1, 6) AS markedness FROM f""")
def _(t):
    m = V.classification_metrics(V.binary_tally(scored(t), "y", "p"))
    return m.select(*[c if c in ("tp", "tn", "fp", "fn") else F.round(c, 6).alias(c) for c in m.columns])


@query("confusion_matrix", f"WITH {SCORED} SELECT y, count(*) FILTER (p = 0) AS predicted_0, count(*) FILTER (p = 1) AS predicted_1 FROM scored GROUP BY 1")
def _(t):
    return V.confusion_matrix(scored(t), "y", "p", [0, 1])


@query("weighted_accuracy", f"WITH {SCORED} SELECT round(avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END), 8) AS weighted_accuracy FROM scored")
def _(t):
    return V.weighted_accuracy(scored(t), "y", "p").select(F.round("weighted_accuracy", 8).alias("weighted_accuracy"))


@query("roc_points", f"""WITH {SCORED} SELECT threshold, round(count(*) FILTER (y = 0 AND s >= threshold) / (count(*) FILTER (y = 0))::DOUBLE, 6) AS fpr,
  round(count(*) FILTER (y = 1 AND s >= threshold) / (count(*) FILTER (y = 1))::DOUBLE, 6) AS tpr FROM scored, (SELECT unnest([0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1])::DOUBLE AS threshold) GROUP BY 1""")
def _(t):
    rows = V.roc_points(scored(t), "y", "s")
    return rows.withColumns({"fpr": F.round("fpr", 6), "tpr": F.round("tpr", 6)})


@query("auc", f"WITH {SCORED}, r AS (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r FROM scored) SELECT round((sum(r) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2.0) / (count(*) FILTER (y = 1) * count(*) FILTER (y = 0)), 8) AS auc FROM r")
def _(t):
    return V.auc(scored(t), "y", "s").select(F.round("auc", 8).alias("auc"))


@query("ensemble_vote", f"WITH {SCORED} SELECT doc_id, CASE WHEN (s + p) / 2 > 1 - (s + p) / 2 THEN 1 ELSE 0 END AS prediction FROM scored")
def _(t):
    a = scored(t).select("doc_id", F.array(1 - C("s"), C("s")).alias("pr"))
    b = scored(t).select("doc_id", F.array(1.0 - C("p"), C("p").cast("double")).alias("pr"))
    return V.ensemble_vote([a, b], "doc_id", "pr").select("doc_id", "prediction")


# --- user functions ---------------------------------------------------------------------------


@query("register_scalar_udf", "SELECT c_custkey, CASE WHEN c_mktsegment = upper(c_mktsegment) THEN lower(c_mktsegment) ELSE upper(c_mktsegment) END AS flipped FROM customer")
def _(t):
    D.register_scalar_udf(t.spark, "flip_case", lambda s: s.lower() if s.isupper() else s.upper(), "string")
    return t.customer.select("c_custkey", F.call_function("flip_case", C("c_mktsegment")).alias("flipped"))


@query("register_vector_udf", "SELECT s_suppkey, round(s_acctbal * 2, 2) AS doubled FROM supplier")
def _(t):
    def double(values: pd.Series) -> pd.Series:
        return values * 2

    D.register_vector_udf(t.spark, "double_it", double, "double")
    return t.supplier.select("s_suppkey", F.round(F.call_function("double_it", C("s_acctbal")), 2).alias("doubled"))


@query("graph_map", "SELECT p_partkey AS id, upper(p_brand) AS brand FROM part")
def _(t):
    return D.graph_map(
        t.part.select(C("p_partkey").alias("id"), C("p_brand").alias("brand")),
        lambda batch: batch.assign(brand=batch["brand"].str.upper()), "id bigint, brand string",
    )


@query("map_partitions_column", "SELECT o_orderkey, o_orderstatus || '/' || o_orderpriority AS both FROM orders")
def _(t):
    rows = D.map_partitions_column(
        t.orders, "both", "string", lambda b: b["o_orderstatus"] + "/" + b["o_orderpriority"], ["o_orderstatus", "o_orderpriority"]
    )
    return rows.select("o_orderkey", "both")


@query("derive_property", "SELECT l_linenumber, CAST(sum(CAST(trunc(l_quantity * 1.60934) AS BIGINT)) AS BIGINT) AS km, count(CASE WHEN l_returnflag <> 'N' THEN l_tax END) AS kept FROM lineitem GROUP BY 1")
def _(t):
    rows = t.lineitem.withColumns({"km": (C("l_quantity") * 1.60934).cast("bigint"), "tax": F.when(C("l_returnflag") != "N", C("l_tax"))})
    return rows.groupBy("l_linenumber").agg(F.sum("km").alias("km"), F.count("tax").alias("kept"))


@query("property_upsert_and_add", "SELECT s_suppkey, round(s_acctbal + 1, 2) AS s_acctbal, 'x' AS note FROM supplier")
def _(t):
    from trellis.operators.mutate import add_property, property_upsert

    rows = property_upsert(t.supplier, "s_acctbal", F.round(C("s_acctbal") + 1, 2))
    return add_property(rows, "note", F.lit("x")).select("s_suppkey", "s_acctbal", "note")


@query("property_set_filter", "SELECT p_partkey, p_brand IN ('Brand#1', 'Brand#2') AS flagged FROM part")
def _(t):
    return t.part.select("p_partkey", C("p_brand").isin("Brand#1", "Brand#2").alias("flagged"))


@query("collect_by_key_map", "SELECT n_name AS name, string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS segments FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY 1")
def _(t):
    rows = t.customer.join(t.nation, C("c_nationkey") == C("n_nationkey"))
    return rows.groupBy(C("n_name").alias("name")).agg(F.array_join(F.sort_array(F.collect_set("c_mktsegment")), ",").alias("segments"))


@query("iterate_edges_of_type", "SELECT o_custkey AS id, count(*) AS edges, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def _(t):
    from trellis.operators.match import Hop, Node, match_path
    from trellis.plans.graphs import supply

    rows = match_path(supply(t), Node("c"), Hop("r", Node("o", ("Order",), None, ("o_totalprice",)), ("PLACED",)))
    return rows.groupBy(C("c_id").cast("bigint").alias("id")).agg(F.count("*").alias("edges"), F.round(F.sum("o_o_totalprice"), 2).alias("total"))


@query("apply_per_group", "SELECT o_orderstatus, o_month, max(n) AS n, count(*) OVER (PARTITION BY o_orderstatus) AS months FROM (SELECT o_orderstatus, strftime(o_orderdate, '%Y%m') AS o_month, count(*) AS n FROM orders GROUP BY ALL) GROUP BY o_orderstatus, o_month")
def _(t):
    def months(group: pd.DataFrame) -> pd.DataFrame:
        return group.assign(months=len(group))

    per = t.orders.groupBy("o_orderstatus", F.date_format("o_orderdate", "yyyyMM").alias("o_month")).agg(F.count("*").alias("n"))
    return D.apply_per_group(per, ["o_orderstatus"], months, "o_orderstatus string, o_month string, n bigint, months bigint")


# --- streams ----------------------------------------------------------------------------------


def _events_stream(t):
    rows = S.read_stream(t.spark, t.folder, t.events.schema, pathGlobFilter="events.parquet")
    return rows.withColumn("ts", C("ts").cast("timestamp"))


@query("stream_windowed_counts", "SELECT strftime(time_bucket(INTERVAL 6 hours, ts), '%Y-%m-%d %H:%M') AS window_start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL")
def _(t):
    counted = S.stream_windowed_counts(_events_stream(t), "ts", ["event_type"], "6 hours", value="value")
    rows = S.complete_result(counted, "windowed_counts", Scratch(t.spark).root)
    return rows.select(F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), "event_type", "n", F.round("total", 2).alias("total"))


@query("stream_repeat_transfers", """SELECT strftime(time_bucket(INTERVAL 1 day, ts), '%Y-%m-%d') AS window_start, user_id, event_type, count(*) AS n, round(avg(value), 6) AS average FROM events
  WHERE value < 80 GROUP BY ALL HAVING avg(value) > 10 AND count(*) > 2""")
def _(t):
    found = S.stream_repeat_transfers(_events_stream(t), "ts", "user_id", "event_type", "value", "1 day", 80, 10, 2)
    rows = S.complete_result(found, "repeat_transfers", Scratch(t.spark).root)
    return rows.select(F.date_format("window_start", "yyyy-MM-dd").alias("window_start"), "user_id", "event_type", "n", F.round("average", 6).alias("average"))


@query("stream_dedupe", "SELECT DISTINCT user_id, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events")
def _(t):
    keyed = _events_stream(t).select(
        "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"), "ts"
    )
    root = Scratch(t.spark).root
    rows = S.run_to_table(S.stream_dedupe(keyed, ["user_id", "event_type", "day"], "ts", "40 days"), root + "/out", root + "/log")
    return rows.select("user_id", "event_type", "day")


@query("stream_alerts", "SELECT o_orderkey, o_custkey, 'ALERT' AS label FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_acctbal < 0")
def _(t):
    orders = S.read_stream(t.spark, t.folder, t.orders.schema, pathGlobFilter="orders.parquet")
    flagged = t.customer.filter("c_acctbal < 0").select(C("c_custkey").alias("id"))
    root = Scratch(t.spark).root
    rows = S.run_to_table(S.stream_alerts(orders, flagged, "o_custkey", "suspicious sender"), root + "/out", root + "/log")
    return rows.select("o_orderkey", "o_custkey", "label")


@query("stream_graph_ingest", """SELECT (SELECT count(DISTINCT user_id) FROM events WHERE event_type <> 'error') + 5 - 1 AS num_nodes,
  (SELECT count(*) FROM events WHERE event_type <> 'error') AS num_edges""")
def _(t):
    root = Scratch(t.spark).root
    batch = t.events.withColumn("operation", F.when(C("event_type") == "error", "delete").otherwise("upsert"))
    batch.select("event_id", "user_id", "event_type", "value", "operation").write.parquet(root + "/in")
    stream = S.read_stream(t.spark, root + "/in", t.spark.read.parquet(root + "/in").schema)

    def nodes(df):
        kinds = df.select("event_type").distinct()
        users = df.filter("operation = 'upsert'").select("user_id").distinct()
        return nodes_from_dataframe(users, "user_id", "user", "User", property_columns=[]).unionByName(
            nodes_from_dataframe(kinds, "event_type", "type", "Type", property_columns=[])
        )

    def edges(df):
        return edges_from_dataframe(df, "user_id", "event_type", "user", "type", "DID", ["value"], ["event_id"])

    store = GraphStore(t.spark, root + "/graphs", "db", "activity")
    S.stream_graph_ingest(stream, store, root + "/log", nodes, edges).awaitTermination()
    return store.load().counts()
