"""Text and category features over whole vocabularies.

A vocabulary is a table, not an array in the driver: every different token with its number, its documents and its occurrences. Numbers
are given in the order of the tokens' code points over range partitions. Features are rows of (key, token, n) joined to that table; a
sparse vector is one row's numbers and values. Token counts are long-tailed, so a join by token splits in two: the few tokens that
each make up more than one ``HOT``-th of all rows (fewer than ``HOT`` of them, whatever the corpus) are broadcast, all
others are joined by a shuffle in which none of them is hot.

Naive Bayes needs no vectors at all: counts by token and class give the weights in closed form, and a score is a sum over a
document's token rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trellis.functions.text import tokenize
from trellis.operators.ordering import global_row_number
from trellis.session import Scratch, spread

HOT = 10_000
MOST_CLASSES = 1000


def token_rows(df: DataFrame, key: str, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """``<key>, <keep…>, token, n``: how often each token stands in each text."""
    rows = spread(df.select(key, *keep, text)).select(key, *keep, F.explode(tokenize(text)).alias("token"))
    return rows.groupBy(key, *keep, "token").agg(F.count("*").alias("n"))


def dictionary(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``token, token_id, documents, n`` for every token of ``rows`` (``token, n``); ids from 0 in the order of code points."""
    words = rows.groupBy("token").agg(F.count("*").alias("documents"), F.sum("n").alias("n"))
    numbered = global_row_number(words, ["token"], "_rn")
    return scratch.put(numbered.select("token", (F.col("_rn") - 1).alias("token_id"), "documents", "n"), "dictionary")


def lookup(rows: DataFrame, words: DataFrame, hot: DataFrame) -> DataFrame:
    """``rows`` with the columns of their token in ``words``; rows of other tokens go. ``hot``: the tokens of ``words`` that may
    stand in a large share of the rows, as ``frequent`` finds them."""
    hot = F.broadcast(hot.select("token"))
    common = F.broadcast(words.join(hot, "token", "left_semi"))
    return rows.join(common, "token").unionByName(rows.join(hot, "token", "left_anti").join(words, "token"))


def frequent(words: DataFrame, count: str = "documents") -> DataFrame:
    """Tokens that each make up more than one ``HOT``-th of all counts: fewer than ``HOT`` of them."""
    (total,) = words.agg(F.coalesce(F.sum(count), F.lit(0))).first()
    return words.filter(F.col(count) * HOT > total).select("token")


def sparse_vectors(rows: DataFrame, key: str, value: Column) -> DataFrame:
    """``<key>, indices, values`` from rows with a ``token_id``: ascending indices and their values."""
    pairs = rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("token_id", value.cast("double").alias("v")))).alias("_p"))
    return pairs.select(key, F.transform("_p", lambda p: p["token_id"]).alias("indices"), F.transform("_p", lambda p: p["v"]).alias("values"))


def with_empty(vectors: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """One row per row of ``df``: texts without tokens have an empty vector."""
    none = {"indices": F.expr("cast(array() as array<bigint>)"), "values": F.expr("cast(array() as array<double>)")}
    return df.select(key).join(vectors, key, "left").withColumns({c: F.coalesce(c, empty) for c, empty in none.items()})


def bag_of_words(df: DataFrame, key: str, text: str, scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame]:
    """``<key>, indices, values`` with the counts of all tokens, and the dictionary. ``key`` tells rows apart."""
    scratch = scratch or Scratch(df.sparkSession)
    rows = scratch.put(token_rows(df, key, text), "token_rows")
    words = dictionary(rows, scratch)
    found = lookup(rows, words.select("token", "token_id"), frequent(words))
    return with_empty(sparse_vectors(found, key, F.col("n")), df, key), words


def tfidf(df: DataFrame, key: str, text: str, scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame]:
    """``<key>, indices, values`` with count times ``ln((N + 1) / (documents + 1))``, and the dictionary."""
    scratch = scratch or Scratch(df.sparkSession)
    rows = scratch.put(token_rows(df, key, text), "token_rows")
    words = dictionary(rows, scratch)
    idf = F.log((F.lit(df.count()) + 1.0) / (F.col("documents") + 1.0))
    found = lookup(rows, words.select("token", "token_id", idf.alias("idf")), frequent(words))
    return with_empty(sparse_vectors(found, key, F.col("n") * F.col("idf")), df, key), words


def encode_by_descriptor(df: DataFrame, key: str, spec: Sequence[tuple[str, str]], scratch: Scratch | None = None) -> tuple[DataFrame, int]:
    """``<key>, indices, values`` from (column, kind) with kinds ``number``, ``category`` and ``text``, and the width of the vectors.

    Numbers are standardised and come first, in the order of the descriptor; then every category column and every text column with
    a place for each of its values or tokens, however many. Missing numbers are left out, missing categories are none."""
    scratch = scratch or Scratch(df.sparkSession)
    numbers = [c for c, kind in spec if kind == "number"]
    parts, width = [], len(numbers)
    if numbers:
        moments = df.agg(*[f(F.col(c).cast("double")).alias(f"{name}_{i}") for i, c in enumerate(numbers) for name, f in (("m", F.avg), ("s", F.stddev))]).first()
        scaled = []
        for i, c in enumerate(numbers):
            mean, deviation = moments[f"m_{i}"] or 0.0, moments[f"s_{i}"] or 0.0
            value = (F.col(c).cast("double") - mean) / deviation if deviation else F.col(c).cast("double") * 0.0
            scaled.append(F.struct(F.lit(i).cast("bigint").alias("token_id"), value.alias("n")))
        parts.append(df.select(key, F.inline(F.array(*scaled))).filter("n IS NOT NULL"))
    for c, kind in spec:
        if kind == "number":
            continue
        if kind == "text":
            rows = token_rows(df, key, c)
        else:
            rows = df.filter(F.col(c).isNotNull()).select(key, F.col(c).cast("string").alias("token"), F.lit(1).cast("bigint").alias("n"))
        rows = scratch.put(rows, f"rows_{c}")
        words = dictionary(rows, scratch)
        found = lookup(rows, words.select("token", "token_id"), frequent(words))
        parts.append(found.select(key, (F.col("token_id") + width).alias("token_id"), F.col("n").cast("double").alias("n")))
        width += words.count()
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return with_empty(sparse_vectors(whole, key, F.col("n")), df, key), width


@dataclass
class NaiveBayesTable:
    """Per token one weight for each class (``token, documents, weights``), and a constant and a cost per known unit for each class."""

    classes: list
    weights: DataFrame
    constant: list[float]
    per_unit: list[float]
    binary: bool


def fit_naive_bayes(rows: DataFrame, docs: DataFrame, label: str, kind: str = "multinomial", smoothing: float = 1.0, scratch: Scratch | None = None) -> NaiveBayesTable:
    """From token rows (``<label>, token, n``; ``n`` may be a weight) and documents (``<label>``), in closed form over all tokens."""
    scratch = scratch or Scratch(rows.sparkSession)
    sizes = {r[label]: r["count"] for r in docs.groupBy(label).count().limit(MOST_CLASSES + 1).collect()}
    if len(sizes) > MOST_CLASSES:
        raise ValueError(f"{label} has more than {MOST_CLASSES} classes")
    classes = sorted(sizes)
    total = sum(sizes.values())
    prior = [math.log(sizes[c] + smoothing) - math.log(total + smoothing * len(classes)) for c in classes]
    unit = F.lit(1) if kind == "bernoulli" else F.col("n")
    counts = [F.coalesce(F.sum(F.when(F.col(label) == c, unit)), F.lit(0)).cast("double") for c in classes]
    table = scratch.put(rows.groupBy("token").agg(F.count("*").alias("documents"), F.array(*counts).alias("t")), "by_class")
    if kind == "multinomial":
        sums = table.agg(F.count("*").alias("v"), *[F.coalesce(F.sum(F.col("t")[i]), F.lit(0.0)).alias(f"s{i}") for i in range(len(classes))]).first()
        weights = F.transform("t", lambda x: F.log(x + smoothing))
        per_unit = [-math.log(sums[f"s{i}"] + smoothing * sums["v"]) if sums["v"] else 0.0 for i in range(len(classes))]
        constant = prior
    elif kind == "bernoulli":
        absent = [F.log((sizes[c] - F.col("t")[i] + smoothing) / (sizes[c] + 2 * smoothing)) for i, c in enumerate(classes)]
        sums = table.agg(*[F.coalesce(F.sum(a), F.lit(0.0)).alias(f"s{i}") for i, a in enumerate(absent)]).first()
        weights = F.array(*[F.log(F.col("t")[i] + smoothing) - F.log(sizes[c] - F.col("t")[i] + smoothing) for i, c in enumerate(classes)])
        per_unit = [0.0] * len(classes)
        constant = [p + sums[f"s{i}"] for i, p in enumerate(prior)]
    else:
        raise ValueError(f"{kind} is neither multinomial nor bernoulli")
    return NaiveBayesTable(classes, scratch.put(table.select("token", "documents", weights.alias("weights")), "weights"), constant, per_unit, kind == "bernoulli")


def predict_naive_bayes(model: NaiveBayesTable, rows: DataFrame, docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with ``prediction``; tokens the model does not know count for nothing, equal scores go to the smaller class."""
    unit = F.lit(1.0) if model.binary else F.col("n").cast("double")
    found = lookup(rows.select(key, "token", "n"), model.weights.select("token", "weights"), frequent(model.weights))
    n = len(model.classes)
    sums = found.groupBy(key).agg(F.sum(unit).alias("_u"), *[F.sum(unit * F.col("weights")[i]).alias(f"_s{i}") for i in range(n)])
    joined = docs.join(sums, key, "left")
    scores = [
        F.struct((-(F.coalesce(F.col(f"_s{i}"), F.lit(0.0)) + F.coalesce("_u", F.lit(0.0)) * model.per_unit[i] + model.constant[i])).alias("s"), F.lit(c).alias("c"))
        for i, c in enumerate(model.classes)
    ]
    return joined.withColumn("prediction", F.array_min(F.array(*scores))["c"]).drop("_u", *[f"_s{i}" for i in range(n)])


def naive_bayes_folds(df: DataFrame, key: str, text: str, label: str, fold: Column, folds: int, kind: str, scratch: Scratch | None = None) -> DataFrame:
    """``fold, num_test, accuracy`` of naive Bayes on all tokens, trained on the other folds."""
    scratch = scratch or Scratch(df.sparkSession)
    docs = scratch.put(df.select(key, label, text).withColumn("_fold", fold), "docs")
    rows = scratch.put(token_rows(docs, key, text, [label, "_fold"]), "token_rows")
    out = None
    for i in range(folds):
        model = fit_naive_bayes(rows.filter(F.col("_fold") != i), docs.filter(F.col("_fold") != i), label, kind, scratch=scratch)
        tested = predict_naive_bayes(model, rows.filter(F.col("_fold") == i), docs.filter(F.col("_fold") == i), key)
        scored = tested.agg(
            F.lit(i).cast("bigint").alias("fold"), F.count("*").alias("num_test"),
            F.avg((F.col(label) == F.col("prediction")).cast("double")).alias("accuracy"),
        )
        out = scored if out is None else out.unionAll(scored)
    return out


def text_classifier(df: DataFrame, key: str, text: str, label: str, scratch: Scratch | None = None) -> DataFrame:
    """``<key>, <label>, prediction``: tokens weighted by tf-idf, multinomial naive Bayes, over the whole vocabulary."""
    scratch = scratch or Scratch(df.sparkSession)
    docs = scratch.put(df.select(key, label, text), "docs")
    rows = scratch.put(token_rows(docs, key, text, [label]), "token_rows")
    words = dictionary(rows, scratch)
    idf = F.log((F.lit(docs.count()) + 1.0) / (F.col("documents") + 1.0))
    found = lookup(rows.withColumnRenamed("n", "tf"), words.select("token", idf.alias("idf")), frequent(words))
    weighted = scratch.put(found.select(key, label, "token", (F.col("tf") * F.col("idf")).alias("n")), "weighted")
    model = fit_naive_bayes(weighted, docs, label, scratch=scratch)
    return predict_naive_bayes(model, weighted, docs.select(key, label), key)
