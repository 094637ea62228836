"""Toxicity by a counterfactual-regularised classifier.

Features of a text are the words it holds and their beginnings, each counted once. On a bounded sample of labelled
documents, executors count how many documents of either label hold each feature; those that tell the labels
apart are the model's (together with the identity terms), and a logistic regression is fitted to them.

Its loss has a third term beside likelihood and weight decay. In each labelled sentence that mentions a group, the
mention is swapped for other groups of its kind; the squared change of the score over all such pairs is
penalised. So weights that hang on which group is named shrink, even where the sample's labels go along with a group, and neutral
mentions do not raise a score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trellis.llm.common import body, text_chunks
from trellis.session import Scratch

# Identity terms by kind and language. Swaps stay within one list.
IDENTITIES = [line.split() for line in (
    "men women",
    "man woman",
    "black white asian latino",
    "christian muslim jewish hindu buddhist atheist",
    "christians muslims jews hindus buddhists atheists",
    "gay lesbian straight bisexual transgender queer",
    "immigrant native refugee foreigner",
    "immigrants natives refugees foreigners",
    "mexican chinese african american european arab indian russian",
    "deaf blind disabled",
    "männer frauen",
    "christen muslime juden hindus buddhisten atheisten",
    "schwarze weiße asiaten",
    "ausländer einheimische flüchtlinge",
    "schwule lesben",
    "hommes femmes",
    "chrétiens musulmans juifs hindous bouddhistes athées",
    "noirs blancs asiatiques arabes",
    "étrangers immigrés réfugiés",
    "hombres mujeres",
    "cristianos musulmanes judíos hindúes budistas ateos",
    "negros blancos asiáticos árabes",
    "extranjeros inmigrantes refugiados",
)]
SAMPLE = 12_000  # labelled documents that are learned from, at most
LEAST_DOCS = 3  # a feature needs so many documents
LEAST_G = 12.0  # and so large a log-likelihood ratio
MOST_FEATURES = 20_000  # the strongest, in the order of that ratio
BEGINNINGS = (4, 5, 6, 7)
DECAY = 0.3
COUNTERFACTUAL = 1.0
ROUNDS = 300
THRESHOLD = 0.3
HELD_OUT = 2  # remainder of crc32(id) by 4
WORDS = re.compile(r"[^\W\d_]+")
SENTENCES = re.compile(r"[.!?\n]+")
MEMO_WORDS = 300_000  # words kept with their features per Python worker; a full table is emptied
PAIR_KINDS = {term: kind for kind in IDENTITIES for term in kind}


def held_out(id: Column) -> Column:
    return F.pmod(F.crc32(id.cast("string").cast("binary")), F.lit(4)) == HELD_OUT


def word_features(word: str) -> list[str]:
    return [word] + [f"{word[:n]}+" for n in BEGINNINGS if len(word) > n]


def text_features(text: str) -> set[str]:
    return {f for word in set(WORDS.findall(text.lower())) for f in word_features(word)}


def swaps(text: str) -> list[tuple[str, str]]:
    """(mentioned, put in its place), once for each mention in each sentence."""
    found = []
    for sentence in SENTENCES.split(text.lower()):
        for word in PAIR_KINDS.keys() & set(WORDS.findall(sentence)):
            found.extend((word, other) for other in PAIR_KINDS[word] if other != word)
    return found


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """``doc_id, toxic, text`` of at most ``most`` labelled documents outside the held-out part, the first by a hash of
    their id. A document with several labels has the highest, one without a label or an id is not learned from."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~F.coalesce(held_out(F.col("doc_id")), F.lit(True)))
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"), F.min("text").alias("text")
    )


def _featured(sample: DataFrame) -> DataFrame:
    """``toxic, features, swapped`` for each sampled document; the text stays behind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text"):
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([sorted(text_features(t)) for t in texts], pa.list_(pa.string())),
                pa.array([["\t".join(s) for s in swaps(t)] for t in texts], pa.list_(pa.string())),
            ], names=["toxic", "features", "swapped"])

    return sample.select("toxic", body(F.col("text")).alias("text")).mapInArrow(run, "toxic int, features array<string>, swapped array<string>")


def likelihood_ratio(a: Column, b: Column, toxic: int, clean: int) -> Column:
    """G of the table of having the feature (``a`` toxic documents, ``b`` clean ones) or not."""
    n = toxic + clean

    def cell(count: Column, row: Column, column: float) -> Column:
        return F.when(count > 0, count * F.log(count * n / (row * column))).otherwise(0.0)

    have, lack = a + b, F.lit(n) - a - b
    return 2 * (cell(a, have, toxic) + cell(b, have, clean) + cell(F.lit(toxic) - a, lack, toxic) + cell(F.lit(clean) - b, lack, clean))


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> tuple[dict[str, float], float]:
    """Weights by feature, and the bias. The driver holds the chosen features of the sample only."""
    scratch = Scratch(docs.sparkSession)
    rows = scratch.put(_featured(labelled_sample(docs, labels, most)), "features")
    counts = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, clean = counts.get(1, 0), counts.get(0, 0)
    if not toxic or not clean:
        return {}, math.log((toxic + 0.5) / (clean + 0.5)) if toxic + clean else math.log(0.05)
    held = rows.select("toxic", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.sum("toxic").alias("a"), (F.count("*") - F.sum("toxic")).alias("b")
    )
    strong = held.filter(F.col("a") + F.col("b") >= LEAST_DOCS).withColumn("g", likelihood_ratio(F.col("a"), F.col("b"), toxic, clean))
    strong = strong.filter(F.col("g") >= LEAST_G).orderBy(F.col("g").desc(), "feature").limit(MOST_FEATURES)
    names = sorted({r["feature"] for r in strong.select("feature").collect()} | PAIR_KINDS.keys())
    table = rows.select("toxic", _chosen(rows, names).alias("chosen")).groupBy("toxic", "chosen").count().collect()
    pairs = rows.select(F.explode("swapped").alias("pair")).groupBy("pair").count().collect()
    return _regression(names, [tuple(r) for r in table], [tuple(r) for r in pairs])


def _chosen(rows: DataFrame, names: list[str]) -> Column:
    wanted = rows.sparkSession.sparkContext.broadcast(frozenset(names))  # at most MOST_FEATURES and the identity terms

    @F.udf("array<string>")
    def keep(features):
        return [f for f in features if f in wanted.value]

    return keep("features")


def _regression(names: list[str], table: list[tuple], pairs: list[tuple]) -> tuple[dict[str, float], float]:
    """Logistic regression over different rows with counts, by Nesterov's accelerated gradient."""
    place = {name: i for i, name in enumerate(names)}
    table.sort(key=lambda r: (r[0], r[1]))
    y, times = np.array([r[0] for r in table], dtype=float), np.array([r[2] for r in table], dtype=float)
    row = np.repeat(np.arange(len(table)), [len(r[1]) for r in table])
    column = np.array([place[f] for r in table for f in r[1]], dtype=np.int64)
    pair_row, pair_column, pair_sign, pair_times = [], [], [], []
    for number, (pair, count) in enumerate(sorted(pairs)):
        pair_times.append(count)
        for word, sign in zip(pair.split("\t"), (-1.0, 1.0)):
            for feature in place.keys() & word_features(word):
                pair_row.append(number)
                pair_column.append(place[feature])
                pair_sign.append(sign)
    pair_row, pair_column, pair_sign = np.array(pair_row, dtype=np.int64), np.array(pair_column, dtype=np.int64), np.array(pair_sign)
    pair_times = np.array(pair_times, dtype=float)
    n, m = len(names), len(table)
    toxic_share = float((y * times).sum() / times.sum())

    def gradient(w: np.ndarray, bias: float) -> tuple[np.ndarray, float]:
        z = bias + np.bincount(row, w[column], m)
        error = times * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        slope = np.bincount(column, error[row], n) + DECAY * w
        if len(pair_times):
            change = pair_times * np.bincount(pair_row, w[pair_column] * pair_sign, len(pair_times))
            slope += COUNTERFACTUAL * np.bincount(pair_column, change[pair_row] * pair_sign, n)
        return slope, float(error.sum())

    # Steps per weight from a bound on the curvature: documents with the feature times their feature number.
    size = np.bincount(row, minlength=m) + 1.0
    curve = 0.25 * np.bincount(column, (times * size)[row], n) + DECAY
    if len(pair_times):
        wide = np.bincount(pair_row, minlength=len(pair_times)) * pair_times
        curve += COUNTERFACTUAL * np.bincount(pair_column, wide[pair_row], n)
    bias_curve = 0.25 * float((times * size).sum())
    w, bias = np.zeros(n), math.log(toxic_share / (1 - toxic_share))
    w_old, bias_old = w, bias
    for k in range(ROUNDS):
        ahead = k / (k + 3)
        w_try, bias_try = w + ahead * (w - w_old), bias + ahead * (bias - bias_old)
        slope, bias_slope = gradient(w_try, bias_try)
        w_old, bias_old = w, bias
        w, bias = w_try - slope / curve, bias_try - bias_slope / bias_curve
    return {name: float(x) for name, x in zip(names, w) if abs(x) > 1e-6}, float(bias)


class Scorer:
    """Scores of texts; remembers the weight-carrying features of words."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias, self.memo = weights, bias, {}

    def __call__(self, text: str) -> float:
        memo, weights, held = self.memo, self.weights, set()
        for word in set(WORDS.findall(text.lower())):
            known = memo.get(word)
            if known is None:
                known = tuple(f for f in word_features(word) if f in weights)
                if len(memo) >= MEMO_WORDS:
                    memo.clear()
                memo[word] = known
            if known:
                held.update(known)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.bias + math.fsum(weights[f] for f in held)))))


def score(docs: DataFrame, weights: dict[str, float], bias: float, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row, from the whole text alone.

    Null and empty texts get the bias's score; a null id is not held out; repeated rows are scored each; other columns are not
    read; an empty table gives no rows. No shuffle; the broadcast weights are bounded by ``MOST_FEATURES``."""
    model = docs.sparkSession.sparkContext.broadcast((weights, bias))
    rows = docs.select(
        F.struct(F.col(id).alias("doc_id"), F.coalesce(held_out(F.col(id)), F.lit(False)).alias("held_out")).alias("row"),
        body(F.col(text)).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*model.value)
        for batch in text_chunks(batches, "text"):
            scores = pa.array([scorer(t) for t in batch.column(1).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], names=["row", "score"])

    kind = rows.schema["row"].dataType.simpleString()
    found = rows.mapInArrow(run, f"row {kind}, score double")
    return found.select("row.*", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
