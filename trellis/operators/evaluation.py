"""Classifier evaluation from tables of labels, predictions and scores."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trellis.operators.ordering import running_total


def binary_tally(df: DataFrame, label: str, prediction: str, keys: Sequence[str] = ()) -> DataFrame:
    """Counts ``tp, tn, fp, fn`` of 0/1 columns."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    return df.groupBy(*keys).agg(
        F.count(F.when(y & p, 1)).alias("tp"),
        F.count(F.when(~y & ~p, 1)).alias("tn"),
        F.count(F.when(~y & p, 1)).alias("fp"),
        F.count(F.when(y & ~p, 1)).alias("fn"),
    )


def _over(top: Column, bottom: Column) -> Column:
    return F.when(bottom != 0, top / bottom)


def classification_metrics(tally: DataFrame) -> DataFrame:
    """Rates and agreement measures of a tally; null where a denominator is zero."""
    tp, tn, fp, fn = (F.col(c).cast("double") for c in ("tp", "tn", "fp", "fn"))
    n = tp + tn + fp + fn
    tpr, tnr = _over(tp, tp + fn), _over(tn, tn + fp)
    ppv, npv = _over(tp, tp + fp), _over(tn, tn + fn)
    chance = _over((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp), n * n)
    observed = _over(tp + tn, n)
    return tally.withColumns(
        {
            "accuracy": observed,
            "tpr": tpr,
            "tnr": tnr,
            "ppv": ppv,
            "npv": npv,
            "fpr": _over(fp, tn + fp),
            "fnr": _over(fn, tp + fn),
            "f1": _over(2.0 * tp, 2.0 * tp + fp + fn),
            "mcc": _over(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))),
            "kappa": _over(observed - chance, 1.0 - chance),
            "informedness": tpr + tnr - 1.0,
            "markedness": ppv + npv - 1.0,
        }
    )


def confusion_matrix(df: DataFrame, label: str, prediction: str, classes: Sequence) -> DataFrame:
    """One row per label, one column per predicted class."""
    table = df.groupBy(label).pivot(prediction, list(classes)).agg(F.count(F.lit(1))).fillna(0)
    return table.select(label, *[F.col(str(c)).alias(f"predicted_{c}") for c in classes])


def weighted_accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Per-class accuracy weighted by the share of the class."""
    per = df.groupBy(label).agg(
        F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("_acc"), F.count("*").alias("_n")
    )
    return per.agg((F.sum(F.col("_acc") * F.col("_n")) / F.sum("_n")).alias("weighted_accuracy"))


def roc_points(
    df: DataFrame, label: str, score: str, thresholds: Sequence[float] = (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1)
) -> DataFrame:
    """``threshold, fpr, tpr``: a score at or above the threshold counts as positive. All
    thresholds come from one pass of conditional counts."""
    y = F.col(label) == 1
    counted = df.agg(
        F.count(F.when(y, 1)).alias("p"), F.count(F.when(~y, 1)).alias("n"),
        *[F.count(F.when(y & (F.col(score) >= t), 1)).alias(f"tp{i}") for i, t in enumerate(thresholds)],
        *[F.count(F.when(~y & (F.col(score) >= t), 1)).alias(f"fp{i}") for i, t in enumerate(thresholds)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(t).alias("threshold"), _over(F.col(f"fp{i}"), F.col("n")).alias("fpr"),
                _over(F.col(f"tp{i}"), F.col("p")).alias("tpr"),
            )
            for i, t in enumerate(thresholds)
        ]
    )
    return counted.select(F.explode(rows).alias("r")).select("r.*")


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact area under the ROC curve (ties count half). Equal scores are grouped, and the number
    of negatives below comes from one range-partitioned running total."""
    y = F.col(label) == 1
    groups = df.groupBy(score).agg(F.count(F.when(y, 1)).alias("p"), F.count(F.when(~y, 1)).alias("n"))
    below = running_total(groups, [score], {"cum": F.col("n")})
    wins = F.sum(F.col("p") * (F.col("cum") - F.col("n") / 2.0))
    return below.agg((wins / (F.sum("p").cast("double") * F.sum("n"))).alias("auc"))


def ensemble_vote(predictions: Sequence[DataFrame], key: str, probabilities: str, how: str = "average") -> DataFrame:
    """Join the class-probability arrays of several models; average or maximum per class, then the
    class with the highest value (the smallest on a tie)."""
    frames = [p.select(key, F.col(probabilities).alias(f"_p{i}")) for i, p in enumerate(predictions)]
    rows = reduce(lambda a, b: a.join(b, key), frames)
    joined = F.arrays_zip(*[F.col(f"_p{i}") for i in range(len(frames))])
    if how == "average":
        combine = lambda z: reduce(lambda a, b: a + b, [z[f"_p{i}"] for i in range(len(frames))]) / len(frames)
    else:
        combine = lambda z: F.greatest(*[z[f"_p{i}"] for i in range(len(frames))])
    rows = rows.select(key, F.transform(joined, combine).alias("probabilities"))
    best = (F.array_position("probabilities", F.array_max("probabilities")) - 1).cast("int")
    return rows.withColumn("prediction", best)
