"""Classifiers, reduction and model selection on tables, with Spark's own estimators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trellis.functions.scalar import hash_bucket
from trellis.operators.similarity import embedding_topk
from trellis.session import materialize


def as_vectors(df: DataFrame, array: str, out: str = "features") -> DataFrame:
    """An ML vector column from an array column."""
    return df.withColumn(out, array_to_vector(F.col(array).cast("array<double>")))


def class_centroids(df: DataFrame, label: str, vector: str) -> DataFrame:
    """``label, centroid``: the element-wise mean per class."""
    means = (
        df.select(label, F.posexplode(vector).alias("_p", "_x")).groupBy(label, "_p").agg(F.avg(F.col("_x").cast("double")).alias("_m"))
    )
    # one row per class and dimension is left here
    pairs = means.groupBy(label).agg(F.sort_array(F.collect_list(F.struct("_p", "_m"))).alias("_v"))
    return pairs.select(label, F.transform("_v", lambda e: e["_m"]).alias("centroid"))


def nearest_centroid(train: DataFrame, test: DataFrame, label: str, vector: str, out: str = "prediction") -> DataFrame:
    """Test rows with the class whose centroid is nearest (squared distance, smallest label on a
    tie). All centroids travel as one row: classes times dimensions."""
    table = class_centroids(train, label, vector).agg(
        F.collect_list(F.struct(F.col(label).alias("l"), "centroid")).alias("_all")
    )
    rows = test.withColumn("_one", F.lit(1)).join(F.broadcast(table.withColumn("_one", F.lit(1))), "_one")

    def distance(c):
        squares = F.zip_with(F.col(vector), c["centroid"], lambda a, b: (a.cast("double") - b) * (a.cast("double") - b))
        return F.struct(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x).alias("d"), c["l"].alias("l"))

    best = F.array_min(F.transform("_all", distance))
    return rows.withColumn(out, best["l"]).drop("_all", "_one")


def knn_classify(
    train: DataFrame, test: DataFrame, key: str, label: str, vector: str, k: int, leave_one_out: bool = False
) -> DataFrame:
    """``<key>, prediction``: majority of the k nearest training rows, the smallest label on a tie."""
    neighbours = embedding_topk(
        train.select(F.col(key).alias("_near"), vector), test.select(key, vector), k, "_near", key, vector,
        "sqeuclidean", leave_one_out,
    )
    votes = (
        neighbours.join(train.select(F.col(key).alias("_near"), label), "_near")
        .groupBy(key, label)
        .agg(F.count("*").alias("_n"))
    )
    return votes.groupBy(key).agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col(label).alias("l")))["l"].alias("prediction"))


def naive_bayes(kind: str = "multinomial", smoothing: float = 1.0) -> NaiveBayes:
    """``gaussian``, ``multinomial`` or ``bernoulli``."""
    return NaiveBayes(modelType=kind, smoothing=smoothing)


def decision_tree(depth: int = 5, seed: int = 1) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(maxDepth=depth, seed=seed)


def random_forest(trees: int = 50, depth: int = 5, seed: int = 1) -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed)


def linear_svm(c: float = 1.0, classes: int = 2, max_iterations: int = 50) -> Estimator:
    """Linear SVM with cost ``c``; more than two classes are split one against the rest."""
    svm = LinearSVC(regParam=1.0 / c, maxIter=max_iterations)
    return svm if classes == 2 else OneVsRest(classifier=svm)


def logistic_regression(penalty: str = "l2", strength: float = 0.01, max_iterations: int = 50) -> LogisticRegression:
    return LogisticRegression(elasticNetParam=1.0 if penalty == "l1" else 0.0, regParam=strength, maxIter=max_iterations)


def mlp_classifier(layers: Sequence[int], seed: int = 1, max_iterations: int = 50) -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(layers=list(layers), seed=seed, maxIter=max_iterations)


def pca_reduce(df: DataFrame, vector: str, components: int, out: str = "components") -> DataFrame:
    """The first principal components of mean-centred vectors, as an array column."""
    staged = as_vectors(df, vector, "_raw")
    model = Pipeline(
        stages=[
            StandardScaler(inputCol="_raw", outputCol="_centred", withMean=True, withStd=False),
            PCA(k=components, inputCol="_centred", outputCol="_pca"),
        ]
    ).fit(staged)
    return model.transform(staged).withColumn(out, vector_to_array("_pca")).drop("_raw", "_centred", "_pca")


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> float:
    return df.agg(F.avg((F.col(label).cast("double") == F.col(prediction).cast("double")).cast("double"))).first()[0]


def kfold_eval(
    df: DataFrame, key: str, make: Callable[[], Estimator], folds: int = 5, label: str = "label", seed: int = 0
) -> DataFrame:
    """``fold, num_test, accuracy`` per fold; folds are cut by hash of the key. The rows are
    written once, since every fold reads them several times."""
    rows = materialize(df.withColumn("_fold", hash_bucket(key, seed, folds)), "folds")
    out = None
    for i in range(folds):
        model = make().fit(rows.filter(F.col("_fold") != i))
        scored = model.transform(rows.filter(F.col("_fold") == i)).agg(
            F.lit(i).cast("bigint").alias("fold"), F.count("*").alias("num_test"),
            F.avg((F.col(label).cast("double") == F.col("prediction")).cast("double")).alias("accuracy"),
        )
        out = scored if out is None else out.unionAll(scored)
    return out


def kfold_summary(folds: DataFrame) -> DataFrame:
    """Mean accuracy and its standard error."""
    return folds.agg(
        F.avg("accuracy").alias("mean_accuracy"),
        (F.stddev_samp("accuracy") / F.sqrt(F.count("*"))).alias("standard_error"),
    )


def grid_search(
    df: DataFrame, key: str, estimator: Estimator, grid: dict, folds: int = 3, label: str = "label", seed: int = 0
) -> DataFrame:
    """``setting, mean_accuracy`` for every combination of parameter values."""
    builder = ParamGridBuilder()
    for param, values in grid.items():
        builder = builder.addGrid(param, list(values))
    out = None
    for setting in builder.build():
        name = ",".join(f"{p.name}={v}" for p, v in sorted(setting.items(), key=lambda x: x[0].name))
        result = kfold_eval(df, key, lambda s=setting: estimator.copy(s), folds, label, seed).agg(
            F.lit(name).alias("setting"), F.avg("accuracy").alias("mean_accuracy")
        )
        out = result if out is None else out.unionAll(result)
    return out


def baseline_vs_enhanced(
    rows: DataFrame, key: str, label: str, base: Sequence[str], extra: Sequence[str], seed: int = 0
) -> DataFrame:
    """``model, accuracy`` of a logistic regression on the base columns and on base plus extra
    columns, fitted and tested on the same split."""
    split = materialize(rows.withColumn("_part", hash_bucket(key, seed, 10)), "rows")
    train, test = split.filter("_part < 7"), split.filter("_part >= 7")
    out = None
    for name, columns in (("baseline", base), ("enhanced", [*base, *extra])):
        model = Pipeline(
            stages=[
                VectorAssembler(inputCols=list(columns), outputCol="_raw"),
                StandardScaler(inputCol="_raw", outputCol="features", withMean=True),
                LogisticRegression(labelCol=label, maxIter=50),
            ]
        ).fit(train)
        scored = model.transform(test).agg(
            F.lit(name).alias("model"),
            F.avg((F.col(label).cast("double") == F.col("prediction")).cast("double")).alias("accuracy"),
        )
        out = scored if out is None else out.unionAll(scored)
    return out
