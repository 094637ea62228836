"""Feature columns and vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trellis.functions.scalar import hash_bucket
from trellis.model import stack
from trellis.operators.centrality import betweenness_centrality, pagerank
from trellis.session import Scratch


def assemble_features(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    """Property columns as one array of doubles; a missing value counts 0."""
    return df.withColumn(out, F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns]))


def standard_scale(df: DataFrame, columns: Sequence[str], suffix: str = "_z") -> DataFrame:
    """z-scores with the population deviation; null or a constant column gives 0."""
    stats = df.agg(
        *[F.avg(c).alias(f"_m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"_s_{c}") for c in columns]
    ).withColumn("_one", F.lit(1))
    rows = df.withColumn("_one", F.lit(1)).join(F.broadcast(stats), "_one")  # one row of statistics
    z = {
        f"{c}{suffix}": F.coalesce(
            F.when(F.col(f"_s_{c}") > 0, (F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}")), F.lit(0.0)
        )
        for c in columns
    }
    return rows.withColumns(z).select(*df.columns, *z)


def minmax_scale(df: DataFrame, columns: Sequence[str], low: float = 0.0, high: float = 1.0, suffix: str = "_scaled") -> DataFrame:
    stats = df.agg(
        *[F.min(c).alias(f"_lo_{c}") for c in columns], *[F.max(c).alias(f"_hi_{c}") for c in columns]
    ).withColumn("_one", F.lit(1))
    rows = df.withColumn("_one", F.lit(1)).join(F.broadcast(stats), "_one")  # one row of statistics
    scaled = {
        f"{c}{suffix}": low
        + (F.col(c) - F.col(f"_lo_{c}")) / (F.col(f"_hi_{c}") - F.col(f"_lo_{c}")) * (high - low)
        for c in columns
    }
    return rows.withColumns(scaled).select(*df.columns, *scaled)


def one_hot(df: DataFrame, column: str, categories: Sequence[str] | None = None) -> DataFrame:
    """One 0/1 column per category in sorted order; a null row is 0 in all. Without a list the
    distinct values are read first, at most 1000 of them."""
    if categories is None:
        seen = df.select(column).distinct().dropna().orderBy(column).take(1001)
        if len(seen) > 1000:
            raise ValueError(f"{column} has more than 1000 categories; use vocabulary.encode_by_descriptor")
        categories = [r[0] for r in seen]
    return df.withColumns(
        {f"{column}_{v}": F.coalesce((F.col(column) == v).cast("int"), F.lit(0)) for v in sorted(categories)}
    )


def pad_vector(vector: str | Column, size: int) -> Column:
    """Zero-pad an array to ``size``; a longer one is an error."""
    c = F.col(vector) if isinstance(vector, str) else vector
    fits = F.concat(c, F.array_repeat(F.lit(0.0), F.greatest(size - F.size(c), F.lit(0))))
    return F.when(F.size(c) > size, F.raise_error(F.lit(f"vector is wider than {size}"))).otherwise(fits)


def hash_split(df: DataFrame, key: str, shares: dict[str, float], seed: int = 0, out: str = "split") -> DataFrame:
    """Random split by hash of the key: the same rows on any partitioning."""
    bucket = hash_bucket(key, seed)
    names, cut, choice = list(shares), 0.0, None
    for name in names[:-1]:
        cut += shares[name]
        limit = round(cut * 1000)
        choice = F.when(bucket < limit, name) if choice is None else choice.when(bucket < limit, name)
    return df.withColumn(out, choice.otherwise(names[-1]))


def split_shares(df: DataFrame, column: str = "split") -> DataFrame:
    """``split, num_rows, share``."""
    counts = df.groupBy(column).agg(F.count("*").alias("num_rows"))
    return counts.withColumn("share", F.col("num_rows") / F.sum("num_rows").over(Window.partitionBy()))


def supervised_pairs(edges: DataFrame, value: str, threshold: float) -> DataFrame:
    """(source, target, label) with label 1 where the value is above the threshold; edges without
    a value are left out."""
    return edges.filter(F.col(value).isNotNull()).select(
        F.col("src").alias("source"), F.col("dst").alias("target"), (F.col(value) > threshold).cast("int").alias("label")
    )


def neighbour_feature_aggregate(
    nodes: DataFrame, edges: DataFrame, columns: Sequence[str], direction: str = "in", layers: int = 1
) -> DataFrame:
    """Per node mean, max, min and deviation of its neighbours' features (``in``: along incoming
    edges). With more layers the mean of one layer is the feature of the next; columns are
    suffixed ``_mean<layer>`` and so on. Nodes without neighbours get null."""
    scratch = Scratch(edges.sparkSession)
    pair = ("src", "dst") if direction == "in" else ("dst", "src")
    steps = scratch.put(edges.select(F.col(pair[0]).alias("far"), F.col(pair[1]).alias("id")), "edges")
    out = nodes.select("id", *columns)
    current = {c: c for c in columns}
    for layer in range(1, layers + 1):
        values = out.select(F.col("id").alias("far"), *[F.col(v).alias(f"_v_{c}") for c, v in current.items()])
        per = steps.join(values, "far").groupBy("id").agg(
            *[
                f(f"_v_{c}").alias(f"{c}_{name}{layer}")
                for c in columns
                for name, f in (("mean", F.avg), ("max", F.max), ("min", F.min), ("std", F.stddev_pop))
            ]
        )
        out = scratch.put(out.join(per, "id", "left"), f"layer_{layer}")
        current = {c: f"{c}_mean{layer}" for c in columns}
    return out


def sample_neighbourhood(edges: DataFrame, seeds: DataFrame, fans: Sequence[int], seed: int = 0) -> DataFrame:
    """Sub-graph around seeds: at hop i every reached node keeps at most ``fans[i]`` out-edges, the
    first by hash. ``seed_id, hop, src, dst``. The rank is cut before the shuffle as well, so a
    hub sends only its first edges."""
    scratch = Scratch(edges.sparkSession)
    steps = edges.select("src", "dst").distinct()
    frontier = seeds.select(F.col("id").alias("seed_id"), F.col("id").alias("src"))
    found = []
    for hop, fan in enumerate(fans, 1):
        order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("seed_id").cast("string"), F.col("src").cast("string"), F.col("dst").cast("string")))
        rank = F.row_number().over(Window.partitionBy("seed_id", "src").orderBy(order, "dst"))
        taken = scratch.put(
            frontier.join(steps, "src").withColumn("_rn", rank).filter(F.col("_rn") <= fan)
            .select("seed_id", F.lit(hop).cast("bigint").alias("hop"), "src", "dst"),
            f"hop_{hop}",
        )
        found.append(taken)
        frontier = taken.select("seed_id", F.col("dst").alias("src")).distinct()
    return stack(found)


def graph_feature_columns(nodes: DataFrame, edges: DataFrame, num_sources: int, max_iterations: int = 10) -> DataFrame:
    """Node rows with ``pagerank`` and ``betweenness`` columns."""
    ranks = pagerank(nodes, edges, max_iterations, tolerance=None, result="pagerank")
    between = betweenness_centrality(nodes, edges, num_sources, result="betweenness")
    return nodes.join(ranks, "id", "left").join(between, "id", "left")
