"""Centroid clustering by Lloyd's rounds, sharded by dimension.

Vectors are kept as integers, cut into blocks of ``BLOCK`` components: one table row per vector and block, written once. In
each round a task reads rows of column blocks, holds the centroids' slices, and computes for every row the exact partial squared
distances to all centroids. A reduction by vector adds up the blocks' partial distances and takes the smallest, the smaller
centroid number on ties. The assignment goes back to the blocks, where each block sums its own components by centroid and
replaces its own slice of every centroid by the exact floor of the mean. No task ever holds more than one block of a vector, so
vectors may be as wide as one likes. Sums are combined before they are shuffled, so a cluster of most rows is no hot key.

The centroids (``k`` times the dimensions, whatever the number of vectors) are the only thing that passes through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trellis.session import Scratch

BLOCK = 16
MOST = 1 << 27  # components beyond would overflow the exact sums of squares


def whole_numbers(vectors: DataFrame, id: str, vector: str, dimensions: int, scale: float) -> DataFrame:
    """``vec_id, x``: rows whose vector has ``dimensions`` components, none null or non-finite, as ``floor(scale * component)``."""
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = vectors.select(F.col(id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("v").isNotNull() & (F.size("v") == dimensions)).filter(finite)
    x = F.transform("v", lambda c: F.when(
        F.abs(c * scale) <= MOST, F.floor(c * scale)
    ).otherwise(F.raise_error(F.lit(f"a component beyond {MOST} has no exact distance"))).cast("long"))
    return rows.select("vec_id", x.alias("x"))


def first_centroids(rows: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The vectors with the ``k`` smallest hashes of seed and id, in that order; of equal ids the smaller vector first."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    chosen = rows.select(F.sha2(text, 256).alias("hash"), "x").orderBy("hash", "x").limit(k).collect()
    return [list(r["x"]) for r in chosen]


def _partial_distances(blocks: DataFrame, centroids: list[list[int]], block: int) -> DataFrame:
    """``number, d0, d1, ...``: of each row of a column block the distances to the centroids' slices."""
    k = len(centroids)
    slices = {b: np.array([c[b * block:(b + 1) * block] for c in centroids], dtype=np.int64) for b in range(-(-len(centroids[0]) // block))}
    held = blocks.sparkSession.sparkContext.broadcast(slices)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, shards = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            lists = batch.column(2)
            flat, ends = lists.flatten().to_numpy(), np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
            out, order = [np.zeros((0, k), dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
            for shard in np.unique(shards).tolist():
                centre, own = held.value[shard], np.flatnonzero(shards == shard)
                x = flat[ends[own][:, None] + np.arange(centre.shape[1])]
                out.append(np.stack([((x - c) ** 2).sum(axis=1) for c in centre], axis=1))
                order.append(numbers[own])
            distances = np.concatenate(out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(order))] + [pa.array(distances[:, i]) for i in range(k)], names=["number"] + [f"d{i}" for i in range(k)]
            )

    kinds = ", ".join(f"d{i} long" for i in range(k))
    return blocks.select("number", "shard", "slice").mapInArrow(run, f"number long, {kinds}")


def _assigned(blocks: DataFrame, centroids: list[list[int]], block: int) -> DataFrame:
    """``number, distance, cluster``: partial distances added up by vector, and the nearest centroid."""
    k = len(centroids)
    totals = _partial_distances(blocks, centroids, block).groupBy("number").agg(*[F.sum(f"d{i}").alias(f"d{i}") for i in range(k)])
    nearest = F.array_min(F.array(*[F.struct(F.col(f"d{i}").alias("distance"), F.lit(i).alias("cluster")) for i in range(k)]))
    return totals.select("number", nearest.alias("nearest")).select("number", "nearest.distance", "nearest.cluster")


def _moved(blocks: DataFrame, assigned: DataFrame, centroids: list[list[int]], block: int) -> list[list[int]]:
    """Every shard's new slices of the centroids that have vectors; the others stay."""
    width = min(block, len(centroids[0]))
    joined = blocks.join(assigned.select("number", "cluster"), "number")
    sums = [F.sum(F.get("slice", F.lit(i))).alias(f"s{i}") for i in range(width)]
    new = [list(c) for c in centroids]
    for row in joined.groupBy("shard", "cluster").agg(F.count("*").alias("n"), *sums).collect():  # k rows a shard
        for i in range(width):  # exact floors
            at = row["shard"] * block + i
            if at < len(new[0]):
                new[row["cluster"]][at] = row[f"s{i}"] // row["n"]
    return new


def cluster(
    vectors: DataFrame, k: int, rounds: int, dimensions: int, id: str = "vec_id", vector: str = "embedding", scale: float = 64.0, seed: int = 1,
    block: int = BLOCK, scratch: Scratch | None = None,
) -> tuple[DataFrame, list[list[int]]]:
    """``vec_id, cluster, distance`` (squared) for every kept vector, and the final centroids.

    A vector is kept if it has ``dimensions`` components, none null or non-finite; fewer vectors than ``k`` give as many
    centroids, none give no rows. A null id counts as an empty text where ids are hashed; rows that repeat an id are vectors
    of their own; other columns are not read. A component over ``MOST`` after scaling raises an error, as its distances
    would not be exact."""
    scratch = scratch or Scratch(vectors.sparkSession)
    rows = scratch.put(whole_numbers(vectors, id, vector, dimensions, scale).withColumn("number", F.monotonically_increasing_id()), "vectors")
    centroids = first_centroids(rows, k, seed)
    if not centroids:
        empty = rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return empty, []
    cuts = [F.struct(F.lit(b).alias("shard"), F.slice("x", b * block + 1, block).alias("slice")) for b in range(-(-dimensions // block))]
    blocks = scratch.put(rows.select("number", F.inline(F.array(*cuts))), "blocks")
    for _ in range(rounds):
        assigned = scratch.put(_assigned(blocks, centroids, block), "assigned")
        centroids = _moved(blocks, assigned, centroids, block)
    assigned = scratch.put(_assigned(blocks, centroids, block), "assigned")
    return rows.select("number", "vec_id").join(assigned, "number").select("vec_id", "cluster", "distance"), centroids


def with_inertia(found: DataFrame, centroids: list[list[int]], scratch: Scratch) -> DataFrame:
    """Beside each vector its cluster's and the whole inertia and its centroid's hash. One row per cluster is joined back."""
    found = scratch.put(found, "found")
    per = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # k rows
    total = sum(r["cluster_inertia"] for r in per)
    named = [
        (r["cluster"], r["cluster_inertia"], total, hashlib.sha256(",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest()) for r in per
    ]
    table = found.sparkSession.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
