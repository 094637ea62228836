"""Streams of events and of graph batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from trellis.sources.store import GraphStore


def read_stream(spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet", **options: str) -> DataFrame:
    """Files that arrive under a path, as a stream."""
    return spark.readStream.format(format).schema(schema).options(**options).load(path)


def stream_windowed_counts(
    events: DataFrame, time: str, keys: Sequence[str], size: str, slide: str | None = None, late: str = "1 hour",
    value: str | None = None,
) -> DataFrame:
    """Counts (and the sum of ``value``) per event-time window and key. Rows behind the watermark
    are dropped in a stream; on a batch frame the watermark has no effect."""
    window = F.window(time, size, slide) if slide else F.window(time, size)
    aggregates = [F.count("*").alias("n")] + ([F.sum(value).alias("total")] if value else [])
    return (
        events.withWatermark(time, late)
        .groupBy(window.alias("w"), *keys)
        .agg(*aggregates)
        .select(F.col("w.start").alias("window_start"), *keys, "n", *(["total"] if value else []))
    )


def stream_repeat_transfers(
    transfers: DataFrame, time: str, sender: str, receiver: str, amount: str, size: str,
    limit: float, above: float, more_than: int, late: str = "1 hour",
) -> DataFrame:
    """Pairs with many transfers just below a limit inside a window."""
    return (
        transfers.filter(F.col(amount) < limit)
        .withWatermark(time, late)
        .groupBy(F.window(time, size).alias("w"), sender, receiver)
        .agg(F.count("*").alias("n"), F.avg(amount).alias("average"))
        .filter((F.col("average") > above) & (F.col("n") > more_than))
        .select(F.col("w.start").alias("window_start"), sender, receiver, "n", "average")
    )


def stream_dedupe(events: DataFrame, key: Sequence[str], time: str, within: str) -> DataFrame:
    """Drop repeats of a key that arrive within the watermark."""
    return events.withWatermark(time, within).dropDuplicatesWithinWatermark(list(key))


def stream_alerts(transactions: DataFrame, flagged: DataFrame, party: str, description: str) -> DataFrame:
    """ALERT rows for transactions whose party is flagged (stream-static join)."""
    return transactions.join(flagged.select(F.col("id").alias(party)).distinct(), party, "left_semi").select(
        "*", F.lit("ALERT").alias("label"), F.lit(description).alias("description")
    )


def stream_graph_ingest(
    batches: DataFrame, store: GraphStore, checkpoint: str, to_nodes: Callable[[DataFrame], DataFrame],
    to_edges: Callable[[DataFrame], DataFrame], operation: str = "operation", base_version: int = 0, compact_every: int | None = None,
) -> StreamingQuery:
    """Mini-batches with an operation column (upsert or delete) become graph versions that hold the changes only, so a batch writes
    as much as it brings. The version of a batch is ``base_version`` (the version the stream starts from) plus its batch id plus one;
    a finished version is never written again, so a replayed batch changes nothing. An edge that arrives before its nodes waits in
    the store and joins the graph when they have come. Every ``compact_every`` versions the buckets that changed get a new base."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        version = base_version + batch_id + 1
        if version in store.versions():
            return
        batch.persist()
        upserts = batch.filter(F.col(operation) == "upsert")
        store.append(to_nodes(upserts), to_edges(upserts), to_nodes(batch.filter(F.col(operation) == "delete")), version)
        batch.unpersist()
        if compact_every and version % compact_every == 0:
            store.compact(version)

    return (
        batches.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Drain what is there into Parquet and read it back."""
    query = (
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode(mode).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def complete_result(stream: DataFrame, name: str, checkpoint: str) -> DataFrame:
    """Drain an aggregation in complete mode: the last batch written is the result."""
    target = f"{checkpoint}/result"

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/{batch_id}")
        last.append(batch_id)

    last: list[int] = []
    query = (
        stream.writeStream.foreachBatch(keep).queryName(name).option("checkpointLocation", f"{checkpoint}/log")
        .outputMode("complete").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    if not last:  # nothing has arrived
        return stream.sparkSession.createDataFrame([], stream.schema)
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{target}/{last[-1]}")


