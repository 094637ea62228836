"""Total orders and running totals without a one-task window.

A window with no partition keys sends every row to one task, and a window over a hot key sends
that key to one task. Here rows are range-partitioned on the order, the partition number is
written down, each partition is summed, and the running total of the partition sums (one row
per partition) is added back.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from trellis.session import Scratch


def _name_of(columns: Sequence[str]) -> list[Column]:
    return [F.col(c) for c in columns]


def _ranges(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Rows range-partitioned on an order and written, with their partition in ``_range``."""
    ranged = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    return Scratch(df.sparkSession).put(ranged, "ranged")


def running_total(
    df: DataFrame,
    order_by: Sequence[str | Column],
    sums: dict[str, Column],
) -> DataFrame:
    """Add one inclusive running total per entry of ``sums`` (output name -> value), in the
    order given. The order must tell rows apart, otherwise equal rows share no range split;
    callers add a key or group equal rows first."""
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    stored = _ranges(df, order)
    totals = stored.groupBy("_range").agg(
        *[F.sum(value).alias(f"_sum_{name}") for name, value in sums.items()]
    )
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_range",
        *[
            F.coalesce(F.sum(f"_sum_{name}").over(earlier), F.lit(0)).alias(f"_off_{name}")
            for name in sums
        ],
    )
    within = (
        Window.partitionBy("_range")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # offsets holds one row per range partition, so its size is the partition count
    joined = stored.join(F.broadcast(offsets), "_range")
    out = joined.select(
        *_name_of(df.columns),
        *[
            (F.col(f"_off_{name}") + F.sum(value).over(within)).alias(name)
            for name, value in sums.items()
        ],
    )
    return out


def global_row_number(df: DataFrame, order_by: Sequence[str | Column], out: str = "rn") -> DataFrame:
    """1-based position of every row in a total order."""
    return running_total(df, order_by, {out: F.lit(1).cast("bigint")})


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """A join in which a null key meets a null key, as in grouping."""
    named = right.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    joined = left.join(named, on, how)
    return joined if how == "left_semi" else joined.drop(*[f"_key_{k}" for k in keys])


def row_number_within(
    df: DataFrame, group: Sequence[str], order_by: Sequence[str | Column], out: str = "rn"
) -> DataFrame:
    """1-based position inside each group. Only the first and the last group of a range can span
    ranges; the rows they have in earlier ranges are counted and added."""
    stored = _ranges(df, [*group, *order_by])
    key = F.struct(*group)
    edges = stored.groupBy("_range").agg(F.min(key).alias("_a"), F.max(key).alias("_b"))
    # at most two groups per range partition
    edges = edges.select("_range", F.explode(F.array_distinct(F.array("_a", "_b"))).alias("_g")).select("_range", "_g.*")
    counts = _join_null_safe(stored, F.broadcast(edges), ["_range", *group], "left_semi").groupBy("_range", *group).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = counts.select("_range", *group, F.sum("_n").over(earlier).alias("_before"))
    within = Window.partitionBy("_range", *group).orderBy(*order_by)
    return (
        _join_null_safe(stored, F.broadcast(carried), ["_range", *group], "left")
        .withColumn(out, F.coalesce("_before", F.lit(0)) + F.row_number().over(within))
        .select(*df.columns, out)
    )


TOP_ROWS = 100_000  # up to here a range is cut from the sorted top, beyond it by position


def row_range(df: DataFrame, order_by: Sequence[str | Column], start: int, stop: int) -> DataFrame:
    """Rows at positions start..stop (0-based, stop not included) of a total order."""
    if stop <= TOP_ROWS:
        return df.orderBy(*order_by).limit(stop).offset(start)
    numbered = global_row_number(df, order_by, "_rn")
    return numbered.filter((F.col("_rn") > start) & (F.col("_rn") <= stop)).drop("_rn")


def running_last(
    df: DataFrame, group: Sequence[str], order_by: Sequence[str], value: str, out: str
) -> DataFrame:
    """Add the last non-null ``value`` of the group at or before each row of a total order.

    Rows are range-partitioned on group and order; what a range starts with is the last value of
    the ranges before it, if that belongs to the same group. A hot group spans many ranges.
    """
    order = [*group, *order_by]
    stored = _ranges(df, order)
    lasts = (
        stored.filter(F.col(value).isNotNull())
        .groupBy("_range")
        .agg(F.max(F.struct(*order, value)).alias("_last"))
    )
    all_ranges = stored.select("_range").distinct().join(lasts, "_range", "left")
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range partition
    carried = all_ranges.select("_range", F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    within = (
        Window.partitionBy("_range", *group)
        .orderBy(*order_by)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    same = F.lit(True)
    for g in group:
        same = same & F.col(f"_carried.{g}").eqNullSafe(F.col(g))
    return (
        stored.join(F.broadcast(carried), "_range")
        .withColumn(
            out,
            F.coalesce(F.last(value, ignorenulls=True).over(within), F.when(same, F.col(f"_carried.{value}"))),
        )
        .drop("_range", "_carried")
    )


def collect_lists(df: DataFrame, keys: Sequence[str], values: Sequence[str], out: str) -> DataFrame:
    """COLLECT per key, in the order of ``values``: ``keys, <out>``, one row per key.

    Two levels: rows are range-partitioned on keys and values, so a hot key spans many ranges, and each range sorts the part of a
    list that it holds. The parts of a key are then put behind each other in the order of their ranges; the last step
    moves one row per key and range and sorts nothing but these. Null keys are a key, null values stay in the list."""
    stored = _ranges(df.select(*keys, *values), [*keys, *values])
    parts = stored.groupBy("_range", *keys).agg(F.sort_array(F.collect_list(F.struct(*values))).alias("_l"))
    if len(values) == 1:
        parts = parts.withColumn("_l", F.transform("_l", lambda e: e[values[0]]))
    lists = parts.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_range", "_l"))).alias("_parts"))
    return lists.select(*keys, F.flatten(F.transform("_parts", lambda p: p["_l"])).alias(out))


def drop_every_second(df: DataFrame, order_by: Sequence[str | Column]) -> DataFrame:
    """Keep rows 0, 2, 4 … of a total order."""
    return global_row_number(df, order_by, "_rn").filter(F.col("_rn") % 2 == 1).drop("_rn")


def paginate(df: DataFrame, order_by: Sequence[str | Column], page_size: int) -> DataFrame:
    """Add ``page`` (0-based) and ``row_in_page`` (0-based)."""
    numbered = global_row_number(df, order_by, "_rn")
    zero_based = F.col("_rn") - 1
    return numbered.select(
        *df.columns,
        F.floor(zero_based / page_size).cast("bigint").alias("page"),
        (zero_based % page_size).cast("bigint").alias("row_in_page"),
    )


def add_sequence_column(
    df: DataFrame, order_by: Sequence[str | Column], out: str, start: int = 0, prefix: str | None = None
) -> DataFrame:
    """Running integer ids from ``start`` in a stated order, optionally with a text prefix."""
    numbered = global_row_number(df, order_by, "_rn")
    value = F.col("_rn") - 1 + start
    if prefix is not None:
        value = F.concat(F.lit(prefix), value.cast("string"))
    return numbered.withColumn(out, value).drop("_rn")


def next_row_pairs(df: DataFrame, group: Sequence[str], order_by: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """Each row with the ``carry`` columns of the next row of its group as ``next_<c>``.

    Rows are shuffled once, into ranges of group and order, sorted there and passed in that order: each takes the values of the row
    behind it, and the last row of a range those of the first row of the next one. A hot group spans many ranges.
    """
    order = list(dict.fromkeys([*group, *order_by, *carry]))
    ranged = df.repartitionByRange(*group, *order_by).sortWithinPartitions(*order).withColumn("_range", F.spark_partition_id())
    types = {f.name: f.dataType for f in df.schema.fields}
    fields = [StructField(c, t) for c, t in types.items()] + [StructField("_range", IntegerType())]
    fields += [StructField(c, BooleanType()) for c in ("_starts", "_ends", "_same")] + [StructField(f"_next_{c}", types[c]) for c in carry]
    stored = Scratch(df.sparkSession).put(ranged.mapInArrow(_with_next_row(group, carry), StructType(fields)), "paired")
    later = Window.orderBy("_range").rowsBetween(1, 1)
    # one row per range partition that has rows
    firsts = stored.filter("_starts").select("_range", F.struct(*dict.fromkeys([*group, *carry])).alias("_first"))
    following = firsts.select("_range", F.first("_first").over(later).alias("_following"))
    joined = stored.join(F.broadcast(following), "_range")
    same = F.col("_following").isNotNull()
    for g in group:
        same = same & F.col(f"_following.{g}").eqNullSafe(F.col(g))
    after = [F.when(F.col("_ends"), F.col(f"_following.{c}")).otherwise(F.col(f"_next_{c}")).alias(f"next_{c}") for c in carry]
    return joined.filter(F.col("_same") | (F.col("_ends") & same)).select(*df.columns, *after)


def _with_next_row(group: Sequence[str], carry: Sequence[str]):
    """Rows with some columns of the row behind them, whether that is of the same group, and whether they are the first or the last of
    their partition. Others without a next row of their group are left out."""

    def paired(batch: pa.RecordBatch, behind: pa.RecordBatch | None, first: bool) -> pa.RecordBatch:
        def shifted(c: str) -> pa.Array:
            tail = pa.nulls(1, batch.column(c).type) if behind is None else behind.column(c).slice(0, 1)
            return pa.concat_arrays([batch.column(c).slice(1), tail])

        place = np.arange(batch.num_rows)
        columns = {c: batch.column(c) for c in batch.schema.names}
        columns["_starts"] = pa.array((place == 0) & first)
        columns["_ends"] = pa.array((place == batch.num_rows - 1) & (behind is None))
        same = pc.invert(columns["_ends"])
        for g in group:
            a, b = batch.column(g), shifted(g)
            nulls = pc.and_(pc.is_null(a), pc.is_null(b))
            if pa.types.is_floating(a.type):  # equal as Spark has it
                nulls = pc.or_(nulls, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
            same = pc.and_(same, pc.or_(pc.fill_null(pc.equal(a, b), False), nulls))
        columns["_same"] = same
        for c in carry:
            columns[f"_next_{c}"] = shifted(c)
        out = pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
        return out.filter(pc.or_(same, pc.or_(columns["_starts"], columns["_ends"])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, first = None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                yield paired(held, batch, first)
                first = False
            held = batch
        if held is not None:
            yield paired(held, None, first)

    return run


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probabilities: dict[str, float]
) -> DataFrame:
    """Exact interpolated quantiles per group (``probabilities``: output name -> p).

    Equal values are counted first; the group's running count comes from one global running
    total, so neither a hot group nor a group with many values ends up in one task.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    cum = running_total(counts, [*keys, value], {"_cum": F.col("_n")})
    span = cum.groupBy(*keys).agg(
        F.sum("_n").alias("_total"), F.min(F.col("_cum") - F.col("_n")).alias("_start")
    )
    if keys:
        placed = _join_null_safe(cum, span, list(keys), "inner")
    else:
        placed = cum.withColumn("_one", F.lit(1)).join(F.broadcast(span.withColumn("_one", F.lit(1))), "_one")
    last = F.col("_cum") - F.col("_start")
    first = last - F.col("_n")
    picks = []
    for name, p in probabilities.items():
        position = F.lit(p) * (F.col("_total") - 1)
        low, high = F.floor(position), F.ceil(position)
        picks += [
            F.max(F.when((first <= low) & (low < last), F.col(value))).alias(f"_lo_{name}"),
            F.max(F.when((first <= high) & (high < last), F.col(value))).alias(f"_hi_{name}"),
        ]
    found = placed.groupBy(*keys).agg(F.max("_total").alias("_total"), *picks)
    out = list(keys)
    for name, p in probabilities.items():
        position = F.lit(p) * (F.col("_total") - 1)
        part = position - F.floor(position)
        out.append(
            (F.col(f"_lo_{name}") + part * (F.col(f"_hi_{name}") - F.col(f"_lo_{name}"))).alias(name)
        )
    return found.select(*out)
