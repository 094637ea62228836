"""Column statistics and tests, as aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trellis.operators.ordering import exact_quantiles


def describe_column(df: DataFrame, column: str) -> DataFrame:
    """One row: count, mean, sample and population deviation, standard error, min, exact quartiles,
    max, skewness."""
    c = F.col(column)
    base = df.agg(
        F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
        F.stddev_pop(c).alias("std_pop"), (F.stddev_samp(c) / F.sqrt(F.count(c))).alias("std_error"),
        F.min(c).alias("min"), F.max(c).alias("max"), F.skewness(c).alias("skewness"),
    ).withColumn("_one", F.lit(1))
    quartiles = exact_quantiles(df.select(column), [], column, {"q25": 0.25, "median": 0.5, "q75": 0.75})
    return base.join(quartiles.withColumn("_one", F.lit(1)), "_one").drop("_one")


def median_by_group(df: DataFrame, keys: Sequence[str], column: str, out: str = "median") -> DataFrame:
    return exact_quantiles(df.select(*keys, column), keys, column, {out: 0.5})


def quantile(df: DataFrame, column: str, p: float, out: str = "quantile") -> DataFrame:
    return exact_quantiles(df.select(column), [], column, {out: p})


def boxplot_stats(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Per group: quartiles, whiskers (furthest values within 1.5 IQR) and outlier count."""
    q = exact_quantiles(df.select(*keys, column), keys, column, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    v = F.col(column)
    low = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))
    high = F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    rows = df.select(*keys, column).join(q, list(keys))
    inside = (v >= low) & (v <= high)
    return rows.groupBy(*keys, "q1", "median", "q3").agg(
        F.min(F.when(inside, v)).alias("whisker_low"),
        F.max(F.when(inside, v)).alias("whisker_high"),
        F.count(F.when(~inside, 1)).alias("outliers"),
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``x, y, corr`` (Pearson) for every column pair, from one pass."""
    pairs = list(combinations_with_replacement(columns, 2))
    one = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    rows = F.array(
        *[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"{a}|{b}").alias("corr")) for a, b in pairs]
    )
    return one.select(F.explode(rows).alias("r")).select("r.*")


def brown_forsythe_f(df: DataFrame, group: str, column: str) -> DataFrame:
    """One row: the F statistic for equal variances from absolute deviations to the group median,
    with its degrees of freedom. The caller compares it with a critical value."""
    medians = median_by_group(df, [group], column, "_median")
    spread = df.select(group, column).join(medians, group).select(
        group, F.abs(F.col(column) - F.col("_median")).alias("z")
    )
    groups = spread.groupBy(group).agg(
        F.count("z").alias("n"), F.avg("z").alias("m"), F.var_pop("z").alias("v")
    )
    total = groups.agg(
        F.sum("n").alias("big_n"), F.count("*").alias("p"),
        F.sum(F.col("n") * F.col("m")).alias("s"),
        F.sum(F.col("n") * F.col("m") * F.col("m")).alias("ss"),
        F.sum(F.col("n") * F.col("v")).alias("within"),
    )
    between = F.col("ss") - F.col("s") * F.col("s") / F.col("big_n")
    return total.select(
        ((F.col("big_n") - F.col("p")) / (F.col("p") - 1) * between / F.col("within")).alias("f_statistic"),
        (F.col("p") - 1).alias("df1"),
        (F.col("big_n") - F.col("p")).alias("df2"),
    )


def welch_t(df: DataFrame, group: str, a, b, column: str) -> DataFrame:
    """One row: Welch's t and its degrees of freedom for two groups."""
    def side(value, name: str) -> list[Column]:
        x = F.when(F.col(group) == value, F.col(column))
        return [F.count(x).alias(f"n{name}"), F.avg(x).alias(f"m{name}"), F.var_samp(x).alias(f"v{name}")]

    rows = df.filter(F.col(group).isin(a, b)).agg(*side(a, "a"), *side(b, "b"))
    ea, eb = F.col("va") / F.col("na"), F.col("vb") / F.col("nb")
    return rows.select(
        ((F.col("ma") - F.col("mb")) / F.sqrt(ea + eb)).alias("t"),
        (F.pow(ea + eb, 2) / (ea * ea / (F.col("na") - 1) + eb * eb / (F.col("nb") - 1))).alias("df"),
    )


def crosstab_pivot(df: DataFrame, row: Column, column: Column, values: Sequence[str], row_name: str = "row") -> DataFrame:
    """Counts per row value and listed column value; absent pairs count 0."""
    table = df.select(row.alias(row_name), column.alias("_c")).groupBy(row_name).pivot("_c", list(values)).agg(F.count(F.lit(1)))
    return table.fillna(0)


def rolling_mean(df: DataFrame, order_by: str, column: str, size: int, centred: bool = False, out: str = "rolling") -> DataFrame:
    """Mean over ``size`` rows, null until the window is full. The window has one order over all
    rows: aggregate to one row per period first."""
    back = (size - 1) // 2 if centred else size - 1
    ahead = size - 1 - back if centred else 0
    frame = Window.orderBy(order_by).rowsBetween(-back, ahead)
    return df.withColumn(out, F.when(F.count(column).over(frame) == size, F.avg(column).over(frame)))


def sort_position(column: str, order: Sequence) -> Column:
    """1-based position of a value in a list; values not listed come after."""
    found = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(column))
    return F.when(found > 0, found).otherwise(len(order) + 1)


def custom_sort_order(df: DataFrame, column: str, order: Sequence) -> DataFrame:
    """Rows sorted by the position of a value in a list."""
    return df.orderBy(sort_position(column, order), column)


def chunk_combine_finalize(df: DataFrame, keys: Sequence[str], chunk: dict[str, Column], finalize: dict[str, Column]) -> DataFrame:
    """A user aggregate in three steps: ``chunk`` aggregates (combined by Spark's partial and final
    aggregation), then ``finalize`` expressions over them."""
    rows = df.groupBy(*keys).agg(*[v.alias(k) for k, v in chunk.items()])
    return rows.select(*keys, *[v.alias(k) for k, v in finalize.items()])


def distributed_reduce(df: DataFrame, column: str) -> DataFrame:
    """Sum, maximum and minimum over all partitions."""
    return df.agg(F.sum(column).alias("total"), F.max(column).alias("maximum"), F.min(column).alias("minimum"))


def type_key_histogram(edges: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Edges per (type, names of the properties present)."""
    from trellis.functions.scalar import keys_of

    return edges.groupBy("type", F.array_join(keys_of(columns), ",").alias("keys")).agg(F.count("*").alias("n"))


def label_histogram(nodes: DataFrame) -> DataFrame:
    """Nodes per label; a node with several labels counts under each."""
    return nodes.select(F.explode("labels").alias("label")).groupBy("label").agg(F.count("*").alias("n"))
