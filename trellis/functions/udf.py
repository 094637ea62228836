"""User functions: register by name, drop by name, run over a table in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def register_scalar_udf(spark: SparkSession, name: str, function: Callable, returns: T.DataType | str):
    """A function of single values, usable by name in SQL. Arrow carries the rows in batches."""
    return spark.udf.register(name, F.udf(function, returns, useArrow=True))


def register_vector_udf(spark: SparkSession, name: str, function: Callable, returns: T.DataType | str):
    """A function over a whole column batch (pandas Series in, Series out)."""
    return spark.udf.register(name, F.pandas_udf(function, returns))


def deregister(spark: SparkSession, name: str) -> None:
    """Drop a registered function; an unknown name is an error."""
    spark.sql(f"DROP TEMPORARY FUNCTION {name}")


def graph_map(
    table: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str
) -> DataFrame:
    """Run a function on every batch of a node or edge table; the result stays distributed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield function(batch)

    return table.mapInPandas(run, schema)


def map_partitions_column(
    df: DataFrame, out: str, returns: str, function: Callable[[pd.DataFrame], pd.Series], columns: list[str]
) -> DataFrame:
    """Add a column computed from the named columns, one batch at a time."""

    @F.pandas_udf(returns)
    def compute(batch: pd.DataFrame) -> pd.Series:
        return function(batch)

    return df.withColumn(out, compute(F.struct(*columns)))


def apply_per_group(df: DataFrame, keys: list[str], function: Callable, schema: T.StructType | str) -> DataFrame:
    """Python per group. The whole group is in one task's memory, so group on keys of bounded
    size and reduce first where a built-in aggregate can."""
    return df.groupBy(*keys).applyInPandas(function, schema)
