"""Named queries: a function of (session, table folder) and, where SQL can say it, an oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trellis.session import size_shuffles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


# Lazy frames by (application, folder, table): the file schema is read once.
_frames: dict[tuple[str, str, str], DataFrame] = {}

# Tables of many short rows, which are joined and shuffled whole.
LONG_TABLES = ("lineitem", "orders", "events")


class Tables:
    """The input tables of one folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _frames:
            _frames[key] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            if name in LONG_TABLES:
                size_shuffles(self.spark, _frames[key].count())
        return _frames[key]


def query(name: str, sql: str | None = None):
    """Register ``f(tables) -> DataFrame`` under a name."""

    def register(function: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: function(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register
