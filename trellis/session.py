"""Session helpers: recommended settings and the shared folder for iteration state.

Iterative operators cut their lineage by writing each round as a Parquet table and reading it
back. A written table is computed once, survives the loss of any executor, and tells the
planner its size, so the next join may be broadcast only when the table really is small.
"""

from __future__ import annotations

import atexit
import itertools
import shutil
import tempfile
import uuid

import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

_local_dirs: dict[str, str] = {}


def local_session(cores: str | int = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("trellis")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    builder = builder.config("spark.driver.memory", memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can read")
    if sc.applicationId not in _local_dirs:
        path = tempfile.mkdtemp(prefix="trellis-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        _local_dirs[sc.applicationId] = path
    return _local_dirs[sc.applicationId]


class NotConverged(RuntimeError):
    """An iteration reached the caller's limit before its own end."""


def rounds(most: int | None):
    """Round numbers from 0, without end, or an error after the caller's limit."""
    turn = 0
    while most is None or turn < most:
        yield turn
        turn += 1
    raise NotConverged(f"not done after {most} rounds")


def turns(most: int | None):
    """Numbers from 1 without end, or to the limit that the caller names as part of the question."""
    return itertools.count(1) if most is None else range(1, most + 1)


PIECE_ROWS = 1 << 19  # input rows of a shuffle's piece, on average


def size_shuffles(spark: SparkSession, rows: int) -> None:
    """Let shuffles of this many rows start with pieces of a bounded size, so that what a task sorts does not grow with the input and
    need not be spilled. Adaptive execution puts small pieces together again. A larger number already set stays."""
    setting = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    now = int(spark.conf.get(setting, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    if -(-rows // PIECE_ROWS) > now:
        spark.conf.set(setting, str(-(-rows // PIECE_ROWS)))


_on_clear: list = []


def forget_on_clear(cache: dict) -> dict:
    """Empty ``cache`` whenever the scratch tables go: its frames read them."""
    _on_clear.append(cache)
    return cache


SCHEMES = {"s3a": "s3", "s3n": "s3"}  # names that Hadoop and Arrow give the same store


def file_system(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """Arrow's file system for a folder named as Hadoop names it, and the path there."""
    scheme, colon, rest = folder.partition("://")
    return pyarrow.fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}{colon}{rest}")


class Scratch:
    """Tables written under the shared folder by one operator run."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{_application_dir(spark)}/{uuid.uuid4().hex}"
        self._slots: dict[str, list[str]] = {}

    def put(self, df: DataFrame, slot: str = "state") -> DataFrame:
        """Write ``df`` once and read it back. Re-using a slot drops its version before last:
        the newest version was computed from the last one, nothing reads older ones."""
        versions = self._slots.setdefault(slot, [])
        path = f"{self.root}/{slot}-{uuid.uuid4().hex[:8]}"
        df.write.mode("overwrite").parquet(path)
        versions.append(path)
        while len(versions) > 2:
            self._delete(versions.pop(0))
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        """Delete all of this run's tables. What was computed from them must be saved by then."""
        _delete(self.spark, self.root)
        self._slots.clear()

    def _delete(self, path: str) -> None:
        _delete(self.spark, path)


def _application_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/trellis/{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def clear_scratch(spark: SparkSession) -> None:
    """Drop every table this application wrote between rounds. Results still to be read from them
    must be saved first, so call it at the end of a job."""
    for cache in _on_clear:
        cache.clear()
    _delete(spark, _application_dir(spark))


def materialize(df: DataFrame, slot: str = "table") -> DataFrame:
    """Write a frame to the shared folder and read it back."""
    return Scratch(df.sparkSession).put(df, slot)


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores before work that is heavy per row, when the input has fewer splits than
    there are cores. Inputs of many splits stay as they are, so no large table is shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
