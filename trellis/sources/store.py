"""Graphs on disk under ``<root>/<database>/<graph>``: whole versions, and versions that hold only what changed.

A whole version ``v=<n>`` has a Parquet table of nodes and one of edges. A change version has the rows that were upserted and the keys of
the nodes that were deleted, nothing else, so it is as large as its batch. Reading a change version merges on read: rows fall into
``BUCKETS`` buckets by hash of their key, each bucket has a base (a whole version or a compaction), and the changes since that
base are folded over it, the newest non-null value of every column. Compaction writes a new base for the buckets that changed since
theirs, and leaves the other buckets where they are; a small manifest names each bucket's base. Older versions stay readable.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trellis.model import PropertyGraph, stack
from trellis.operators.mutate import NODE_KEY, first_per_key

BUCKETS = 64
KEYS = {"nodes": NODE_KEY, "edges": ["edge_id"]}


def bucket(table: str) -> Column:
    return F.pmod(F.xxhash64(*KEYS[table]), F.lit(BUCKETS)).cast("int")


class GraphStore:
    """Versioned graphs. A version is complete when its ``_DONE`` marker exists; a writer that
    dies half-way leaves no marker and the version is written anew."""

    def __init__(self, spark: SparkSession, root: str, database: str, graph: str):
        self.spark = spark
        self.path = f"{root}/{database}/{graph}"

    def _fs(self, path: str):
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), target

    def _exists(self, path: str) -> bool:
        fs, target = self._fs(path)
        return fs.exists(target)

    def _marked(self, marker: str) -> list[int]:
        """Versions that have a file of this name."""
        fs, root = self._fs(self.path)
        if not fs.exists(root):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(root)]
        return sorted(int(n[2:]) for n in names if n.startswith("v=") and self._exists(f"{self.path}/{n}/{marker}"))

    def versions(self) -> list[int]:
        return self._marked("_DONE")

    def _mark(self, path: str, text: str = "") -> None:
        fs, target = self._fs(path)
        out = fs.create(target, True)
        out.write(bytearray(text.encode()))
        out.close()

    def _text(self, path: str) -> str:
        fs, target = self._fs(path)
        stream = fs.open(target)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def save(self, graph: PropertyGraph, version: int | None = None) -> int:
        """Write the next version (or a given one, which makes a replay of the same batch
        overwrite its own half-written files and skip a finished one) as a whole."""
        known = self.versions()
        number = (known[-1] + 1 if known else 1) if version is None else version
        if number in known:
            return number
        base = f"{self.path}/v={number}"
        graph.nodes.write.mode("overwrite").parquet(f"{base}/nodes")
        graph.edges.write.mode("overwrite").parquet(f"{base}/edges")
        self._mark(f"{base}/_DONE")
        return number

    def append(self, nodes: DataFrame, edges: DataFrame, deleted: DataFrame, version: int | None = None) -> int:
        """Write the next version (or a given one, as in ``save``) as changes: rows to upsert by key, of one key the first, and the keys
        (``id_space, id``) of nodes that are deleted after that, with all their edges. An edge whose ends are missing
        waits: it is kept, and belongs to the graph of every version in which both ends exist. An edge id keeps its ends."""
        known = self.versions()
        number = (known[-1] + 1 if known else 1) if version is None else version
        if number in known:
            return number
        base = f"{self.path}/v={number}/changes"
        for table, rows in (("nodes", nodes), ("edges", edges)):
            key = KEYS[table]
            first_per_key(rows, key, [c for c in rows.columns if c not in key] or key).write.mode("overwrite").parquet(f"{base}/{table}")
        deleted.select(*NODE_KEY).distinct().write.mode("overwrite").parquet(f"{base}/deleted")
        self._mark(f"{self.path}/v={number}/_DONE")
        return number

    def _bases(self, table: str, version: int) -> dict[int, int]:
        """The version of each bucket's base at a version; 0 is none."""
        whole = [v for v in self.versions() if v <= version and self._exists(f"{self.path}/v={v}/nodes")]
        found = dict.fromkeys(range(BUCKETS), whole[-1] if whole else 0)
        packed = [v for v in self._marked("base/_MANIFEST") if found[0] <= v <= version]
        if packed:
            found.update({int(b): v for b, v in json.loads(self._text(f"{self.path}/v={packed[-1]}/base/_MANIFEST"))[table].items()})
        return found

    def _rows(self, table: str, version: int) -> DataFrame | None:
        """All rows of a table that count at a version, each with the version it is from: the buckets' bases and the changes since."""
        bases = self._bases(table, version)
        parts = []
        for base in sorted(set(bases.values()) - {0}):
            own = [b for b, v in bases.items() if v == base]
            packed = f"{self.path}/v={base}/base/{table}"
            if self._exists(packed):
                rows = self.spark.read.parquet(packed).filter(F.col("_bucket").isin(own)).drop("_bucket")
            else:
                rows = self.spark.read.parquet(f"{self.path}/v={base}/{table}")
                rows = rows if len(own) == BUCKETS else rows.filter(bucket(table).isin(own))
            parts.append(rows.withColumn("_version", F.lit(base)))
        since = F.element_at(F.array(*[F.lit(bases[b]) for b in range(BUCKETS)]), bucket(table) + 1)
        for change in self._changes(min(bases.values()), version):
            rows = self.spark.read.parquet(f"{self.path}/v={change}/changes/{table}").withColumn("_version", F.lit(change))
            parts.append(rows.filter(since < F.lit(change)))
        return stack(parts) if parts else None

    def _changes(self, after: int, version: int) -> list[int]:
        return [v for v in self.versions() if after < v <= version and self._exists(f"{self.path}/v={v}/changes")]

    def _deleted(self, version: int) -> DataFrame | None:
        """``id_space, id, _gone``: the last version that deleted each node."""
        low = min(min(self._bases(table, version).values()) for table in KEYS)
        keys = [self.spark.read.parquet(f"{self.path}/v={v}/changes/deleted").withColumn("_gone", F.lit(v)) for v in self._changes(low, version)]
        return stack(keys).groupBy(*NODE_KEY).agg(F.max("_gone").alias("_gone")) if keys else None

    def _folded(self, table: str, version: int) -> DataFrame:
        """One row per key: of every column the newest non-null value since the key's node, or an end of the edge, was last deleted."""
        rows, gone = self._rows(table, version), self._deleted(version)
        if rows is None:
            raise ValueError(f"no version {version} under {self.path}")
        if gone is not None:
            ends = [NODE_KEY] if table == "nodes" else [["src_space", "src"], ["dst_space", "dst"]]
            for end in ends:
                named = gone.select(F.col("id_space").alias(end[0]), F.col("id").alias(end[1]), "_gone")
                rows = rows.join(named, end, "left").filter(F.col("_gone").isNull() | (F.col("_gone") < F.col("_version"))).drop("_gone")
        key = KEYS[table]
        others = [c for c in rows.columns if c not in key and c != "_version"]
        newest = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_version"))).alias(c) for c in others]
        return rows.groupBy(*key).agg(*newest) if newest else rows.select(*key).distinct()

    def load(self, version: int | None = None) -> PropertyGraph:
        """Open the newest version or the one asked for."""
        known = self.versions()
        number = known[-1] if version is None else version
        if number not in known:
            raise ValueError(f"no version {number} under {self.path}")
        if self._exists(f"{self.path}/v={number}/nodes"):
            return PropertyGraph(*[self.spark.read.parquet(f"{self.path}/v={number}/{table}") for table in KEYS])
        return PropertyGraph(self._folded("nodes", number), self._folded("edges", number)).resolved()

    def compact(self, version: int | None = None) -> dict[str, int]:
        """Give the buckets that changed since their base a new base at a version; how many of each table. Edges that wait
        for their ends are kept."""
        number = self.versions()[-1] if version is None else version
        manifest, written = {}, {}
        for table in KEYS:
            bases = self._bases(table, number)
            touched: set[int] = set()
            for change in self._changes(min(bases.values()), number):
                rows = self.spark.read.parquet(f"{self.path}/v={change}/changes/{table}")
                found = {r[0] for r in rows.select(bucket(table)).distinct().collect()}  # BUCKETS rows at most
                if table == "nodes":
                    gone = self.spark.read.parquet(f"{self.path}/v={change}/changes/deleted")
                    found |= {r[0] for r in gone.select(bucket(table)).distinct().collect()}
                touched |= {b for b in found if bases[b] < change}
            if touched:
                rows = self._folded(table, number).withColumn("_bucket", bucket(table)).filter(F.col("_bucket").isin(sorted(touched)))
                rows.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.path}/v={number}/base/{table}")
            manifest[table] = {b: number if b in touched else v for b, v in bases.items()}
            written[table] = len(touched)
        self._mark(f"{self.path}/v={number}/base/_MANIFEST", json.dumps(manifest))
        return written

    def version_counts(self) -> DataFrame:
        """``version, num_nodes, num_edges`` of every version."""
        return stack(
            self.load(v).counts().select(F.lit(v).alias("version"), "num_nodes", "num_edges")
            for v in self.versions()
        )

    def size(self, version: int) -> int:
        """Bytes that a version's own files take."""
        fs, target = self._fs(f"{self.path}/v={version}")
        return fs.getContentSummary(target).getLength()
