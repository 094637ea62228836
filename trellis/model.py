"""The property graph: a node table and an edge table.

Nodes: ``id_space STRING, id STRING, labels ARRAY<STRING>`` and free property columns.
Edges: ``src_space, src, dst_space, dst STRING, type STRING, edge_id STRING`` and free property
columns. A node is known by ``(id_space, id)``; an edge by ``edge_id``, so parallel edges stay
apart. A property that a row does not have is null. An empty string is a value.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NODE_KEYS = ["id_space", "id", "labels"]
EDGE_KEYS = ["src_space", "src", "dst_space", "dst", "type", "edge_id"]


def stack(frames: Iterable[DataFrame]) -> DataFrame:
    """Union of sparse frames: the schema is the union of the columns, missing means null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def property_names(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in NODE_KEYS and c not in EDGE_KEYS]


@dataclass(frozen=True)
class PropertyGraph:
    """Node and edge tables. Every operator returns a new graph; frames stay lazy."""

    nodes: DataFrame
    edges: DataFrame

    @classmethod
    def of(cls, nodes: Sequence[DataFrame], edges: Sequence[DataFrame]) -> PropertyGraph:
        """Stack per-label and per-type frames. Their label and type columns are literals, so a
        later filter on a label folds to a constant and drops the other branches of the union."""
        return cls(stack(nodes), stack(edges))

    def nodes_with(self, *labels: str) -> DataFrame:
        return self.nodes.filter(has_label(*labels)) if labels else self.nodes

    def edges_of(self, *types: str) -> DataFrame:
        return self.edges.filter(F.col("type").isin(list(types))) if types else self.edges

    def project(self, labels: Sequence[str] | None = None, types: Sequence[str] | None = None) -> PropertyGraph:
        """Sub-graph view: nodes by label, edges by type, and only edges whose ends survive."""
        nodes = self.nodes_with(*labels) if labels else self.nodes
        edges = self.edges_of(*types) if types else self.edges
        if labels:
            edges = resolve_ends(edges, nodes)
        return PropertyGraph(nodes, edges)

    def resolved(self) -> PropertyGraph:
        """Drop edges with an end that is not in the node table (the import rule)."""
        return PropertyGraph(self.nodes, resolve_ends(self.edges, self.nodes))

    def unresolved_edges(self) -> DataFrame:
        """The edges that :meth:`resolved` drops."""
        return self.edges.join(
            resolve_ends(self.edges, self.nodes).select("edge_id"), "edge_id", "left_anti"
        )

    def counts(self) -> DataFrame:
        """One row: ``num_nodes, num_edges``."""
        tagged = self.nodes.select(F.lit(1).alias("n"), F.lit(0).alias("e")).unionAll(
            self.edges.select(F.lit(0), F.lit(1))
        )
        return tagged.agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("num_nodes"),
            F.coalesce(F.sum("e"), F.lit(0)).cast("bigint").alias("num_edges"),
        )

    def schema_table(self) -> DataFrame:
        """Labels and types with the properties seen on them: ``kind, name, property, data_type, n``."""
        return stack(
            [
                _schema_rows(self.nodes.withColumn("_name", F.explode("labels")), "node"),
                _schema_rows(self.edges.withColumn("_name", F.col("type")), "edge"),
            ]
        )


def _schema_rows(df: DataFrame, kind: str) -> DataFrame:
    types = dict(df.dtypes)
    props = [p for p in property_names(df) if p != "_name"]
    counted = df.groupBy("_name").agg(
        F.count("*").alias("_rows"), *[F.count(F.col(p)).alias(p) for p in props]
    )
    entries = F.array(
        *[
            F.struct(F.lit(p).alias("property"), F.lit(types[p]).alias("data_type"), F.col(p).alias("n"))
            for p in props
        ]
    )
    if not props:
        entries = F.expr("cast(array() as array<struct<property:string,data_type:string,n:bigint>>)")
    return (
        counted.select(F.lit(kind).alias("kind"), F.col("_name").alias("name"), F.explode(entries).alias("p"))
        .filter("p.n > 0")
        .select("kind", "name", "p.property", "p.data_type", "p.n")
    )


def has_label(*labels: str) -> Column:
    """True when the node carries any of the labels."""
    if len(labels) == 1:
        return F.array_contains("labels", labels[0])
    return F.arrays_overlap(F.col("labels"), F.array(*[F.lit(x) for x in labels]))


def node_keys(nodes: DataFrame, side: str) -> DataFrame:
    """Node keys named like one end of an edge (``side`` is ``src`` or ``dst``)."""
    return nodes.select(F.col("id_space").alias(f"{side}_space"), F.col("id").alias(side))


def resolve_ends(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges whose two ends are in ``nodes``."""
    for side in ("src", "dst"):
        edges = edges.join(node_keys(nodes, side), [f"{side}_space", side], "left_semi")
    return edges


def key_columns(nodes: DataFrame) -> list[Column]:
    return [F.col("id_space"), F.col("id")]
