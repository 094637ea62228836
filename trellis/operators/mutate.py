"""Graph mutation. Every function returns new tables; the input tables stay as they are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trellis.model import EDGE_KEYS, NODE_KEYS, PropertyGraph, has_label, node_keys, property_names, stack

NODE_KEY = ["id_space", "id"]


class DuplicateKeys(ValueError):
    """Raised when the caller asked to fail on duplicate keys."""


def first_per_key(rows: DataFrame, key: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first in a stated order. The rank filter is applied before the shuffle
    too, so a hot key sends one row per task."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order_by))
    return rows.withColumn("_rn", rank).filter(F.col("_rn") == 1).drop("_rn")


def _require_unique(rows: DataFrame, key: Sequence[str]) -> None:
    twice = rows.groupBy(*key).agg(F.count("*").alias("_n")).filter("_n > 1").limit(1)
    if twice.take(1):
        raise DuplicateKeys(f"duplicate values of {list(key)}")


def graph_insert(
    table: DataFrame,
    rows: DataFrame,
    key: Sequence[str],
    on_duplicate: str = "keep_first",
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Add rows; existing rows stay untouched. ``on_duplicate`` is ``keep_first`` (existing rows
    win, then the first new row in ``order_by``) or ``fail``."""
    if on_duplicate == "fail":
        _require_unique(table.select(*key).unionAll(rows.select(*key)), key)
        return stack([table, rows])
    if order_by is None:
        order_by = [c for c in rows.columns if c not in key]
    fresh = first_per_key(rows, key, list(order_by) or list(key))
    return stack([table, fresh.join(table.select(*key), list(key), "left_anti")])


def graph_update(
    table: DataFrame, rows: DataFrame, key: Sequence[str], on_duplicate: str = "keep_first", order_by: Sequence[str] | None = None
) -> DataFrame:
    """Rows matched by key get the non-null new values; new columns are added. Of rows with one key the first in
    ``order_by`` counts (``keep_first``), or it is an error (``fail``)."""
    return _merge(table, _one_per_key(rows, key, on_duplicate, order_by), key, "left")


def graph_upsert(
    table: DataFrame, rows: DataFrame, key: Sequence[str], on_duplicate: str = "keep_first", order_by: Sequence[str] | None = None
) -> DataFrame:
    """Update matched rows, insert the others; rows with one key as in ``graph_update``."""
    return _merge(table, _one_per_key(rows, key, on_duplicate, order_by), key, "full_outer")


def _one_per_key(rows: DataFrame, key: Sequence[str], on_duplicate: str, order_by: Sequence[str] | None) -> DataFrame:
    if on_duplicate == "fail":
        _require_unique(rows, key)
        return rows
    return first_per_key(rows, key, list(order_by or [c for c in rows.columns if c not in key]) or list(key))


def _merge(table: DataFrame, rows: DataFrame, key: Sequence[str], how: str) -> DataFrame:
    new = rows.select(*key, *[F.col(c).alias(f"_new_{c}") for c in rows.columns if c not in key])
    merged = table.join(new, list(key), how)
    out = []
    for c in [*table.columns, *[c for c in rows.columns if c not in table.columns]]:
        if c in key or c not in rows.columns:
            out.append(F.col(c))
        elif c in table.columns:
            out.append(F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c))
        else:
            out.append(F.col(f"_new_{c}").alias(c))
    return merged.select(*out)


def graph_delete(graph: PropertyGraph, keys: DataFrame) -> PropertyGraph:
    """Delete nodes by key; their edges go too (DETACH DELETE)."""
    keys = keys.select(*NODE_KEY)
    edges = graph.edges
    for side in ("src", "dst"):
        edges = edges.join(node_keys(keys, side), [f"{side}_space", side], "left_anti")
    return PropertyGraph(graph.nodes.join(keys, NODE_KEY, "left_anti"), edges)


detach_delete = graph_delete


def delete_nodes(graph: PropertyGraph, keys: DataFrame) -> PropertyGraph:
    """Plain DELETE: refuses when a node still has edges."""
    keys = keys.select(*NODE_KEY)
    ends = node_keys_of_edges(graph.edges)
    if keys.join(ends, NODE_KEY, "left_semi").take(1):
        raise ValueError("a node to delete still has edges; use detach_delete")
    return PropertyGraph(graph.nodes.join(keys, NODE_KEY, "left_anti"), graph.edges)


def node_keys_of_edges(edges: DataFrame) -> DataFrame:
    """Both ends of every edge as node keys (with repeats)."""
    return edges.select(F.col("src_space").alias("id_space"), F.col("src").alias("id")).unionAll(
        edges.select("dst_space", "dst")
    )


def delete_edges(graph: PropertyGraph, edge_ids: DataFrame) -> PropertyGraph:
    return PropertyGraph(graph.nodes, graph.edges.join(edge_ids.select("edge_id"), "edge_id", "left_anti"))


def delete_with_count(graph: PropertyGraph, keys: DataFrame) -> tuple[PropertyGraph, int]:
    """Delete and tell how many nodes went."""
    gone = graph.nodes.join(keys.select(*NODE_KEY), NODE_KEY, "left_semi").count()
    return graph_delete(graph, keys), gone


def create_nodes(graph: PropertyGraph, rows: DataFrame) -> PropertyGraph:
    return PropertyGraph(stack([graph.nodes, rows]), graph.edges)


def create_edges_from_match(graph: PropertyGraph, rows: DataFrame) -> PropertyGraph:
    """Pattern result rows, shaped as edges, join the edge table."""
    return PropertyGraph(graph.nodes, stack([graph.edges, rows]))


def create_reverse_edges(edges: DataFrame, copy_properties: bool = False) -> DataFrame:
    """The edges plus one reverse edge each; by default the reverse edges have null properties."""
    swapped = edges.select(
        F.col("dst_space").alias("src_space"),
        F.col("dst").alias("src"),
        F.col("src_space").alias("dst_space"),
        F.col("src").alias("dst"),
        "type",
        F.concat("edge_id", F.lit(":rev")).alias("edge_id"),
        *(property_names(edges) if copy_properties else []),
    )
    return stack([edges, swapped])


def change_edge_type(edges: DataFrame, old: str, new: str) -> DataFrame:
    return edges.withColumn("type", F.when(F.col("type") == old, F.lit(new)).otherwise(F.col("type")))


def set_property(df: DataFrame, name: str, value: Column, where: Column | None = None) -> DataFrame:
    """Set a property on all rows or on those that match; other rows keep theirs (or null)."""
    if where is None:
        return df.withColumn(name, value)
    before = F.col(name) if name in df.columns else F.lit(None)
    return df.withColumn(name, F.when(where, value).otherwise(before))


def set_from_aggregate(
    nodes: DataFrame, edges: DataFrame, neighbours: DataFrame, source: str, target: str
) -> DataFrame:
    """Set ``target`` to the sum of ``source`` over out-neighbours; parallel edges each count.
    Nodes without a match keep what they had."""
    values = neighbours.select(
        F.col("id_space").alias("dst_space"), F.col("id").alias("dst"), F.col(source).alias("_v")
    )
    sums = (
        edges.join(values, ["dst_space", "dst"])
        .groupBy(F.col("src_space").alias("id_space"), F.col("src").alias("id"))
        .agg(F.sum("_v").alias("_sum"))
    )
    before = F.col(target) if target in nodes.columns else F.lit(None)
    return (
        nodes.join(sums, NODE_KEY, "left").withColumn(target, F.coalesce(F.col("_sum"), before)).drop("_sum")
    )


def remove_property(df: DataFrame, name: str, label: str | None = None) -> tuple[DataFrame, bool]:
    """Drop a property, or null it for one label. A missing name is no error: the flag is false."""
    if name not in df.columns or name in NODE_KEYS or name in EDGE_KEYS:
        return df, False
    if label is None:
        return df.drop(name), True
    return df.withColumn(name, F.when(~has_label(label), F.col(name))), True


def add_property(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a property; fails when it is there already."""
    if name in df.columns:
        raise ValueError(f"property {name} is already there")
    return df.withColumn(name, value)


def property_upsert(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a property or replace it."""
    return df.withColumn(name, value)


def merge_nodes(
    nodes: DataFrame, rows: DataFrame, on_create: dict[str, Column], order_by: Sequence[str] = ("id",)
) -> DataFrame:
    """MERGE … ON CREATE SET: a key that is there stays as it is, a new one is made once and gets
    the ON CREATE values."""
    fresh = first_per_key(rows, NODE_KEY, list(order_by)).withColumns(on_create)
    return stack([nodes, fresh.join(nodes.select(*NODE_KEY), NODE_KEY, "left_anti")])


def merge_edges(edges: DataFrame, rows: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """MERGE of edges: one edge per (source, destination, type) and the ``also`` columns."""
    key = ["src_space", "src", "dst_space", "dst", "type", *also]
    fresh = first_per_key(rows, key, ["edge_id"])
    return stack([edges, fresh.join(edges.select(*key), key, "left_anti")])


def foreach_create(
    graph: PropertyGraph, rows: DataFrame, list_column: str, make_node: dict[str, Column], make_edge: dict[str, Column]
) -> PropertyGraph:
    """For each element of a list column (as ``element``) create a node and an edge."""
    each = rows.withColumn("element", F.explode(list_column))
    node_rows = first_per_key(
        each.select(*[v.alias(k) for k, v in make_node.items()]), NODE_KEY, ["id"]
    )
    edge_rows = each.select(*[v.alias(k) for k, v in make_edge.items()])
    nodes = stack([graph.nodes, node_rows.join(graph.nodes.select(*NODE_KEY), NODE_KEY, "left_anti")])
    return PropertyGraph(nodes, stack([graph.edges, edge_rows]))


def flag_and_alert(
    graph: PropertyGraph, flagged: DataFrame, suspicious: DataFrame, description: str
) -> PropertyGraph:
    """An ALERT node with a HAS_ALERT edge for each flagged transaction key, and
    ``SUSPICIOUS = 'true'`` on each suspicious node key."""
    alerts = flagged.select(
        F.lit("alert").alias("id_space"),
        F.concat(F.lit("alert:"), "id").alias("id"),
        F.array(F.lit("ALERT")).alias("labels"),
        F.lit(description).alias("DESCRIPTION"),
    ).distinct()
    links = flagged.select(
        F.lit("alert").alias("src_space"),
        F.concat(F.lit("alert:"), "id").alias("src"),
        F.col("id_space").alias("dst_space"),
        F.col("id").alias("dst"),
        F.lit("HAS_ALERT").alias("type"),
        F.concat(F.lit("HAS_ALERT:"), "id").alias("edge_id"),
    ).distinct()
    marked = graph_update(
        graph.nodes, suspicious.select(*NODE_KEY).distinct().withColumn("SUSPICIOUS", F.lit("true")), NODE_KEY
    )
    return PropertyGraph(stack([marked, alerts]), stack([graph.edges, links]))


def batch_ingest_report(before: DataFrame, batch: DataFrame, key: Sequence[str], rejected: DataFrame) -> DataFrame:
    """``status, num_rows``: ingested (new keys), updated (known keys), rejected."""
    known = before.select(*key).distinct().withColumn("_known", F.lit(True))
    status = F.when(F.col("_known"), "updated").otherwise("ingested")
    counted = batch.join(known, list(key), "left").select(status.alias("status"))
    return (
        counted.unionAll(rejected.select(F.lit("rejected")))
        .groupBy("status")
        .agg(F.count("*").alias("num_rows"))
    )
