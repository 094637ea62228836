"""Node and edge tables from DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trellis.model import stack
from trellis.session import materialize


def nodes_from_dataframe(
    df: DataFrame,
    id_column: str,
    id_space: str,
    label: str | None = None,
    label_column: str | None = None,
    property_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Node rows. With ``label`` every row gets that one label, even if the frame has a label
    column; with ``label_column`` a string or an array column gives the labels."""
    if (label is None) == (label_column is None):
        raise ValueError("give exactly one of label and label_column")
    if label is not None:
        labels = F.array(F.lit(label))
    elif dict(df.dtypes)[label_column].startswith("array"):
        labels = F.col(label_column)
    else:
        labels = F.array(F.col(label_column))
    props = list(df.columns if property_columns is None else property_columns)
    if label_column is not None and property_columns is None:
        props.remove(label_column)
    return df.select(
        F.lit(id_space).alias("id_space"),
        F.col(id_column).cast("string").alias("id"),
        labels.alias("labels"),
        *props,
    )


def edges_from_dataframe(
    df: DataFrame,
    source_column: str,
    destination_column: str,
    source_id_space: str,
    destination_id_space: str,
    type: str | Column,
    property_columns: Sequence[str] = (),
    key_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Edge rows. ``key_columns`` name a unique key of the input rows and give a stable edge id.
    Without them ids are numbered once and the numbered table is written to the shared folder,
    so a lost task cannot number it anew."""
    kind = F.lit(type) if isinstance(type, str) else type
    if key_columns is None:
        df = materialize(df.withColumn("_n", F.monotonically_increasing_id()), "edge_ids")
        key_columns = ["_n"]
    return df.select(
        F.lit(source_id_space).alias("src_space"),
        F.col(source_column).cast("string").alias("src"),
        F.lit(destination_id_space).alias("dst_space"),
        F.col(destination_column).cast("string").alias("dst"),
        kind.alias("type"),
        F.concat_ws(":", kind, *[F.col(k).cast("string") for k in key_columns]).alias("edge_id"),
        *property_columns,
    )


def add_reverse_edges(edges: DataFrame, type: str | None = None) -> DataFrame:
    """The edges and a copy with ends swapped, properties kept, optionally under another type."""
    kind = F.col("type") if type is None else F.lit(type)
    swapped = edges.withColumns(
        {
            "src_space": F.col("dst_space"),
            "src": F.col("dst"),
            "dst_space": F.col("src_space"),
            "dst": F.col("src"),
            "type": kind,
            "edge_id": F.concat(F.col("edge_id"), F.lit(":rev")),
        }
    )
    return edges.unionByName(swapped)


def edges_from_fk(
    df: DataFrame, id_column: str, fk_column: str, id_space: str, fk_space: str, type: str
) -> DataFrame:
    """One edge per row with a foreign key; rows without one yield only a node."""
    filled = F.col(fk_column).isNotNull() & (F.length(F.col(fk_column).cast("string")) > 0)
    return edges_from_dataframe(
        df.filter(filled), id_column, fk_column, id_space, fk_space, type, key_columns=[id_column]
    )


def edges_from_sql_join(
    left: DataFrame,
    right: DataFrame,
    on: tuple[str, str],
    left_id: str,
    right_id: str,
    spaces: tuple[str, str],
    type: str,
    cast_key: str | None = None,
) -> DataFrame:
    """Edges defined by a two-table join, optionally with both keys cast to one type."""
    lk, rk = F.col(f"l.{on[0]}"), F.col(f"r.{on[1]}")
    if cast_key:
        lk, rk = lk.cast(cast_key), rk.cast(cast_key)
    pairs = left.alias("l").join(right.alias("r"), lk == rk).select(
        F.col(f"l.{left_id}").alias("src"), F.col(f"r.{right_id}").alias("dst")
    )
    return edges_from_dataframe(pairs, "src", "dst", *spaces, type, key_columns=["src", "dst"])


def promote_column_to_nodes(
    df: DataFrame, id_column: str, column: str, id_space: str, value_space: str, label: str, type: str
) -> tuple[DataFrame, DataFrame]:
    """Distinct values of a column become nodes; each row links to its value."""
    filled = df.filter(F.col(column).isNotNull())
    values = filled.select(F.col(column).cast("string").alias("value")).distinct()
    nodes = nodes_from_dataframe(values, "value", value_space, label, property_columns=[])
    edges = edges_from_dataframe(
        filled, id_column, column, id_space, value_space, type, key_columns=[id_column]
    )
    return nodes, edges


def explode_to_nodes_edges(
    df: DataFrame,
    id_column: str,
    list_column: str,
    id_space: str,
    value_space: str,
    label: str,
    types: tuple[str, str],
    separator: str = ",",
    longer_than: int = 2,
) -> tuple[DataFrame, DataFrame]:
    """A separated list column becomes keyword nodes and edges in both directions; keywords are
    trimmed and kept when longer than ``longer_than`` characters."""
    pairs = (
        df.select(
            F.col(id_column).cast("string").alias("_id"),
            F.explode(F.split(list_column, separator)).alias("_word"),
        )
        .select("_id", F.trim("_word").alias("_word"))
        .filter(F.length("_word") > longer_than)
        .distinct()
    )
    nodes = nodes_from_dataframe(
        pairs.select("_word").distinct(), "_word", value_space, label, property_columns=[]
    )
    there = edges_from_dataframe(
        pairs, "_id", "_word", id_space, value_space, types[0], key_columns=["_id", "_word"]
    )
    back = edges_from_dataframe(
        pairs, "_word", "_id", value_space, id_space, types[1], key_columns=["_word", "_id"]
    )
    return nodes, there.unionByName(back)


def split_combined_export(
    df: DataFrame, id_column: str = "_id", label_column: str = "_labels", type_column: str = "_type"
) -> tuple[DataFrame, DataFrame]:
    """One export with node rows and edge rows in null-disjoint columns -> two tables. Labels may
    carry a leading ``:`` or ``;`` and several may be joined by either."""
    skip = {id_column, label_column, type_column, "_start", "_end"}
    props = [c for c in df.columns if c not in skip]
    bare = F.regexp_replace(label_column, "^[:;]+", "")
    nodes = df.filter(F.col(id_column).isNotNull()).select(
        F.lit("node").alias("id_space"),
        F.col(id_column).cast("string").alias("id"),
        F.split(bare, "[:;]").alias("labels"),
        *props,
    )
    edge_rows = df.filter(F.col(type_column).isNotNull())
    edges = edges_from_dataframe(
        edge_rows, "_start", "_end", "node", "node", F.col(type_column), props
    )
    return nodes, edges


def relational_to_graph(
    tables: dict[str, tuple[DataFrame, str, str]],
    links: Sequence[tuple[str, str, str, str]],
) -> tuple[DataFrame, DataFrame]:
    """Relational tables -> node and edge tables.

    ``tables``: name -> (frame, key column, label). ``links``: (table, foreign key, other table,
    edge type); the key values are compared as strings, so differing key types meet.
    """
    nodes = stack(
        nodes_from_dataframe(df, key, name, label) for name, (df, key, label) in tables.items()
    )
    edges = stack(
        edges_from_fk(tables[t][0], tables[t][1], fk, t, other, kind) for t, fk, other, kind in links
    )
    return nodes, edges
