"""Graphs derived from the input tables, each with the SQL that derives the same rows.

* ``hand_over``: a part passes from one buyer to its next buyer (customer -> customer).
* ``trade``: customer nation -> supplier nation with counts.
* ``supply``: the property graph of customers, orders, parts, suppliers, nations and regions.

The pairs behind edges that need a global order are written once per session and input folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trellis.model import PropertyGraph
from trellis.operators.ordering import next_row_pairs
from trellis.plans.registry import Tables
from trellis.session import forget_on_clear
from trellis.sources.frames import edges_from_dataframe, edges_from_fk, nodes_from_dataframe

_pairs: dict[tuple[str, str], DataFrame] = forget_on_clear({})

HAND_OVER = """
hand_over AS (
  SELECT src, dst, qty, price, ship FROM (
    SELECT o_custkey AS src,
           lead(o_custkey) OVER (PARTITION BY l_partkey
             ORDER BY l_shipdate, l_orderkey, l_linenumber, l_extendedprice) AS dst,
           CAST(l_quantity AS BIGINT) AS qty, l_extendedprice AS price, l_shipdate AS ship
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
  WHERE dst IS NOT NULL)"""

# The same edges with their ids.
HAND_OVER_IDS = """
hand_over_ids AS (
  SELECT src, dst, qty, eid FROM (
    SELECT o_custkey AS src,
           lead(o_custkey) OVER (PARTITION BY l_partkey
             ORDER BY l_shipdate, l_orderkey, l_linenumber, l_extendedprice) AS dst,
           CAST(l_quantity AS BIGINT) AS qty,
           concat_ws(':', CAST(l_partkey AS VARCHAR), CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS eid
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
  WHERE dst IS NOT NULL)"""

TRADE = """
trade AS (
  SELECT c_nationkey AS src, s_nationkey AS dst, count(*) AS n
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
  GROUP BY 1, 2)"""


def _next_buyers(t: Tables) -> DataFrame:
    sold = t.lineitem.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "o_custkey"
    )
    pairs = next_row_pairs(
        sold, ["l_partkey"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice"], ["o_custkey"]
    )
    return pairs.select(
        F.col("o_custkey").alias("src"),
        F.col("next_o_custkey").alias("dst"),
        F.col("l_quantity").cast("bigint").alias("qty"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_shipdate").alias("ship"),
        F.concat_ws(":", "l_partkey", "l_orderkey", "l_linenumber").alias("eid"),
    )


def hand_over(t: Tables) -> DataFrame:
    """Its rows are written once, as pairs; ids and other columns are derived as they are read."""
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key not in _pairs:
        _pairs[key] = _next_buyers(t)
    return _pairs[key]


def customers(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("id"))


def trade(t: Tables) -> DataFrame:
    return (
        t.lineitem.select("l_orderkey", "l_suppkey")
        .join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(F.col("c_nationkey").alias("src"), F.col("s_nationkey").alias("dst"))
        .agg(F.count("*").alias("n"))
    )


_graphs: dict[tuple[str, str], PropertyGraph] = {}


def supply(t: Tables) -> PropertyGraph:
    """Typed property graph; CONTAINS keeps parallel edges. The lazy frames are built once."""
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key not in _graphs:
        _graphs[key] = _supply(t)
    return _graphs[key]


def _supply(t: Tables) -> PropertyGraph:
    nodes = [
        nodes_from_dataframe(t.customer, "c_custkey", "customer", "Customer",
                             property_columns=["c_name", "c_acctbal", "c_mktsegment"]),
        nodes_from_dataframe(t.orders, "o_orderkey", "order", "Order",
                             property_columns=["o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]),
        nodes_from_dataframe(t.part, "p_partkey", "part", "Part",
                             property_columns=["p_name", "p_brand", "p_type", "p_size", "p_retailprice"]),
        nodes_from_dataframe(t.supplier, "s_suppkey", "supplier", "Supplier", property_columns=["s_name", "s_acctbal"]),
        nodes_from_dataframe(t.nation, "n_nationkey", "nation", "Nation", property_columns=["n_name"]),
        nodes_from_dataframe(t.region, "r_regionkey", "region", "Region", property_columns=["r_name"]),
    ]
    line_key = ["l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice"]
    edges = [
        edges_from_dataframe(t.orders, "o_custkey", "o_orderkey", "customer", "order", "PLACED", key_columns=["o_orderkey"]),
        edges_from_dataframe(t.lineitem, "l_orderkey", "l_partkey", "order", "part", "CONTAINS",
                             ["l_quantity", "l_extendedprice", "l_returnflag"], line_key),
        edges_from_dataframe(t.lineitem, "l_orderkey", "l_suppkey", "order", "supplier", "SUPPLIED_BY",
                             ["l_quantity"], line_key),
        edges_from_fk(t.customer, "c_custkey", "c_nationkey", "customer", "nation", "IN_NATION"),
        edges_from_fk(t.supplier, "s_suppkey", "s_nationkey", "supplier", "nation", "SUPPLIER_IN"),
        edges_from_fk(t.nation, "n_nationkey", "n_regionkey", "nation", "region", "IN_REGION"),
    ]
    return PropertyGraph.of(nodes, edges)
