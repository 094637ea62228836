"""Named queries: sources and sinks, graph import, cleaning, statistics and text."""

from __future__ import annotations

from pyspark.sql import functions as F

from trellis.functions import text as X
from trellis.model import PropertyGraph
from trellis.operators import clean, stats
from trellis.operators.mutate import batch_ingest_report
from trellis.plans.graphs import HAND_OVER, hand_over, supply
from trellis.plans.registry import query
from trellis.session import Scratch
from trellis.sources import files, frames, header
from trellis.sources.store import GraphStore

C = F.col
ORDER_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
PER_STATUS = "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1"


def per_status(df):
    return df.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


def folder(t) -> str:
    return Scratch(t.spark).root


# --- readers and writers ----------------------------------------------------------------------


@query("read_csv_typed", PER_STATUS)
def _(t):
    path = folder(t) + "/orders.csv"
    files.write_csv(t.orders, path, "|", header=False)
    return per_status(files.read_csv_typed(t.spark, path, ORDER_SCHEMA, "|", columns=["o_orderstatus", "o_totalprice"]))


@query("read_csv_glob", "SELECT o_orderpriority LIKE '1%' AS urgent, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def _(t):
    root = folder(t)
    files.write_csv(t.orders.filter("o_orderpriority like '1%'"), root + "/urgent", header=False)
    files.write_csv(t.orders.filter("o_orderpriority not like '1%'"), root + "/other", header=False)
    rows = files.read_csv_glob(t.spark, root, "part-*.csv", ORDER_SCHEMA)
    return rows.filter(F.length("file_name") > 0).groupBy(C("o_orderpriority").like("1%").alias("urgent")).agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query("read_parquet", "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1")
def _(t):
    rows = files.read_parquet(t.spark, f"{t.folder}/lineitem.parquet", ["l_returnflag"])
    return rows.groupBy("l_returnflag").agg(F.count("*").alias("n"))


@query("read_json_lines", "SELECT user_id, count(*) AS n, CAST(sum(CASE WHEN value > 50 THEN CAST(json_extract(props, '$.k') AS BIGINT) ELSE -1 END) AS BIGINT) AS k FROM events GROUP BY 1")
def _(t):
    path = folder(t) + "/events.json"
    k = F.from_json("props", "k bigint")["k"]
    t.events.select("user_id", F.when(C("value") > 50, k).alias("k")).write.json(path)
    rows = files.read_json_lines(t.spark, path, "user_id bigint, k bigint", {"k": -1})
    return rows.groupBy("user_id").agg(F.count("*").alias("n"), F.sum("k").alias("k"))


@query("read_text_records", "SELECT c_custkey AS id, c_mktsegment AS segment, CASE WHEN c_acctbal >= 0 THEN c_name END AS name FROM customer")
def _(t):
    path = folder(t) + "/records"
    lines = F.concat(
        F.lit("id: "), C("c_custkey").cast("string"), F.lit("\nreview/segment: "), C("c_mktsegment"),
        F.when(C("c_acctbal") >= 0, F.concat(F.lit("\nname: "), C("c_name"))).otherwise(""), F.lit("\n"),
    )
    t.customer.select(lines.alias("value")).write.text(path)
    rows = files.read_text_records(t.spark, path, {"id": "id", "review/segment": "segment", "name": "name"})
    return rows.withColumn("id", C("id").cast("bigint"))


@query("csv_to_parquet", "SELECT CAST(year(o_orderdate) AS BIGINT) AS y, count(*) AS n FROM orders GROUP BY 1")
def _(t):
    root = folder(t)
    text = t.orders.select("o_orderkey", F.date_format("o_orderdate", "dd/MM/yyyy").alias("d"))
    files.write_csv(text, root + "/csv", "|")
    files.csv_to_parquet(t.spark, root + "/csv", root + "/parquet", "o_orderkey bigint, d string", {"d": F.to_date("d", "dd/MM/yyyy")})
    return files.read_parquet(t.spark, root + "/parquet").groupBy(F.year("d").cast("bigint").alias("y")).agg(F.count("*").alias("n"))


@query("write_csv", PER_STATUS)
def _(t):
    path = folder(t) + "/out"
    files.write_csv(per_status(t.orders), path, ";", gzip=True, null_text="NULL", single_file=True)
    return files.read_csv_typed(t.spark, path, "o_orderstatus string, n bigint, total double", ";", header=True, null_value="NULL")


@query("write_parquet", PER_STATUS)
def _(t):
    path = folder(t) + "/out"
    files.write_parquet(t.orders.select("o_orderstatus", "o_totalprice"), path, ["o_orderstatus"])
    return per_status(files.read_parquet(t.spark, path))


@query("range_partition_write", "SELECT CAST(CASE WHEN o_totalprice < 100000 THEN 0 WHEN o_totalprice < 300000 THEN 1 ELSE 2 END AS BIGINT) AS part, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY 1")
def _(t):
    path = folder(t) + "/out"
    files.range_partition_write(t.orders.select("o_orderkey", "o_totalprice"), path, "o_totalprice", [100000.0, 300000.0])
    rows = files.read_parquet(t.spark, path)
    return rows.groupBy(C("part").cast("bigint").alias("part")).agg(F.count("*").alias("n"), F.max("o_totalprice").alias("top"))


@query("repartition")
def _(t):
    return files.partition_profile(files.repartition(t.orders, 4, "o_custkey"))


@query("write_query_partitions")
def _(t):
    path = folder(t) + "/out"
    files.write_query_partitions(per_status(t.orders), path, 2)
    return files.first_rows_of_one_file(t.spark, path, 3)


@query("write_table_sql", "SELECT md5(url) AS note_id, page_id FROM pages")
def _(t):
    files.write_table_sql(t.pages.select("page_id", "url"), "notes", "note_id", "url")
    return t.spark.sql("SELECT note_id, page_id FROM notes")


@query("export_feature_table", "SELECT user_id, event_id, round(value, 2) AS value, strftime(date_trunc('day', ts), '%Y-%m-%d') AS event_timestamp FROM events")
def _(t):
    rows = files.export_feature_table(t.events.withColumn("value", F.round("value", 2)), "user_id", "ts", ["event_id", "value"])
    return rows.withColumn("event_timestamp", F.date_format("event_timestamp", "yyyy-MM-dd"))


@query("lookup_join_pipeline", "SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 40) AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY 1")
def _(t):
    rows = files.lookup_join_pipeline(
        t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey"),
        [(t.part.filter("p_size > 40"), "l_partkey", "p_partkey"), (t.supplier.filter("s_acctbal > 0"), "l_suppkey", "s_suppkey")],
    )
    return rows.groupBy("l_orderkey").agg(F.count("*").alias("n"))


# --- graph import -----------------------------------------------------------------------------

NODE_HEADER = "DEFAULT_LABEL=Customer\nc_custkey:ID(customer)|c_name:STRING|c_acctbal:DOUBLE|:IGNORE\ncustomers\n\nDEFAULT_LABEL=Nation\nn_nationkey:ID(nation)|n_name:STRING\nnations"
EDGE_HEADER = "DEFAULT_TYPE=IN_NATION\n:START_ID(customer)|:END_ID(nation)|since:LONG\nin_nation"
IMPORTED = "SELECT (SELECT count(*) FROM customer) + 25 AS num_nodes, (SELECT count(*) FROM customer WHERE c_nationkey < 20) AS num_edges, (SELECT round(sum(c_acctbal), 2) FROM customer) AS balance"


def _header_files(t, kind: str):
    """Customer, nation and edge files; edges of nations 20 and up point to unknown nations."""
    root = folder(t)
    known = F.when(C("c_nationkey") < 20, C("c_nationkey")).otherwise(C("c_nationkey") + 1000)
    parts = {
        "customers": t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"),
        "nations": t.nation.select("n_nationkey", "n_name"),
        "in_nation": t.customer.select("c_custkey", known.alias("n"), F.lit(2000).cast("bigint").alias("since")),
    }
    for name, df in parts.items():
        if kind == "csv":
            files.write_csv(df, f"{root}/{name}", "|", header=False)
        else:
            files.write_parquet(df, f"{root}/{name}")
    return root


def _imported(t, kind: str):
    g = header.read_graph_header(t.spark, NODE_HEADER, EDGE_HEADER, _header_files(t, kind), kind)
    total = g.nodes.agg(F.round(F.sum("c_acctbal"), 2).alias("balance")).withColumn("k", F.lit(1))
    return g.counts().withColumn("k", F.lit(1)).join(total, "k").drop("k")


@query("read_graph_header_csv", IMPORTED)
def _(t):
    return _imported(t, "csv")


@query("read_graph_header_parquet", IMPORTED)
def _(t):
    return _imported(t, "parquet")


@query("split_combined_export", """SELECT kind, name, count(*) AS n FROM (SELECT 'node' AS kind, 'Customer' AS name FROM customer UNION ALL SELECT 'node', 'Debtor' FROM customer WHERE c_acctbal < 0
  UNION ALL SELECT 'node', 'Nation' FROM nation UNION ALL SELECT 'edge', 'IN_NATION' FROM customer) GROUP BY ALL""")
def _(t):
    label = F.when(C("c_acctbal") < 0, ":Customer:Debtor").otherwise(":Customer")
    export = (
        t.customer.select(F.concat(F.lit("c"), "c_custkey").alias("_id"), label.alias("_labels"), "c_name")
        .unionByName(t.nation.select(F.concat(F.lit("n"), "n_nationkey").alias("_id"), F.lit(";Nation").alias("_labels")), allowMissingColumns=True)
        .unionByName(
            t.customer.select(F.concat(F.lit("c"), "c_custkey").alias("_start"), F.concat(F.lit("n"), "c_nationkey").alias("_end"), F.lit("IN_NATION").alias("_type")),
            allowMissingColumns=True,
        )
    )
    nodes, edges = frames.split_combined_export(export)
    n = stats.label_histogram(nodes).select(F.lit("node").alias("kind"), C("label").alias("name"), "n")
    return n.unionAll(edges.groupBy(F.lit("edge").alias("kind"), C("type")).agg(F.count("*")))


def _graphml(t) -> str:
    """All customers and hand-overs as a folder of GraphML files."""
    path = folder(t) + "/graphml"
    nodes = t.customer.select(F.concat(F.lit("n"), "c_custkey").alias("id"), F.lit(":Customer").alias("labels"), C("c_name").alias("name"), C("c_acctbal").cast("string").alias("balance"))
    edges = hand_over(t).select(F.concat(F.lit("n"), "src").alias("src"), F.concat(F.lit("n"), "dst").alias("dst"), F.lit("HANDED_TO").alias("label"), "qty")
    files.write_graphml(nodes, edges, path, ["name", "balance"], ["qty"])
    return path


@query("read_graphml", "SELECT 'n' || CAST(c_custkey AS VARCHAR) AS _id, ':Customer' AS _labels, c_name AS name, CAST(NULL AS VARCHAR) AS absent FROM customer")
def _(t):
    return files.read_graphml(t.spark, _graphml(t), "node", ["name", "absent"])


@query("read_graphml_edges", f"WITH {HAND_OVER} SELECT 'n' || CAST(src AS VARCHAR) AS _source, 'n' || CAST(dst AS VARCHAR) AS _target, 'HANDED_TO' AS _label, CAST(qty AS VARCHAR) AS qty FROM hand_over")
def _(t):
    return files.read_graphml(t.spark, _graphml(t), "edge", ["qty"])


@query("nodes_from_dataframe", "SELECT 'supplier' AS id_space, CAST(s_suppkey AS VARCHAR) AS id, 'Supplier' AS label, s_name FROM supplier")
def _(t):
    rows = frames.nodes_from_dataframe(t.supplier.withColumn("LABEL", F.array(F.lit("A"), F.lit("B"))), "s_suppkey", "supplier", "Supplier", property_columns=["s_name"])
    return rows.select("id_space", "id", F.array_join("labels", ",").alias("label"), "s_name")


@query("edges_from_dataframe", "SELECT CAST(c_custkey AS VARCHAR) AS src, CAST(c_nationkey AS VARCHAR) AS dst, 'IN_NATION' AS type FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
def _(t):
    nation = t.nation.filter("n_regionkey = 1")
    nodes = frames.nodes_from_dataframe(t.customer, "c_custkey", "customer", "Customer", property_columns=[]).unionByName(
        frames.nodes_from_dataframe(nation, "n_nationkey", "nation", "Nation", property_columns=[])
    )
    edges = frames.edges_from_dataframe(t.customer, "c_custkey", "c_nationkey", "customer", "nation", "IN_NATION")
    return PropertyGraph(nodes, edges).resolved().edges.select("src", "dst", "type")


@query("add_reverse_edges", f"WITH {HAND_OVER} SELECT type, count(*) AS n, CAST(sum(qty) AS BIGINT) AS qty FROM (SELECT 'HANDS_TO' AS type, qty FROM hand_over UNION ALL SELECT 'GOT_FROM', qty FROM hand_over) GROUP BY 1")
def _(t):
    e = frames.edges_from_dataframe(hand_over(t), "src", "dst", "c", "c", "HANDS_TO", ["qty"], ["eid"])
    return frames.add_reverse_edges(e, "GOT_FROM").groupBy("type").agg(F.count("*").alias("n"), F.sum("qty").alias("qty"))


@query("edges_from_fk", "SELECT CAST(c_nationkey AS VARCHAR) AS dst, count(*) AS n FROM customer WHERE c_nationkey NOT IN (3, 4) GROUP BY 1")
def _(t):
    rows = t.customer.withColumn("fk", F.when(C("c_nationkey") == 3, "").when(C("c_nationkey") != 4, C("c_nationkey").cast("string")))
    e = frames.edges_from_fk(rows, "c_custkey", "fk", "customer", "nation", "IN_NATION")
    return e.groupBy("dst").agg(F.count("*").alias("n"))


@query("edges_from_sql_join", "SELECT CAST(c_custkey AS VARCHAR) AS src, CAST(o_orderkey AS VARCHAR) AS dst FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_totalprice > 400000")
def _(t):
    orders = t.orders.filter("o_totalprice > 400000").withColumn("cust", C("o_custkey").cast("string"))
    e = frames.edges_from_sql_join(t.customer, orders, ("c_custkey", "cust"), "c_custkey", "o_orderkey", ("customer", "order"), "PLACED", "string")
    return e.select("src", "dst")


@query("promote_column_to_nodes", "SELECT p_brand AS id, count(*) AS edges FROM part GROUP BY 1")
def _(t):
    nodes, edges = frames.promote_column_to_nodes(t.part, "p_partkey", "p_brand", "part", "brand", "Brand", "OF_BRAND")
    return nodes.select("id").join(edges.groupBy(C("dst").alias("id")).agg(F.count("*").alias("edges")), "id")


@query("explode_to_nodes_edges", """WITH w AS (SELECT DISTINCT p_partkey, trim(unnest([split_part(p_name, ' ', 1), ' ' || split_part(p_name, ' ', 2), 'x'])) AS w FROM part)
  SELECT w AS word, count(*) AS there, count(*) AS back FROM w WHERE length(w) > 2 GROUP BY 1""")
def _(t):
    lists = t.part.select("p_partkey", F.concat(F.replace("p_name", F.lit(" "), F.lit(", ")), F.lit(",x")).alias("words"))
    nodes, edges = frames.explode_to_nodes_edges(lists, "p_partkey", "words", "part", "word", "Word", ("HAS", "IN"))
    per = edges.groupBy(F.when(C("type") == "HAS", C("dst")).otherwise(C("src")).alias("id")).agg(
        F.count(F.when(C("type") == "HAS", 1)).alias("there"), F.count(F.when(C("type") == "IN", 1)).alias("back")
    )
    return nodes.select("id").join(per, "id").withColumnRenamed("id", "word")


@query("nested_json_to_graph", "SELECT CAST(user_id AS VARCHAR) AS entity_id, event_type AS code, count(*) AS n FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY ALL")
def _(t):
    body = F.to_json(F.struct(F.array(F.struct(C("user_id").cast("string").alias("entityId"), F.array("event_type").alias("vocabularyCodes"))).alias("entities")))
    _, codes, _ = files.nested_json_to_graph(t.events.select("event_id", body.alias("json")), "event_id", "json")
    return codes.groupBy("entity_id", "code").agg(F.count("*").alias("n"))


@query("relational_to_graph", "SELECT id_space, count(*) AS n FROM (SELECT 'region' AS id_space FROM region UNION ALL SELECT 'nation' FROM nation UNION ALL SELECT 'supplier' FROM supplier) GROUP BY 1")
def _(t):
    nodes, edges = frames.relational_to_graph(
        {"region": (t.region, "r_regionkey", "Region"), "nation": (t.nation, "n_nationkey", "Nation"), "supplier": (t.supplier, "s_suppkey", "Supplier")},
        [("nation", "n_regionkey", "region", "IN_REGION"), ("supplier", "s_nationkey", "nation", "IN_NATION")],
    )
    g = PropertyGraph(nodes, edges).resolved()
    return g.nodes.groupBy("id_space").agg(F.count("*").alias("n"))


@query("save_and_load_graph", "SELECT (SELECT count(*) FROM supplier) + 25 AS num_nodes, (SELECT count(*) FROM supplier) AS num_edges")
def _(t):
    store = GraphStore(t.spark, folder(t), "db", "supply")
    store.save(supply(t).project(["Supplier", "Nation"], ["SUPPLIER_IN"]))
    return store.load().counts()


@query("snapshot_at_version", "SELECT 1 AS version, 30 AS num_nodes, 25 AS num_edges UNION ALL SELECT 2, 30 + (SELECT count(*) FROM supplier), 25 + (SELECT count(*) FROM supplier) UNION ALL SELECT 3, 5 + (SELECT count(*) FROM supplier), 0")
def _(t):
    from trellis.operators.mutate import graph_delete

    store = GraphStore(t.spark, folder(t), "db", "supply")
    store.save(supply(t).project(["Nation", "Region"], ["IN_REGION"]))
    store.save(supply(t).project(["Supplier", "Nation", "Region"], ["SUPPLIER_IN", "IN_REGION"]))
    two = store.load(2)
    store.save(graph_delete(two, two.nodes_with("Nation")))
    return store.version_counts()


@query("batch_ingest_report", """SELECT status, count(*) AS num_rows FROM (SELECT CASE WHEN o_totalprice < 300000 THEN 'updated' ELSE 'ingested' END AS status FROM orders WHERE o_totalprice >= 200000
  UNION ALL SELECT 'rejected' FROM orders WHERE o_totalprice < 2000) GROUP BY 1""")
def _(t):
    return batch_ingest_report(
        t.orders.filter("o_totalprice < 300000"), t.orders.filter("o_totalprice >= 200000"), ["o_orderkey"], t.orders.filter("o_totalprice < 2000")
    )


# --- cleaning and statistics ------------------------------------------------------------------

# the same holes on both sides: discount 0 is missing, quantity below 3 is missing, most comments are missing
HOLES = "holes AS (SELECT l_orderkey, nullif(l_discount, 0) AS discount, CASE WHEN l_quantity >= 2 THEN l_quantity END AS quantity, CASE WHEN l_tax > 0.05 THEN l_returnflag END AS flag, CASE WHEN l_tax > 0.01 THEN l_linestatus END AS status FROM lineitem)"


def holes(t):
    return t.lineitem.select(
        "l_orderkey", F.nullif(C("l_discount"), F.lit(0.0)).alias("discount"), F.when(C("l_quantity") >= 2, C("l_quantity")).alias("quantity"),
        F.when(C("l_tax") > 0.05, C("l_returnflag")).alias("flag"), F.when(C("l_tax") > 0.01, C("l_linestatus")).alias("status"),
    )


@query("missing_profile", f"WITH {HOLES} " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", round(100.0 * count(*) FILTER ({c} IS NULL) / count(*), 6) AS pct_missing FROM holes" for c in ("l_orderkey", "discount", "quantity", "flag", "status")))
def _(t):
    return clean.missing_profile(holes(t)).withColumn("pct_missing", F.round("pct_missing", 6))


@query("missing_policy", f"""WITH {HOLES}, mode AS (SELECT discount AS m FROM holes WHERE discount IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
  SELECT coalesce(discount, m) AS discount, coalesce(status, 'Unknown') AS status, count(*) AS n, sum(quantity) AS quantity FROM holes, mode WHERE quantity IS NOT NULL GROUP BY ALL""")
def _(t):
    rows = clean.missing_policy(holes(t), ["discount"])
    return rows.groupBy("discount", "status").agg(F.count("*").alias("n"), F.sum("quantity").alias("quantity"))


@query("drop_sparse_columns", f"WITH {HOLES} SELECT l_orderkey % 10 AS k, count(discount) AS discount, count(quantity) AS quantity, count(status) AS status FROM holes GROUP BY 1")
def _(t):
    rows = clean.drop_sparse_columns(holes(t))
    kept = [c for c in rows.columns if c != "l_orderkey"]
    return rows.groupBy((C("l_orderkey") % 10).alias("k")).agg(*[F.count(c).alias(c) for c in kept])


@query("describe_column", """SELECT count(l_extendedprice) AS count, round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS std, round(stddev_pop(l_extendedprice), 4) AS std_pop,
  round(stddev_samp(l_extendedprice) / sqrt(count(*)), 4) AS std_error, min(l_extendedprice) AS min, max(l_extendedprice) AS max,
  round((avg(pow(l_extendedprice, 3)) - 3 * avg(l_extendedprice) * avg(pow(l_extendedprice, 2)) + 2 * pow(avg(l_extendedprice), 3)) / pow(stddev_pop(l_extendedprice), 3), 4) AS skewness,
  round(quantile_cont(l_extendedprice, 0.25), 4) AS q25, round(median(l_extendedprice), 4) AS median, round(quantile_cont(l_extendedprice, 0.75), 4) AS q75 FROM lineitem""")
def _(t):
    row = stats.describe_column(t.lineitem, "l_extendedprice")
    return row.select(*[c if c in ("count", "min", "max") else F.round(c, 4).alias(c) for c in row.columns])


@query("median_by_group", "SELECT l_returnflag, l_linestatus, round(median(l_extendedprice), 4) AS median FROM lineitem GROUP BY ALL")
def _(t):
    rows = stats.median_by_group(t.lineitem, ["l_returnflag", "l_linestatus"], "l_extendedprice")
    return rows.withColumn("median", F.round("median", 4))


@query("quantile", "SELECT round(quantile_cont(value, 0.9), 6) AS quantile FROM events")
def _(t):
    return stats.quantile(t.events, "value", 0.9).select(F.round("quantile", 6).alias("quantile"))


@query("boxplot_stats", """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, median(value) AS median, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1)
  SELECT event_type, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, min(value) FILTER (value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1)) AS whisker_low,
  max(value) FILTER (value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1)) AS whisker_high, count(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS outliers
  FROM events JOIN q USING (event_type) GROUP BY ALL""")
def _(t):
    rows = stats.boxplot_stats(t.events, ["event_type"], "value")
    return rows.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("correlation_matrix", " UNION ALL ".join(f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 8) AS corr FROM lineitem" for i, a in enumerate(CORR) for b in CORR[i:]))
def _(t):
    return stats.correlation_matrix(t.lineitem, CORR).withColumn("corr", F.round("corr", 8))


@query("brown_forsythe_f", """WITH m AS (SELECT c_mktsegment, median(c_acctbal) AS md FROM customer GROUP BY 1), z AS (SELECT c_mktsegment AS g, abs(c_acctbal - md) AS z FROM customer JOIN m USING (c_mktsegment)),
  g AS (SELECT g, count(*) AS n, avg(z) AS m, var_pop(z) AS v FROM z GROUP BY 1), t AS (SELECT avg(z) AS gm, count(*) AS big FROM z)
  SELECT round((max(big) - count(*)) / (count(*) - 1) * sum(n * pow(m - gm, 2)) / sum(n * v), 6) AS f_statistic, count(*) - 1 AS df1, max(big) - count(*) AS df2 FROM g, t""")
def _(t):
    return stats.brown_forsythe_f(t.customer, "c_mktsegment", "c_acctbal").withColumn("f_statistic", F.round("f_statistic", 6))


@query("welch_t", """WITH s AS (SELECT count(*) FILTER (c_mktsegment = 'MACHINERY') AS na, count(*) FILTER (c_mktsegment = 'BUILDING') AS nb, avg(c_acctbal) FILTER (c_mktsegment = 'MACHINERY') AS ma, avg(c_acctbal) FILTER (c_mktsegment = 'BUILDING') AS mb,
  var_samp(c_acctbal) FILTER (c_mktsegment = 'MACHINERY') AS va, var_samp(c_acctbal) FILTER (c_mktsegment = 'BUILDING') AS vb FROM customer)
  SELECT round((ma - mb) / sqrt(va / na + vb / nb), 6) AS t, round(pow(va / na + vb / nb, 2) / (pow(va / na, 2) / (na - 1) + pow(vb / nb, 2) / (nb - 1)), 4) AS df FROM s""")
def _(t):
    row = stats.welch_t(t.customer, "c_mktsegment", "MACHINERY", "BUILDING", "c_acctbal")
    return row.select(F.round("t", 6).alias("t"), F.round("df", 4).alias("df"))


DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


@query("crosstab_pivot", "SELECT monthname(o_orderdate) AS month, " + ", ".join(f"count(*) FILTER (dayname(o_orderdate) = '{d}') AS {d}" for d in DAYS) + " FROM orders GROUP BY 1")
def _(t):
    return stats.crosstab_pivot(t.orders, F.date_format("o_orderdate", "MMMM"), F.date_format("o_orderdate", "EEEE"), DAYS, "month")


BUCKET = "CAST('0x' || left(md5(concat('{seed}:', CAST({key} AS VARCHAR))), 8) AS BIGINT) % {n}"


@query("sample_fraction", f"SELECT event_id, user_id FROM events WHERE {BUCKET.format(seed=3, key='event_id', n=10000)} < 100")
def _(t):
    return clean.sample_fraction(t.events, "event_id", 0.01, 3).select("event_id", "user_id")


@query("derive_age", "SELECT CAST(year(l_shipdate) - (1990 + l_linenumber * 2) AS BIGINT) AS age, count(*) AS n FROM lineitem WHERE year(l_shipdate) - (1990 + l_linenumber * 2) >= 0 GROUP BY 1")
def _(t):
    rows = t.lineitem.withColumn("made", 1990 + C("l_linenumber") * 2)
    return clean.derive_age(rows, "l_shipdate", "made", "age").groupBy(C("age").cast("bigint").alias("age")).agg(F.count("*").alias("n"))


@query("standardize_records", """SELECT o_orderkey AS id, round(o_totalprice, 2) AS price, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders WHERE o_orderstatus <> 'P'""")
def _(t):
    raw = t.orders.select(
        C("o_orderkey").cast("string").alias("id"), F.when(C("o_orderstatus") == "P", "n/a").otherwise(C("o_totalprice").cast("decimal(18,2)").cast("string")).alias("price"),
        F.when(C("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
    ).unionAll(t.region.select(F.lit("id"), F.lit("price"), F.lit("day")))  # a header row per file
    from trellis.functions.scalar import cast_or_default, first_parsed

    return clean.standardize_records(
        raw, {"id": cast_or_default("id", "bigint"), "price": cast_or_default("price", "double"),
              "day": F.date_format(first_parsed("day", ["dd/MM/yyyy", "yyyy-MM-dd"]), "yyyy-MM-dd")},
        ["id", "price", "day"], ("id", "id"),
    )


@query("dedupe_keep_first", "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1")
def _(t):
    return clean.dedupe_keep_first(t.events, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("graph_quality_rules", """WITH owned AS (SELECT c_custkey AS id, count(o_orderkey) AS n, coalesce(min(CASE WHEN length(o_orderpriority) > 5 THEN o_orderpriority END), '') AS valid
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1)
  SELECT 'short_text' AS rule, 'o' || o_orderkey AS id, o_orderpriority AS detail FROM orders WHERE length(o_orderpriority) < 6 UNION ALL SELECT 'too_many', 'c' || id, CAST(n AS VARCHAR) FROM owned WHERE n > 15
  UNION ALL SELECT 'neighbour_count', 'c' || id, CAST(n AS VARCHAR) FROM owned UNION ALL
  SELECT 'valid_text', 'c' || c_custkey, coalesce((SELECT min(CASE WHEN length(o_orderpriority) > 6 THEN o_orderpriority END) FROM orders WHERE o_custkey = c_custkey), '') FROM customer""")
def _(t):
    nodes = t.customer.select(F.concat(F.lit("c"), "c_custkey").alias("id"), F.lit("person").alias("label")).unionByName(
        t.orders.select(F.concat(F.lit("o"), "o_orderkey").alias("id"), F.lit("address").alias("label"), C("o_orderpriority").alias("text")),
        allowMissingColumns=True,
    )
    edges = t.orders.select(F.concat(F.lit("c"), "o_custkey").alias("src"), F.concat(F.lit("o"), "o_orderkey").alias("dst"))
    return clean.graph_quality_rules(nodes, edges, "text", "person", "address", 6, 15)


@query("class_balance_split", """SELECT label, split, count(*) AS n, min(vec_id) AS lowest FROM (SELECT *, CASE WHEN rn < 0.9 * size THEN 'train' WHEN rn < 0.95 * size THEN 'val' ELSE 'test' END AS split FROM (
  SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY md5(concat('5:', CAST(vec_id AS VARCHAR))), vec_id) - 1 AS rn, count(*) OVER (PARTITION BY label) AS size FROM embeddings)) GROUP BY ALL""")
def _(t):
    rows = clean.class_balance_split(t.embeddings.select("vec_id", "label"), "vec_id", "label", {"train": 0.9, "val": 0.05, "test": 0.05}, 5)
    return rows.groupBy("label", "split").agg(F.count("*").alias("n"), F.min("vec_id").alias("lowest"))


# --- text -------------------------------------------------------------------------------------

STOPS = ("the", "and", "of", "in", "le", "la", "der", "die", "und", "de")
TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')"
KEPT = f"list_filter({TOKENS}, lambda w: NOT list_contains({list(STOPS)}, w))"


def _pairs(condition: str = "true") -> str:
    return f"""SELECT bigram, count(*) AS documents FROM (SELECT DISTINCT doc_id, unnest(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) AS bigram
  FROM (SELECT doc_id, {KEPT} AS w FROM documents LEFT JOIN labels USING (doc_id) WHERE {condition})) GROUP BY 1 ORDER BY documents DESC, bigram LIMIT 10"""


@query("tokenize", f"SELECT doc_id, CAST(len({KEPT}) AS BIGINT) AS n, {KEPT}[1] AS first FROM documents")
def _(t):
    tokens = X.tokenize("text", STOPS)
    return t.documents.select("doc_id", tokens.alias("t")).select(
        "doc_id", F.size("t").cast("bigint").alias("n"), F.get("t", F.lit(0)).alias("first")
    )


@query("bigrams_topk", _pairs())
def _(t):
    return X.bigrams_topk(t.documents, "text", 10, STOPS)


@query("conditional_bigrams", _pairs("quality = 0"))
def _(t):
    return X.bigrams_topk(t.documents.join(t.labels, "doc_id"), "text", 10, STOPS, C("quality") == 0)


@query("distinct_token_count", f"SELECT count(DISTINCT w) AS vocabulary FROM (SELECT unnest({TOKENS}) AS w FROM documents)")
def _(t):
    return X.distinct_token_count(t.documents, "text")


TOP100 = f"top AS (SELECT token, count(*) AS n FROM (SELECT unnest({TOKENS}) AS token FROM documents) GROUP BY 1 ORDER BY n DESC, token LIMIT 100)"


@query("top_tokens", f"WITH {TOP100} SELECT token, n FROM top")
def _(t):
    return X.top_tokens(t.documents, "text", 100)


@query("binary_token_vectors", f"""WITH {TOP100}, v AS (SELECT list(token ORDER BY n DESC, token) AS v FROM top)
  SELECT item_id, array_to_string(list_transform(v, lambda x: CASE WHEN list_contains({TOKENS}, x) THEN 1 ELSE 0 END), '') AS vector FROM benchmark, v""")
def _(t):
    words = [r[0] for r in X.top_tokens(t.documents, "text", 100).collect()]
    rows = X.binary_token_vectors(t.benchmark, "item_id", "text", words)
    return rows.withColumn("vector", F.array_join(C("vector").cast("array<string>"), ""))


@query("sentiment_tag", "SELECT CASE WHEN l_linenumber > 3 THEN 'positive' ELSE 'negative' END AS sentiment, count(*) AS n FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy(X.sentiment_tag("l_linenumber").alias("sentiment")).agg(F.count("*").alias("n"))


VOTES = "(CAST(json_extract(props, '$.k') AS BIGINT) % 10)"


@query("helpfulness_ratio", f"""SELECT event_id, CASE WHEN user_id % 10 >= 1 THEN round({VOTES} / (user_id % 10)::DOUBLE, 6) END AS ratio,
  coalesce(CASE WHEN user_id % 10 >= 1 THEN {VOTES} / (user_id % 10)::DOUBLE > 0.75 END, false) AS helpful FROM events""")
def _(t):
    k = F.from_json("props", "k bigint")["k"] % 10
    votes = t.events.select("event_id", F.concat_ws("/", k.cast("string"), (C("user_id") % 10).cast("string")).alias("votes"))
    return votes.select("event_id", F.round(X.helpfulness_ratio("votes"), 6).alias("ratio"), X.is_helpful("votes").alias("helpful"))


@query("length_by_group", "SELECT quality, round(avg(length(text)), 6) AS mean_length FROM documents JOIN labels USING (doc_id) GROUP BY 1")
def _(t):
    return t.documents.join(t.labels, "doc_id").groupBy("quality").agg(F.round(F.avg(F.length("text")), 6).alias("mean_length"))


@query("word_document_graph", f"""WITH t AS (SELECT doc_id, {KEPT} AS w FROM documents), s AS (SELECT doc_id, w AS word, count(*) / max(len)::DOUBLE AS score FROM (SELECT doc_id, len(w) AS len, unnest(w) AS w FROM t) GROUP BY ALL)
  SELECT word, count(*) AS documents, round(max(score), 8) AS best FROM s WHERE score > 0.02 GROUP BY 1""")
def _(t):
    words, said = X.word_document_graph(t.documents, "doc_id", "text", STOPS)
    strong = said.filter("score > 0.02")
    return words.join(strong, C("id") == C("src")).groupBy(C("id").alias("word")).agg(
        F.count("*").alias("documents"), F.round(F.max("score"), 8).alias("best")
    )


@query("entity_relation_table", """SELECT conv_id, turn, 'DRUG-' || CASE turn % 3 WHEN 0 THEN 'FORM' WHEN 1 THEN 'ROUTE' ELSE 'STRENGTH' END AS relation,
  CASE turn % 3 WHEN 1 THEN role ELSE role || ' ' || turn END AS rx_text, lower(role) AS resolved FROM conversations""")
def _(t):
    kind = F.element_at(F.array(F.lit("FORM"), F.lit("ROUTE"), F.lit("STRENGTH")), (C("turn") % 3 + 1).cast("int"))
    drug_first = C("turn") % 2 == 0
    meta = F.create_map(
        F.lit("entity1"), F.when(drug_first, "DRUG").otherwise(kind), F.lit("chunk1"), F.when(drug_first, C("role")).otherwise(C("turn").cast("string")),
        F.lit("entity2"), F.when(drug_first, kind).otherwise("DRUG"), F.lit("chunk2"), F.when(drug_first, C("turn").cast("string")).otherwise(C("role")),
        F.lit("confidence"), F.lit("0.9"),
    )
    rows = t.conversations.select("conv_id", "turn", F.array(F.concat(F.lit("DRUG-"), kind)).alias("r"), F.array(meta).alias("m"))
    from trellis.functions.scalar import first_of

    out = X.entity_relation_table(rows.withColumn("list", F.lit(1)), ["conv_id", "turn"], "r", "m")
    role = F.when(C("entity1") == "DRUG", C("chunk1")).otherwise(C("chunk2"))
    return out.select("conv_id", "turn", "relation", "rx_text", first_of(F.concat(F.upper(role), F.lit(":::X"))).alias("resolved"))
