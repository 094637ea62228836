"""Named queries: projections, predicates, scalar functions, ordering and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from trellis.functions import scalar as S
from trellis.model import stack
from trellis.operators import ordering, stats
from trellis.operators.match import Node, match_nodes
from trellis.plans.graphs import supply
from trellis.plans.registry import query

C = F.col


@query("match_nodes", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name FROM customer WHERE c_mktsegment = 'MACHINERY'")
def _(t):
    found = match_nodes(supply(t), Node("n", ("Customer",), C("c_mktsegment") == "MACHINERY", ("c_name",)))
    return found.select(C("n_id").alias("id"), C("n_c_name").alias("name"))


@query("match_any_label", """SELECT 'Nation' AS label, count(*) AS n FROM nation
  UNION ALL SELECT 'Region', count(*) FROM region UNION ALL SELECT 'Supplier', count(*) FROM supplier""")
def _(t):
    g = supply(t)
    wanted = F.arrays_overlap(C("labels"), F.array(F.lit("Nation"), F.lit("Region"), F.lit("Supplier")))
    return g.nodes.filter(wanted).groupBy(C("labels")[0].alias("label")).agg(F.count("*").alias("n"))


@query("negated_label", "SELECT (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier) + (SELECT count(*) FROM nation) + (SELECT count(*) FROM region) AS n")
def _(t):
    neither = ~F.arrays_overlap(C("labels"), F.array(F.lit("Order"), F.lit("Part")))
    return supply(t).nodes.filter(neither).agg(F.count("*").alias("n"))


@query("project_columns", "SELECT s_name AS supplier, round(s_acctbal * 2, 2) AS doubled, s_nationkey AS nation FROM supplier")
def _(t):
    return t.supplier.select(
        C("s_name").alias("supplier"), F.round(C("s_acctbal") * 2, 2).alias("doubled"), C("s_nationkey").alias("nation")
    )


@query("entity_functions", """SELECT CAST(n_nationkey AS VARCHAR) AS id, 'Nation' AS label, 'n_name' AS keys, n_name AS name,
  'IN_REGION' AS type, CAST(n_nationkey AS VARCHAR) AS start_node, CAST(n_regionkey AS VARCHAR) AS end_node FROM nation""")
def _(t):
    g = supply(t)
    props = ["c_name", "n_name", "r_name", "s_name", "p_name"]
    n = g.nodes_with("Nation").select(
        "id", C("labels")[0].alias("label"), F.array_join(S.keys_of(props), ",").alias("keys"),
        F.element_at(S.properties_of(props), "n_name").alias("name"),
    )
    e = g.edges_of("IN_REGION").select("type", C("src").alias("start_node"), C("dst").alias("end_node"))
    return n.join(e, n["id"] == e["start_node"])


@query("compare_predicates", """SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders
  WHERE o_totalprice >= 400000 AND o_orderpriority < '3' AND o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderstatus <> 'F'""")
def _(t):
    return t.orders.filter(
        (C("o_totalprice") >= 400000) & (C("o_orderpriority") < "3") & (C("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
        & (C("o_orderstatus") != "F")
    ).select("o_orderkey", "o_totalprice", "o_orderpriority")


@query("boolean_predicates", """SELECT p_partkey, p_brand FROM part
  WHERE (p_size < 10 AND NOT p_type = 'ECONOMY') OR (p_retailprice > 1050 AND p_size >= 40)""")
def _(t):
    return t.part.filter(
        ((C("p_size") < 10) & ~(C("p_type") == "ECONOMY")) | ((C("p_retailprice") > 1050) & (C("p_size") >= 40))
    ).select("p_partkey", "p_brand")


@query("null_predicates", """SELECT d.lang, count(*) FILTER (l.quality IS NULL) AS unlabelled,
  count(*) FILTER (l.quality IS NOT NULL) AS labelled FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1""")
def _(t):
    rows = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return rows.groupBy("lang").agg(
        F.count(F.when(C("quality").isNull(), 1)).alias("unlabelled"),
        F.count(F.when(C("quality").isNotNull(), 1)).alias("labelled"),
    )


@query("in_list", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('MACHINERY', 'FURNITURE')")
def _(t):
    return t.customer.filter(C("c_mktsegment").isin("MACHINERY", "FURNITURE")).select("c_custkey", "c_mktsegment")


@query("not_in_list", """SELECT event_type, count(*) AS n FROM events WHERE event_type NOT IN ('click', 'view')
  AND nullif(user_id, 3) NOT IN (1, 2) GROUP BY 1""")
def _(t):
    user = F.nullif(C("user_id"), F.lit(3))
    return (
        t.events.filter(~C("event_type").isin("click", "view") & ~user.isin(1, 2))
        .groupBy("event_type").agg(F.count("*").alias("n"))
    )


@query("prefix_predicate", """SELECT count(*) FILTER (starts_with(p_name, 'red')) AS red,
  count(*) FILTER (NOT starts_with(p_name, 'red')) AS others FROM part""")
def _(t):
    red = F.startswith(C("p_name"), F.lit("red"))
    return t.part.agg(F.count(F.when(red, 1)).alias("red"), F.count(F.when(~red, 1)).alias("others"))


@query("contains_predicate", """SELECT lang, count(*) AS n FROM documents
  WHERE contains(lower(text), 'license') OR contains(lower(text), 'password') GROUP BY 1""")
def _(t):
    low = F.lower("text")
    return (
        t.documents.filter(F.contains(low, F.lit("license")) | F.contains(low, F.lit("password")))
        .groupBy("lang").agg(F.count("*").alias("n"))
    )


@query("any_in_list_predicate", """SELECT p_partkey, p_name FROM part
  WHERE len(list_filter(['widget', 'gear', 'blue'], lambda w: contains(p_name, w))) > 0""")
def _(t):
    return t.part.filter(S.any_in_list("p_name", ["widget", "gear", "blue"])).select("p_partkey", "p_name")


@query("regex_predicate", "SELECT p_partkey, p_brand FROM part WHERE regexp_matches(p_brand, '^Brand#1[0-9]$')")
def _(t):
    return t.part.filter(C("p_brand").rlike("^Brand#1[0-9]$")).select("p_partkey", "p_brand")


@query("numeric_string_filter", """SELECT count(*) FILTER (regexp_full_match(v, '[0-9]+')) AS numeric,
  count(*) FILTER (NOT regexp_full_match(v, '[0-9]+')) AS other, CAST(sum(try_cast(v AS BIGINT)) AS BIGINT) AS total
  FROM (SELECT regexp_extract(o_orderpriority, '^[0-9]|[A-Z]+$') AS v FROM orders
        UNION ALL SELECT replace(o_orderpriority, '-', '') FROM orders)""")
def _(t):
    v = t.orders.select(F.regexp_extract("o_orderpriority", "^[0-9]|[A-Z]+$", 0).alias("v")).unionAll(
        t.orders.select(F.replace("o_orderpriority", F.lit("-"), F.lit("")))
    )
    numeric = S.is_numeric_text("v")
    return v.agg(
        F.count(F.when(numeric, 1)).alias("numeric"), F.count(F.when(~numeric, 1)).alias("other"),
        F.sum(S.cast_or_default("v", "bigint")).alias("total"),
    )


@query("date_range_filter", """SELECT CAST(year(o_orderdate) AS BIGINT) AS y, count(*) AS n FROM orders
  WHERE o_orderdate > TIMESTAMP '1996-03-01' AND o_orderdate <= TIMESTAMP '1998-09-30' GROUP BY 1""")
def _(t):
    d = C("o_orderdate")
    low, high = F.lit("1996-03-01").cast("timestamp_ntz"), F.lit("1998-09-30").cast("timestamp_ntz")
    return t.orders.filter((d > low) & (d <= high)).groupBy(F.year(d).cast("bigint").alias("y")).agg(F.count("*").alias("n"))


@query("row_range", """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 100""")
def _(t):
    return ordering.row_range(t.orders.select("o_orderkey", "o_totalprice"), [C("o_totalprice").desc(), "o_orderkey"], 100, 150)


@query("drop_every_second", """SELECT c_custkey FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS rn FROM customer) WHERE rn % 2 = 1""")
def _(t):
    return ordering.drop_every_second(t.customer.select("c_custkey", "c_acctbal"), ["c_acctbal", "c_custkey"]).select("c_custkey")


@query("select_drop_columns", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderstatus = 'F'")
def _(t):
    kept = [c for c in t.orders.columns if c.endswith(("key", "date"))]
    return t.orders.filter(C("o_orderstatus") == "F").select(*kept)


@query("rename_columns", "SELECT n_nationkey AS nation_id, n_name AS nation, n_regionkey FROM nation")
def _(t):
    return t.nation.withColumnsRenamed({"n_nationkey": "nation_id", "n_name": "nation"})


@query("add_const_or_copy_column", """SELECT s_suppkey, 'Supplier' AS label, lower(s_name) AS name_lower,
  CAST(s_suppkey AS VARCHAR) AS key_text, s_acctbal AS balance_copy FROM supplier""")
def _(t):
    return t.supplier.withColumns(
        {"label": F.lit("Supplier"), "name_lower": F.lower("s_name"), "key_text": C("s_suppkey").cast("string"),
         "balance_copy": C("s_acctbal")}
    ).select("s_suppkey", "label", "name_lower", "key_text", "balance_copy")


@query("add_sequence_column", """SELECT o_orderkey, concat('ord_', CAST(99 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS VARCHAR)) AS seq FROM orders""")
def _(t):
    return ordering.add_sequence_column(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], "seq", 100, "ord_").drop("o_orderdate")


@query("limit_head_skip", "SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 10 OFFSET 5")
def _(t):
    return t.events.select("event_id", "value").orderBy(C("value").desc(), "event_id").offset(5).limit(10)


@query("distinct_rows", """SELECT DISTINCT array_to_string([p_brand, p_type], '|') AS pair FROM part""")
def _(t):
    lists = t.part.select(F.array("p_brand", "p_type").alias("l")).distinct()
    return lists.select(F.array_join("l", "|").alias("pair"))


@query("drop_duplicates_subset", """SELECT l_partkey, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY 1""")
def _(t):
    from trellis.operators.clean import dedupe_keep_first

    return dedupe_keep_first(t.lineitem.select("l_partkey", "l_suppkey"), ["l_partkey"], ["l_suppkey"])


@query("paginate", """SELECT CAST((rn - 1) // 1000 AS BIGINT) AS page, count(*) AS num_rows, min(o_orderkey) AS lowest, max(o_totalprice) AS dearest
  FROM (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS rn FROM orders) GROUP BY 1""")
def _(t):
    pages = ordering.paginate(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], 1000)
    return pages.groupBy("page").agg(
        F.count("*").alias("num_rows"), F.min("o_orderkey").alias("lowest"), F.max("o_totalprice").alias("dearest")
    )


# --- scalar functions -------------------------------------------------------------------------


@query("fn_cast", """SELECT event_id, CAST(value AS BIGINT) - CASE WHEN CAST(value AS BIGINT) > value THEN 1 ELSE 0 END AS whole,
  coalesce(try_cast(substr(props, 7, 2) AS INTEGER), -1) AS k FROM events""")
def _(t):
    return t.events.select(
        "event_id", S.whole("value").cast("bigint").alias("whole"),
        S.cast_or_default(F.substring("props", 7, 2), "int", -1).alias("k"),
    )


@query("fn_conditional", """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END AS band FROM customer""")
def _(t):
    b = C("c_acctbal")
    return t.customer.select("c_custkey", F.when(b < 0, "debt").when(b < 5000, "low").otherwise("high").alias("band"))


@query("fn_recode", """SELECT code, kept, count(*) AS n FROM (
  SELECT CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' ELSE 'unknown' END AS code,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderpriority ELSE 'Other' END AS kept FROM orders) GROUP BY ALL""")
def _(t):
    return (
        t.orders.select(
            S.recode("o_orderstatus", {"F": "filled", "O": "open"}, "unknown").alias("code"),
            S.keep_or_other("o_orderpriority", ["1-URGENT", "2-HIGH"]).alias("kept"),
        ).groupBy("code", "kept").agg(F.count("*").alias("n"))
    )


@query("rare_to_other", """SELECT name, count(*) AS n FROM (
  SELECT CASE WHEN count(*) OVER (PARTITION BY p_name) >= 30 THEN p_name ELSE 'Other' END AS name FROM part) GROUP BY 1""")
def _(t):
    from trellis.operators.clean import rare_to_other

    return rare_to_other(t.part.select(C("p_name").alias("name")), "name", 30).groupBy("name").agg(F.count("*").alias("n"))


@query("fn_string", """SELECT c_custkey, c_mktsegment || '-' || CAST(c_nationkey AS VARCHAR) AS joined, lower(c_mktsegment) AS low,
  upper(c_name) AS up, replace(c_name, '#', ' ') AS replaced, left(c_mktsegment, 3) AS head, substr(c_mktsegment, 2) AS tail,
  length(trim('  ' || c_name || ' ')) AS len, split_part(c_name, '#', 2) AS part FROM customer""")
def _(t):
    return t.customer.select(
        "c_custkey", F.concat("c_mktsegment", F.lit("-"), C("c_nationkey").cast("string")).alias("joined"),
        F.lower("c_mktsegment").alias("low"), F.upper("c_name").alias("up"),
        F.replace("c_name", F.lit("#"), F.lit(" ")).alias("replaced"),
        S.left_text("c_mktsegment", 3).alias("head"), S.drop_first("c_mktsegment").alias("tail"),
        F.length(F.trim(F.concat(F.lit("  "), "c_name", F.lit(" ")))).cast("bigint").alias("len"),
        F.split("c_name", "#")[1].alias("part"),
    )


@query("fn_case_flip", """SELECT c_custkey, CASE WHEN upper(c_mktsegment) = c_mktsegment THEN lower(c_mktsegment) ELSE upper(c_mktsegment) END AS segment,
  CASE WHEN upper(c_name) = c_name THEN lower(c_name) ELSE upper(c_name) END AS name FROM customer""")
def _(t):
    return t.customer.select("c_custkey", S.case_flip("c_mktsegment").alias("segment"), S.case_flip("c_name").alias("name"))


@query("fn_list", """SELECT p_partkey, split_part(p_name, ' ', 2) AS second, len(string_split(p_name, ' ')) AS size,
  list_contains(string_split(p_name, ' '), 'red') AS has_red, array_to_string(list_concat(string_split(p_name, ' '), [p_type]), '|') AS joined FROM part""")
def _(t):
    words = F.split("p_name", " ")
    return t.part.select(
        "p_partkey", words[1].alias("second"), F.size(words).cast("bigint").alias("size"),
        F.array_contains(words, "red").alias("has_red"),
        F.array_join(F.concat(words, F.array("p_type")), "|").alias("joined"),
    )


@query("fn_map", """SELECT s_suppkey, s_name AS name, CAST(s_nationkey AS BIGINT) AS nation FROM supplier""")
def _(t):
    rows = t.supplier.select(
        "s_suppkey", F.struct(C("s_name").alias("name")).alias("s"),
        F.create_map(F.lit("nation"), C("s_nationkey").cast("bigint")).alias("m"),
    )
    return rows.select("s_suppkey", C("s.name").alias("name"), C("m")["nation"].alias("nation"))


@query("fn_json", """SELECT CAST(json_extract(props, '$.k') AS BIGINT) % 10 AS k, count(*) AS n,
  CAST(sum(coalesce(try_cast(json_extract_string(props, '$.absent') AS BIGINT), -1)) AS BIGINT) AS absent FROM events GROUP BY 1""")
def _(t):
    j = F.from_json("props", "k bigint, absent bigint")
    rows = t.events.select((j["k"] % 10).alias("k"), F.coalesce(j["absent"], F.lit(-1)).alias("absent"))
    return rows.groupBy("k").agg(F.count("*").alias("n"), F.sum("absent").alias("absent"))


@query("fn_date", """SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS month_key, dayname(o_orderdate) AS weekday,
  monthname(o_orderdate) AS month, CAST(year(o_orderdate) AS BIGINT) AS y, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_start,
  strftime(o_orderdate, '%d/%m/%Y') AS parsed_back FROM orders""")
def _(t):
    d = C("o_orderdate")
    text = F.when(C("o_orderkey") % 2 == 0, F.date_format(d, "dd/MM/yyyy")).otherwise(F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
    parsed = S.first_parsed(text, ["dd/MM/yyyy", "yyyy-MM-dd HH:mm:ss"])
    return t.orders.select(
        "o_orderkey", S.month_key(d).alias("month_key"), S.weekday_name(d).alias("weekday"), S.month_name(d).alias("month"),
        F.year(d).cast("bigint").alias("y"), F.date_format(F.date_trunc("month", d), "yyyy-MM-dd").alias("month_start"),
        F.date_format(parsed, "dd/MM/yyyy").alias("parsed_back"),
    )


@query("fn_math", """SELECT l_linenumber, CAST(sum(trunc(l_quantity * 1.60934)) AS BIGINT) AS km, round(sum(abs(l_discount - l_tax)), 4) AS gap,
  round(sum(pow(l_quantity, 2)), 2) AS squares, count(*) FILTER (CASE WHEN l_tax > 0 THEN l_discount / l_tax END IS NULL) AS no_ratio
  FROM lineitem GROUP BY 1""")
def _(t):
    return t.lineitem.groupBy("l_linenumber").agg(
        F.sum(S.whole(C("l_quantity") * 1.60934)).alias("km"),
        F.round(F.sum(F.abs(C("l_discount") - C("l_tax"))), 4).alias("gap"),
        F.round(F.sum(F.pow("l_quantity", F.lit(2))), 2).alias("squares"),
        F.count(F.when(S.safe_ratio("l_discount", "l_tax").isNull(), 1)).alias("no_ratio"),
    )


@query("fn_hash", "SELECT doc_id, md5(text) AS digest FROM documents")
def _(t):
    return t.documents.select("doc_id", F.md5("text").alias("digest"))


@query("fn_null", """SELECT event_type, round(sum(coalesce(nullif(value, 0), -1)), 2) AS total, count(nullif(event_type, 'click')) AS kept FROM events GROUP BY 1""")
def _(t):
    return t.events.groupBy("event_type").agg(
        F.round(F.sum(F.coalesce(F.nullif(C("value"), F.lit(0.0)), F.lit(-1.0))), 2).alias("total"),
        F.count(F.nullif(C("event_type"), F.lit("click"))).alias("kept"),
    )


# --- ordering and set operations --------------------------------------------------------------


@query("order_by", """SELECT p_partkey, row_number() OVER (ORDER BY p_brand DESC NULLS LAST, p_size ASC NULLS LAST, p_partkey) AS position FROM part""")
def _(t):
    order = [C("p_brand").desc_nulls_last(), C("p_size").asc_nulls_last(), "p_partkey"]
    return ordering.global_row_number(t.part.select("p_partkey", "p_brand", "p_size"), order, "position").select("p_partkey", "position")


@query("top_k", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20")
def _(t):
    return t.customer.select("c_custkey", "c_acctbal").orderBy(C("c_acctbal").desc(), "c_custkey").limit(20)


@query("top_k_by_value", "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 10")
def _(t):
    return t.lineitem.groupBy("l_partkey").agg(F.count("*").alias("n")).orderBy(C("n").desc(), "l_partkey").limit(10)


@query("limit_then_continue", """WITH top AS (SELECT c_custkey FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20)
  SELECT c_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS spent FROM top JOIN orders ON o_custkey = c_custkey GROUP BY 1""")
def _(t):
    top = t.customer.select("c_custkey", "c_acctbal").orderBy(C("c_acctbal").desc(), "c_custkey").limit(20)
    return top.join(t.orders, C("o_custkey") == C("c_custkey")).groupBy("c_custkey").agg(
        F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("spent")
    )


_MONTHS = "(SELECT strftime(o_orderdate, '%Y%m') AS m, count(*) AS n FROM orders GROUP BY 1)"


@query("rolling_mean", f"""SELECT m, CASE WHEN count(*) OVER w = 3 THEN round(avg(n) OVER w, 6) END AS rolling,
  CASE WHEN count(*) OVER c = 3 THEN round(avg(n) OVER c, 6) END AS centred FROM {_MONTHS}
  WINDOW w AS (ORDER BY m ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), c AS (ORDER BY m ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)""")
def _(t):
    months = t.orders.groupBy(S.month_key("o_orderdate").alias("m")).agg(F.count("*").alias("n"))
    rows = stats.rolling_mean(months, "m", "n", 3)
    rows = stats.rolling_mean(rows, "m", "n", 3, centred=True, out="centred")
    return rows.select("m", F.round("rolling", 6).alias("rolling"), F.round("centred", 6).alias("centred"))


@query("custom_sort_order", """SELECT o_orderstatus, n, row_number() OVER (ORDER BY CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'O' THEN 1 WHEN 'F' THEN 2 END) AS position
  FROM (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1)""")
def _(t):
    counts = t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    order = ["P", "O", "F"]
    return stats.custom_sort_order(counts, "o_orderstatus", order).withColumn(
        "position", stats.sort_position("o_orderstatus", order).cast("bigint")
    )


@query("union_distinct", """SELECT c_nationkey AS nation FROM customer WHERE c_acctbal < 0 UNION SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000""")
def _(t):
    a = t.customer.filter("c_acctbal < 0").select(C("c_nationkey").alias("nation"))
    return a.unionByName(t.supplier.filter("s_acctbal > 9000").select(C("s_nationkey").alias("nation"))).distinct()


@query("append_rows", """SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
  UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier""")
def _(t):
    return stack([
        t.customer.select(C("c_name").alias("name"), C("c_acctbal").alias("balance"), C("c_mktsegment").alias("segment")),
        t.supplier.select(C("s_name").alias("name"), C("s_acctbal").alias("balance")),
    ])


@query("intersect_sets", """SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 48 INTERSECT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A' AND l_quantity >= 48""")
def _(t):
    heavy = t.lineitem.filter("l_quantity >= 48")
    return heavy.filter("l_returnflag = 'R'").select("l_partkey").intersect(heavy.filter("l_returnflag = 'A'").select("l_partkey"))


@query("except_rows", """SELECT c_custkey AS custkey FROM customer EXCEPT ALL SELECT o_custkey FROM orders WHERE o_totalprice > 250000""")
def _(t):
    return t.customer.select(C("c_custkey").alias("custkey")).exceptAll(
        t.orders.filter("o_totalprice > 250000").select(C("o_custkey").alias("custkey"))
    )
