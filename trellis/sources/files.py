"""File and table readers and writers. Schemas are given, never inferred from the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv_typed(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | str,
    delimiter: str = ",",
    header: bool = False,
    columns: Sequence[str] | None = None,
    null_value: str = "",
    **options: str,
) -> DataFrame:
    """One or many delimited files with declared types; ``columns`` keeps some of them."""
    reader = (
        spark.read.schema(schema)
        .option("sep", delimiter)
        .option("header", str(header).lower())
        .option("nullValue", null_value)
    )
    for key, value in options.items():
        reader = reader.option(key, value)
    df = reader.csv(paths if isinstance(paths, str) else list(paths))
    return df.select(*columns) if columns else df


def read_csv_glob(
    spark: SparkSession,
    root: str,
    pattern: str,
    schema: T.StructType | str,
    delimiter: str = ",",
    header: bool = False,
) -> DataFrame:
    """Every file under ``root`` whose name matches ``pattern``, with its name in ``file_name``."""
    df = read_csv_typed(
        spark, root, schema, delimiter, header, pathGlobFilter=pattern, recursiveFileLookup="true"
    )
    return df.withColumn("file_name", F.element_at(F.split(F.input_file_name(), "/"), -1))


def read_parquet(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Parquet, reading only ``columns``."""
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    return df.select(*columns) if columns else df


def read_sql_table(
    spark: SparkSession,
    url: str,
    table: str,
    column: str | None = None,
    lower: int | str | None = None,
    upper: int | str | None = None,
    partitions: int | None = None,
    divisions: Sequence[str] | None = None,
    columns: Sequence[str] | None = None,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A table over JDBC, read in parallel by a numeric range or by explicit ``divisions`` (the
    values between partitions of ``column``)."""
    props = properties or {}
    if divisions is not None:
        df = spark.read.jdbc(url, table, predicates=division_predicates(column, divisions), properties=props)
    elif column is not None:
        df = spark.read.jdbc(url, table, column, lower, upper, partitions, properties=props)
    else:
        df = spark.read.jdbc(url, table, properties=props)
    return df.select(*columns) if columns else df


def division_predicates(column: str, divisions: Sequence[str]) -> list[str]:
    """WHERE clauses, one per partition, that cover every row once (nulls go to the first)."""
    first, last = divisions[0], divisions[-1]
    inner = [f"{column} >= '{a}' AND {column} < '{b}'" for a, b in zip(divisions, divisions[1:])]
    return [f"{column} < '{first}' OR {column} IS NULL", *inner, f"{column} >= '{last}'"]


def read_external_db(spark: SparkSession, format: str, options: dict[str, str]) -> DataFrame:
    """A table from a connector on the class path (its data-source name and options)."""
    return spark.read.format(format).options(**options).load()


def read_json_lines(
    spark: SparkSession, path: str, schema: T.StructType | str, defaults: dict[str, object]
) -> DataFrame:
    """One JSON object per line; a missing field takes its default."""
    return with_defaults(spark.read.schema(schema).json(path), defaults)


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    return df.withColumns(
        {name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()}
    )


def read_text_records(
    spark: SparkSession, path: str, fields: dict[str, str], charset: str = "ISO-8859-1"
) -> DataFrame:
    """Blocks of ``key: value`` lines divided by a blank line (``fields``: key -> column)."""
    blocks = spark.read.option("lineSep", "\n\n").text(path)
    if charset.upper() != "UTF-8":
        blocks = blocks.select(F.decode(F.col("value").cast("binary"), charset).alias("value"))
    return parse_text_records(blocks, "value", fields)


def parse_text_records(df: DataFrame, column: str, fields: dict[str, str]) -> DataFrame:
    """Columns from ``key: value`` lines in a text column; a missing key is null."""
    pairs = F.expr(f"str_to_map({column}, '\n', ': ')")
    parsed = df.filter(F.length(F.trim(column)) > 0).withColumn("_pairs", pairs)
    return parsed.select(*[F.try_element_at("_pairs", F.lit(k)).alias(name) for k, name in fields.items()])


def read_graphml(spark: SparkSession, path: str, row_tag: str, keys: Sequence[str]) -> DataFrame:
    """``node`` or ``edge`` rows of a GraphML file with the named data keys as columns."""
    attributes = {"node": ["_id", "_labels"], "edge": ["_source", "_target", "_label"]}[row_tag]
    fields = "".join(f"{a} string, " for a in attributes)
    schema = f"{fields}data array<struct<_key:string,_VALUE:string>>"
    rows = spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)
    entries = F.map_from_entries(
        F.transform("data", lambda d: F.struct(d["_key"].alias("key"), d["_VALUE"].alias("value")))
    )
    return rows.withColumn("_map", entries).select(
        *attributes, *[F.try_element_at("_map", F.lit(k)).alias(k) for k in keys]
    )


def _xml(value: Column) -> Column:
    escaped = F.coalesce(value.cast("string"), F.lit(""))
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        escaped = F.replace(escaped, F.lit(plain), F.lit(entity))
    return escaped


def _graphml_rows(df: DataFrame, tag: str, attributes: dict[str, str], keys: Sequence[str]) -> DataFrame:
    start = [F.concat(F.lit(f' {name}="'), _xml(F.col(c)), F.lit('"')) for name, c in attributes.items()]
    data = [F.when(F.col(k).isNotNull(), F.concat(F.lit(f'<data key="{k}">'), _xml(F.col(k)), F.lit("</data>"))).otherwise("") for k in keys]
    return df.select(F.concat(F.lit(f"<{tag}"), *start, F.lit(">"), *data, F.lit(f"</{tag}>")).alias("value"))


def write_graphml(nodes: DataFrame, edges: DataFrame, path: str, node_keys: Sequence[str], edge_keys: Sequence[str]) -> None:
    """Nodes (``id, labels``) and edges (``src, dst, label``) with data keys as a folder of GraphML files, each well-formed by itself:
    every partition of either table writes its own, so the work is spread over all tasks. A missing value has no entry."""

    def framed(batches):
        import pyarrow as pa

        def text(lines: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([lines], names=["value"])

        yield text(pa.array(['<?xml version="1.0" encoding="UTF-8"?>', '<graphml><graph edgedefault="directed">']))
        for batch in batches:
            yield text(batch.column(0).cast(pa.string()))
        yield text(pa.array(["</graph></graphml>"]))

    rows = _graphml_rows(nodes, "node", {"id": "id", "labels": "labels"}, node_keys).unionAll(
        _graphml_rows(edges, "edge", {"source": "src", "target": "dst", "label": "label"}, edge_keys)
    )
    rows.mapInArrow(framed, "value string").write.mode("overwrite").text(path)


def csv_to_parquet(
    spark: SparkSession,
    source: str,
    target: str,
    schema: T.StructType | str,
    converters: dict[str, Column] | None = None,
    delimiter: str = "|",
    header: bool = True,
) -> None:
    """Convert a directory of delimited files; ``converters`` replace columns (dates and such)."""
    df = read_csv_typed(spark, source, schema, delimiter, header)
    write_parquet(df.withColumns(converters or {}), target)


def write_csv(
    df: DataFrame,
    path: str,
    delimiter: str = ",",
    header: bool = True,
    gzip: bool = False,
    null_text: str = "",
    single_file: bool = False,
) -> None:
    """Delimited text. ``single_file`` passes all rows through one task; use it for small results."""
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode("overwrite").option("sep", delimiter).option("nullValue", null_text)
    if gzip:
        writer = writer.option("compression", "gzip")
    writer.option("header", str(header).lower()).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), compression: str = "snappy") -> None:
    df.write.mode("overwrite").option("compression", compression).partitionBy(*partition_by).parquet(path)


def range_partition_write(
    df: DataFrame, path: str, column: str, boundaries: Sequence[object] | None = None, partitions: int | None = None
) -> None:
    """Write ranges of ``column``: with ``boundaries`` one directory per explicit range, else
    files cut by sampled ranges."""
    if boundaries is not None:
        part = F.lit(0)
        for b in boundaries:
            part = part + F.when(F.col(column) >= F.lit(b), 1).otherwise(0)
        write_parquet(df.withColumn("part", part), path, ["part"])
        return
    ranged = df.repartitionByRange(partitions, column) if partitions else df.repartitionByRange(column)
    write_parquet(ranged, path)


def repartition(df: DataFrame, partitions: int, *columns: str) -> DataFrame:
    """Change the partition count; fewer partitions without keys need no shuffle."""
    if not columns and partitions < df.rdd.getNumPartitions():
        return df.coalesce(partitions)
    return df.repartition(partitions, *columns)


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows per partition: ``partition_id, num_rows``."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(F.count("*").alias("num_rows"))


def write_query_partitions(df: DataFrame, path: str, partitions: int | None = None) -> None:
    """Write a result with at least one file per partition."""
    write_parquet(df if partitions is None else df.repartition(partitions), path)


def first_rows_of_one_file(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The first ``n`` rows of the first file (by name) of a written result."""
    files = sorted(f for f in spark.read.parquet(path).inputFiles())
    return spark.read.parquet(files[0]).limit(n)


def write_table_sql(df: DataFrame, view: str, id_column: str, id_source: str) -> DataFrame:
    """Register a frame under a name, with an id that is the md5 of a column."""
    out = df.select(F.md5(F.col(id_source).cast("string")).alias(id_column), *df.columns)
    out.createOrReplaceTempView(view)
    return out


def export_feature_table(df: DataFrame, entity: str, timestamp: str, features: Sequence[str]) -> DataFrame:
    """Entity id, features and the event timestamp truncated to the day."""
    return df.select(
        entity, *features, F.date_trunc("day", F.col(timestamp)).alias("event_timestamp")
    )


def lookup_join_pipeline(left: DataFrame, lookups: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """Keep rows of ``left`` that find a match in each lookup (frame, left key, right key)."""
    for right, lk, rk in lookups:
        left = left.join(right.select(F.col(rk).alias(lk)), lk, "left_semi")
    return left


def nested_json_to_graph(
    df: DataFrame, id_column: str, json_column: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Entity JSON ``{"entities": [{entityId, vocabularyCodes: [...]}]}`` per row.

    Returns (entity edges, code edges, report): row -> entity, entity -> code, and one row with
    the number of rows that are no JSON and of rows without the root key.
    """
    schema = "entities array<struct<entityId:string,preferredTerm:string,vocabularyCodes:array<string>>>, _corrupt string"
    parsed = df.withColumn(
        "_j", F.from_json(json_column, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    )
    entities = parsed.select(id_column, F.explode("_j.entities").alias("e")).select(
        id_column, F.col("e.entityId").alias("entity_id"), F.col("e.vocabularyCodes").alias("codes")
    )
    codes = entities.select("entity_id", F.explode("codes").alias("code")).distinct()
    bad = F.col("_j._corrupt").isNotNull()
    report = parsed.agg(
        F.count("*").alias("num_rows"),
        F.count(F.when(bad, 1)).alias("bad_json"),
        F.count(F.when(~bad & F.col("_j.entities").isNull(), 1)).alias("missing_root"),
    )
    return entities.select(id_column, "entity_id").distinct(), codes, report
