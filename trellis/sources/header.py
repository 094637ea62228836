"""Header specs: a text file of blocks that type the data files of a graph.

A block is a ``DEFAULT_LABEL=<label>`` line (or ``DEFAULT_TYPE=<type>`` for edges), one line of
typed columns, and one line per data file. Column roles: ``name:ID(space)``, ``:START_ID(space)``,
``:END_ID(space)``, ``:LABEL``, ``:TYPE``, ``:IGNORE``; other columns are ``name:type``.
Only the header file is read on the driver; it has one line per column set and file name.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trellis.model import PropertyGraph, stack
from trellis.sources.frames import edges_from_dataframe, nodes_from_dataframe

# Header type names and the Spark types they stand for.
HEADER_TYPES = {
    "STRING": T.StringType(),
    "LONG": T.LongType(),
    "INT": T.IntegerType(),
    "FLOAT": T.DoubleType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "DATETIME": T.TimestampType(),
}

_COLUMN = re.compile(r"^(?P<name>[^:]*):(?P<kind>[A-Za-z_]+)(\((?P<space>[^)]*)\))?$")


@dataclass
class Column:
    name: str
    kind: str
    space: str = ""


@dataclass
class Block:
    default: str
    columns: list[Column]
    files: list[str] = field(default_factory=list)

    def role(self, kind: str) -> Column | None:
        return next((c for c in self.columns if c.kind == kind), None)


def parse_header(text: str, delimiter: str = "|") -> list[Block]:
    blocks: list[Block] = []
    default = ""
    for line in (raw.strip() for raw in text.splitlines()):
        if not line:
            continue
        if line.startswith("DEFAULT_"):
            default = line.split("=", 1)[1].strip() if "=" in line else line.split(None, 1)[1].strip()
        elif ":" in line and _COLUMN.match(line.split(delimiter)[0].strip()):
            blocks.append(Block(default, [_column(c.strip()) for c in line.split(delimiter)]))
        else:
            blocks[-1].files.append(line)
    return blocks


def _column(text: str) -> Column:
    found = _COLUMN.match(text)
    if not found:
        raise ValueError(f"not a typed column: {text!r}")
    return Column(found["name"], found["kind"].upper(), found["space"] or "")


def _spark_schema(block: Block, ids_are_integers: bool) -> T.StructType:
    fields = []
    for i, c in enumerate(block.columns):
        if c.kind in HEADER_TYPES:
            kind = HEADER_TYPES[c.kind]
        elif c.kind in ("ID", "START_ID", "END_ID") and ids_are_integers:
            kind = T.LongType()
        else:
            kind = T.StringType()
        fields.append(T.StructField(_field_name(c, i), kind))
    return T.StructType(fields)


def _field_name(c: Column, position: int) -> str:
    return c.name or f"_{c.kind.lower()}_{position}"


def read_graph_header(
    spark: SparkSession,
    node_header: str,
    edge_header: str,
    root: str,
    format: str = "csv",
    data_delimiter: str = "|",
    schema_delimiter: str = "|",
    files_have_headers: bool = False,
    ids_are_integers: bool = False,
    default_id_property: str = "id",
) -> PropertyGraph:
    """A graph from header texts and the CSV or Parquet files they name under ``root``. Edges
    whose ends do not resolve are dropped."""

    def load(block: Block) -> tuple[DataFrame, dict[str, str], list[str]]:
        schema = _spark_schema(block, ids_are_integers)
        paths = [f"{root}/{name}" for name in block.files]
        if format == "csv":
            reader = spark.read.schema(schema).option("sep", data_delimiter)
            df = reader.option("header", str(files_have_headers).lower()).csv(paths)
        else:
            df = spark.read.parquet(*paths).toDF(*schema.names)
        roles = {c.kind: _field_name(c, i) for i, c in enumerate(block.columns) if c.kind not in HEADER_TYPES}
        props = [_field_name(c, i) for i, c in enumerate(block.columns) if c.kind in HEADER_TYPES]
        return df, roles, props

    nodes = []
    for block in parse_header(node_header, schema_delimiter):
        df, roles, props = load(block)
        if "LABEL" in roles and not block.default:
            part = nodes_from_dataframe(
                df, roles["ID"], block.role("ID").space, label_column=roles["LABEL"], property_columns=props
            )
        else:
            part = nodes_from_dataframe(
                df, roles["ID"], block.role("ID").space, block.default, property_columns=props
            )
        name = block.role("ID").name or default_id_property
        nodes.append(part if name == "id" else part.withColumn(name, F.col("id")))
    edges = []
    for block in parse_header(edge_header, schema_delimiter):
        df, roles, props = load(block)
        kind = F.col(roles["TYPE"]) if "TYPE" in roles and not block.default else block.default
        edges.append(
            edges_from_dataframe(
                df,
                roles["START_ID"],
                roles["END_ID"],
                block.role("START_ID").space,
                block.role("END_ID").space,
                kind,
                props,
            )
        )
    return PropertyGraph(stack(nodes), stack(edges)).resolved()


_NAMES = {"bigint": "LONG", "int": "INT", "double": "DOUBLE", "float": "FLOAT", "boolean": "BOOLEAN",
          "date": "DATE", "timestamp": "DATETIME", "timestamp_ntz": "DATETIME"}


def generate_header_spec(
    frames: dict[str, tuple[DataFrame, Sequence[str]]],
    ids: dict[str, tuple[str, str]] | None = None,
    ends: dict[str, tuple[tuple[str, str], tuple[str, str]]] | None = None,
    delimiter: str = "|",
) -> str:
    """Header text from frame schemas. ``frames``: label or type -> (frame, file names); ``ids``:
    label -> (key column, space); ``ends``: type -> ((column, space), (column, space))."""
    lines = []
    for name, (df, files) in frames.items():
        roles = {}
        if ids and name in ids:
            key, space = ids[name]
            roles[key] = f"{key}:ID({space})"
        if ends and name in ends:
            (a, sa), (b, sb) = ends[name]
            roles[a], roles[b] = f":START_ID({sa})", f":END_ID({sb})"
        typed = [roles.get(c, f"{c}:{_NAMES.get(t, 'STRING')}") for c, t in df.dtypes]
        lines += [f"DEFAULT_LABEL={name}", delimiter.join(typed), *files, ""]
    return "\n".join(lines)


def batch_header_specs(
    batches: dict[str, dict[str, tuple[DataFrame, Sequence[str]]]], **roles: object
) -> dict[str, str]:
    """One header per batch kind (snapshot, inserts, deletes)."""
    return {batch: generate_header_spec(frames, **roles) for batch, frames in batches.items()}
