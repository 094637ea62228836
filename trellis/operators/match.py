"""Pattern matching as joins.

All patterns are equi-joins on ``(space, id)``. Catalyst picks the join strategy and AQE splits
hot keys; a side is broadcast only when its measured size is below Spark's own threshold.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset
import pyarrow.fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from trellis.model import PropertyGraph, has_label, node_keys, stack
from trellis.operators.mutate import node_keys_of_edges
from trellis.operators.ordering import collect_lists, row_number_within, running_last
from trellis.session import PIECE_ROWS, Scratch, file_system, turns


@dataclass(frozen=True)
class Node:
    """A node variable: its labels, a filter on node columns, and the properties to carry."""

    name: str
    labels: tuple[str, ...] = ()
    where: Column | None = None
    props: tuple[str, ...] = ()

    @property
    def bare(self) -> bool:
        return not self.labels and self.where is None and not self.props


@dataclass(frozen=True)
class Hop:
    """A relationship variable and the node it leads to. ``direction``: out, in or both."""

    name: str
    to: Node
    types: tuple[str, ...] = ()
    direction: str = "out"
    where: Column | None = None
    props: tuple[str, ...] = ()


def match_nodes(graph: PropertyGraph, node: Node) -> DataFrame:
    """``MATCH (n:Label {…})``: columns ``<n>_space, <n>_id`` and ``<n>_<prop>``."""
    rows = graph.nodes
    if node.labels:
        rows = rows.filter(has_label(*node.labels))
    if node.where is not None:
        rows = rows.filter(node.where)
    return rows.select(
        F.col("id_space").alias(f"{node.name}_space"),
        F.col("id").alias(f"{node.name}_id"),
        *[F.col(p).alias(f"{node.name}_{p}") for p in node.props],
    )


def directed(edges: DataFrame, direction: str) -> DataFrame:
    """Edges as seen when walking ``out``, ``in`` or ``both`` ways; a self-loop is seen once."""
    if direction == "out":
        return edges
    swapped = edges.withColumns(
        {"src_space": F.col("dst_space"), "src": F.col("dst"), "dst_space": F.col("src_space"), "dst": F.col("src")}
    )
    if direction == "in":
        return swapped
    loop = (F.col("src") == F.col("dst")) & (F.col("src_space") == F.col("dst_space"))
    return edges.unionByName(swapped.filter(~loop))


def _edge_rows(graph: PropertyGraph, start: str, hop: Hop) -> DataFrame:
    edges = graph.edges_of(*hop.types)
    if hop.where is not None:
        edges = edges.filter(hop.where)
    return directed(edges, hop.direction).select(
        F.col("src_space").alias(f"{start}_space"),
        F.col("src").alias(f"{start}_id"),
        F.col("dst_space").alias(f"{hop.to.name}_space"),
        F.col("dst").alias(f"{hop.to.name}_id"),
        F.col("edge_id").alias(f"{hop.name}_id"),
        *[F.col(p).alias(f"{hop.name}_{p}") for p in hop.props],
    )


def extend(graph: PropertyGraph, rows: DataFrame, start: str, hop: Hop) -> DataFrame:
    """Join one more hop onto a binding table. When the target variable is bound already the
    hop closes on it."""
    step = _edge_rows(graph, start, hop)
    keys = [f"{start}_space", f"{start}_id"]
    target = [f"{hop.to.name}_space", f"{hop.to.name}_id"]
    if target[1] in rows.columns:
        return rows.join(step, keys + target)
    rows = rows.join(step, keys)
    return rows if hop.to.bare else rows.join(match_nodes(graph, hop.to), target)


def match_path(graph: PropertyGraph, start: Node, *hops: Hop) -> DataFrame:
    """A chain of hops. No relationship is used twice within the pattern."""
    if start.bare and hops:
        rows, at, rest = _edge_rows(graph, start.name, hops[0]), hops[0].to, hops[1:]
        if not at.bare:
            rows = rows.join(match_nodes(graph, at), [f"{at.name}_space", f"{at.name}_id"])
    else:
        rows, at, rest = match_nodes(graph, start), start, hops
    for hop in rest:
        rows = extend(graph, rows, at.name, hop)
        at = hop.to
    return distinct_relationships(rows, hops)


def distinct_relationships(rows: DataFrame, hops: Sequence[Hop]) -> DataFrame:
    for i, a in enumerate(hops):
        for b in hops[i + 1 :]:
            if not a.types or not b.types or set(a.types) & set(b.types):
                rows = rows.filter(F.col(f"{a.name}_id") != F.col(f"{b.name}_id"))
    return rows


def match_star(graph: PropertyGraph, centre: Node, *hops: Hop) -> DataFrame:
    """Several one-hop patterns that share the variable ``centre``."""
    rows = match_nodes(graph, centre)
    for hop in hops:
        rows = extend(graph, rows, centre.name, hop)
    return distinct_relationships(rows, hops)


def anti_pattern(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes without any edge, either way."""
    return nodes.join(node_keys_of_edges(edges), ["id_space", "id"], "left_anti")


def semi_pattern(rows: DataFrame, pattern: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows for which the pattern exists."""
    return rows.join(pattern.select(*on), list(on), "left_semi")


def optional_match(rows: DataFrame, pattern: DataFrame, on: Sequence[str], collect: str, out: str) -> DataFrame:
    """OPTIONAL MATCH … COLLECT: a sorted list per row, empty when nothing matched."""
    lists = collect_lists(pattern, on, [collect], out)
    element = dict(pattern.dtypes)[collect]
    empty = F.expr(f"cast(array() as array<{element}>)")
    return rows.join(lists, list(on), "left").withColumn(out, F.coalesce(out, empty))


# --- two hops without a direct edge -----------------------------------------------------------


def oriented_edges(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Simple undirected edges (columns a, b) as u -> v from the lower to the higher degree, ties
    by id. No node has more than sqrt(2m) out-edges then, hubs included."""
    pairs = (
        edges.filter(F.col("src") != F.col("dst"))
        .select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
        .distinct()
    )
    pairs = scratch.put(pairs, "simple_edges")
    degree = (
        pairs.select(F.col("a").alias("n")).unionAll(pairs.select("b")).groupBy("n").agg(F.count("*").alias("d"))
    )
    ranked = pairs.join(degree.select(F.col("n").alias("a"), F.col("d").alias("da")), "a").join(
        degree.select(F.col("n").alias("b"), F.col("d").alias("db")), "b"
    )
    first = F.col("da") <= F.col("db")
    return ranked.select(
        F.when(first, F.col("a")).otherwise(F.col("b")).alias("u"),
        F.when(first, F.col("b")).otherwise(F.col("a")).alias("v"),
    )


CELL_EDGES = 1 << 22  # edges that a task holds of one cell, on average
WEDGES = 1 << 21  # wedges that a task checks at a time


def node_parts(edges: int, cores: int, cell_edges: int | None = None) -> int:
    """Parts of the nodes: as few as keep a cell at its size and give each core one. An edge is read three times as often."""
    return max(math.ceil(math.sqrt(3 * edges / (cell_edges or CELL_EDGES))), math.ceil(round(cores ** (1 / 3), 6)))


def triangle_list(edges: DataFrame, scratch: Scratch | None = None, cell_edges: int | None = None) -> DataFrame:
    """Every undirected triangle once as ``u, v, w``.

    Edges run from the end of fewer neighbours to that of more, so nobody has more than sqrt(2m) out-edges. Nodes are hashed to ``p``
    parts, which cuts the edges into p * p blocks, written once, and a cell for each three parts reads the three blocks that its triangles
    need. An edge is shuffled and written once and read up to 3p times, whatever the lists of its ends, and ``p`` follows from the number
    of edges, so what a task holds stays the same; no wedge is ever shuffled."""
    scratch = scratch or Scratch(edges.sparkSession)
    oriented = scratch.put(oriented_edges(edges, scratch), "oriented")
    cores = edges.sparkSession.sparkContext.defaultParallelism
    p = node_parts(oriented.count(), cores, cell_edges)

    a, b = [F.pmod(F.xxhash64(end), F.lit(p)) for end in ("u", "v")]
    folder = f"{scratch.root}/blocks"
    oriented.select("u", "v", a.alias("a"), b.alias("b")).repartition(p * p, "a", "b").write.partitionBy("a", "b").parquet(folder)
    kind = dict(oriented.dtypes)["u"]
    # A stated number of tasks: cells are work. Those that follow each other share their first block.
    tasks = min(p**3, 4 * max(cores, int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    cells = edges.sparkSession.range(0, p**3, 1, tasks)
    return cells.mapInPandas(_cells(folder, p), f"u {kind}, v {kind}, w {kind}")


def _cells(folder: str, p: int):
    """The triangles of each cell, from the blocks of a wedge's first side, of its second and of what closes it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, root = file_system(folder)

        @lru_cache(2)
        def block(a: int, b: int) -> pd.DataFrame | None:
            at = f"{root}/a={a}/b={b}"
            if files.get_file_info(at).type == pyarrow.fs.FileType.NotFound:
                return None
            return pyarrow.dataset.dataset(at, format="parquet", filesystem=files).to_table(columns=["u", "v"]).to_pandas()

        for pdf in batches:
            for number in pdf["id"].tolist():
                i, j, k = number // (p * p), number // p % p, number % p
                sides = [block(*ends) for ends in ((j, k), (i, k), (i, j))][::-1]
                if all(side is not None for side in sides):
                    yield from _triangles_of(pd.concat([side.assign(role=role) for role, side in enumerate(sides)]))

    return run


def _triangles_of(cell: pd.DataFrame) -> Iterator[pd.DataFrame]:
    codes, names = pd.factorize(np.concatenate([cell["u"].to_numpy(), cell["v"].to_numpy()]))
    x, y, role = codes[:len(cell)], codes[len(cell):], cell["role"].to_numpy()
    first, second = role == 0, role == 1
    closing = np.sort(x[role == 2] * len(names) + y[role == 2])
    if not (first.any() and second.any() and len(closing)):
        return
    order = np.argsort(x[second], kind="stable")
    from_u, to_w = x[second][order], y[second][order]
    u, v = x[first], y[first]
    start = np.searchsorted(from_u, u)
    count = np.searchsorted(from_u, u, "right") - start
    u, v, start, count = u[count > 0], v[count > 0], start[count > 0], count[count > 0]
    total = np.cumsum(count)
    for low in range(0, int(total[-1]) if len(total) else 0, WEDGES):
        # The edges whose wedges begin in this stretch.
        rows = slice(*np.searchsorted(total - count, [low, low + WEDGES]))
        n = count[rows]
        edge = np.repeat(np.arange(len(n)), n)
        w = to_w[np.repeat(start[rows] - (np.cumsum(n) - n), n) + np.arange(len(edge))]
        wanted = v[rows][edge] * len(names) + w
        at = np.minimum(np.searchsorted(closing, wanted), len(closing) - 1)
        hit = closing[at] == wanted
        if hit.any():
            yield pd.DataFrame({"u": names[u[rows][edge[hit]]], "v": names[v[rows][edge[hit]]], "w": names[w[hit]]})


def two_hop_not_direct(edges: DataFrame, measures: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per start node ``id``, sums of ``columns`` over the ends of all two-hop paths a -> b -> c
    that have no direct edge a -> c. Paths count, not distinct ends; parallel edges count.

    ``edges``: src, dst. ``measures``: id and numeric columns. The paths are not listed: the sum
    over all two-hop paths is two group-bys, and the sum over paths with a direct edge comes from
    the triangles, so a hub with d edges costs d, not d squared.
    """
    scratch = Scratch(edges.sparkSession)
    loops = edges.filter(F.col("src") == F.col("dst")).select(F.col("src").alias("id")).distinct()
    counted = scratch.put(
        edges.filter(F.col("src") != F.col("dst")).groupBy("src", "dst").agg(F.count("*").alias("n")), "counted"
    )
    at_dst = measures.select(F.col("id").alias("dst"), *columns)
    by_middle = (
        counted.join(at_dst, "dst")
        .groupBy(F.col("src").alias("dst"))
        .agg(*[F.sum(F.col("n") * F.col(c)).alias(c) for c in columns])
    )
    total = counted.join(by_middle, "dst").select(
        F.col("src").alias("id"), *[(F.col("n") * F.col(c)).alias(c) for c in columns]
    )
    closed = _closed_paths(counted, scratch).join(
        measures.select(F.col("id").alias("end"), *columns), "end"
    )
    back = counted.alias("x").join(
        counted.alias("y"), (F.col("x.dst") == F.col("y.src")) & (F.col("x.src") == F.col("y.dst"))
    ).select(F.col("x.src").alias("id"), (F.col("x.n") * F.col("y.n")).alias("_paths"))
    back = back.join(loops, "id", "left_semi").join(measures.select("id", *columns), "id")
    minus = [(-F.col("_paths") * F.col(c)).alias(c) for c in columns]
    return (
        total.unionByName(closed.select("id", *minus))
        .unionByName(back.select("id", *minus))
        .groupBy("id")
        .agg(*[F.sum(c).alias(c) for c in columns])
    )


def _closed_paths(counted: DataFrame, scratch: Scratch) -> DataFrame:
    """``id, end, _paths``: two-hop paths id -> b -> end for which id -> end exists, from the
    triangles; each triangle is read in its six orders."""
    triangles = triangle_list(counted, scratch)
    both_ways = (
        counted.select(
            F.least("src", "dst").alias("p"),
            F.greatest("src", "dst").alias("q"),
            F.when(F.col("src") < F.col("dst"), F.col("n")).alias("up"),
            F.when(F.col("src") > F.col("dst"), F.col("n")).alias("down"),
        )
        .groupBy("p", "q")
        .agg(F.coalesce(F.sum("up"), F.lit(0)).alias("up"), F.coalesce(F.sum("down"), F.lit(0)).alias("down"))
    )
    rows = triangles.select(F.sort_array(F.array("u", "v", "w")).alias("t")).select(
        F.col("t")[0].alias("x"), F.col("t")[1].alias("y"), F.col("t")[2].alias("z")
    )
    for p, q in (("x", "y"), ("y", "z"), ("x", "z")):
        rows = rows.join(
            both_ways.select(
                F.col("p").alias(p), F.col("q").alias(q),
                F.col("up").alias(f"{p}{q}"), F.col("down").alias(f"{q}{p}"),
            ),
            [p, q],
        )
    orders = [("x", "y", "z"), ("x", "z", "y"), ("y", "x", "z"), ("y", "z", "x"), ("z", "x", "y"), ("z", "y", "x")]
    found = F.array(
        *[
            F.struct(
                F.col(a).alias("id"),
                F.col(c).alias("end"),
                F.when(F.col(f"{a}{c}") > 0, F.col(f"{a}{b}") * F.col(f"{b}{c}")).otherwise(F.lit(0)).alias("_paths"),
            )
            for a, b, c in orders
        ]
    )
    return rows.select(F.explode(found).alias("f")).select("f.*").filter("_paths > 0")


# --- shared neighbours ------------------------------------------------------------------------


PIECE_PAIRS = 1 << 22  # pairs that a task lists, on average


def pairs_within(
    df: DataFrame, group: Sequence[str], member: str, block: int = 1000, carry: Sequence[str] | None = None
) -> DataFrame:
    """Unordered member pairs ``left < right`` of each group. A group above ``block`` members is
    cut into blocks and each pair of blocks is its own join key, so a hot group is spread over
    many tasks; nothing is left out. The tasks follow the number of pairs, which may be many times that of the rows: by the bytes
    of the rows Spark would put groups together until a task lists, and counts in memory, more pairs the larger the input.

    With ``carry`` all pairs of rows come, with these columns of both as ``<c>_l`` and ``<c>_r``. Where no group is cut, both sides
    of the join read one shuffle."""
    spark = df.sparkSession
    named = {c: f"_v{place}" for place, c in enumerate(carry or [])}
    df = df.select(*group, F.struct(F.col(member).alias("_m"), *[F.col(c).alias(v) for c, v in named.items()]).alias("_x"))
    for g in [*group, "_x._m"]:  # a null group is none
        df = df.filter(F.col(g).isNotNull())
    if carry is None:
        df = df.distinct()
    # groups are counted by their hashes: two with the same one are at worst cut without need
    hashed = df.select(F.xxhash64(*group).alias("_h")).groupBy("_h").agg(F.count("*").alias("_n"))
    large = hashed.select(F.when(F.col("_n") > block, F.col("_h")).alias("_h"), "_n").groupBy("_h", "_n").agg(F.count("*").alias("_times"))
    large = Scratch(spark).put(large, "group_sizes")
    n, times = F.col("_n").cast("double"), F.col("_times")
    pairs, rows = large.agg(F.sum(times * n * (n - 1) / 2), F.sum(times * n)).first()
    setting = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(math.ceil((pairs or 0) / PIECE_PAIRS), math.ceil((rows or 0) / PIECE_ROWS), setting)
    key, left, right = list(group), df, df
    cut = large.filter("_h is not null").select("_h", F.ceil(F.col("_n") / block).cast("int").alias("_blocks"))
    if cut.take(1):
        key = [*group, "_i", "_j"]
        placed = df.withColumn("_h", F.xxhash64(*group)).join(cut, "_h", "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
        placed = placed.withColumn("_b", F.pmod(F.xxhash64("_x._m"), F.col("_blocks")).cast("int"))
        left = placed.select(*group, "_x", F.col("_b").alias("_i"), F.explode(F.sequence("_b", F.col("_blocks") - 1)).alias("_j"))
        right = placed.select(*group, "_x", F.explode(F.sequence(F.lit(0), F.col("_b"))).alias("_i"), F.col("_b").alias("_j"))
    left, right = [side.repartition(tasks, *key).withColumnRenamed("_x", name) for side, name in ((left, "_l"), (right, "_r"))]
    ordered = F.col("_l._m") < F.col("_r._m")
    joined = left.join(right, key).filter(ordered if key == list(group) else ordered | (F.col("_i") != F.col("_j")))
    low, high = [F.when(ordered, F.col(a)).otherwise(F.col(b)) for a, b in (("_l", "_r"), ("_r", "_l"))]
    return joined.select(*group, low.alias("_l"), high.alias("_r")).select(
        *group, F.col("_l._m").alias("left"), F.col("_r._m").alias("right"),
        *[F.col(f"_{side}.{v}").alias(f"{c}_{side}") for c, v in named.items() for side in "lr"],
    )


HOT_NEIGHBOUR = 1000  # neighbours with more members than this may be left out of candidates


def ranked_memberships(
    memberships: DataFrame, member: str, neighbour: str, carry: Sequence[str], scratch: Scratch
) -> DataFrame:
    """Distinct memberships with ``_rank``: 1, 2, … for a member's hot neighbours from the most
    common one down, null for all others."""
    base = scratch.put(memberships.select(member, neighbour, *carry).distinct(), "memberships")
    hot = base.groupBy(neighbour).agg(F.count("*").alias("_f")).filter(F.col("_f") > HOT_NEIGHBOUR)
    hot_rows = base.select(member, neighbour).join(hot, neighbour)
    ranks = row_number_within(hot_rows, [member], [F.col("_f").desc(), neighbour], "_rank").drop("_f")
    return scratch.put(base.join(ranks, [member, neighbour], "left"), "ranked")


BLOCK_MEMBERSHIPS = 1 << 21  # memberships of a block of members, on average
CHUNK_PAIRS = 1 << 21  # pairs that a task counts at a time


def candidate_pairs(
    ranked: DataFrame, member: str, neighbour: str, cases: Sequence[tuple[int, Sequence[str]]], scratch: Scratch | None = None
) -> DataFrame:
    """Pairs ``left < right`` among which are all that fit a case: at least so many common neighbours, counting those only where both have
    equal, known values in the columns of the case.

    For a case of t each member leaves out up to t-1 of its hottest neighbours. Since all rank them alike, two
    members lose no more common neighbours than the one that left out more, so a pair must still
    show t minus that many. Without hot neighbours the count shown is the exact one.

    Members are hashed to blocks, whose memberships are shuffled and written once; a cell for each two blocks reads both and counts the pairs
    of their members in pieces of a bounded size. So no pair is shuffled or written unless it is a candidate; a block is read by as many cells as
    there are blocks, and their number follows from that of the memberships, so what a task holds stays the same. Neighbours and values are compared by
    their hashes, which can only add candidates."""
    spark = ranked.sparkSession
    scratch = scratch or Scratch(spark)
    named = list(dict.fromkeys(c for _, columns in cases for c in columns))
    values = [f"v{place}" for place in range(len(named))]
    rows = ranked.filter(F.col(member).isNotNull() & F.col(neighbour).isNotNull()).select(
        F.col(member).alias("m"), F.xxhash64(neighbour).alias("h"), F.coalesce("_rank", F.lit(0)).cast("int").alias("rank"),
        *[F.when(F.col(c).isNotNull(), F.xxhash64(c)).alias(v) for c, v in zip(named, values)],
    )
    cores = spark.sparkContext.defaultParallelism
    blocks = max(math.ceil(rows.count() / BLOCK_MEMBERSHIPS), math.ceil(round(math.sqrt(2 * cores), 6)))
    folder = f"{scratch.root}/members"
    dealt = rows.withColumn("b", F.pmod(F.xxhash64("m", F.lit(2)), F.lit(blocks)).cast("int")).repartition(4 * blocks, "b")
    dealt.sortWithinPartitions("b", "h", "m").write.partitionBy("b").parquet(folder)
    wanted = [(least, [values[named.index(c)] for c in columns]) for least, columns in cases]
    cells = blocks * (blocks + 1) // 2
    # A stated number of tasks: cells are work. Those that follow each other share a block.
    tasks = min(cells, 4 * max(cores, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    kind = ranked.schema[member].dataType
    schema = StructType([StructField("left", kind), StructField("right", kind)])
    found = spark.range(0, cells, 1, tasks).mapInArrow(_member_cells(folder, values, wanted, to_arrow_type(kind)), schema)
    return found.select(F.least("left", "right").alias("left"), F.greatest("left", "right").alias("right"))


@dataclass(frozen=True)
class _Members:
    """Memberships of a block in the order of their neighbours' hashes. ``code``: the place of the member among ``names``; ``lost``: how many
    neighbours a member leaves out, by case."""

    names: pa.Array
    h: np.ndarray
    code: np.ndarray
    rank: np.ndarray
    values: dict[str, tuple[np.ndarray, np.ndarray]]
    lost: list[np.ndarray]


def _members(table: pa.Table, values: Sequence[str], cases: Sequence[tuple[int, Sequence[str]]]) -> _Members:
    coded = table["m"].combine_chunks().dictionary_encode()
    code, h, rank = coded.indices.to_numpy(), table["h"].to_numpy(), table["rank"].to_numpy()
    out = lambda least: (rank > 0) & (rank < least)
    lost = [np.bincount(code[out(least)], minlength=len(coded.dictionary)) for least, _ in cases]
    order = np.lexsort((code, h))
    order = order[~out(min(least for least, _ in cases))[order]]
    known = {v: (pc.fill_null(table[v], 0).to_numpy()[order], pc.is_valid(table[v]).to_numpy()[order]) for v in values}
    return _Members(coded.dictionary, h[order], code[order].astype("int64"), rank[order], known, lost)


def _member_cells(folder: str, values: Sequence[str], cases: Sequence[tuple[int, Sequence[str]]], kind: pa.DataType):
    """The candidates of each cell, numbered 0 for blocks 0 and 0, 1 and 2 for block 1 with 0 and 1, and so on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = file_system(folder)

        @lru_cache(2)
        def block(b: int) -> _Members | None:
            at = f"{root}/b={b}"
            if files.get_file_info(at).type == pyarrow.fs.FileType.NotFound:
                return None
            table = pyarrow.dataset.dataset(at, format="parquet", filesystem=files).to_table(columns=["m", "h", "rank", *values])
            return _members(table, values, cases)

        for batch in batches:
            for number in batch.column("id").to_pylist():
                far = (math.isqrt(8 * number + 1) - 1) // 2
                near = number - far * (far + 1) // 2
                x, y = block(far), block(near)
                if x is None or y is None:
                    continue
                for left, right in _met(x, y, cases):
                    ends = [side.names.take(pa.array(place)).cast(kind) for side, place in ((x, left), (y, right))]
                    yield pa.RecordBatch.from_arrays(ends, names=["left", "right"])

    return run


def _met(x: _Members, y: _Members, cases: Sequence[tuple[int, Sequence[str]]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes of the members of ``x`` and ``y`` that fit a case; within one block each pair once."""
    starts = np.flatnonzero(np.r_[True, y.h[1:] != y.h[:-1]]) if len(y.h) else np.empty(0, "int64")
    if not len(starts) or not len(x.h):
        return
    kinds, stops = y.h[starts], np.r_[starts[1:], len(y.h)]
    at = np.minimum(np.searchsorted(kinds, x.h), len(kinds) - 1)
    first = np.arange(len(x.h)) + 1 if x is y else starts[at]
    count = np.where(kinds[at] == x.h, stops[at] - first, 0)
    rows = np.flatnonzero(count)
    rows = rows[np.argsort(x.code[rows], kind="stable")]
    first, count, owner = first[rows], count[rows], x.code[rows]
    total = np.cumsum(count)
    ends = np.flatnonzero(np.r_[owner[1:] != owner[:-1], True]) + 1 if len(rows) else []  # of the rows of a member
    low = 0
    while low < len(rows):
        # members whose pairs fit into a piece, or one member, whose own pairs are counted in pieces
        fit = np.searchsorted(total, (total[low - 1] if low else 0) + CHUNK_PAIRS, "right")
        high = ends[max(np.searchsorted(ends, fit, "right") - 1, np.searchsorted(ends, low, "right"))]
        pieces = [slice(low, high)]
        if high > fit:
            cuts = np.unique(np.r_[low, np.searchsorted(total[low:high], np.arange(total[low], total[high - 1], CHUNK_PAIRS)) + low, high])
            pieces = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:])]
        counted = [[] for _ in cases]
        for piece in pieces:
            n = count[piece]
            edge = np.repeat(np.arange(len(n)), n)
            other = np.repeat(first[piece] - (np.cumsum(n) - n), n) + np.arange(len(edge))
            own = rows[piece][edge]
            for place, (least, columns) in enumerate(cases):
                kept = x.code[own] != y.code[other] if x is y else np.ones(len(own), bool)
                for side, row in ((x, own), (y, other)):
                    kept &= (side.rank[row] == 0) | (side.rank[row] >= least)
                for c in columns:
                    (a, a_known), (b, b_known) = x.values[c], y.values[c]
                    kept &= a_known[own] & b_known[other] & (a[own] == b[other])
                counted[place].append(np.unique(x.code[own[kept]] * len(y.names) + y.code[other[kept]], return_counts=True))
        hits = []
        for (least, _), lost_x, lost_y, some in zip(cases, x.lost, y.lost, counted):
            key, n = some[0] if len(some) == 1 else _added(some)
            bound = n + np.maximum(lost_x[key // len(y.names)], lost_y[key % len(y.names)])
            hits.append(key[bound >= least])
        hit = np.unique(np.concatenate(hits))
        if len(hit):
            yield hit // len(y.names), hit % len(y.names)
        low = high


def _added(counts: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The different keys of all and their summed counts."""
    keys, place = np.unique(np.concatenate([key for key, _ in counts]), return_inverse=True)
    return keys, np.bincount(place, weights=np.concatenate([n for _, n in counts]), minlength=len(keys)).astype("int64")


def count_shared(pairs: DataFrame, memberships: DataFrame, member: str, neighbour: str) -> DataFrame:
    """``left, right, shared``: common neighbours of each pair, looked up from the smaller set, so
    a member with a huge set costs little."""
    sets = memberships.select(F.col(member).alias("_m"), F.col(neighbour).alias("_x"))
    sizes = sets.groupBy("_m").agg(F.count("*").alias("_s"))
    sized = pairs.join(sizes.toDF("left", "_sl"), "left").join(sizes.toDF("right", "_sr"), "right")
    left_smaller = F.col("_sl") <= F.col("_sr")
    sided = sized.select(
        "left", "right",
        F.when(left_smaller, F.col("left")).otherwise(F.col("right")).alias("_small"),
        F.when(left_smaller, F.col("right")).otherwise(F.col("left")).alias("_large"),
    )
    return (
        sided.join(sets.toDF("_small", "_x"), "_small")
        .join(sets.toDF("_large", "_x"), ["_large", "_x"], "left_semi")
        .groupBy("left", "right")
        .agg(F.count("*").alias("shared"))
    )


def shared_neighbor_pairs(
    memberships: DataFrame, member: str, neighbour: str, min_shared: int
) -> DataFrame:
    """Pairs ``left < right`` of members with at least ``min_shared`` common neighbours, with the
    exact count ``shared``."""
    scratch = Scratch(memberships.sparkSession)
    ranked = ranked_memberships(memberships, member, neighbour, (), scratch)
    pairs = scratch.put(candidate_pairs(ranked, member, neighbour, [(min_shared, ())], scratch), "candidates")
    return count_shared(pairs, ranked, member, neighbour).filter(F.col("shared") >= min_shared)


# --- other joins ------------------------------------------------------------------------------


def theta_join(left: DataFrame, right: DataFrame, equal: Sequence[tuple[str, str]], condition: Column) -> DataFrame:
    """An equi-join on ``equal`` (left column, right column) with a residual condition; columns of
    the sides are addressed as ``l.x`` and ``r.x`` in the condition."""
    on = condition
    for a, b in equal:
        on = on & (F.col(f"l.{a}") == F.col(f"r.{b}"))
    return left.alias("l").join(right.alias("r"), on)


def cartesian_match(left: DataFrame, right: DataFrame, equal: Sequence[tuple[str, str]]) -> DataFrame:
    """``MATCH (a), (b) WHERE a.x = b.y``: always joined on the equality, never a product."""
    return theta_join(left, right, equal, F.lit(True))


def merge_left_indicator(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full merge with ``merge_flag``: both, left_only or right_only."""
    l = left.withColumn("_l", F.lit(True))
    r = right.withColumn("_r", F.lit(True))
    flag = F.when(F.col("_l") & F.col("_r"), "both").when(F.col("_l"), "left_only").otherwise("right_only")
    return l.join(r, list(on), "full_outer").withColumn("merge_flag", flag).drop("_l", "_r")


def isin_other_table(df: DataFrame, column: str, other: DataFrame, other_column: str, out: str) -> DataFrame:
    """A boolean column: does the value occur in the other table."""
    known = other.select(F.col(other_column).alias(column)).distinct().withColumn(out, F.lit(True))
    return df.join(known, column, "left").withColumn(out, F.coalesce(out, F.lit(False)))


def correlated_chain(facts: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Facts aggregated per key and joined one after the other on it (inner)."""
    rows = facts[0]
    for fact in facts[1:]:
        rows = rows.join(fact, list(on))
    return rows


def rematch_chain(rows: DataFrame, carried: Sequence[str], pattern: DataFrame, on: Sequence[str]) -> DataFrame:
    """WITH DISTINCT carried … MATCH pattern."""
    return rows.select(*carried).distinct().join(pattern, list(on))


def point_in_time_features(
    events: DataFrame,
    features: DataFrame,
    entity: str,
    event_time: str,
    feature_time: str,
    columns: Sequence[str],
) -> DataFrame:
    """Each event with the latest feature row of its entity at or before the event time.

    Events and features are put in one order of (entity, time) and the last feature is carried
    forward over range partitions, so one busy entity does not end up in one task.
    """
    kept = events.columns
    feats = features.select(
        entity, F.col(feature_time).alias("_t"), F.lit(0).alias("_kind"),
        F.struct(F.col(feature_time).alias("_at"), *columns).alias("_v"),
    )
    both = stack([feats, events.withColumns({"_t": F.col(event_time), "_kind": F.lit(1)})])
    found = running_last(both, [entity], ["_t", "_kind"], "_v", "_found").filter("_kind = 1")
    return found.select(
        *kept, F.col("_found._at").alias("feature_time"), *[F.col(f"_found.{c}").alias(c) for c in columns]
    )


def name_ratio(a: Column, b: Column) -> Column:
    """Similarity of two strings in [0, 1]: one minus the edit distance over the longer length."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(1.0)).otherwise(1.0 - F.levenshtein(a, b) / longest)


def fuzzy_name_join(
    rows: DataFrame, id_column: str, name: str, threshold: float = 0.8, block_on: Sequence[Column] = ()
) -> DataFrame:
    """All pairs of distinct names with a ratio above ``threshold`` (and equal ``block_on``
    values, if given), and how many rows each name stands for.

    Equal names are grouped first, so copies cost nothing. A pair above the threshold with the
    longer length M is fewer than (1 - threshold) * M edits apart. When the shorter name is cut
    into one segment more than that many edits, at least one segment is untouched and stands in
    the longer name, shifted by no more than the edits. Names are joined on such segments, which
    loses no pair, and the candidates are then scored.
    """
    keys = [f"_k{i}" for i in range(len(block_on))]
    names = rows.groupBy(name).agg(F.count(id_column).alias("n")).withColumns(dict(zip(keys, block_on)))
    names = Scratch(rows.sparkSession).put(names.withColumn("_len", F.length(name)), "names")
    cut = names.select(*keys, F.col(name).alias("a"), "_len", F.explode(_longer_lengths(threshold)).alias("_m"))
    cut = cut.withColumn("_d", _edits("_m", threshold)).select(
        *keys, "a", "_len", "_m", "_d", F.explode(F.sequence(F.lit(0), F.col("_d"))).alias("_i")
    )
    start = F.floor(F.col("_len") * F.col("_i") / (F.col("_d") + 1)).cast("int")
    stop = F.floor(F.col("_len") * (F.col("_i") + 1) / (F.col("_d") + 1)).cast("int")
    cut = cut.select(*keys, "a", "_len", "_m", "_i", F.substring("a", start + 1, stop - start).alias("_seg"))
    probe = names.select(*keys, F.col(name).alias("b"), F.col("_len").alias("_m")).withColumn("_d", _edits("_m", threshold))
    probe = probe.withColumn("_len", F.explode(F.sequence(F.greatest(F.col("_m") - F.col("_d"), F.lit(1)), F.col("_m"))))
    probe = probe.select("*", F.explode(F.sequence(F.lit(0), F.col("_d"))).alias("_i")).withColumns(
        {"_s": start, "_w": stop - start}
    )
    shifts = F.sequence(F.greatest(F.col("_s") - F.col("_d"), F.lit(0)), F.least(F.col("_s") + F.col("_d"), F.col("_m") - F.col("_w")))
    reachable = F.greatest(F.col("_s") - F.col("_d"), F.lit(0)) <= F.least(F.col("_s") + F.col("_d"), F.col("_m") - F.col("_w"))
    probe = probe.filter(reachable).select("*", F.explode(shifts).alias("_p")).select(
        *keys, "b", "_len", "_m", "_i", F.substring("b", F.col("_p") + 1, F.col("_w")).alias("_seg")
    ).distinct()
    pairs = (
        cut.join(probe, [*keys, "_len", "_m", "_i", "_seg"])
        .filter(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("left"), F.greatest("a", "b").alias("right"))
        .distinct()
    )
    scored = pairs.withColumn("ratio", name_ratio(F.col("left"), F.col("right"))).filter(F.col("ratio") > threshold)
    sizes = names.select(name, "n")
    return (
        scored.join(sizes.toDF("left", "left_rows"), "left")
        .join(sizes.toDF("right", "right_rows"), "right")
        .select("left", "right", "ratio", "left_rows", "right_rows")
    )


def _edits(length: str, threshold: float) -> Column:
    """Most edits of a pair above the threshold whose longer name has this length."""
    return F.greatest(F.ceil(F.col(length) * F.lit(1.0 - threshold) + 1e-9) - 1, F.lit(0)).cast("int")


def _longer_lengths(threshold: float) -> Column:
    """Lengths M a longer partner may have: the difference in length is itself an edit."""
    most = F.floor(F.col("_len") / F.lit(threshold) + 1e-9).cast("int")
    return F.sequence(F.col("_len"), F.greatest(most, F.col("_len")))


def blocked_pair_scoring(
    records: DataFrame,
    id_column: str,
    block_on: Sequence[str],
    comparisons: Sequence[tuple[str, float, float]],
    frequency_columns: Sequence[str] = (),
) -> DataFrame:
    """Record pairs that agree on the blocking rule, with a Fellegi-Sunter match weight.

    ``comparisons``: (column, m, u): the chance that the column agrees for a match and for a
    non-match; agreement adds log2(m/u), disagreement log2((1-m)/(1-u)). For a frequency column u
    is the share of records with that value, so agreement on a rare value weighs more.
    """
    columns = [c for c, _, _ in comparisons]
    records = records.select(id_column, *block_on, *[c for c in columns if c not in block_on])
    scored = _blocked_pairs(records, id_column, block_on, columns)
    # what the weight needs of a pair, so that no more is shuffled for the frequencies
    agree = [(F.col(f"{c}_l") == F.col(f"{c}_r")).alias(f"_agree_{c}") for c in columns]
    scored = scored.select("left", "right", *agree, *[f"{c}_l" for c in columns if c in frequency_columns])
    weight = F.lit(0.0)
    total = records.agg(F.count("*").alias("_total"))
    for c, m, u in comparisons:
        chance = F.lit(u)
        if c in frequency_columns:
            share = records.groupBy(F.col(c).alias(f"{c}_l")).agg(F.count("*").alias(f"_n_{c}"))
            scored = scored.join(share, f"{c}_l", "left")
            chance = F.col(f"_n_{c}") / F.col("_total")
        weight = weight + F.when(F.col(f"_agree_{c}"), F.log2(F.lit(m) / chance)).otherwise(
            F.log2(F.lit(1.0 - m) / F.lit(1.0 - u))
        )
    if frequency_columns:
        one = F.lit(1).alias("_one")
        scored = scored.withColumn("_one", F.lit(1)).join(
            F.broadcast(total.select(one, "_total")), "_one"
        )  # a single row
    return scored.select("left", "right", weight.alias("match_weight"))


def _blocked_pairs(records: DataFrame, id_column: str, block_on: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``left, right`` and both values of the columns for all records of two ids that meet in a block. Records are shuffled once, by block,
    and bring their columns; only ids with records in several blocks are looked up again."""
    scratch = Scratch(records.sparkSession)
    values = [f"{c}_{side}" for c in columns for side in "lr"]
    repeated = records.groupBy(F.xxhash64(id_column).alias("_k")).agg(F.count("*").alias("_n")).filter("_n > 1").select("_k")
    repeated = scratch.put(repeated, "repeated")
    scattered = None
    if repeated.take(1):
        again = records.withColumn("_k", F.xxhash64(id_column)).join(repeated, "_k", "left_semi")
        several = F.count_distinct(F.struct(*block_on)) > 1
        scattered = scratch.put(again.groupBy(id_column).agg(several.alias("_apart")).filter("_apart"), "scattered")
    if scattered is None or not scattered.take(1):
        return pairs_within(records, block_on, id_column, carry=columns).select("left", "right", *values)
    marked = records.join(scattered, id_column, "left")
    pairs = pairs_within(marked, block_on, id_column, carry=[*columns, "_apart"])
    apart = F.coalesce("_apart_l", "_apart_r", F.lit(False))
    far = pairs.filter(apart).select("left", "right").distinct()
    for side in ("left", "right"):
        far = far.join(records.select(F.col(id_column).alias(side), *[F.col(c).alias(f"{c}_{side[0]}") for c in columns]), side)
    return stack([pairs.filter(~apart).select("left", "right", *values), far.select("left", "right", *values)])


def watchlist_match(people: DataFrame, first: str, last: str, watchlist: DataFrame, name: str) -> DataFrame:
    """People whose full name is on the list."""
    return people.withColumn("full_name", F.concat_ws(" ", first, last)).join(
        watchlist.select(F.col(name).alias("full_name")).distinct(), "full_name", "left_semi"
    )


# --- paths of many hops -----------------------------------------------------------------------


def variable_length_paths(
    edges: DataFrame,
    starts: DataFrame,
    max_hops: int,
    ends: DataFrame | None = None,
    min_hops: int = 1,
    direction: str = "out",
) -> DataFrame:
    """Paths of ``min_hops..max_hops`` edges that use no edge twice, one row each:
    ``start, end, hops, nodes, edge_ids``.

    ``edges``: src, dst, edge_id; ``starts`` and ``ends``: id. With ``ends`` the search goes from both sides: distances from the starts
    and to the ends are found first, half-paths grow from either side over nodes that still lie on a way of ``max_hops`` edges, and
    the halves meet on their middle node. So the rows before the last join are those of half the length.
    """
    scratch = Scratch(edges.sparkSession)
    steps = scratch.put(_plain(edges, direction), "edges")
    if ends is None:
        halves = _grown_paths(steps, starts, max_hops, None, scratch, "out")
        return stack(rows.withColumn("hops", F.lit(hop).cast("bigint")) for hop, rows in enumerate(halves) if hop >= max(min_hops, 1)).select(
            F.col("first").alias("start"), F.col("last").alias("end"), "hops", "nodes", "edge_ids"
        )
    backward = steps.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "edge_id")
    to_go = scratch.put(_hops_to(steps, ends, max_hops, scratch), "to_go")
    gone = scratch.put(_hops_to(backward, starts, max_hops, scratch), "gone")
    on_way = to_go.withColumnRenamed("away", "_to").join(gone.withColumnRenamed("away", "_from"), "id").filter(F.col("_to") + F.col("_from") <= max_hops)
    on_way = scratch.put(on_way, "on_way")
    forth = (max_hops + 1) // 2
    out = _grown_paths(steps, starts, forth, on_way.select("id", F.col("_to").alias("_left")), scratch, "out", max_hops)
    back = _grown_paths(backward, ends, max_hops - forth, on_way.select("id", F.col("_from").alias("_left")), scratch, "back", max_hops)
    found = []
    for hop in range(max(min_hops, 1), max_hops + 1):
        half = (hop + 1) // 2
        tail = back[hop - half].select(
            F.col("first").alias("end"), F.col("last").alias("_middle"), F.reverse("nodes").alias("_nodes"), F.reverse("edge_ids").alias("_edges")
        )
        met = out[half].join(tail, F.col("last") == F.col("_middle")).filter(~F.arrays_overlap("edge_ids", "_edges"))
        found.append(met.select(
            F.col("first").alias("start"), "end", F.lit(hop).cast("bigint").alias("hops"),
            F.concat("nodes", F.slice("_nodes", F.lit(2), F.size("_nodes"))).alias("nodes"), F.concat("edge_ids", "_edges").alias("edge_ids"),
        ))
    return stack(found)


def _grown_paths(
    steps: DataFrame, starts: DataFrame, most: int, left: DataFrame | None, scratch: Scratch, name: str, within: int = 0
) -> list[DataFrame]:
    """For 0 to ``most`` edges the paths from ``starts``: ``first, last, nodes, edge_ids``. ``left``: ``id, _left``, the only nodes to
    visit and the edges that at least follow, of ``within`` in all."""
    rows = starts.select(
        F.col("id").alias("first"), F.col("id").alias("last"), F.array("id").alias("nodes"), F.expr("cast(array() as array<string>)").alias("edge_ids")
    )
    if left is not None:
        rows = rows.join(left.select(F.col("id").alias("last")), "last", "left_semi").select("first", "last", "nodes", "edge_ids")
    grown = [scratch.put(rows, f"{name}_0")]
    for hop in range(1, most + 1):
        further = grown[-1].join(steps.withColumnRenamed("src", "last"), "last").filter(~F.array_contains("edge_ids", F.col("edge_id")))
        if left is not None:
            alive = left.filter(F.col("_left") <= within - hop).select(F.col("id").alias("dst"))
            further = further.join(alive, "dst", "left_semi")
        grown.append(scratch.put(further.select(
            "first", F.col("dst").alias("last"), F.array_append("nodes", F.col("dst")).alias("nodes"),
            F.array_append("edge_ids", F.col("edge_id")).alias("edge_ids"),
        ), f"{name}_{hop}"))
    return grown


def path_listing(*args, **kwargs) -> DataFrame:
    """:func:`variable_length_paths` with the node list as text: ``start, end, hops, path``."""
    rows = variable_length_paths(*args, **kwargs)
    return rows.select("start", "end", "hops", F.array_join("nodes", ">").alias("path"))


def _plain(edges: DataFrame, direction: str) -> DataFrame:
    ends = edges.select("src", "dst", "edge_id")
    if direction == "out":
        return ends
    swapped = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "edge_id")
    return swapped if direction == "in" else ends.unionAll(swapped.filter("src <> dst"))


def _hops_to(steps: DataFrame, ends: DataFrame, max_hops: int, scratch: Scratch) -> DataFrame:
    """``id, away``: fewest hops from a node to the end set, up to ``max_hops``."""
    backward = steps.select(F.col("dst").alias("src"), F.col("src").alias("dst")).distinct()
    return reachable_levels(backward, ends, max_hops, scratch).withColumnRenamed("level", "away")


def reachable_levels(
    edges: DataFrame, starts: DataFrame, max_hops: int | None = None, scratch: Scratch | None = None
) -> DataFrame:
    """``id, level`` of every node that the start set reaches, or reaches within ``max_hops``. Each round
    joins the new nodes only and stops when none are left."""
    scratch = scratch or Scratch(edges.sparkSession)
    seen = scratch.put(starts.select("id", F.lit(0).cast("bigint").alias("level")).distinct(), "reached")
    frontier = seen
    for level in turns(max_hops):
        fresh = (
            frontier.select(F.col("id").alias("src"))
            .join(edges.select("src", "dst"), "src")
            .select(F.col("dst").alias("id"))
            .distinct()
            .join(seen.select("id"), "id", "left_anti")
            .withColumn("level", F.lit(level).cast("bigint"))
        )
        frontier = scratch.put(fresh, f"level_{level}")
        if not frontier.take(1):
            break
        seen = seen.unionByName(frontier)
    return seen


def reachable_set(edges: DataFrame, starts: DataFrame, max_hops: int | None = None) -> DataFrame:
    """Distinct ends reachable from the start set (starts themselves only if reached again are
    not repeated: a start is level 0)."""
    return reachable_levels(edges, starts, max_hops)


def closed_walk_counts(edges: DataFrame, key: str, length: int) -> DataFrame:
    """Closed chains of ``length`` edges with an equal ``key`` value, counted per
    (key, start node): ``<key>, start, cycles``. Consecutive nodes differ.

    Edges that cannot lie on a cycle are trimmed first (each node needs an edge in and out with
    that key). Walks are kept as counts per (key, start, node), so parallel edges and shared
    middles add up instead of multiplying rows.
    """
    scratch = Scratch(edges.sparkSession)
    live = edges.filter("src <> dst").groupBy(key, "src", "dst").agg(F.count("*").alias("n"))
    live = scratch.put(live, "live")
    for _ in range(length):
        has_in = live.select(key, F.col("dst").alias("src")).distinct()
        has_out = live.select(key, F.col("src").alias("dst")).distinct()
        live = live.join(has_in, [key, "src"], "left_semi").join(has_out, [key, "dst"], "left_semi")
        live = scratch.put(live, "live")
    walks = live.select(key, F.col("src").alias("start"), F.col("dst").alias("at"), "n")
    for step in range(2, length + 1):
        grown = walks.join(
            live.select(key, F.col("src").alias("at"), "dst", F.col("n").alias("m")), [key, "at"]
        )
        if step == length:
            grown = grown.filter(F.col("dst") == F.col("start"))
        walks = scratch.put(
            grown.groupBy(key, "start", F.col("dst").alias("at")).agg(F.sum(F.col("n") * F.col("m")).alias("n")),
            "walks",
        )
    return walks.select(key, "start", F.col("n").alias("cycles"))


def cycle_match(edges: DataFrame, key: str, length: int) -> DataFrame:
    """Closed chains of ``length`` edges with an equal ``key``: ``<key>, nodes, edge_ids``. Only
    starts that lie on a counted cycle are expanded, and two half-chains meet in the middle."""
    scratch = Scratch(edges.sparkSession)
    counted = closed_walk_counts(edges, key, length)
    on_cycle = scratch.put(counted.select(key, F.col("start").alias("n")).distinct(), "on_cycle")
    live = edges.filter("src <> dst").select(key, "src", "dst", "edge_id")
    for side in ("src", "dst"):
        live = live.join(on_cycle.withColumnRenamed("n", side), [key, side], "left_semi")
    live = scratch.put(live, "live")

    def chains(k: int) -> DataFrame:
        rows = live.select(
            key, F.col("src").alias("a"), F.col("dst").alias("z"), F.array("src", "dst").alias("nodes"),
            F.array("edge_id").alias("edge_ids"),
        )
        for _ in range(k - 1):
            rows = rows.join(live.withColumnRenamed("src", "z"), [key, "z"]).select(
                key, "a", F.col("dst").alias("z"), F.array_append("nodes", F.col("dst")).alias("nodes"),
                F.array_append("edge_ids", F.col("edge_id")).alias("edge_ids"),
            )
        return rows

    half = length // 2
    first = chains(length - half)
    second = chains(half).select(
        key, F.col("a").alias("z"), F.col("z").alias("a"), F.col("nodes").alias("nodes2"), F.col("edge_ids").alias("ids2")
    )
    return first.join(second, [key, "a", "z"]).select(
        key,
        F.concat("nodes", F.expr("slice(nodes2, 2, size(nodes2))")).alias("nodes"),
        F.concat("edge_ids", "ids2").alias("edge_ids"),
    )
