"""PageRank, betweenness and degrees."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trellis.model import stack
from trellis.operators.neighbourhoods import Blocks
from trellis.session import Scratch, turns


def pagerank(
    nodes: DataFrame,
    edges: DataFrame,
    max_iterations: int = 20,
    alpha: float = 0.15,
    tolerance: float | None = 1e-3,
    result: str = "rank",
    cut_every: int = 3,
    hub_size: int = 200_000,
) -> DataFrame:
    """``rank(v) = (1 - alpha) + alpha * sum(rank(u) / outdegree(u))``, un-normalised.

    The default ``alpha`` 0.15 is the weight of the *links* (the published results that this
    matches use it so); pass 0.85 for the usual damping. Parallel edges each count. The rank of a
    node without out-edges goes nowhere. With a ``tolerance`` the run stops when no rank moved
    more since the last time the state was written (every ``cut_every`` rounds).

    Edges are shuffled once into blocks of their targets and packed; a round reads them where they lie (``neighbourhoods``), shuffles nothing
    and writes one row per node. A node's rank is sent as one number however many out-edges it has, so ``hub_size``, from where sources
    were cut, changes nothing.
    """
    scratch = Scratch(edges.sparkSession)
    ends = F.array("src", "dst")  # of one type
    grouped = edges.select(ends[0].alias("src"), ends[1].alias("dst")).groupBy("src", "dst").agg(F.count("*").cast("double").alias("n"))
    grouped = scratch.put(grouped, "edges")
    sources = scratch.put(grouped.filter("src is not null").groupBy("src").agg(F.sum("n").alias("out")), "sources")
    listed = nodes.select("id").distinct()
    first = F.lit(1.0 if max_iterations < 1 else 1.0 - alpha).alias(result)
    rows = grouped.count()
    if not rows or max_iterations < 1:
        return listed.select("id", first)
    # each source is a node of the blocks, also one without in-edges
    graph = grouped.filter("src is not null and dst is not null").select(F.col("dst").alias("i"), F.col("src").alias("j"), F.col("n").alias("a"))
    graph = graph.unionAll(sources.select(F.col("src").alias("i"), F.lit(None).cast(sources.schema["src"].dataType).alias("j"), F.lit(0.0).alias("a")))
    blocks = Blocks(graph, rows, scratch, "in_edges")
    known = blocks.nodes.select("b", "l", "id").join(listed.withColumn("_known", F.lit(True)), "id", "left")
    out = known.join(sources.withColumnRenamed("src", "id"), "id", "left").select("b", "l", F.when(F.col("_known"), F.col("out")).alias("out"), "_known")
    rank = F.when(F.col("_known"), 1.0)
    start = out.select("b", "l", rank.alias("rank"), F.coalesce(1.0 / F.col("out"), F.lit(0.0)).alias("share"), "out", rank.alias("mark"))
    slot, mark = blocks.put(start, "ranks_0"), False
    for turn in range(1, max_iterations + 1):
        before, slot = slot, f"ranks_{turn}"
        ranks = blocks.received(before, slot, alpha, mark)
        blocks.drop(before)
        mark = turn % cut_every == 0 and turn < max_iterations
        if mark and tolerance is not None and not ranks.filter(F.abs(F.col("rank") - F.col("mark")) > tolerance).take(1):
            break
    found = blocks.nodes.select("b", "l", "id").join(ranks.select("b", "l", F.col("rank").alias("_rank")), ["b", "l"]).select("id", "_rank")
    return listed.join(found, "id", "left").select("id", F.coalesce("_rank", first).alias(result))


SOURCES = 512  # whose paths are followed at a time


def first_sources(nodes: DataFrame, num_sources: int) -> DataFrame:
    """The first ids in md5 order: a fixed choice that does not depend on the partitioning."""
    return nodes.select("id").orderBy(F.md5(F.col("id").cast("string")), "id").limit(num_sources)


def betweenness_centrality(
    nodes: DataFrame,
    edges: DataFrame,
    num_sources: int | None = None,
    max_depth: int | None = None,
    result: str = "betweenness",
    block: int = SOURCES,
) -> DataFrame:
    """Unnormalised directed betweenness over shortest hop paths (Brandes), from all nodes or from
    the first ``num_sources`` in md5 order. About ``block`` sources at a time advance together, level by level, on rows (source,
    node, paths), to the last node reached or to the hop limit that the caller names; the way back adds the dependencies level by
    level. A level is one pass over the edges where they lie (``neighbourhoods``), both ways; it shuffles nothing.
    A block's tables go when its sums are added to the total, so the state is never more than a block times the nodes."""
    scratch = Scratch(edges.sparkSession)
    ends = F.array("src", "dst")  # of one type
    steps = edges.select(ends[0].alias("v"), ends[1].alias("w")).filter("v <> w").distinct()
    steps = scratch.put(steps, "edges")
    rows = steps.count()
    none = nodes.select("id", F.lit(0.0).alias(result))
    if not rows:
        return none
    sources = scratch.put(nodes.select("id") if num_sources is None else first_sources(nodes, num_sources), "sources")
    groups = -(-sources.count() // block)
    # a bit of the weight for either direction, since both may be there
    graph = steps.select(F.col("w").alias("i"), F.col("v").alias("j"), F.lit(1.0).alias("a")).unionAll(steps.select("v", "w", F.lit(2.0)))
    blocks = Blocks(graph, 2 * rows, scratch, "steps")
    code = (F.col("l").cast("bigint") * blocks.count + F.col("b")).alias("s")
    group = F.pmod(F.xxhash64("id"), F.lit(max(groups, 1))).alias("_group")
    starts = scratch.put(sources.distinct().join(blocks.nodes.select("id", "b", "l"), "id").select("b", "l", code, group), "starts")
    total = None
    for number in range(groups):
        part = _dependencies(blocks, starts.filter(F.col("_group") == number).drop("_group"), max_depth, number)
        if part is None:
            continue
        sums, slots = part
        both = sums if total is None else stack([total, sums]).groupBy("b", "l").agg(F.sum("_b").alias("_b"))
        total = scratch.put(both, "total")
        for slot in slots:
            blocks.drop(slot)
    if total is None:
        return none
    found = total.join(blocks.nodes.select("b", "l", "id"), ["b", "l"]).select("id", "_b")
    return nodes.select("id").join(found, "id", "left").select("id", F.coalesce("_b", F.lit(0.0)).alias(result))


def _dependencies(blocks: Blocks, starts: DataFrame, max_depth: int | None, number: int) -> tuple[DataFrame, list[str]] | None:
    """``b, l, _b``: what the shortest paths from these sources add to each node's betweenness, and the slots that hold it; none if they lead nowhere."""
    sources = [row["s"] for row in starts.select("s").collect()]  # no more than about a block
    levels = [blocks.put(starts.withColumn("paths", F.lit(1.0)), f"level_{number}_0")]
    for depth in turns(max_depth):
        slot = f"level_{number}_{depth}"
        level = blocks.reached(levels, sources, slot)
        if not level.take(1):
            blocks.drop(slot)
            break
        levels.append(slot)
    if len(levels) == 1:
        blocks.drop(levels[0])
        return None
    totals, behind, slots = [], None, list(levels)
    for depth in range(len(levels) - 1, 0, -1):
        slot = f"delta_{number}_{depth}"
        totals.append(blocks.returned(levels[depth], behind, sources, slot).select("b", "l", "delta"))
        behind = slot
        slots.append(slot)
    return stack(totals).groupBy("b", "l").agg(F.sum("delta").alias("_b")), slots


def degree_centrality(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``id, in_degree, out_degree, degree``; parallel edges count."""
    ends = edges.select(F.col("src").alias("id"), F.lit(1).alias("o"), F.lit(0).alias("i")).unionAll(
        edges.select("dst", F.lit(0), F.lit(1))
    )
    sums = ends.groupBy("id").agg(F.sum("o").alias("o"), F.sum("i").alias("i"))
    o, i = F.coalesce("o", F.lit(0)).cast("bigint"), F.coalesce("i", F.lit(0)).cast("bigint")
    return nodes.select("id").join(sums, "id", "left").select(
        "id", i.alias("in_degree"), o.alias("out_degree"), (i + o).alias("degree")
    )


def neighbour_labels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Distinct (label, direction, neighbour label). ``nodes``: id, label."""
    s = nodes.select(F.col("id").alias("src"), F.col("label").alias("sl"))
    d = nodes.select(F.col("id").alias("dst"), F.col("label").alias("dl"))
    pairs = edges.select("src", "dst").join(s, "src").join(d, "dst").select("sl", "dl").distinct()
    return pairs.select(F.col("sl").alias("label"), F.lit("out").alias("direction"), F.col("dl").alias("neighbour_label")).unionAll(
        pairs.select("dl", F.lit("in"), "sl")
    )
