"""Shortest paths, breadth-first search, k shortest paths and random walks.

Graphs are ``nodes`` (id) and ``edges`` (src, dst and property columns). Each round joins the rows
that changed in the last one, writes the new ones, and stops when none changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trellis.model import stack
from trellis.operators.match import reachable_levels
from trellis.operators.ordering import global_row_number
from trellis.session import Scratch, turns


DRAWS = 8  # draws of a biased walker per round


class NegativeWeight(ValueError):
    """Raised for a negative edge weight."""


def weighted_edges(edges: DataFrame, weight: str | None, null_weights: str = "drop") -> DataFrame:
    """``src, dst, w``: the lightest of parallel edges; without a weight every edge counts one.
    Edges without a weight value are dropped, or refused with ``null_weights='fail'``."""
    if weight is None:
        return edges.select("src", "dst").distinct().withColumn("w", F.lit(1).cast("bigint"))
    if null_weights == "fail" and edges.filter(F.col(weight).isNull()).take(1):
        raise ValueError(f"an edge has no {weight}")
    if edges.filter(F.col(weight) < 0).take(1):
        raise NegativeWeight(f"negative {weight}")
    return edges.filter(F.col(weight).isNotNull()).groupBy("src", "dst").agg(F.min(weight).alias("w"))


def bfs(nodes: DataFrame, edges: DataFrame, source, max_iterations: int | None = None, result: str = "level") -> DataFrame:
    """``id`` and the level from ``source``; null when not reached, or not within ``max_iterations``."""
    scratch = Scratch(edges.sparkSession)
    steps = scratch.put(edges.select("src", "dst").distinct(), "edges")
    start = nodes.filter(F.col("id") == F.lit(source)).select("id")
    levels = reachable_levels(steps, start, max_iterations, scratch)
    return nodes.select("id").join(levels.withColumnRenamed("level", result), "id", "left")


def sssp(
    nodes: DataFrame,
    edges: DataFrame,
    source,
    weight: str | None = None,
    max_iterations: int | None = None,
    result: str = "distance",
    null_weights: str = "drop",
) -> DataFrame:
    """``id`` and the cheapest distance from ``source``, over all paths or those of at most ``max_iterations``
    edges; null when there is none."""
    scratch = Scratch(edges.sparkSession)
    steps = scratch.put(weighted_edges(edges, weight, null_weights), "edges")
    best = _distances(steps, nodes.filter(F.col("id") == F.lit(source)).select("id"), max_iterations, scratch)
    return nodes.select("id").join(best.withColumnRenamed("dist", result), "id", "left")


def _distances(steps: DataFrame, starts: DataFrame, max_iterations: int | None, scratch: Scratch) -> DataFrame:
    kind = dict(steps.dtypes)["w"]
    frontier = scratch.put(starts.select("id", F.lit(0).cast(kind).alias("dist")), "start")
    parts = [frontier]
    for turn in turns(max_iterations):
        offers = (
            frontier.withColumnRenamed("id", "src")
            .join(steps, "src")
            .groupBy(F.col("dst").alias("id"))
            .agg(F.min(F.col("dist") + F.col("w")).alias("dist"))
        )
        known = stack(parts).groupBy("id").agg(F.min("dist").alias("_known"))
        better = offers.join(known, "id", "left").filter(
            F.col("_known").isNull() | (F.col("dist") < F.col("_known"))
        )
        frontier = scratch.put(better.select("id", "dist"), f"round_{turn}")
        if not frontier.take(1):
            break
        parts.append(frontier)
        if len(parts) > 6:
            parts = [scratch.put(stack(parts).groupBy("id").agg(F.min("dist").alias("dist")), "known")]
    return stack(parts).groupBy("id").agg(F.min("dist").alias("dist"))


def shortest_path_tree(
    nodes: DataFrame, edges: DataFrame, source, weight: str | None = None, max_iterations: int | None = None
) -> DataFrame:
    """``id, distance, predecessor``: the predecessor is the smallest id that lies on a cheapest
    path. Weights must be positive."""
    scratch = Scratch(edges.sparkSession)
    steps = scratch.put(weighted_edges(edges, weight), "edges")
    start = nodes.filter(F.col("id") == F.lit(source)).select("id")
    best = scratch.put(_distances(steps, start, max_iterations, scratch), "best")
    via = (
        steps.join(best.select(F.col("id").alias("src"), F.col("dist").alias("_from")), "src")
        .join(best.withColumnRenamed("id", "dst"), "dst")
        .filter((F.col("_from") + F.col("w") == F.col("dist")) & (F.col("dst") != F.lit(source)))
        .groupBy(F.col("dst").alias("id"))
        .agg(F.min("src").alias("predecessor"))
    )
    return (
        nodes.select("id")
        .join(best.withColumnRenamed("dist", "distance"), "id", "left")
        .join(via, "id", "left")
    )


def _next_steps(steps: DataFrame, away: DataFrame) -> DataFrame:
    """``src, next``: from every node that reaches the target the smallest next node on a cheapest way there."""
    return (
        steps.join(away.select(F.col("id").alias("dst"), F.col("dist").alias("_to")), "dst")
        .join(away.select(F.col("id").alias("src"), F.col("dist").alias("_from")), "src")
        .filter(F.col("w") + F.col("_to") == F.col("_from"))
        .groupBy("src")
        .agg(F.min("dst").alias("next"))
    )


def _followed(rows: DataFrame, tree: DataFrame, target, most: int | None, scratch: Scratch) -> DataFrame:
    """``cost, nodes`` of the rows (``at, cost, nodes``) that reach the target along the tree, without a loop and with
    at most ``most`` edges."""
    there = None
    for turn in turns(most):
        arrived = rows.filter((F.col("at") == F.lit(target)) & ((F.size("nodes") - 1 <= most) if most else F.lit(True))).select("cost", "nodes")
        there = arrived if there is None else there.unionByName(arrived)
        going = rows.filter(F.col("at") != F.lit(target)).join(tree.withColumnRenamed("src", "at"), "at")
        going = going.filter(~F.array_contains("nodes", F.col("next")))
        rows = scratch.put(
            going.select(F.col("next").alias("at"), "cost", F.array_append("nodes", F.col("next")).alias("nodes")), f"followed_{turn}"
        )
        if not rows.take(1):
            return there
    return there.unionByName(rows.filter((F.col("at") == F.lit(target)) & (F.size("nodes") - 1 <= most)).select("cost", "nodes"))


def _deviations(steps: DataFrame, away: DataFrame, start, target, most: int | None, scratch: Scratch) -> DataFrame:
    """``cost, nodes`` of the tree's path from start to target and of the loopless paths that leave it once: along some other edge,
    and from that edge's end along the tree again."""
    kinds = dict(steps.dtypes)
    tree = scratch.put(_next_steps(steps, away), "tree")
    first = steps.sparkSession.range(1).select(
        F.lit(start).cast(kinds["src"]).alias("at"), F.lit(0).cast(kinds["w"]).alias("cost"), F.array(F.lit(start).cast(kinds["src"])).alias("nodes")
    ).join(away.select(F.col("id").alias("at"), F.col("dist").alias("_d")), "at").select("at", F.col("_d").alias("cost"), "nodes")
    main = scratch.put(_followed(first, tree, target, most, scratch), "main")
    # One row per node of the path but the last, with the path up to there; each is joined with its edges.
    places = main.select("cost", "nodes", F.posexplode("nodes").alias("_i", "at")).filter(F.col("at") != F.lit(target)).select(
        "cost", "at", F.slice("nodes", F.lit(1), F.col("_i") + 1).alias("before"), F.get("nodes", F.col("_i") + 1).alias("_on")
    )
    sides = (
        places.join(steps.withColumnRenamed("src", "at"), "at").filter((F.col("dst") != F.col("_on")) & ~F.array_contains("before", F.col("dst")))
        .join(away.select(F.col("id").alias("dst"), F.col("dist").alias("_to")), "dst")
        .join(away.select(F.col("id").alias("at"), F.col("dist").alias("_from")), "at")
        .select(F.col("dst").alias("at"), (F.col("cost") + F.col("w") + F.col("_to") - F.col("_from")).alias("cost"), F.array_append("before", F.col("dst")).alias("nodes"))
    )
    left = _followed(scratch.put(sides, "sides"), tree, target, most, scratch)
    return scratch.put(main.unionByName(left).distinct(), "deviations")


def ksssp(
    edges: DataFrame, start, target, k: int, weight: str | None = None, max_iterations: int | None = None
) -> DataFrame:
    """The ``k`` cheapest loopless paths, of at most ``max_iterations`` edges if given: ``rank, cost, hops, path``, ties in path order.

    First the tree of cheapest ways to the target, over reversed edges. It gives every node's distance to go, and complete paths at
    once: the tree's own from the start, and all that leave it along one edge and follow the tree again. The cost of the k-th of these is
    a bound before any search. Prefixes then grow edge by edge, and one is kept only while its cost plus the distance to go is
    within the bound, which paths that arrive lower further; so no answer is lost, and where the bound is tight few prefixes are
    looked at however large the graph. If fewer than ``k`` such paths exist, there is no bound until ``k`` have arrived.
    """
    scratch = Scratch(edges.sparkSession)
    spark = edges.sparkSession
    steps = scratch.put(weighted_edges(edges, weight).filter("src <> dst"), "edges")
    kinds = dict(steps.dtypes)
    backward = steps.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w")
    end = spark.range(1).select(F.lit(target).cast(kinds["src"]).alias("id"))
    away = scratch.put(_distances(backward, end, max_iterations, scratch), "away")
    rows = spark.range(1).select(
        F.lit(start).cast(kinds["src"]).alias("at"), F.lit(0).cast(kinds["w"]).alias("cost"),
        F.array(F.lit(start).cast(kinds["src"])).alias("nodes"),
    )
    known = _deviations(steps, away, start, target, max_iterations, scratch).orderBy("cost").limit(k).agg(F.count("*"), F.max("cost")).first()
    bound = known[1] if known[0] == k else None
    done = None
    for hop in turns(max_iterations):
        grown = (
            rows.withColumnRenamed("at", "src")
            .join(steps, "src")
            .filter(~F.array_contains("nodes", F.col("dst")))
            .join(away.select(F.col("id").alias("dst"), F.col("dist").alias("_left")), "dst")
            .withColumn("cost", F.col("cost") + F.col("w"))
        )
        if bound is not None:
            grown = grown.filter(F.col("cost") + F.col("_left") <= F.lit(bound))
        grown = scratch.put(
            grown.select(F.col("dst").alias("at"), "cost", F.array_append("nodes", F.col("dst")).alias("nodes")),
            f"prefix_{hop}",
        )
        arrived = grown.filter(F.col("at") == F.lit(target))
        done = arrived if done is None else done.unionByName(arrived)
        kth = done.orderBy("cost").limit(k).agg(F.count("*"), F.max("cost")).first()
        if kth[0] == k:
            bound = kth[1]
            done = done.filter(F.col("cost") <= F.lit(bound))
        rows = grown.filter(F.col("at") != F.lit(target))
        if bound is not None:
            rows = rows.filter(F.col("cost") <= F.lit(bound))
        if not rows.take(1):
            break
    best = done.select("cost", (F.size("nodes") - 1).cast("bigint").alias("hops"), F.array_join("nodes", ">").alias("path"))
    best = best.orderBy("cost", "path").limit(k)  # k rows: the window below is over these only
    return best.withColumn("rank", F.row_number().over(Window.orderBy("cost", "path")).cast("bigint"))


def random_walks(
    edges: DataFrame,
    roots: DataFrame,
    walk_length: int,
    number_of_walks: int,
    backward_probability: float = 1.0,
    forward_probability: float = 1.0,
    seed: int = 7,
    max_turns: int = 6,
) -> DataFrame:
    """Reproducible walks: ``root, walk, path``. A walk ends early at a node without out-edges.

    Out-edges are numbered 1..M over the whole graph in source order, so a walker picks one by
    joining on that number: a hub's walkers spread over all its edges. The node2vec bias is drawn
    by rejection: the step back to the previous node is kept with weight
    ``backward_probability``, a step to a node next to the previous one with weight 1, any other
    with weight ``forward_probability``. A walker draws DRAWS times at once and takes the first
    draw that is kept; one without any draws again, up to ``max_turns`` times. The few that are then left
    draw from all their weighted out-edges at once, which follows the same law, so no walk is lost; a walk whose
    out-edges all have weight 0 ends.
    """
    scratch = Scratch(edges.sparkSession)
    numbered = scratch.put(
        global_row_number(edges.select("src", "dst").distinct(), ["src", "dst"], "pos"), "numbered"
    )
    spans = scratch.put(
        numbered.groupBy("src").agg(F.min("pos").alias("first"), F.count("*").alias("degree")), "spans"
    )
    biased = backward_probability != 1.0 or forward_probability != 1.0
    highest = max(1.0, backward_probability, forward_probability)
    walks = scratch.put(
        roots.select(F.col("id").alias("root"))
        .withColumn("walk", F.explode(F.sequence(F.lit(0), F.lit(number_of_walks - 1))))
        .select("root", "walk", F.array("root").alias("path")),
        "walks",
    )
    ended = []
    for step in range(walk_length):
        at = walks.withColumn("src", F.element_at("path", -1)).join(spans, "src", "left")
        ended.append(at.filter("degree is null").select("root", "walk", "path"))
        pending = at.filter("degree is not null")
        if not biased:
            draw = F.pmod(F.xxhash64(F.lit(seed), "root", "walk", F.lit(step)), F.col("degree"))
            moved = pending.withColumn("pos", F.col("first") + draw).join(numbered.select("pos", "dst"), "pos")
            walks = scratch.put(_longer(moved), f"walks_{step}")
            continue
        kept = []
        for turn in range(max_turns):
            drawn = _biased_draws(pending, numbered, seed, step, turn, backward_probability, forward_probability, highest)
            tried = scratch.put(
                pending.join(drawn, ["root", "walk"], "left").select(*pending.columns, "dst"), f"drawn_{step}_{turn}"
            )
            kept.append(_longer(tried.filter("dst is not null")))
            pending = tried.filter("dst is null").drop("dst")
            if not pending.take(1):
                break
        else:
            rest = scratch.put(
                pending.join(_weighted_draws(pending, numbered, seed, step, backward_probability, forward_probability, highest), ["root", "walk"], "left")
                .select(*pending.columns, "dst"), f"drawn_{step}_rest"
            )
            kept.append(_longer(rest.filter("dst is not null")))
            ended.append(rest.filter("dst is null").select("root", "walk", "path"))
        walks = scratch.put(stack(kept), f"walks_{step}")
    return stack([*ended, walks])


def _longer(rows: DataFrame) -> DataFrame:
    return rows.select("root", "walk", F.array_append("path", F.col("dst")).alias("path"))


def _bias(steps: DataFrame, numbered: DataFrame, back: float, forward: float, highest: float) -> DataFrame:
    """The ``_weight`` of each step to ``dst`` of a walker with ``path``."""
    near = numbered.select(F.col("src").alias("_before"), "dst", F.lit(True).alias("_near"))
    steps = steps.withColumn("_before", F.when(F.size("path") > 1, F.try_element_at("path", F.lit(-2)))).join(
        near, ["_before", "dst"], "left"
    )
    weight = (
        F.when(F.col("_before").isNull(), F.lit(highest))
        .when(F.col("dst") == F.col("_before"), F.lit(back))
        .when(F.col("_near"), F.lit(1.0))
        .otherwise(F.lit(forward))
    )
    return steps.withColumn("_weight", weight)


def _weighted_draws(
    pending: DataFrame, numbered: DataFrame, seed: int, step: int, back: float, forward: float, highest: float
) -> DataFrame:
    """``root, walk, dst``: one draw by weight for each walker, the smallest of exponential keys."""
    steps = _bias(pending.join(numbered.select("src", "dst"), "src"), numbered, back, forward, highest).filter("_weight > 0")
    uniform = (F.pmod(F.xxhash64(F.lit(seed + 2), "root", "walk", F.lit(step), "dst"), F.lit(1 << 30)) + 1) / float((1 << 30) + 1)
    return steps.groupBy("root", "walk").agg(F.min(F.struct((-F.log(uniform) / F.col("_weight")).alias("_key"), "dst"))["dst"].alias("dst"))


def _biased_draws(
    pending: DataFrame, numbered: DataFrame, seed: int, step: int, turn: int, back: float, forward: float, highest: float
) -> DataFrame:
    """``root, walk, dst``: the first kept draw of each walker that has one."""
    tries = F.sequence(F.lit(turn * DRAWS), F.lit(turn * DRAWS + DRAWS - 1))
    draws = pending.withColumn("_try", F.explode(tries)).withColumn(
        "pos", F.col("first") + F.pmod(F.xxhash64(F.lit(seed), "root", "walk", F.lit(step), "_try"), F.col("degree"))
    )
    draws = _bias(draws.join(numbered.select("pos", "dst"), "pos"), numbered, back, forward, highest)
    coin = F.pmod(F.xxhash64(F.lit(seed + 1), "root", "walk", F.lit(step), "_try"), F.lit(1 << 30)) / float(1 << 30)
    return (
        draws.filter(coin < F.col("_weight") / highest)
        .groupBy("root", "walk")
        .agg(F.min(F.struct("_try", "dst"))["dst"].alias("dst"))
    )
