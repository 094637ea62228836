"""Triangles by blocks against brute force, with cells and stretches of a few rows."""

import itertools
import random

import pytest

from trellis.operators import match


@pytest.mark.parametrize("text_ids", [False, True])
def test_triangles_by_blocks(spark, monkeypatch, text_ids):
    monkeypatch.setattr(match, "WEDGES", 50)
    rng = random.Random(3)
    name = (lambda i: f"n{i}") if text_ids else (lambda i: i)
    # A hub next to every node, a clique, and random edges both ways, repeated and looped.
    pairs = [(0, i) for i in range(1, 60)] + list(itertools.combinations(range(20, 32), 2))
    pairs += [(rng.randrange(60), rng.randrange(60)) for _ in range(300)]
    pairs += pairs[:40]
    kind = "string" if text_ids else "long"
    edges = spark.createDataFrame([(name(a), name(b)) for a, b in pairs], f"src {kind}, dst {kind}")
    linked = {frozenset((a, b)) for a, b in pairs if a != b}
    want = {
        frozenset(map(name, t)) for t in itertools.combinations(range(60), 3) if all(frozenset(side) in linked for side in itertools.combinations(t, 2))
    }
    for cell_edges in (None, 60):
        found = [frozenset((r.u, r.v, r.w)) for r in match.triangle_list(edges, cell_edges=cell_edges).collect()]
        assert len(found) == len(want) and set(found) == want


def test_no_triangles_without_edges(spark):
    edges = spark.createDataFrame([], "src long, dst long")
    assert match.triangle_list(edges).count() == 0
    assert match.triangle_list(spark.createDataFrame([(1, 2), (2, 3)], "src long, dst long")).count() == 0


def test_few_copies_of_an_edge():
    """A cell holds up to 4,194,304 edges, so 3.3 million edges on eight cores are sent 6 times, not 12."""
    from trellis.operators.match import node_parts

    assert 3 * node_parts(3_300_000, 8) == 6
    assert 3 * node_parts(150_000_000, 12) == 33
    assert node_parts(10, 27) == 3


def test_blocks_hold_each_edge_once(spark):
    """What is shuffled and written does not grow with the number of parts; only what the cells read does."""
    from trellis.session import Scratch

    pairs = list(itertools.combinations(range(12), 2))
    scratch = Scratch(spark)
    found = match.triangle_list(spark.createDataFrame(pairs + pairs, "src long, dst long"), scratch, cell_edges=10)
    assert match.node_parts(len(pairs), 1, 10) == 5
    assert spark.read.parquet(f"{scratch.root}/blocks").count() == len(pairs)
    assert found.count() == 220
