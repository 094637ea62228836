"""Neighbourhood samples against plain Python: every seed ranks all out-edges of a node by a hash of its own."""

from collections import defaultdict
from hashlib import md5

from trellis.operators.features import sample_neighbourhood


def test_each_seed_ranks_all_out_edges(spark):
    edges = [(a, b) for a in (1, 2, 3) for b in range(10, 40)] + [(b, b + 100 + i) for b in range(10, 40) for i in range(4)] + [(1, 10)]
    seeds = [1, 2, 3, 10, 11, 999]
    out = defaultdict(set)
    for a, b in edges:
        out[a].add(b)
    want, frontier = set(), {(s, s) for s in seeds}
    for hop, fan in enumerate((3, 2), 1):
        taken = {
            (s, hop, v, w)
            for s, v in frontier
            for w in sorted(out[v], key=lambda w: (md5(f"0:{s}:{v}:{w}".encode()).hexdigest(), w))[:fan]
        }
        want |= taken
        frontier = {(s, w) for s, _, _, w in taken}
    rows = sample_neighbourhood(
        spark.createDataFrame(edges, "src long, dst long"), spark.createDataFrame([(s,) for s in seeds], "id long"), [3, 2]
    )
    assert {(r.seed_id, r.hop, r.src, r.dst) for r in rows.collect()} == want
