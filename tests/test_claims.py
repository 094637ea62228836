"""Clusters of claimants are ranked by PageRank over claimants, claims and common claims."""

import pytest

from trellis.plans import usecases

# two groups of claimants; an id is one of a claimant and of a claim
CLAIMS = [(m, 100 + p) for m in (1, 2, 3) for p in range(2)] + [(m, p) for m in (4, 5, 6, 7) for p in range(1, 4)] + [(8, 1)]


def plain_ranks(rows, common):
    out = {}
    for m, c in set(rows):
        out.setdefault(("m", m), []).append(("c", c))
    for a, b in common:
        out[("m", a)].append(("m", b))
        out[("m", b)].append(("m", a))
    nodes = set(out) | {x for far in out.values() for x in far}
    rank = dict.fromkeys(nodes, 1.0)
    for _ in range(60):
        got = dict.fromkeys(nodes, 0.0)
        for v, far in out.items():
            for w in far:
                got[w] += rank[v] / len(far)
        rank = {v: 0.85 + 0.15 * x for v, x in got.items()}
    return rank


def test_clusters_are_ranked_by_pagerank(spark):
    memberships = spark.createDataFrame(CLAIMS + CLAIMS[:3], "c long, p long")
    sets = {m: {p for n, p in CLAIMS if n == m} for m, _ in CLAIMS}
    common = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 2]
    ranks = plain_ranks(CLAIMS, common)
    got = usecases.common_claim_graph(memberships, "c", "p", 2).collect()
    groups = {r["cluster"]: [1, 2, 3] if r["cluster"] in (1, 2, 3) else [4, 5, 6, 7] for r in got}
    assert len(got) == 2 and {tuple(g) for g in groups.values()} == {(1, 2, 3), (4, 5, 6, 7)}
    assert [r["avg_score"] for r in got] == sorted((r["avg_score"] for r in got), reverse=True)
    for r in got:
        expected = [ranks["m", m] for m in groups[r["cluster"]]]
        assert r["size"] == len(expected)
        assert r["avg_score"] == pytest.approx(sum(expected) / len(expected), abs=1e-3)
        assert r["sum_score"] == pytest.approx(sum(expected), abs=4e-3)
