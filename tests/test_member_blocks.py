"""Pairs of members are counted by blocks: every candidate once, whatever the sizes of blocks and pieces, and no pair is shuffled."""

import random
from itertools import combinations

import pytest

from trellis.operators import match
from trellis.plans import usecases
from trellis.session import Scratch


def people(seed, members=40, things=12):
    rng = random.Random(seed)
    accounts = [(f"a{i:02}", rng.choice(["x", "y", None]), rng.choice([1, 2, None])) for i in range(members)]
    links = [(f"a{rng.randrange(members):02}", rng.choice([None, *range(things)])) for _ in range(240)]
    return accounts, links + links[:20] + [("a00", t) for t in range(things)] + [(None, 1)]


def plain_clusters(accounts, links, above):
    sets, names = {}, {a: (f, n) for a, f, n in accounts}
    for a, t in links:
        if a is not None and t is not None:
            sets.setdefault(a, set()).add(t)
    group = {a: {a} for a in names}
    for a, b in combinations(sorted(sets), 2):
        same = sum(p is not None and p == q for p, q in zip(names[a], names[b]))
        if sets[a] & sets[b] and len(sets[a] & sets[b]) + same > above:
            both = group[a] | group[b]
            for m in both:
                group[m] = both
    return {a: min(g) for a, g in group.items()}


@pytest.mark.parametrize(("hot", "block", "chunk"), [(1000, 1 << 21, 1 << 21), (5, 25, 7), (10, 60, 40)])
def test_clusters_as_by_brute_force(spark, monkeypatch, hot, block, chunk):
    monkeypatch.setattr(match, "HOT_NEIGHBOUR", hot)
    monkeypatch.setattr(match, "BLOCK_MEMBERSHIPS", block)
    rows, pairs = people(3)
    accounts = spark.createDataFrame(rows, "a string, f string, n int")
    links = spark.createDataFrame(pairs, "a string, t int")
    got = usecases.entity_resolution_clusters(accounts, "a", links, "t", ["f", "n"], 5).collect()
    assert {r["id"]: r["cluster"] for r in got} == plain_clusters(rows, pairs, 5)


def test_pieces_do_not_change_what_meets(monkeypatch):
    import pyarrow as pa

    rng = random.Random(1)
    table = lambda: pa.table({"m": [rng.randrange(30) for _ in range(400)], "h": [rng.randrange(25) for _ in range(400)], "rank": pa.array([rng.choice([0, 0, 1, 2]) for _ in range(400)], "int32"), "v": [rng.choice([None, 1, 2]) for _ in range(400)]})
    cases = [(4, []), (3, ["v"])]
    x, y = [match._members(table(), ["v"], cases) for _ in range(2)]
    found = {}
    for chunk in (1 << 21, 300, 1):
        monkeypatch.setattr(match, "CHUNK_PAIRS", chunk)
        found[chunk] = [sorted((int(a), int(b)) for left, right in match._met(p, q, cases) for a, b in zip(left, right)) for p, q in ((x, y), (x, x))]
        assert all(len(some) == len(set(some)) for some in found[chunk])
    assert found[1 << 21] == found[300] == found[1] and all(found[1])


def test_no_pair_is_shuffled(spark):
    """200 members of 20 things each make 199 * 100 pairs; what is shuffled and written for the candidates follows the memberships."""
    rows = spark.range(200).selectExpr("id as m", "explode(sequence(0, 19)) as t")
    ranked = match.ranked_memberships(rows, "m", "t", (), Scratch(spark))
    pairs = match.candidate_pairs(ranked, "m", "t", [(21, ())])
    assert pairs.count() == 0
    assert "Exchange" not in pairs._jdf.queryExecution().executedPlan().toString()
    assert match.candidate_pairs(ranked, "m", "t", [(20, ())]).count() == 199 * 100
