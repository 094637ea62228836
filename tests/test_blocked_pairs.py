"""Record pairs of a blocking rule: repeated ids, null keys, cut groups, and how often records are shuffled."""

import math
import random
from collections import Counter

from pyspark.sql import functions as F

from trellis.operators import match

SCHEMA = "id string, g long, h long, s long, f string"


def records(seed, n=300):
    rng = random.Random(seed)
    pick = lambda most: rng.choice([None, *range(most)])
    rows = [(f"r{rng.randrange(n)}" if rng.random() > 0.05 else None, pick(12), pick(3), pick(4), rng.choice(["a", "b", None])) for _ in range(n)]
    return rows + rows[:40]


def plain(rows):
    seen, by_id, meet = Counter(r[3] for r in rows), {}, set()
    for r in rows:
        by_id.setdefault(r[0], []).append(r)
    for a in rows:
        meet |= {(a[0], b[0]) for b in rows if None not in (a[0], b[0], a[1], a[2]) and a[1:3] == b[1:3] and a[0] < b[0]}
    out = Counter()
    for x, y in meet:
        for a in by_id[x]:
            for b in by_id[y]:
                s = a[3] is not None and a[3] == b[3]
                f = a[4] is not None and a[4] == b[4]
                w = math.log2(0.9 / (seen[a[3]] / len(rows))) if s else math.log2(0.1 / 0.99)
                out[x, y, round(w + (math.log2(0.8 / 0.33) if f else math.log2(0.2 / 0.67)), 6)] += 1
    return out


def scored(frame):
    return match.blocked_pair_scoring(frame, "id", ["g", "h"], [("s", 0.9, 0.01), ("f", 0.8, 0.33)], ["s"])


def test_pairs_as_by_brute_force(spark):
    for seed in range(2):
        rows = records(seed)
        got = Counter((r["left"], r["right"], round(r["match_weight"], 6)) for r in scored(spark.createDataFrame(rows, SCHEMA)).collect())
        assert got == plain(rows)


def test_cut_groups_carry_the_columns_of_both(spark):
    rows = [(f"m{i % 25}", i % 2, i) for i in range(60)]
    got = match.pairs_within(spark.createDataFrame(rows, "m string, g long, v long"), ["g"], "m", 7, ["v"]).collect()
    want = Counter((g, a, b, v, w) for a, g, v in rows for b, h, w in rows if g == h and a < b)
    assert Counter((r["g"], r["left"], r["right"], r["v_l"], r["v_r"]) for r in got) == want


def test_records_are_shuffled_by_block_once(spark):
    rows = [(f"r{i:05}", i % 97, 0, i % 5, "a") for i in range(600)]
    frame = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = scored(frame).agg(F.count("*"))
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_block = [line for line in plan.splitlines() if "REPARTITION_BY_NUM" in line]
    assert len(by_block) == 2 and sum("ReusedExchange" in line for line in by_block) == 1
