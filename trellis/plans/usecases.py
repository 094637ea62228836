"""End-to-end queries built from the operators."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trellis.functions.scalar import any_in_list, left_text
from trellis.operators.centrality import pagerank
from trellis.operators.community import cluster_summary, connected_components, louvain
from trellis.operators.match import (
    candidate_pairs,
    closed_walk_counts,
    count_shared,
    cycle_match,
    ranked_memberships,
    shared_neighbor_pairs,
    two_hop_not_direct,
)
from trellis.operators.ordering import running_total
from trellis.session import Scratch


def friend_of_friend_risk(edges: DataFrame, accounts: DataFrame, bad: Column, unverified: Column, score: str) -> DataFrame:
    """Per account, over friends of friends that are not friends: the average ``score``, the share
    that is ``bad`` and the share that is ``unverified``. Paths count. An account without a bad or
    without an unverified friend of a friend has no row, as each stage is an inner match."""
    measures = accounts.select(
        "id",
        F.lit(1).cast("bigint").alias("paths"),
        F.coalesce(F.col(score), F.lit(0.0)).alias("score_sum"),
        F.col(score).isNotNull().cast("bigint").alias("scored"),
        F.coalesce(bad, F.lit(False)).cast("bigint").alias("bad"),
        F.coalesce(unverified, F.lit(False)).cast("bigint").alias("unverified"),
    )
    sums = two_hop_not_direct(edges, measures, ["paths", "score_sum", "scored", "bad", "unverified"])
    return sums.filter("paths > 0 and bad > 0 and unverified > 0").select(
        "id",
        (F.col("score_sum") / F.nullif(F.col("scored"), F.lit(0))).alias("avg_score"),
        (F.col("bad") / F.col("paths")).alias("bad_share"),
        (F.col("unverified") / F.col("paths")).alias("unverified_share"),
    )


def flagged_second_degree(edges: DataFrame, accounts: DataFrame, flagged: Column) -> DataFrame:
    """Per account, the number of two-hop paths to a flagged account without a direct link."""
    measures = accounts.select("id", F.coalesce(flagged, F.lit(False)).cast("bigint").alias("flagged"))
    return two_hop_not_direct(edges, measures, ["flagged"]).filter("flagged > 0")


def under_the_radar(
    transfers: DataFrame, sender: str, receiver: str, amount: str, time: str, start: str, end: str,
    limit: float = 10_000, average_above: float = 9_000, more_than: int = 5,
) -> DataFrame:
    """Sender and receiver pairs with many transfers just below a limit in a date range."""
    low, high = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    kept = transfers.filter((F.col(time) > low) & (F.col(time) < high) & (F.col(amount) < limit))
    return (
        kept.groupBy(F.col(sender).alias("sender"), F.col(receiver).alias("receiver"))
        .agg(F.count("*").alias("n"), F.avg(amount).alias("average"))
        .filter((F.col("average") > average_above) & (F.col("n") > more_than))
    )


def equal_amount_cycle(transfers: DataFrame, amount: str, length: int = 5) -> DataFrame:
    """Per amount: closed chains of equal amounts by start account, summed, and accounts on one."""
    counts = closed_walk_counts(transfers, amount, length)
    return counts.groupBy(amount).agg(F.sum("cycles").alias("cycles"), F.count("*").alias("accounts"))


def suspicious_in_cycles(transfers: DataFrame, amount: str, length: int, suspicious: DataFrame) -> DataFrame:
    """Edge ids that lie on an equal-amount cycle and among the suspicious ids."""
    on_cycle = cycle_match(transfers, amount, length).select(F.explode("edge_ids").alias("edge_id"))
    return on_cycle.intersect(suspicious.select("edge_id"))


def account_vs_peer_average(transfers: DataFrame, sender: str, receiver: str, amount: str) -> DataFrame:
    """Per account the average amount over all transfers either way, without its largest
    counterparty (the smallest id on a tie)."""
    sides = transfers.select(F.col(sender).alias("account"), F.col(receiver).alias("peer"), amount).unionAll(
        transfers.select(receiver, sender, amount)
    )
    per = sides.groupBy("account", "peer").agg(F.count("*").alias("n"), F.sum(amount).alias("s"))
    total = per.groupBy("account").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"),
        F.min(F.struct((-F.col("n")).alias("k"), "peer", F.col("s").alias("ps"))).alias("top"),
    )
    rest = F.col("n") + F.col("top.k")
    return total.select(
        "account", F.col("top.peer").alias("excluded"),
        F.when(rest > 0, (F.col("s") - F.col("top.ps")) / rest).alias("average_without"),
    )


def common_claim_graph(memberships: DataFrame, member: str, claim: str, min_common: int) -> DataFrame:
    """Claimants that share claims -> weighted edges -> PageRank -> Louvain clusters -> clusters by mean PageRank, the highest first.

    PageRank follows all edges of claimants and claims: those made, and the common claims either way. Louvain sees the common claims alone."""
    scratch = Scratch(memberships.sparkSession)
    pairs = scratch.put(shared_neighbor_pairs(memberships, member, claim, min_common), "pairs")
    edges = pairs.select(F.col("left").alias("src"), F.col("right").alias("dst"), F.col("shared").alias("w"))
    people = memberships.select(F.col(member).alias("id")).distinct()
    clusters = louvain(people, edges, "w", result="cluster")
    # an id of a claimant may be one of a claim as well
    person, thing = [lambda c, kind=kind: F.concat(F.lit(kind), F.col(c).cast("string")) for kind in ("member:", "claim:")]
    made = memberships.select(person(member).alias("src"), thing(claim).alias("dst")).distinct()
    common = [pairs.select(person(a).alias("src"), person(b).alias("dst")) for a, b in (("left", "right"), ("right", "left"))]
    nodes = people.select(person("id").alias("id")).unionAll(memberships.select(thing(claim).alias("id")).distinct())
    ranks = pagerank(nodes, made.unionAll(common[0]).unionAll(common[1]))
    ranked = clusters.withColumn("_person", person("id")).join(ranks.withColumnRenamed("id", "_person"), "_person")
    return cluster_summary(ranked, "cluster", "rank").orderBy(F.col("avg_score").desc(), "cluster")


def prior_common_store(purchases: DataFrame, person: str, store: str, time: str, fraud: str) -> DataFrame:
    """Per store, the number of (fraud, earlier purchase) pairs of one person and of persons. The
    frauds after a purchase are counted with a running total, the pairs are not listed."""
    is_fraud = F.col(fraud).cast("bigint")
    by_time = purchases.groupBy(person, time).agg(F.sum(is_fraud).alias("_f"))
    order = [F.col(person), F.col(time)]
    cum = running_total(by_time, order, {"_cum": F.col("_f")})
    last = cum.groupBy(person).agg(F.max("_cum").alias("_all"))
    later = cum.join(last, person).select(person, time, (F.col("_all") - F.col("_cum")).alias("_later"))
    return (
        purchases.select(person, store, time).join(later.filter("_later > 0"), [person, time])
        .groupBy(store)
        .agg(F.sum("_later").alias("pairs"), F.count_distinct(person).alias("persons"))
    )


def entity_resolution_clusters(
    accounts: DataFrame, account: str, links: DataFrame, link: str, names: Sequence[str], score_above: int = 2
) -> DataFrame:
    """Accounts that share enough links and names, and the component of each.

    The score is the number of shared links plus one per equal name. With a limit of 2 a pair
    qualifies with 3 links, with 2 links and any one equal name, or with 1 link and any two: each case is
    counted on all it requires, so few other pairs are kept, and the score is then computed.
    """
    scratch = Scratch(accounts.sparkSession)
    rows = links.select(account, link).distinct().join(accounts.select(account, *names), account)
    ranked = ranked_memberships(rows, account, link, names, scratch)
    needed = score_above + 1
    # a pair shares one link at least, so more equal names than that leaves over need not be asked for
    cases = [list(case) for size in range(min(len(names), max(needed - 1, 0)) + 1) for case in combinations(names, size)]
    wanted = [(max(needed - len(equal), 1), equal) for equal in cases]
    found = scratch.put(candidate_pairs(ranked, account, link, wanted, scratch), "candidates")
    score = F.col("shared")
    scored = count_shared(found, ranked, account, link)
    for side in ("left", "right"):
        scored = scored.join(
            accounts.select(F.col(account).alias(side), *[F.col(n).alias(f"{side}_{n}") for n in names]), side
        )
    for name in names:
        score = score + F.coalesce((F.col(f"left_{name}") == F.col(f"right_{name}")).cast("int"), F.lit(0))  # missing names agree with none
    similar = scored.filter(score > score_above).select(F.col("left").alias("src"), F.col("right").alias("dst"))
    edges = scratch.put(similar, "similar")
    people = accounts.select(F.col(account).alias("id"))
    return connected_components(people, edges, "cluster")


def patient_journey(facts: Sequence[tuple[DataFrame, str]], person: str, day: str) -> DataFrame:
    """Five kinds of facts aligned per person and day: sorted distinct names and their number;
    days that lack a kind fall away."""
    out = None
    for frame, name in facts:
        per = frame.groupBy(person, day).agg(
            F.array_join(F.sort_array(F.collect_set("name")), ",").alias(name),
            F.count_distinct("name").alias(f"num_{name}"),
        )
        out = per if out is None else out.join(per, [person, day])
    return out


def prescriptions_of_patient(rows: DataFrame, patient: Column) -> DataFrame:
    """Per patient, day, drug and code: the details as one sorted text."""
    text = F.concat(F.coalesce("detail", F.lit("")), F.lit("("), F.coalesce("relation", F.lit("")), F.lit(")"))
    return (
        rows.filter(patient).select("patient", "day", "drug", "code", text.alias("_d")).distinct()
        .groupBy("patient", "day", "drug", "code")
        .agg(F.array_join(F.sort_array(F.collect_set("_d")), " ").alias("details"))
    )


def drug_users(rows: DataFrame, word: str) -> DataFrame:
    """Patients with a drug whose name contains a word."""
    return rows.filter(F.contains(F.col("drug"), F.lit(word))).select("patient", "day", "drug", "code").distinct()


def drug_in_date_range(rows: DataFrame, drugs: Sequence[str], start: str, end: str) -> DataFrame:
    day = F.col("day")
    return rows.filter(F.col("drug").isin(list(drugs)) & (day >= start) & (day < end)).select("patient", "day", "drug").distinct()


def strength_at_least(rows: DataFrame, word: str, least: int) -> DataFrame:
    """Rows of a drug whose strength text starts with a digit of at least ``least``."""
    return rows.filter(
        F.contains(F.lower("drug"), F.lit(word)) & (left_text("strength", 1).try_cast("int") >= least)
    ).select("patient", "day", "drug", "strength").distinct()


def drug_combination(rows: DataFrame, any_of: Sequence[str], other: str) -> DataFrame:
    """Patients with any drug of a list who also have the other drug: the listed drugs they have,
    how many, and each day of the other one."""
    listed = rows.filter(any_in_list("drug", any_of)).groupBy("patient").agg(
        F.array_join(F.sort_array(F.collect_set("drug")), ",").alias("listed"), F.count_distinct("drug").alias("num_listed")
    )
    return rows.filter(F.contains(F.col("drug"), F.lit(other))).select(
        "patient", F.col("drug").alias("other_drug"), "day"
    ).distinct().join(listed, "patient")


def co_occurring_facts(rows: DataFrame, on: Sequence[str], first: Column, second: Column, name: str) -> DataFrame:
    """Distinct pairs of facts of one person on one day. Each side is made distinct first, so a
    fact repeated many times is joined once."""
    a = rows.filter(first).select(*on, F.col(name).alias("first")).distinct()
    b = rows.filter(second).select(*on, F.col(name).alias("second")).distinct()
    return a.join(b, list(on))


def essential_chain(
    essential: DataFrame, mutations: DataFrame, drivers: DataFrame, left: str, right: str
) -> DataFrame:
    """Three stages carried on by DISTINCT: essential items, their observed partners, the partners
    that are drivers."""
    first = essential.select(left).distinct().join(mutations, left)
    return first.distinct().join(drivers.select(right).distinct(), right).distinct()


def ranked_clusters(nodes: DataFrame, edges: DataFrame, clusters: DataFrame, k: int) -> DataFrame:
    """The ``k`` clusters with the highest mean PageRank, clusters of one left out."""
    ranks = pagerank(nodes, edges, 6, tolerance=None)
    return cluster_summary(clusters.join(ranks, "id"), "cluster", "rank").orderBy(
        F.col("avg_score").desc(), "cluster"
    ).limit(k)
