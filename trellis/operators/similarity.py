"""Set and vector similarity."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trellis.operators.ordering import global_row_number
from trellis.session import Scratch

QUERY_BLOCK = 512  # query vectors in a pack
BLOCK_BYTES = 1 << 25  # vectors of one side in a block, on average
CELLS = 64  # cells of the vector search at most
CELL_ROWS = 1024  # vectors that make a cell worth its own packs
PACK_BYTES = 1 << 19  # corpus vectors in a pack
RESCORED = 1 << 16  # pairs scored at a time


def jaccard_similarity(memberships: DataFrame, node, member: str = "src", neighbour: str = "dst") -> DataFrame:
    """Similarity of one node's neighbour set to every other's: ``id, shared, similarity``. Only
    the rows of the given node's neighbours are joined."""
    sets = memberships.select(F.col(member).alias("id"), F.col(neighbour).alias("x")).distinct()
    mine = sets.filter(F.col("id") == F.lit(node)).select("x")
    sizes = sets.groupBy("id").agg(F.count("*").alias("size"))
    own = mine.agg(F.count("*").alias("own")).withColumn("_one", F.lit(1))
    shared = sets.join(mine, "x", "left_semi").groupBy("id").agg(F.count("*").alias("shared"))
    rows = sizes.filter(F.col("id") != F.lit(node)).join(shared, "id", "left").fillna(0, ["shared"])
    rows = rows.withColumn("_one", F.lit(1)).join(F.broadcast(own), "_one")  # one row
    union = F.col("size") + F.col("own") - F.col("shared")
    return rows.select("id", "shared", (F.col("shared") / union).alias("similarity"))


def similarity_summary(similarities: DataFrame) -> DataFrame:
    return similarities.agg(
        F.max("similarity").alias("max_similarity"),
        F.min("similarity").alias("min_similarity"),
        F.avg("similarity").alias("avg_similarity"),
    )


def tanimoto(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union)


def tanimoto_topk(items: DataFrame, id_column: str, features: str, query: list, k: int) -> DataFrame:
    """The ``k`` items most similar to one query fingerprint, ties by id."""
    wanted = F.array(*[F.lit(x) for x in query])
    return (
        items.select(id_column, tanimoto(F.col(features), wanted).alias("similarity"))
        .orderBy(F.col("similarity").desc(), id_column)
        .limit(k)
    )


def min_hash(tokens: Column, seed: int) -> Column:
    return F.array_min(F.transform(tokens, lambda token: F.xxhash64(token, F.lit(seed))))


def minhash_bands(tokens: Column, bands: int, rows: int) -> Column:
    """``bands`` band keys of a token set, each over ``rows`` min-hashes."""
    return F.array(
        *[F.xxhash64(F.lit(b), *[min_hash(tokens, b * rows + r) for r in range(rows)]) for b in range(bands)]
    )


def lsh_similarity_search(
    corpus: DataFrame,
    corpus_id: str,
    queries: DataFrame,
    query_id: str,
    tokens: str,
    threshold: float,
    bands: int | None = None,
    rows: int = 2,
) -> DataFrame:
    """Corpus items whose token set is similar to a query set: ``<query_id>, <corpus_id>,
    similarity``. Equal corpus sets are looked up once and spread out at the end, so copies do not crowd a key.

    Without ``bands`` the answer is exact: candidates share one of their rarest tokens (``prefix_candidates``). With
    ``bands`` candidates share a key over ``rows`` min-hashes, so a pair of similarity s is found with probability
    ``1 - (1 - s**rows)**bands``. Either way each candidate is checked exactly."""
    scratch = Scratch(corpus.sparkSession)
    sets = scratch.put(
        corpus.select(corpus_id, F.sort_array(F.array_distinct(tokens)).alias("c_set"))
        .filter(F.size("c_set") > 0)
        .withColumn("set_key", F.sha2(F.array_join("c_set", "\x1f"), 256)),
        "sets",
    )
    distinct_sets = sets.groupBy("set_key").agg(F.first("c_set").alias("c_set"))
    asked = queries.select(query_id, F.sort_array(F.array_distinct(tokens)).alias("q_set")).filter(F.size("q_set") > 0)
    if bands is None:
        distinct_sets = scratch.put(distinct_sets, "distinct_sets")
        candidates = prefix_candidates(distinct_sets, asked, query_id, threshold, scratch)
    else:
        banded = distinct_sets.select("set_key", F.posexplode(minhash_bands(F.col("c_set"), bands, rows)).alias("band", "key"))
        asked_bands = asked.select(query_id, F.posexplode(minhash_bands(F.col("q_set"), bands, rows)).alias("band", "key"))
        candidates = asked_bands.join(banded, ["band", "key"]).select(query_id, "set_key").distinct()
    scored = (
        candidates.join(asked, query_id)
        .join(distinct_sets, "set_key")
        .withColumn("similarity", tanimoto(F.col("q_set"), F.col("c_set")))
        .filter(F.col("similarity") >= threshold)
    )
    return scored.select(query_id, "set_key", "similarity").join(sets.select(corpus_id, "set_key"), "set_key").drop("set_key")


def prefix_candidates(corpus: DataFrame, asked: DataFrame, query_id: str, threshold: float, scratch: Scratch) -> DataFrame:
    """``<query_id>, set_key`` of pairs among which are all of at least the similarity.

    All tokens have one order: those that no query has, then those of the queries from the rarest in the corpus to the most
    common. Sets of sizes m and n that are similar enough share at least ``t / (1 + t) * (m + n)`` tokens, so each must show a common
    one among its first ``m - ceil(t * m) + 1``, their sizes are within a factor ``t``, and behind the first common token there must be
    room for the rest. Common tokens come last and are seldom in a prefix, so they make no pairs; tokens that no query has
    only take up places, so they are neither counted, ranked nor shuffled."""
    vocabulary = scratch.put(asked.select(F.explode("q_set").alias("token")).distinct(), "vocabulary")
    met = corpus.select(F.explode("c_set").alias("token")).join(vocabulary, "token").groupBy("token").agg(F.count("*").alias("n"))
    words = vocabulary.join(met, "token", "left").fillna(0, ["n"])
    order = scratch.put(global_row_number(words, ["n", "token"], "rank").select("token", "rank"), "rarity")

    def prefixes(sets: DataFrame, key: str, column: str, side: str) -> DataFrame:
        rows = sets.select(key, F.size(column).alias("_size"), F.explode(column).alias("token")).join(order, "token")
        # Tokens without a rank come first of all: they take up places and meet nothing.
        ranks = rows.groupBy(key).agg(F.first("_size").alias("_size"), F.sort_array(F.collect_list("rank")).alias("_ranks"))
        lacking = F.col("_size") - F.size("_ranks")
        length = F.col("_size") - F.ceil(F.col("_size") * F.lit(threshold) - 1e-9) + 1
        shown = F.slice("_ranks", F.lit(1), F.greatest(length - lacking, F.lit(0)).cast("int"))
        return ranks.select(key, F.col("_size").alias(f"_size_{side}"), lacking.alias("_lacking"), F.posexplode(shown).alias("_p", "rank")).select(
            key, f"_size_{side}", (F.col("_p") + F.col("_lacking")).alias(f"_place_{side}"), "rank"
        )

    left = scratch.put(prefixes(asked, query_id, "q_set", "q"), "asked_prefixes")
    right = scratch.put(prefixes(corpus, "set_key", "c_set", "c"), "corpus_prefixes")
    t = F.lit(threshold)
    needed = F.ceil(t / (1 + t) * (F.col("_size_q") + F.col("_size_c")) - 1e-9)
    room = F.least(F.col("_size_q") - F.col("_place_q"), F.col("_size_c") - F.col("_place_c"))
    near = (F.col("_size_c") >= t * F.col("_size_q") - 1e-9) & (F.col("_size_q") >= t * F.col("_size_c") - 1e-9)
    return left.join(right, "rank").filter(near & (room >= needed)).select(query_id, "set_key").distinct()


def embedding_topk(
    corpus: DataFrame,
    queries: DataFrame,
    k: int,
    corpus_id: str,
    query_id: str,
    vector: str,
    metric: str = "cosine",
    exclude_same_id: bool = False,
    cells: int = CELLS,
) -> DataFrame:
    """Exact nearest vectors: ``<query_id>, <corpus_id>, score, rank`` (cosine: highest first;
    ``sqeuclidean``: lowest first; ties by corpus id). Rows without a vector are left out.

    Corpus and queries are read once and laid out in packs of bounded size, by cells around at most ``cells`` of the corpus's vectors.
    Packs are dealt to parts, and a block for each part of the corpus and part of the queries finds the best of its pairs: a vector is
    sent once per part of the other side, whatever the cells. In a block a query's best so far excludes, by the triangle
    inequality, whole packs. Cosines are compared as distances of unit vectors. No vector but the centres passes the driver.
    """
    scratch = Scratch(corpus.sparkSession)
    id_type, query_type = dict(corpus.dtypes)[corpus_id], dict(queries.dtypes)[query_id]
    of = corpus.filter(F.col(vector).isNotNull()).select(F.col(corpus_id).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    asked = queries.filter(F.col(vector).isNotNull()).select(F.col(query_id).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = of.count()
    cells = min(cells, rows // CELL_ROWS + 1)
    # Several times as many as needed: a vector that many rows share is one centre.
    first = of.select("v", F.xxhash64("id", "v").alias("h")).orderBy("h").limit(4 * cells).collect()
    if not first:
        return corpus.sparkSession.createDataFrame([], f"{query_id} {query_type}, {corpus_id} {id_type}, score double, rank bigint")
    centres = _scaled(np.array(list(dict.fromkeys(tuple(row["v"]) for row in first))[:cells]), metric)
    size = centres.shape[1]

    def packs(side: DataFrame, kind: str, most: int, slot: str) -> DataFrame:
        layout = f"cell int, near double, far double, ids array<{kind}>, vs binary"
        return scratch.put(side.mapInPandas(_packs(centres, metric, most), layout), slot)

    pack_rows = max(1, PACK_BYTES // (8 * size))
    sides = {"of": packs(of, id_type, pack_rows, "packs"), "asked": packs(asked, query_type, QUERY_BLOCK, "asked")}
    parts = block_parts(rows, asked.count(), 8 * size, corpus.sparkSession.sparkContext.defaultParallelism)
    blocks = parts["of"] * parts["asked"]
    other = {"of": "asked", "asked": "of"}
    met = {}
    for side, df in sides.items():
        part = F.pmod(F.xxhash64("vs", "ids"), F.lit(parts[side])).cast("int")
        each = df.select("*", part.alias("part"), F.explode(F.sequence(F.lit(0), F.lit(parts[other[side]] - 1))).alias("turn"))
        block = F.col("part") * parts["asked"] + F.col("turn") if side == "of" else F.col("turn") * parts["asked"] + F.col("part")
        # A stated number of tasks: blocks are work, not bytes, by which Spark would put them together.
        met[side] = each.withColumn("block", block).drop("part", "turn").repartition(4 * blocks, "block").groupBy("block")
    found_type = f"q {query_type}, id {id_type}, score double"
    best = met["of"].cogroup(met["asked"]).applyInPandas(_best_of_block(k, centres, metric, exclude_same_id), found_type)
    order = F.col("score").desc() if metric == "cosine" else F.col("score").asc()
    rank = F.row_number().over(Window.partitionBy("q").orderBy(order, "id"))
    ranked = scratch.put(best, "found").withColumn("rank", rank.cast("bigint")).filter(F.col("rank") <= k)
    return ranked.select(F.col("q").alias(query_id), F.col("id").alias(corpus_id), "score", "rank")


def block_parts(rows: int, asked: int, row_bytes: int, cores: int) -> dict[str, int]:
    """Parts of the corpus and of the queries: as few as keep a block at its size and, where there are cells enough, give each core one."""
    of, by = [max(1, math.ceil(n * row_bytes / BLOCK_BYTES)) for n in (rows, asked)]
    return {"of": max(of, min(cores // by, rows // CELL_ROWS)), "asked": by}


def _scaled(x: np.ndarray, metric: str) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300) if metric == "cosine" else x


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    squares = (x * x).sum(1)[:, None] + (centres * centres).sum(1)[None, :] - 2.0 * (x @ centres.T)
    return np.sqrt(np.maximum(squares, 0.0))


def _vectors(pdf: pd.DataFrame, metric: str) -> np.ndarray:
    return _scaled(np.array(pdf["v"].tolist(), dtype="float64"), metric)


def _packed(size: int):
    """Collect rows by cell; ``add`` gives every pack that is full, ``rest`` the others."""
    held: dict[int, list] = {}

    def flush(cell: int):
        parts = held.pop(cell)
        return cell, [np.concatenate(column) for column in zip(*parts)]

    def add(cell: int, *columns):
        held.setdefault(cell, []).append(columns)
        if sum(len(part[0]) for part in held[cell]) >= size:
            yield flush(cell)

    def rest():
        for cell in sorted(held):
            yield flush(cell)

    return add, rest


def _packs(centres: np.ndarray, metric: str, most: int):
    """Vectors of a cell, ``most`` at a time, with how near and how far from its centre they lie."""

    def row(cell: int, columns) -> pd.DataFrame:
        ids, x, d = columns
        return pd.DataFrame({"cell": [cell], "near": [d.min()], "far": [d.max()], "ids": [ids.tolist()], "vs": [x.tobytes()]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        add, rest = _packed(most)
        for pdf in batches:
            for start in range(0, len(pdf), most):
                part = pdf.iloc[start:start + most]
                x, ids = _vectors(part, metric), part["id"].to_numpy(dtype=object)
                away = _distances(x, centres)
                cell = away.argmin(1)
                for c in np.unique(cell):
                    mine = cell == c
                    for full in add(int(c), ids[mine], x[mine], away[mine, c]):
                        yield row(*full)
        for left in rest():
            yield row(*left)

    return run


def _best_of_block(k: int, centres: np.ndarray, metric: str, exclude_same_id: bool):
    """The ``k`` best of a block's corpus for each of its queries, a pack of queries at a time: the packs that may lie nearest come first,
    and those farther from all of them than their best so far are left out."""
    size = centres.shape[1]

    def losses(q: np.ndarray, x: np.ndarray, of_q: np.ndarray, of_x: np.ndarray) -> np.ndarray:
        loss = q @ x.T
        loss *= -1.0 if metric == "cosine" else -2.0
        if metric != "cosine":
            loss += of_q[:, None]
            loss += of_x[None, :]
        return loss

    def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a * b).sum(1) if metric == "cosine" else ((a - b) ** 2).sum(1)

    def best(q: np.ndarray, qs: np.ndarray, packs: list) -> pd.DataFrame:
        away, of_q = _distances(q, centres), (q * q).sum(1)
        own = set(qs) if exclude_same_id else ()
        lower = np.stack([np.maximum(np.maximum(away[:, p.cell] - p.far, p.near - away[:, p.cell]), 0.0) for p in packs], axis=1)
        top = np.full((len(q), k), np.inf)  # the k least losses so far, not in order
        worst = np.full(len(q), np.inf)
        most = max(p.most for p in packs)
        rows, found, scores = [], [], []
        for i in np.argsort(lower.mean(0), kind="stable"):
            p = packs[i]
            # Room for rounding, in proportion to the lengths that were subtracted.
            reach = np.sqrt(np.maximum(2 + 2 * worst if metric == "cosine" else worst, 0.0)) + 1e-6 * (1 + np.sqrt(of_q))
            asked = np.flatnonzero(~(lower[:, i] > reach))
            if not len(asked):
                continue
            loss = losses(q[asked], p.x, of_q[asked], p.of_x)
            if p.odd:
                loss[~np.isfinite(loss)] = np.inf
            if exclude_same_id and not own.isdisjoint(p.idset):
                loss[qs[asked][:, None] == p.ids[None, :]] = np.inf
            # What rounding may have put behind the k-th counts too; the scores are then summed in one order.
            room = 1e-9 * (1 + of_q[asked] + most)
            hit = np.flatnonzero((loss <= (worst[asked] + room)[:, None]).any(1))
            if not len(hit):
                continue
            loss, asked, room = loss[hit], asked[hit], room[hit]
            least = np.partition(np.concatenate([top[asked], loss], axis=1), k - 1, axis=1)[:, :k]
            top[asked], worst[asked] = least, least[:, k - 1]
            a, b = np.nonzero((loss <= (worst[asked] + room)[:, None]) & np.isfinite(loss))
            for start in range(0, len(a), RESCORED):
                here, there = asked[a[start:start + RESCORED]], b[start:start + RESCORED]
                rows.append(here)
                found.append(p.ids[there])
                scores.append(exact(q[here], p.x[there]))
        if not rows:
            return pd.DataFrame({"q": [], "id": [], "score": []})
        rows, ids, score = np.concatenate(rows), np.concatenate(found), np.concatenate(scores)
        order = np.lexsort((ids, -score if metric == "cosine" else score, rows))
        rows, ids, score = rows[order], ids[order], score[order]
        kept = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
        return pd.DataFrame({"q": qs[rows[kept]], "id": ids[kept], "score": score[kept]})

    def run(corpus: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        packs = [_Pack(p.cell, p.near, p.far, p.ids, np.frombuffer(p.vs).reshape(-1, size)) for p in corpus.itertuples(index=False)]
        out = [best(np.frombuffer(p.vs).reshape(-1, size), np.asarray(p.ids, dtype=object), packs) for p in asked.itertuples(index=False)] if packs else []
        out = [x for x in out if len(x)]
        return pd.concat(out) if out else pd.DataFrame({"q": [], "id": [], "score": []})

    return run


class _Pack:
    """Vectors of one cell as the blocks use them."""

    def __init__(self, cell: int, near: float, far: float, ids, x: np.ndarray):
        self.cell, self.near, self.far, self.x = cell, near, far, x
        self.ids = np.asarray(ids, dtype=object)
        self.idset = frozenset(self.ids)
        self.of_x = (x * x).sum(1)
        finite = np.isfinite(self.of_x)
        self.odd, self.most = not finite.all(), self.of_x[finite].max(initial=0.0)
