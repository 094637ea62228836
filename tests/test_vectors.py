"""Vector search by cells against brute force."""

import numpy as np
import pytest

from trellis.operators import similarity


def vectors(n: int) -> np.ndarray:
    """Three clouds, a vector that a third of the rows share, and one without length."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(n, 6)).round(1) + 5 * rng.integers(0, 3, size=(n, 1))
    x[: n // 3] = x[0]
    x[n // 2] = 0
    return x


def nearest(x: np.ndarray, i: int, k: int, metric: str, leave_out: bool) -> list[int]:
    if metric == "cosine":
        unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        loss = -(unit * unit[i]).sum(1)
    else:
        loss = ((x - x[i]) ** 2).sum(1)
    if leave_out:
        loss[i] = np.inf
    return np.lexsort((np.arange(len(x)), loss))[:k].tolist()


@pytest.mark.parametrize("metric, leave_out", [("cosine", False), ("sqeuclidean", True)])
def test_search_by_cells_finds_what_brute_force_finds(spark, metric, leave_out, monkeypatch):
    monkeypatch.setattr(similarity, "CELL_ROWS", 40)
    monkeypatch.setattr(similarity, "PACK_BYTES", 6 * 8 * 32)
    x = vectors(900)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)] + [(900, None)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    corpus, asked = df.withColumnRenamed("id", "near"), df.filter("id % 4 = 0")
    found: dict[int, list] = {}
    for row in similarity.embedding_topk(corpus, asked, 5, "near", "id", "v", metric, leave_out).orderBy("id", "rank").collect():
        found.setdefault(row["id"], []).append(row["near"])
    assert found == {i: nearest(x, i, 5, metric, leave_out) for i in range(0, 900, 4)}


def test_search_with_fewer_rows_than_asked_for_and_with_none(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "id long, v array<float>")
    corpus = df.withColumnRenamed("id", "near")
    rows = similarity.embedding_topk(corpus, df, 3, "near", "id", "v", "sqeuclidean", True).collect()
    assert sorted((r["id"], r["near"], r["rank"]) for r in rows) == [(1, 2, 1), (2, 1, 1)]
    assert similarity.embedding_topk(corpus.limit(0), df, 3, "near", "id", "v").count() == 0
    assert similarity.embedding_topk(corpus, df.limit(0), 3, "near", "id", "v").count() == 0


@pytest.mark.parametrize("metric, leave_out", [("cosine", False), ("sqeuclidean", True)])
def test_search_by_blocks_of_both_sides(spark, metric, leave_out, monkeypatch):
    monkeypatch.setattr(similarity, "CELL_ROWS", 40)
    monkeypatch.setattr(similarity, "PACK_BYTES", 6 * 8 * 16)
    monkeypatch.setattr(similarity, "QUERY_BLOCK", 30)
    monkeypatch.setattr(similarity, "BLOCK_BYTES", 6 * 8 * 100)
    assert similarity.block_parts(400, 400, 48, 2) == {"of": 4, "asked": 4}
    x = vectors(400)
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "id long, v array<double>")
    odd = spark.createDataFrame([(400, [float("inf")] * 6), (401, [float("nan")] * 6)], df.schema)
    found: dict[int, list] = {}
    for row in similarity.embedding_topk(df.unionAll(odd).withColumnRenamed("id", "near"), df, 4, "near", "id", "v", metric, leave_out).orderBy("id", "rank").collect():
        found.setdefault(row["id"], []).append(row["near"])
    assert found == {i: nearest(x, i, 4, metric, leave_out) for i in range(400)}


def test_a_vector_is_sent_once_per_part_of_the_other_side():
    """720,000 vectors of 64 numbers against themselves: 11 copies of each on either side, not one for each of 64 cells and 4 slots."""
    assert similarity.block_parts(720_000, 720_000, 512, 12) == {"of": 11, "asked": 11}
    assert similarity.block_parts(120_000, 120_000, 512, 12) == {"of": 6, "asked": 2}
    assert similarity.block_parts(720_000, 10, 512, 12) == {"of": 12, "asked": 1}
    assert similarity.block_parts(900, 10, 512, 12) == {"of": 1, "asked": 1}
