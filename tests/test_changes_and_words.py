"""Change versions of stored graphs, whole vocabularies, GraphML folders, paths from both sides."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from trellis.operators import match, paths
from trellis.operators import vocabulary as W
from trellis.plans.usecases import entity_resolution_clusters
from trellis.sources import files
from trellis.sources.store import GraphStore

NODE = "id_space string, id string, labels array<string>, x long, y string"
EDGE = "src_space string, src string, dst_space string, dst string, type string, edge_id string, w long"


def changes(rng, step):
    nodes = [("n", str(rng.randint(0, 30)), ["N"], rng.choice([None, step]), rng.choice([None, f"y{step}"])) for _ in range(8)]
    ids = [rng.randint(0, 40) for _ in range(8)]
    edges = [("n", str(i % 31), "n", str(i * 7 % 31), "E", f"e{i}", rng.choice([None, step])) for i in ids]
    return nodes, edges, [("n", str(rng.randint(0, 30))) for _ in range(2)]


def fold(state, nodes, edges, deleted):
    """The same on dictionaries: upsert by key, of one key the first row, then delete."""
    have_n, have_e = state
    for table, rows, width in ((have_n, nodes, 2), (have_e, edges, None)):
        firsts = {}
        for row in sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in ((r[2:]) if width else (r[:5] + r[6:])))):
            firsts.setdefault(row[:2] if width else row[5], row)
        for key, row in firsts.items():
            old = table.get(key)
            table[key] = tuple(b if b is not None else a for a, b in zip(old, row)) if old else row
    for key in deleted:
        have_n.pop(key, None)
        for e in [e for e, r in have_e.items() if r[:2] == key or r[2:4] == key]:
            have_e.pop(e)
    return have_n, have_e


def view(state):
    nodes, edges = state
    return {(*k, tuple(r[2]), r[3], r[4]) for k, r in nodes.items()}, {r for r in edges.values() if r[:2] in nodes and r[2:4] in nodes}


def loaded(graph):
    nodes = {(r["id_space"], r["id"], tuple(r["labels"]), r["x"], r["y"]) for r in graph.nodes.collect()}
    return nodes, {tuple(r) for r in graph.edges.select(*[c.split()[0] for c in EDGE.split(", ")]).collect()}


def test_change_versions_fold_to_the_same_graph(spark, tmp_path):
    rng, store, state, views = random.Random(3), GraphStore(spark, str(tmp_path), "db", "g"), ({}, {}), {}
    for step in range(1, 6):
        nodes, edges, deleted = changes(rng, step)
        frames = spark.createDataFrame(nodes, NODE), spark.createDataFrame(edges, EDGE), spark.createDataFrame(deleted, "id_space string, id string")
        assert store.append(*frames, step) == step
        assert store.append(*frames, step) == step  # a replay writes nothing
        state = fold(state, nodes, edges, deleted)
        views[step] = view(state)
        if step == 3:
            assert loaded(store.load(3)) == views[3]
            written = store.compact()
            assert 0 < written["nodes"] <= 64
    for step in (2, 3, 4, 5):
        assert loaded(store.load(step)) == views[step]
    store.compact()
    assert loaded(store.load()) == views[5] and loaded(store.load(1)) == views[1]


def test_a_change_is_as_large_as_its_batch(spark, tmp_path):
    store = GraphStore(spark, str(tmp_path), "db", "g")
    nodes = spark.range(20000).selectExpr("'n' id_space", "cast(id as string) id", "array('N') labels", "id x", "sha2(cast(id as string), 256) y")
    edges = spark.createDataFrame([], EDGE)
    none = spark.createDataFrame([], "id_space string, id string")
    store.append(nodes.repartition(4), edges, none)
    store.append(nodes.filter("id < 20").coalesce(1), edges, none)
    assert store.size(2) < store.size(1) / 20
    assert store.load().nodes.count() == 20000
    store.compact(1)
    assert store.compact(2)["nodes"] <= 20  # only the buckets of the second batch
    assert store.load().nodes.count() == 20000


def test_graphml_folder(spark, tmp_path):
    nodes = spark.createDataFrame([("a", ":P", 'x<y & "z"'), ("b", ":P", None)], "id string, labels string, name string").repartition(2)
    edges = spark.createDataFrame([("a", "b", "L", 3), ("b", "a", "L", None)], "src string, dst string, label string, w int").repartition(2)
    files.write_graphml(nodes, edges, str(tmp_path / "g"), ["name"], ["w"])
    assert len(list((tmp_path / "g").glob("part-*"))) >= 3
    got = files.read_graphml(spark, str(tmp_path / "g"), "node", ["name"]).collect()
    assert sorted(map(tuple, got), key=str) == [("a", ":P", 'x<y & "z"'), ("b", ":P", None)]
    got = files.read_graphml(spark, str(tmp_path / "g"), "edge", ["w"]).collect()
    assert sorted(map(tuple, got), key=str) == [("a", "b", "L", "3"), ("b", "a", "L", None)]


def test_missing_names_do_not_lose_a_pair(spark):
    accounts = spark.createDataFrame([(1, "ann", None), (2, "ann", None), (3, "bob", "x")], "a long, f string, l string")
    links = spark.createDataFrame([(a, p) for a in (1, 2) for p in "pqr"] + [(3, "p")], "a long, p string")
    got = {r["id"]: r["cluster"] for r in entity_resolution_clusters(accounts, "a", links, "p", ["f", "l"], 2).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


TEXTS = [(1, 1, "the cat the dog"), (2, 1, "the cat sat"), (3, 0, "a bird, a BIRD"), (4, 0, None), (5, 0, ""), (6, 1, "dog " * 50)]


def test_whole_vocabulary(spark):
    df = spark.createDataFrame(TEXTS, "k long, label int, text string")
    words = sorted({"the", "cat", "dog", "sat", "a", "bird"})
    counts = {k: Counter((t or "").lower().replace(",", "").split()) for k, _, t in TEXTS}
    rows, table = W.bag_of_words(df, "k", "text")
    assert [r["token"] for r in table.orderBy("token_id").collect()] == words
    for r in rows.collect():
        assert dict(zip(r["indices"], r["values"])) == {words.index(w): n for w, n in counts[r["k"]].items()}
    idf = {w: math.log(7 / (sum(w in c for c in counts.values()) + 1)) for w in words}
    for r in W.tfidf(df, "k", "text")[0].collect():
        want = {words.index(w): n * idf[w] for w, n in counts[r["k"]].items()}
        assert dict(zip(r["indices"], r["values"])) == pytest.approx(want)
    empty = df.limit(0)
    assert W.bag_of_words(empty, "k", "text")[0].count() == 0


@pytest.mark.parametrize("kind", ["multinomial", "bernoulli"])
def test_naive_bayes_in_closed_form(spark, kind):
    rng = random.Random(5)
    data = [(k, k % 2, " ".join(rng.choice("abcdefgh" if k % 2 else "efghijkl") for _ in range(rng.randint(0, 12)))) for k in range(60)]
    df = spark.createDataFrame(data, "k long, label int, text string")
    train = df.filter("k < 40")
    rows = W.token_rows(df, "k", "text", ["label"])
    model = W.fit_naive_bayes(rows.filter("k < 40"), train, "label", kind)
    got = {r["k"]: r["prediction"] for r in W.predict_naive_bayes(model, rows.filter("k >= 40"), df.filter("k >= 40"), "k").collect()}
    bags = {k: Counter(t.split()) for k, _, t in data}
    vocabulary = set().union(*[bags[k] for k in range(40)])
    for k in range(40, 60):
        score = {}
        for c in (0, 1):
            own = [bags[i] for i in range(40) if i % 2 == c]
            s = math.log((len(own) + 1) / 42)
            total = sum(sum(b.values()) for b in own)
            for w in vocabulary:
                n, d = sum(b[w] for b in own), sum(w in b for b in own)
                if kind == "multinomial":
                    s += bags[k][w] * math.log((n + 1) / (total + len(vocabulary)))
                else:
                    p = (d + 1) / (len(own) + 2)
                    s += math.log(p if w in bags[k] else 1 - p)
            score[c] = s
        assert got[k] == max(score, key=lambda c: (round(score[c], 9), -c))


def test_encoding_has_a_place_for_every_value(spark):
    df = spark.createDataFrame([(1, 2.0, "u", "x y"), (2, 4.0, "v", "y y"), (3, None, None, None)], "k long, a double, c string, t string")
    rows, width = W.encode_by_descriptor(df, "k", [("a", "number"), ("c", "category"), ("t", "text")])
    got = {r["k"]: dict(zip(r["indices"], r["values"])) for r in rows.collect()}
    half = 1 / math.sqrt(2)
    assert width == 5 and got == {1: pytest.approx({0: -half, 1: 1, 3: 1, 4: 1}), 2: pytest.approx({0: half, 2: 1, 4: 2}), 3: {}}


def test_paths_meet_in_the_middle(spark):
    rng = random.Random(9)
    edges = [(rng.randint(0, 9), rng.randint(0, 9), f"e{i}") for i in range(30)]
    e = spark.createDataFrame(edges, "src long, dst long, edge_id string")
    starts, ends = [0, 1], [2, 3, 1]

    def walks(at, used, nodes):
        if used:
            yield nodes, used
        if len(used) < 5:
            for s, d, i in edges:
                if s == at and i not in used:
                    yield from walks(d, [*used, i], [*nodes, d])

    want = sorted((tuple(n), tuple(u)) for s in starts for n, u in walks(s, [], [s]) if n[-1] in ends and len(u) >= 2)
    found = match.variable_length_paths(e, spark.createDataFrame([(s,) for s in starts], "id long"), 5, spark.createDataFrame([(s,) for s in ends], "id long"), 2)
    assert sorted((tuple(r["nodes"]), tuple(r["edge_ids"])) for r in found.collect()) == want
    assert all(r["hops"] == len(r["edge_ids"]) and r["start"] == r["nodes"][0] and r["end"] == r["nodes"][-1] for r in found.collect())


def test_cheapest_paths_without_a_hop_limit(spark):
    rng = random.Random(4)
    edges = {(a, b): rng.randint(1, 9) for a, b in ((rng.randint(0, 8), rng.randint(0, 8)) for _ in range(34)) if a != b}
    e = spark.createDataFrame([(a, b, w) for (a, b), w in edges.items()], "src long, dst long, w long")

    def simple(at, cost, nodes):
        if at == 8:
            yield cost, ">".join(map(str, nodes))
            return
        for (a, b), w in edges.items():
            if a == at and b not in nodes:
                yield from simple(b, cost + w, [*nodes, b])

    want = sorted(simple(0, 0, [0]))
    for k in (1, 6, 40):
        got = [(r["cost"], r["path"]) for r in paths.ksssp(e, 0, 8, k, "w").orderBy("rank").collect()]
        assert got == want[:k]
    assert paths.ksssp(e.filter(F.col("dst") != 8), 0, 8, 3, "w").count() == 0


def test_betweenness_in_blocks_of_sources(spark):
    from trellis.operators.centrality import betweenness_centrality

    rng = random.Random(3)
    nodes, edges = spark.range(30), spark.createDataFrame([(rng.randint(0, 29), rng.randint(0, 29)) for _ in range(90)], "src long, dst long")
    whole = {r[0]: r[1] for r in betweenness_centrality(nodes, edges).collect()}
    blocks = {r[0]: r[1] for r in betweenness_centrality(nodes, edges, block=7).collect()}
    assert blocks == pytest.approx(whole)


@pytest.mark.parametrize("threshold", [0.1, 0.3, 0.5, 1.0])
def test_similar_sets_are_all_found(spark, threshold):
    from trellis.operators.similarity import lsh_similarity_search

    rng = random.Random(6)
    sets = [(i, [rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(0, 14))]) for i in range(120)] + [(200, list("abc")), (201, list("cba"))]
    asked = [(i, [rng.choice("abcdefghijklmnopqrstuvwxyzABC") for _ in range(rng.randint(0, 14))]) for i in range(60)] + [(300, list("bca"))]
    got = lsh_similarity_search(
        spark.createDataFrame(sets, "i long, t array<string>"), "i", spark.createDataFrame(asked, "q long, t array<string>"), "q", "t", threshold
    )
    want = {(x, y) for x, u in asked for y, v in sets if u and v and len(set(u) & set(v)) / len(set(u) | set(v)) >= threshold}
    assert {(r["q"], r["i"]) for r in got.collect()} == want


def test_only_words_of_the_queries_are_ranked(spark, monkeypatch):
    """The rest of a corpus' vocabulary takes up places in a prefix but is not ordered; the answer is that of brute force."""
    from trellis.operators import similarity

    draw = random.Random(5)
    corpus = [(i, [f"w{draw.randrange(60)}" for _ in range(draw.randrange(1, 14))] + [f"own{i}"] * (i % 3 == 0)) for i in range(300)]
    asked = [(q, [f"w{draw.randrange(25)}" for _ in range(draw.randrange(1, 12))] + ["nowhere"] * (q % 2)) for q in range(30)]
    ranked = []
    number = similarity.global_row_number

    def counted(words, *rest):
        ranked.append({r["token"] for r in words.collect()})
        return number(words, *rest)

    monkeypatch.setattr(similarity, "global_row_number", counted)
    got = similarity.lsh_similarity_search(
        spark.createDataFrame(corpus, "doc int, t array<string>"), "doc", spark.createDataFrame(asked, "q int, t array<string>"), "q", "t", 0.3
    )
    want = {(q, d) for q, a in asked for d, c in corpus if len(set(a) & set(c)) / len(set(a) | set(c)) >= 0.3}
    assert {(r["q"], r["doc"]) for r in got.collect()} == want
    assert ranked == [{w for _, words in asked for w in words}]
