"""Table operators, mutation, storage and streams."""

import math
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from trellis.functions import scalar, text, udf
from trellis.model import PropertyGraph
from trellis.operators import clean, evaluation, features, match, models, mutate, ordering, similarity, stats
from trellis.session import Scratch, shared_dir
from trellis.sources import files, header
from trellis.sources.frames import nodes_from_dataframe
from trellis.sources.store import GraphStore
from trellis.streaming import streams


def test_shared_folder_comes_from_the_session(spark):
    named = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: "/shared" if key == "spark.checkpoint.dir" else default))
    assert shared_dir(named) == "/shared"
    bare = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: default), sparkContext=SimpleNamespace(master="yarn", applicationId="a")
    )
    with pytest.raises(RuntimeError):
        shared_dir(bare)
    assert Scratch(spark).root.startswith(shared_dir(spark))


def test_running_total_of_a_hot_key(spark):
    rows = spark.range(1000).selectExpr("if(id % 3 = 0, 0, id) as k", "id")
    got = ordering.running_total(rows, ["k", "id"], {"n": F.lit(1)}).orderBy("k", "id").collect()
    assert [r["n"] for r in got] == list(range(1, 1001))


def test_exact_quantiles_match_sorted_values(spark):
    draw = random.Random(3)
    rows = [("a" if i % 3 else "b", round(draw.uniform(0, 9), 1)) for i in range(200)] + [("c", 4.0), ("d", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: (r["m"], r["p9"]) for r in ordering.exact_quantiles(df, ["k"], "v", {"m": 0.5, "p9": 0.9}).collect()}
    for key in "abc":
        values = sorted(v for k, v in rows if k == key)
        for result, p in zip(got[key], (0.5, 0.9)):
            at = p * (len(values) - 1)
            low, high = values[math.floor(at)], values[math.ceil(at)]
            assert abs(result - (low + (at - math.floor(at)) * (high - low))) < 1e-9
    assert "d" not in got


def test_next_row_pairs(spark):
    rows = spark.createDataFrame([("x", 3), ("x", 1), ("y", 2), ("x", 2), ("y", 9)], "g string, t int")
    got = {(r["g"], r["t"], r["next_t"]) for r in ordering.next_row_pairs(rows, ["g"], ["t"], ["t"]).collect()}
    assert got == {("x", 1, 2), ("x", 2, 3), ("y", 2, 9)}


def test_point_in_time(spark):
    events = spark.createDataFrame([(1, "2024-01-03 10:00:00"), (1, "2024-01-01 05:00:00"), (2, "2024-01-09 00:00:00")], "u int, t string")
    feats = spark.createDataFrame([(1, "2024-01-01 06:00:00", 10), (1, "2024-01-03 09:59:59", 11), (2, "2024-01-02 00:00:00", 20), (2, "2024-01-09 00:00:01", 21)], "u int, s string, f int")
    rows = match.point_in_time_features(events.withColumn("t", F.to_timestamp("t")), feats.withColumn("s", F.to_timestamp("s")), "u", "t", "s", ["f"])
    assert sorted((r["u"], str(r["t"])[8:10], r["f"]) for r in rows.collect()) == [(1, "01", None), (1, "03", 11), (2, "09", 20)]


def test_distinct_compares_lists_by_content(spark):
    rows = spark.createDataFrame([([1, 2],), ([1, 2],), ([2, 1],)], "l array<int>")
    assert rows.distinct().count() == 2


def test_list_and_map_properties(spark):
    rows = spark.createDataFrame([([1, 2, 3], "{'a': 'x'}"), ([4, 5, 6], "{'a': 'y'}"), ([7, 8, 9], None)], "col3 array<int>, m string")
    assert [r[0] for r in rows.select(rows["col3"][1]).collect()] == [2, 5, 8]
    assert [r[0] for r in rows.select(scalar.parse_map_literal("m")["a"]).collect()] == ["x", "y", None]


def test_label_column_and_fixed_label(spark):
    df = spark.createDataFrame([(1, ["A", "B"])], "id int, LABEL array<string>")
    assert nodes_from_dataframe(df, "id", "s", label="X").first()["labels"] == ["X"]
    assert nodes_from_dataframe(df, "id", "s", label_column="LABEL").first()["labels"] == ["A", "B"]


def movie_graph(spark):
    people = spark.createDataFrame([("p1", 1960), ("p2", 1970)], "id string, born int")
    films = spark.createDataFrame([("m1", 1999), ("m2", 2003)], "id string, released int")
    nodes = nodes_from_dataframe(people, "id", "person", "Person", property_columns=["born"]).unionByName(
        nodes_from_dataframe(films, "id", "movie", "Movie", property_columns=["released"]), allowMissingColumns=True
    )
    edges = spark.createDataFrame(
        [("person", "p1", "movie", "m1", "ACTED_IN", "e1"), ("person", "p1", "movie", "m2", "ACTED_IN", "e2"), ("person", "p2", "movie", "m2", "DIRECTED", "e3")],
        "src_space string, src string, dst_space string, dst string, type string, edge_id string",
    )
    return PropertyGraph(nodes, edges)


def sizes(g):
    return tuple(g.counts().first())


def test_mutation_steps_keep_the_counts(spark):
    g = movie_graph(spark)
    assert sizes(g) == (4, 3)
    key = ["id_space", "id"]
    more = spark.createDataFrame([("person", "p3", 1980), ("person", "p1", 1900)], "id_space string, id string, born int")
    inserted = mutate.graph_insert(g.nodes, more, key)
    assert inserted.count() == 5 and inserted.filter("id = 'p1'").first()["born"] == 1960
    with pytest.raises(mutate.DuplicateKeys):
        mutate.graph_insert(g.nodes, more, key, on_duplicate="fail")
    updated = mutate.graph_update(g.nodes, more.withColumn("note", F.lit("x")), key)
    assert updated.count() == 4 and updated.filter("id = 'p1'").first()["born"] == 1900
    assert mutate.graph_upsert(g.nodes, more, key).count() == 5
    p1 = g.nodes.filter("id = 'p1'")
    assert sizes(mutate.graph_delete(g, p1)) == (3, 1)
    with pytest.raises(ValueError):
        mutate.delete_nodes(g, p1)
    left, gone = mutate.delete_with_count(g, p1)
    assert gone == 1 and sizes(left) == (3, 1)
    assert sizes(g) == (4, 3)


def test_removing_a_property(spark):
    g = movie_graph(spark)
    cut, found = mutate.remove_property(g.nodes, "born")
    assert found and "born" not in cut.columns
    assert mutate.remove_property(g.nodes, "absent") == (g.nodes, False)
    one, _ = mutate.remove_property(g.nodes, "born", "Person")
    assert one.filter("born is not null").count() == 0
    with pytest.raises(ValueError):
        mutate.add_property(g.nodes, "born", F.lit(1))


def test_versions_and_replay(spark, tmp_path):
    store = GraphStore(spark, str(tmp_path), "db", "movies")
    g = movie_graph(spark)
    assert store.save(g) == 1
    assert store.save(mutate.graph_delete(g, g.nodes.filter("id = 'p1'"))) == 2
    assert store.save(g, version=2) == 2
    assert sizes(store.load(1)) == (4, 3) and sizes(store.load()) == (3, 1)
    assert [tuple(r) for r in store.version_counts().orderBy("version").collect()] == [(1, 4, 3), (2, 3, 1)]


def test_header_parsing():
    blocks = header.parse_header("DEFAULT_LABEL=Place\nid:ID(place)|name:STRING|since:DATE|x:IGNORE\na.csv\nb.csv\n")
    assert [(c.name, c.kind) for c in blocks[0].columns] == [("id", "ID"), ("name", "STRING"), ("since", "DATE"), ("x", "IGNORE")]
    assert blocks[0].files == ["a.csv", "b.csv"] and blocks[0].default == "Place"


def test_graphml(spark, tmp_path):
    body = "".join(f'<node id="n{i}" labels=":P"><data key="name">x{i}</data></node>' for i in range(5))
    (tmp_path / "g.graphml").write_text(f'<?xml version="1.0"?><graphml><graph>{body}<edge id="e" source="n1" target="n2" label="L"><data key="w">3</data></edge></graph></graphml>')
    nodes = files.read_graphml(spark, str(tmp_path), "node", ["name", "none"]).collect()
    assert sorted((r["_id"], r["name"], r["none"]) for r in nodes)[0] == ("n0", "x0", None)
    assert files.read_graphml(spark, str(tmp_path), "edge", ["w"]).first()["w"] == "3"


def test_text_records_in_latin_1(spark, tmp_path):
    (tmp_path / "r.txt").write_bytes("a: café\nb: 2\n\na: y\n".encode("latin-1"))
    rows = files.read_text_records(spark, str(tmp_path), {"a": "a", "b": "b"}).collect()
    assert sorted((r["a"], r["b"]) for r in rows if r["a"]) == [("café", "2"), ("y", None)] or rows[0]["a"] == "café"


def test_division_predicates_cover_every_row(spark):
    df = spark.createDataFrame([("a",), ("c",), ("m",), ("z",), (None,)], "k string")
    parts = files.division_predicates("k", ["b", "m"])
    assert sum(df.filter(p).count() for p in parts) == 5


def test_scalar_helpers(spark):
    row = spark.createDataFrame([("ABC", "12x", "1/0", "2024-02-30", "a:::B")], "s string, n string, v string, d string, l string").select(
        scalar.case_flip("s").alias("flip"), scalar.cast_or_default("n", "int", 7).alias("n"),
        text.helpfulness_ratio("v").alias("v"), scalar.first_parsed("d", ["yyyy-MM-dd"]).alias("d"), scalar.first_of("l").alias("l"),
    ).first()
    assert (row["flip"], row["n"], row["v"], row["d"], row["l"]) == ("abc", 7, None, None, "a")


def test_deregister_unknown_function(spark):
    udf.register_scalar_udf(spark, "plus_one", lambda x: x + 1, "bigint")
    assert spark.sql("SELECT plus_one(2)").first()[0] == 3
    udf.deregister(spark, "plus_one")
    with pytest.raises(Exception):
        udf.deregister(spark, "plus_one")


def test_pad_vector(spark):
    row = spark.createDataFrame([([1.0, 2.0],)], "v array<double>")
    assert row.select(features.pad_vector("v", 4)).first()[0] == [1.0, 2.0, 0.0, 0.0]
    with pytest.raises(Exception):
        row.select(features.pad_vector("v", 1)).collect()


def test_hash_split_shares(spark):
    rows = features.hash_split(spark.range(20000), "id", {"train": 0.7, "val": 0.1, "test": 0.2})
    shares = {r["split"]: r["share"] for r in features.split_shares(rows).collect()}
    assert abs(shares["train"] - 0.7) < 0.02 and abs(shares["val"] - 0.1) < 0.02
    again = features.hash_split(spark.range(20000).repartition(7), "id", {"train": 0.7, "val": 0.1, "test": 0.2})
    assert rows.exceptAll(again).count() == 0


def test_top_vectors_across_query_blocks(spark, monkeypatch):
    monkeypatch.setattr(similarity, "QUERY_BLOCK", 7)
    draw = random.Random(1)
    data = [(i, [draw.gauss(0, 1) for _ in range(4)]) for i in range(50)]
    df = spark.createDataFrame(data, "id bigint, v array<double>")
    rows = similarity.embedding_topk(df.withColumnRenamed("id", "near"), df, 3, "near", "id", "v", "sqeuclidean", True).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        got.setdefault(r["id"], []).append(r["near"])
    for i, v in data:
        want = sorted((sum((a - b) ** 2 for a, b in zip(v, w)), j) for j, w in data if j != i)[:3]
        assert got[i] == [j for _, j in want]


def test_lsh_finds_copies_and_near_copies(spark):
    words = [f"w{i}" for i in range(40)]
    docs = [(i, words) for i in range(30)] + [(100, words[:36] + ["a"]), (200, ["q", "r"])]
    corpus = spark.createDataFrame(docs, "doc bigint, t array<string>")
    asked = spark.createDataFrame([(1, words)], "q bigint, t array<string>")
    got = {r["doc"] for r in similarity.lsh_similarity_search(corpus, "doc", asked, "q", "t", 0.8).collect()}
    assert got == set(range(30)) | {100}


def test_auc_with_ties(spark):
    draw = random.Random(2)
    rows = [(draw.randrange(2), draw.randrange(6) / 5) for _ in range(300)]
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    got = evaluation.auc(spark.createDataFrame(rows, "y int, s double"), "y", "s").first()[0]
    assert abs(got - want) < 1e-12


def test_metrics_are_null_on_a_zero_denominator(spark):
    tally = evaluation.binary_tally(spark.createDataFrame([(0, 0), (0, 0)], "y int, p int"), "y", "p")
    row = evaluation.classification_metrics(tally).first()
    assert row["tpr"] is None and row["ppv"] is None and row["accuracy"] == 1.0


def test_rolling_mean_needs_a_full_window(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 5)], "m int, v double")
    assert [r["rolling"] for r in stats.rolling_mean(df, "m", "v", 3).orderBy("m").collect()] == [None, None, 2.0, 3.0]
    assert [r["rolling"] for r in stats.rolling_mean(df, "m", "v", 3, True).orderBy("m").collect()] == [None, 2.0, 3.0, None]


def test_missing_policy(spark):
    rows = [(i, None if i % 2 else "x", None if i == 0 else 1, None if i % 5 == 0 else "k") for i in range(100)]
    df = spark.createDataFrame(rows, "id int, half string, rare int, some string")
    out = clean.missing_policy(df)
    assert out.columns == ["id", "rare", "some"]
    assert out.count() == 99 and out.filter("some = 'Unknown'").count() == 19


def test_classifiers_learn(spark):
    draw = random.Random(4)
    data = [(i, float(i % 2), [draw.gauss(3 * (i % 2), 1), draw.gauss(0, 1)]) for i in range(200)]
    df = models.as_vectors(spark.createDataFrame(data, "id bigint, label double, v array<double>"), "v")
    for make in (models.decision_tree, models.logistic_regression, lambda: models.linear_svm(1.0), lambda: models.naive_bayes("gaussian"),
                 lambda: models.random_forest(5), lambda: models.mlp_classifier([2, 4, 2])):
        assert models.accuracy(make().fit(df).transform(df)) > 0.85
    near = models.nearest_centroid(df, df, "label", "v")
    assert models.accuracy(near) > 0.85
    folds = models.kfold_eval(df, "id", models.decision_tree, 3)
    assert folds.agg(F.sum("num_test")).first()[0] == 200


def test_stream_drops_late_rows(spark, tmp_path):
    schema = "k string, ts timestamp"
    source = tmp_path / "in"
    for name, rows in (("a", [("x", "2024-01-01 00:00:00"), ("x", "2024-01-01 05:00:00")]), ("b", [("x", "2024-01-01 05:10:00")]), ("c", [("x", "2024-01-01 00:01:00"), ("x", "2024-01-01 05:30:00")])):
        spark.createDataFrame(rows, "k string, ts string").withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.mode("append").parquet(str(source / name))
    stream = streams.read_stream(spark, str(source / "*"), spark.createDataFrame([], schema).schema, maxFilesPerTrigger="1", latestFirst="false")
    counted = streams.stream_windowed_counts(stream, "ts", ["k"], "1 hour", late="10 minutes")
    rows = streams.run_to_table(counted, str(tmp_path / "out"), str(tmp_path / "log"))
    # the third file's row of 00:01 came after the watermark had passed 04:50
    assert [r["n"] for r in rows.filter("window_start = timestamp'2024-01-01 00:00:00'").collect()] == [1]


def test_stream_ingest_makes_versions_once(spark, tmp_path):
    source = tmp_path / "in"
    rows = [("upsert", "u1", "a"), ("upsert", "u2", "a"), ("upsert", "u2", "b")]
    spark.createDataFrame(rows, "operation string, u string, t string").coalesce(1).write.mode("append").parquet(str(source))
    store = GraphStore(spark, str(tmp_path / "g"), "db", "s")

    def nodes(df):
        return nodes_from_dataframe(df.select("u").distinct(), "u", "u", "User", property_columns=[]).unionByName(
            nodes_from_dataframe(df.filter("operation = 'upsert'").select("t").distinct(), "t", "t", "Type", property_columns=[])
        )

    def edges(df):
        return df.select(F.lit("u").alias("src_space"), F.col("u").alias("src"), F.lit("t").alias("dst_space"), F.col("t").alias("dst"),
                         F.lit("DID").alias("type"), F.concat("u", "t").alias("edge_id"))

    def run():
        stream = streams.read_stream(spark, str(source), spark.read.parquet(str(source)).schema)
        streams.stream_graph_ingest(stream, store, str(tmp_path / "log"), nodes, edges).awaitTermination()

    run()
    assert store.versions() == [1] and sizes(store.load()) == (4, 3)
    run()
    assert store.versions() == [1]
    spark.createDataFrame([("delete", "u2", None), ("upsert", "u3", "b")], "operation string, u string, t string").coalesce(1).write.mode("append").parquet(str(source))
    run()
    assert store.versions() == [1, 2] and sizes(store.load()) == (4, 2)


def test_stream_edges_wait_for_their_nodes(spark, tmp_path):
    source, schema = tmp_path / "in", "operation string, kind string, a string, b string"
    store = GraphStore(spark, str(tmp_path / "g"), "db", "late")

    def nodes(df):
        return nodes_from_dataframe(df.filter("kind = 'node'").select("a"), "a", "u", "User", property_columns=[])

    def edges(df):
        return df.filter("kind = 'edge'").select(
            F.lit("u").alias("src_space"), F.col("a").alias("src"), F.lit("u").alias("dst_space"), F.col("b").alias("dst"),
            F.lit("KNOWS").alias("type"), F.concat("a", "b").alias("edge_id"),
        )

    sized = []
    batches = (
        [("upsert", "node", "x", None), ("upsert", "edge", "x", "y"), ("upsert", "edge", "x", "y"), ("upsert", "edge", "x", "z")],
        [("upsert", "node", "w", None)],
        [("upsert", "node", "y", None)],
        [("delete", "node", "z", None)],
        [("upsert", "node", "z", None)],
    )
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))
        stream = streams.read_stream(spark, str(source), spark.read.parquet(str(source)).schema)
        streams.stream_graph_ingest(stream, store, str(tmp_path / "log"), nodes, edges).awaitTermination()
        sized.append(sizes(store.load()))
    # x-y joins when y comes, x-z falls away with the deletion of z
    assert sized == [(1, 0), (2, 0), (3, 1), (3, 1), (4, 1)]


def test_empty_stream_has_no_rows(spark, tmp_path):
    (tmp_path / "none").mkdir()
    stream = streams.read_stream(spark, str(tmp_path / "none"), spark.createDataFrame([], "k string, ts timestamp").schema)
    counted = streams.stream_windowed_counts(stream, "ts", ["k"], "1 hour")
    assert streams.complete_result(counted, "empty", str(tmp_path / "log")).count() == 0
