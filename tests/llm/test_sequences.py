"""Periodic runs, centroid clustering and language-model scores against brute force; mended operators."""

import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import cases
from trellis.llm import catalog, centroids, html_text, mixing, mixture, periodic, pii

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


# ---- periodic runs

def plain_runs(words, least=12):
    found, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def sequences(seed, n):
    rng = random.Random(seed)
    for _ in range(n):
        words = [rng.choice("abcdef"[:rng.choice([1, 2, 3, 5])]) for _ in range(rng.randint(0, 50))]
        unit = [rng.choice("abcd") for _ in range(rng.randint(1, 25))]
        words += unit * rng.randint(0, 6) + unit[:rng.randint(0, len(unit))]
        yield words + words if rng.random() < 0.3 else words + [rng.choice("ab") for _ in range(rng.randint(0, 20))]


@pytest.mark.parametrize("least", [2, 5, 12, 30])
@pytest.mark.parametrize("piece", [1, 13, 1 << 18])
def test_runs_of_any_pieces(least, piece):
    docs = list(sequences(least, 40))
    texts = pa.array(["", " \t", *[" ".join(d) for d in docs]]).slice(1)  # a slice of a longer array
    bounds, words, rows, own = periodic.runs_of_texts(texts, least, piece)
    for k, doc in enumerate([[], *docs]):
        got = [(s - bounds[k], n, q) for (s, n, q), text in zip(rows.tolist(), own) if text == k]
        assert got == plain_runs(doc, least)


def test_runs_of_very_repetitive_texts():
    fibonacci = ["0", "01"]
    while len(fibonacci[-1]) < 3000:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    for text in (" ".join(fibonacci[-1]), "w " * 200_000, "a b " * 50_000 + "c " * 100):
        _, words, rows, _ = periodic.runs_of_texts(pa.array([text]))
        if len(words) < 10_000:
            assert [tuple(r) for r in rows.tolist()] == plain_runs(text.split())
        else:
            assert len(rows) <= 2


def test_a_wrong_proposal_is_put_right(monkeypatch):
    monkeypatch.setattr(periodic, "_named", lambda left, right: left ^ left)  # every block has one name
    for doc in sequences(8, 10):
        _, _, rows, _ = periodic.runs_of_texts(pa.array([" ".join(doc)]))
        found = {tuple(r) for r in rows.tolist()}
        assert found <= set(plain_runs(doc))  # nothing that is not there


def planted(row):
    words = WORDS.findall(row["text"] or "")
    if row["doc_id"] is not None:
        h = zlib.crc32(str(row["doc_id"]).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def sha(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def test_op11_returns_every_row(spark, tmp_path):
    table = cases.docs(spark)
    table.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, catalog.QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()), key=str)
    want = []
    for row in table.collect():
        words = planted(row)
        runs = plain_runs(words)
        dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
        s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        want.append((
            row["doc_id"], len(runs), s, n, q, 1000 * n // q if runs else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
        ))
    assert got == sorted(want, key=str)
    assert periodic.find(cases.empty(spark)).count() == 0


# ---- centroid clustering

def lloyd(vectors, k, rounds):
    centres = [v for _, v in sorted((sha(f"1:{'' if i is None else i}"), v) for i, v in vectors)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in vectors:
            groups.setdefault(nearest(v)[1], []).append(v)
        centres = [tuple(sum(x) // len(groups[j]) for x in zip(*groups[j])) if j in groups else c for j, c in enumerate(centres)]
    return [(i, nearest(v)[1], nearest(v)[0]) for i, v in vectors], centres


@pytest.mark.parametrize("block", [2, 3, 16])
def test_clusters_by_column_blocks(spark, block):
    rng = random.Random(block)
    rows = [(i, [rng.choice([0.0, 0.3, -0.7, 1.01, -2.5]) for _ in range(7)]) for i in range(90)]
    rows += [(5, rows[7][1]), (None, rows[9][1])] + [(200 + i, [0.5] * 7) for i in range(60)]  # a taken id, no id, one common vector
    odd = [(300, None), (301, []), (302, [1.0] * 6), (303, [1.0] * 6 + [None]), (304, [1.0] * 6 + [float("nan")]), (305, [float("inf")] + [1.0] * 6)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("number", F.lit("clash")).repartition(3)
    found, centres = centroids.cluster(df, 6, 3, 7, block=block)
    want, final = lloyd([(i, tuple(math.floor(64 * x) for x in v)) for i, v in rows], 6, 3)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
    assert [tuple(c) for c in centres] == final


def test_clusters_of_few_and_no_vectors(spark):
    kind = "vec_id long, embedding array<float>"
    found, centres = centroids.cluster(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], kind), 16, 3, 2)
    assert {r["distance"] for r in found.collect()} == {0} and len(centres) == 2
    assert {r["cluster"] for r in found.collect()} == {0}  # equal centroids: the smaller number
    found, centres = centroids.cluster(spark.createDataFrame([], kind), 16, 3, 2)
    assert found.count() == 0 and centres == []


# ---- language-model scores

def base_scores(rows):
    low = [[w.translate(cases_lower) for w in WORDS.findall(r["text"] or "")] + ["\n"] for r in rows]
    out = [r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2 for r in rows]
    counts = Counter(w for words, held in zip(low, out) if not held for w in words)
    n, v = sum(counts.values()), len(counts)
    return [
        (r["doc_id"], held, len(words), sum(counts[w] > 0 for w in words), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words))
        for r, words, held in zip(rows, low, out)
    ]


cases_lower = {i: i + 32 for i in range(65, 91)}


def test_base_scores_equal_brute_force(spark):
    table = cases.docs(spark)
    got = mixture.scored(table).collect()
    want = sorted(base_scores(table.collect()), key=str)
    for g, w in zip(sorted([tuple(r)[:6] for r in got], key=str), want):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9)
    assert len(got) == len(want) and all(r["score"] < 0 and r["bits_per_byte"] > 0 for r in got)
    assert mixture.scored(cases.empty(spark)).count() == 0


def test_frequent_and_rare_words_score_alike(spark, monkeypatch):
    table = cases.docs(spark, n=20).filter("doc_id IS NOT NULL")
    first = {(r["doc_id"], r["n_tokens"]): r for r in mixture.scored(table).collect()}
    monkeypatch.setattr(mixture, "SHARE", 2.0)  # none is frequent: all tokens are joined
    second = {(r["doc_id"], r["n_tokens"]): r for r in mixture.scored(table).collect()}
    assert first.keys() == second.keys()
    for key, row in first.items():
        assert row["base_score"] == pytest.approx(second[key]["base_score"]) and row["score"] == pytest.approx(second[key]["score"], rel=1e-4)


def plain_logs(table, weights, follow, word, before):
    """The model bit by bit, from its counts."""
    model = mixture.Model(table, weights, follow)
    value, total = (word + " ").encode(), 0.0
    for part, low, classes in ((value[:mixture.HEAD], 0, np.array([before])), (value, mixture.HEAD, None)):
        if len(part) > low:
            bits = mixture.Bits(np.frombuffer(part, dtype=np.uint8), np.array([len(part)]), low, classes)
            for k in range(len(bits.bit)):
                odds = [float(model.table[bits.slots[i][k]]) for i in range(mixture.PREDICTORS)] + [1.0]
                gate = int(model.trust[bits.slots[mixture.WHOLE][k] - mixture.STARTS[mixture.WHOLE]]) * 2 + (k % 8) // 4
                z = max(-16.0, min(16.0, sum(w * o for w, o in zip(weights[gate], odds))))
                p = (1 / (1 + math.exp(-z)) + model.refined[mixture._level(np.array([z], dtype=np.float32), bits.node[k:k + 1])[0]]) / 2
                total += math.log10(p if bits.bit[k] else 1 - p)
    return total


def test_word_probabilities_sum_to_one_and_equal_the_plain_model(spark):
    """Over all bytes that may follow, the probabilities of one context sum to one."""
    rng = np.random.default_rng(1)
    table = rng.integers(0, 5, (mixture.STARTS[-1], 2)).astype(np.float32)
    weights, follow = mixture.first_weights() + rng.normal(0, 0.1, (mixture.GATES, mixture.PREDICTORS + 1)), rng.integers(0, 9, (256 * mixture.LEVELS, 2)).astype(float)
    model = mixture.Model(table, weights, follow)
    for low, prefix, classes in ((0, b"", np.full(256, 3)), (mixture.HEAD, b"abcd", None)):
        value = np.concatenate([np.frombuffer(prefix + bytes([b]), dtype=np.uint8) for b in range(256)])
        bits = mixture.Bits(value, np.full(256, len(prefix) + 1), len(prefix), classes)
        assert (10.0 ** model.logs(bits, 256)).sum() == pytest.approx(1, abs=1e-3)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["hello", "a", "\n", "überlang"]), *[pa.array([1] * 4) for _ in range(mixture.CLASSES)], pa.array([511] * 4)],
        names=["word", *mixture.COUNTS, "used"],
    )
    words = mixture.Words(batch)
    tail = np.zeros(4)
    for rows, bits in words.tails(False, 5):
        tail[rows] = model.logs(bits, len(rows))
    row, kind, number, bits = words.heads(False)
    head = model.logs(bits, bits.unit[-1] + 1)[number]
    for r, k, h in zip(row, kind, head):
        assert h + tail[r] == pytest.approx(plain_logs(table, weights, follow, batch.column(0)[int(r)].as_py(), k), abs=1e-3)


def test_learned_words_are_likelier(spark):
    rng = random.Random(2)
    common = ["river", "stone", "window", "garden", "silver"]
    rows = [(i, " ".join(rng.choice(common) for _ in range(30))) for i in range(200)] + [(900, "river stone window garden"), (901, "xqzv jjkk wwqp zzxy")]
    got = {r["doc_id"]: r for r in mixture.scored(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[900]["score"] / 5 > got[901]["score"] / 5 + 1
    held = [r for r in got.values() if r["held_out"] and r["doc_id"] < 200]
    assert sum(r["bits_per_byte"] for r in held) / len(held) < 1


# ---- mended operators

@pytest.mark.parametrize("rows", [
    [(1, "", "a"), (2, "x y z", "b"), (3, "x y", "c")], [(1, None, None), (2, "x y z", "b")], [(1, "", "a"), (2, None, "a"), (3, " ", None)],
    [(1, "x y", "a"), (2, "", "a"), (3, "z z z z", "b"), (4, "", None)],
])
def test_sources_without_words(spark, rows):
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(table).collect()
    assert len(got) == len(rows)
    assert all(r["taken"] == 0 for r in got if r["size"] == 0) and all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    mixing.mixed_rows(table).collect()


def test_an_empty_source_leaves_the_others_at_their_targets(spark):
    rows = [(i, "w " * (i % 50 + 1), f"s{i % 3}") for i in range(600)] + [(1000 + i, "", "empty") for i in range(50)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    for source in {r[2] for r in rows}:
        own = [r for r in got if rows_source(rows, r["doc_id"]) == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 0.01 * own[0]["target"] + mixing.BLOCK


def rows_source(rows, doc_id):
    return next(r[2] for r in rows if r[0] == doc_id)


def test_the_sample_of_personal_data_keeps_its_size(spark):
    ids = spark.range(200_000).withColumnRenamed("id", "doc_id")
    assert 700 < ids.filter(pii.learned_from(200_000, 1000)).count() < 800
    limit = pii.PARTS * 8000 // 10**11
    assert limit > 10**11  # at 1e11 rows the share still has very many parts
    assert ids.filter(pii.learned_from(10**11, 8000)).count() <= 1


def test_numbers_that_fail_a_check_are_never_added():
    assert pii.impossible("4111 1111 1111 1112", "card") and not pii.impossible("4111.1111.1111.1111", "card")
    assert pii.impossible("300-1-2-3", "ip") and not pii.impossible("10_0_0_7", "ip") and pii.impossible("00 12 34", "phone")

    class Everything:
        def __call__(self, x):
            return np.ones(len(x))

    text = "card 4111.1111.1111.1112 or 4111/1111/1111/1111, host 10-0-0-7"
    spans = pii.all_spans(text, pii.base_spans(text), (Everything(), [0.0, 0.0, 0.0, math.inf]))
    assert [text[s:e] for s, kind, e in spans if kind == "card"] == ["4111/1111/1111/1111"]


PARAGRAPH = "<p>" + "This is a long paragraph of the article with many words in it. " * 4 + "</p>"
LINKS = " ".join(f"<a href=x>{w}</a>" for w in "Home News Sport Weather Travel Culture".split())


@pytest.mark.parametrize("page", [
    f"<body><div class=top>{LINKS}</div><h1>Title</h1>{PARAGRAPH * 3}</body>",
    f"<main><ul class=tabs>{''.join(f'<li>{x}</li>' for x in LINKS.split(' <'))}</ul><h1>Title</h1>{PARAGRAPH * 3}</main>".replace("<li>a ", "<li><a "),
    f"<table><tr><td>{LINKS}</td><td><h1>Title</h1>{PARAGRAPH * 3}</td></tr></table>",
    f"<body><div style='display: none'>unseen</div><h1>Title</h1>{PARAGRAPH * 3}",
    *[f"<body><{tag}>{LINKS}<main><h1>Title</h1>{PARAGRAPH * 3}</main>" for tag in ("nav", "button", "select")],
])
def test_menus_without_a_name_and_elements_left_open(page):
    assert html_text.main_text(page).split("\n\n")[0] == "Title"
    assert html_text.main_text(page).count("long paragraph") == 12


def test_a_page_of_menus_has_no_text():
    assert html_text.main_text(f"<nav>{LINKS}</nav><footer>{LINKS}</footer>") == ""


def test_broken_pages_take_time_in_proportion():
    import time

    for page in ("<div><p>some words here " * 8000, "<div>" * 100_000 + "text", "<p><table><div>" * 20_000 + "text"):
        started = time.process_time()
        assert html_text.main_text(page)
        assert time.process_time() - started < 8


def test_registered_queries_of_this_module():
    assert {"op11_periodic_runs", "op12_centroid_clusters", "op13_language_model"} <= catalog.QUERIES.keys()
    json.dumps(sorted(catalog.ORACLES))
