"""Duplicates, mixing, quality and archives against brute force, and the pipeline stage by stage."""

import base64
import hashlib
import io
import re
import struct
import zipfile
from collections import Counter, defaultdict

import pytest
import xxhash

import corpus_pipeline
from tests.llm import cases
from trellis.llm import exact_dedup, mixing, quality, simhash, warc
from trellis.session import Scratch

SPACE = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def least(ids):
    return min((i for i in ids if i is not None), default=None)


# ---- simhash


def plain_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fingerprints):
    """fingerprint -> smallest fingerprint of its component."""
    different, root = sorted(set(fingerprints)), {}
    for f in different:
        root.setdefault(f, f)
    changed = True
    while changed:
        changed = False
        for a in different:
            for b in different:
                if (a ^ b).bit_count() <= 3 and root[b] < root[a]:
                    root[a], changed = root[b], True
    return root


def test_fingerprints_and_components(spark):
    rows = cases.rows()
    got = simhash.near_duplicates(cases.docs(spark)).collect()
    prints = [plain_fingerprint(r[1]) for r in rows]
    root = plain_components(prints)
    ids = defaultdict(list)
    for r, f in zip(rows, prints):
        ids[root[f]].append(r[0])
    want = Counter((r[0], f"{f:016x}", least(ids[root[f]])) for r, f in zip(rows, prints))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want
    kept = simhash.keep_first(cases.docs(spark))
    assert kept.columns == cases.docs(spark).columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(least(g) for g in ids.values())
    assert simhash.near_duplicates(cases.empty(spark)).count() == 0 and simhash.keep_first(cases.empty(spark)).count() == 0


def test_covering_is_complete():
    import itertools

    masks = simhash.covering_masks()
    assert len(masks) == 15 and min(m.bit_count() for m in masks) >= 28
    for bits in itertools.combinations(range(64), 3):
        differ = sum(1 << b for b in bits)
        assert any(not m & differ for m in masks)
    for mask in masks[:3]:
        free = [b for b in range(64) if not mask >> b & 1]
        splits = simhash.split_masks(mask)
        for bits in itertools.combinations(free, 3):
            assert any(not s & sum(1 << b for b in bits) for s in splits)
        assert all((~(mask | s) & (1 << 64) - 1).bit_count() <= 9 for s in splits)


@pytest.mark.parametrize("bucket", [4, 512])
def test_links_connect_what_pairs_connect(spark, monkeypatch, bucket):
    import random

    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng, prints = random.Random(bucket), set()
    for _ in range(12):
        f = rng.getrandbits(64)
        for _ in range(25):
            prints.add(f)
            for _ in range(rng.randint(1, 3)):
                f ^= 1 << rng.randrange(64)
    scratch = Scratch(spark)
    table = spark.createDataFrame([(simhash.signed(f),) for f in prints], "fp long")
    found = simhash.links(table, scratch)
    unsigned = {(r.a % 2**64, r.b % 2**64) for r in found.collect()}
    assert all((a ^ b).bit_count() <= 3 for a, b in unsigned)
    roots = {r.fp % 2**64: r.root % 2**64 for r in simhash.components(found, scratch).collect()}
    plain = plain_components(prints)
    groups, want = defaultdict(set), defaultdict(set)
    for f in prints:
        groups[roots.get(f, f)].add(f)
        want[plain[f]].add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


# ---- exact duplicates


@pytest.mark.parametrize("hot", [200, 2])
def test_exact_duplicates(spark, monkeypatch, hot):
    monkeypatch.setattr(exact_dedup, "HOT_ROWS", hot)
    rows = cases.rows()
    groups = defaultdict(list)
    for r in rows:
        groups[SPACE.sub(" ", r[1] or "")].append(r[0])
    got = exact_dedup.exact_duplicates(cases.docs(spark)).collect()
    want = Counter()
    for text, ids in groups.items():
        for i in ids:
            want[i, least(ids), len(ids), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter({hashlib.sha256(t.encode()).hexdigest(): 1 for t in groups})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    kept = exact_dedup.keep_first(cases.docs(spark))
    assert kept.columns == cases.docs(spark).columns and kept.count() == len(groups)
    assert exact_dedup.exact_duplicates(cases.empty(spark)).count() == 0


def test_content_sort_needs_no_second_shuffle(spark):
    table = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = exact_dedup.exact_duplicates(table)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "hashpartitioning" not in plan


# ---- mixing


def plain_targets(sizes, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        level = (total - sum(2 * sizes[s] for s in full)) / max(1e-9, sum(weight[s] for s in names if s not in full))
        above = {s for s in names if s not in full and weight[s] * level > 2 * sizes[s]}
        if not above:
            return {s: 2 * sizes[s] if s in full else weight[s] * level for s in names}
        full |= above


def test_mix_meets_its_targets(spark):
    rows = cases.rows(n=600)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    want = plain_targets(sizes)
    got = mixing.mix(cases.docs(spark, n=600)).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r[0], len(WORD.findall(r[1] or ""))) for r in rows)
    by_target = defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        by_target[round(r.target, 3)] += r.taken
    assert sorted({round(t, 3) for t in want.values()}) == sorted(by_target)
    for target, taken in by_target.items():
        same = [s for s in want if round(want[s], 3) == target]
        assert abs(taken - target * len(same)) <= 0.01 * target * len(same) + mixing.BLOCK * 2
    again = mixing.mix(cases.docs(spark, n=600, parts=1)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert mixing.mix(cases.empty(spark)).count() == 0


def test_quotas_are_the_highest_quotients(spark):
    import random

    rng, block = random.Random(3), 16
    cells = [(shard, f"s{i}", rng.randint(1, 5000), 1000.0, float(rng.randint(1, 2000))) for shard in range(6) for i in range(1, 2 + shard * 5)]
    table = spark.createDataFrame(cells, "shard long, source string, words long, source_size double, target double")
    got = {(r.shard, r.source): r.quota for r in mixing._quotas(table, block).collect()}
    for shard in range(6):
        wanted = {s: t * w / z for k, s, w, z, t in cells if k == shard}
        seats, held = int(sum(wanted.values()) / block + 0.5), Counter()
        for _ in range(seats):
            held[min(wanted, key=lambda s: (-wanted[s] / (2 * held[s] + 1), s))] += 1
        for k, s, w, _, _ in cells:
            if k == shard:
                assert got.get((k, s), 0) == min(held[s], 2 * -(-w // block)), (shard, s)


def test_mixed_rows_are_what_was_taken(spark):
    table = cases.docs(spark, n=200)
    taken = Counter()
    for r in mixing.mix(table).collect():
        taken[r.doc_id] += r.taken
    rows, texts = mixing.mixed_rows(table), defaultdict(set)
    for r in cases.rows(n=200):
        texts[r[0]].add(r[1])
    assert rows.columns == table.columns
    words = Counter()
    for r in rows.collect():
        words[r.doc_id] += len(WORD.findall(r.text))
        assert r.text in texts[r.doc_id] or any(r.text.split()[0] in (t or "") for t in texts[r.doc_id])
    assert words == +taken
    assert mixing.mixed_rows(cases.empty(spark)).count() == 0


def test_a_source_of_short_texts_meets_its_target_over_many_shards(spark):
    rows = [(i, "long", "w " * 200) for i in range(4000)] + [(10_000 + i, "titles", "one two three") for i in range(300)]
    rows += [(20_000 + i, None, "a b c d e f g h") for i in range(100)]
    table = spark.createDataFrame(rows, "doc_id long, source string, text string")
    placed = mixing._placed(
        table.selectExpr("CAST(NULL AS LONG) AS number", "doc_id", "source", "CAST(size(split(trim(text), ' ')) AS LONG) AS size"),
        Scratch(spark), shard_rows=30,
    ).collect()
    by_id, taken, target = {r[0]: r for r in rows}, Counter(), {}
    for r in placed:
        source = by_id[r.doc_id][1]
        taken[source] += r.taken
        target[source] = r.target
        assert 0 <= r.taken <= 2 * r.size
    assert len(placed) == len(rows)
    assert all(abs(taken[s] - target[s]) <= 0.02 * target[s] for s in target), (taken, target)


# ---- quality


def plain_measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i:i + 8])].append(i)
    repeated = {i + k for places in windows.values() if len(places) > 1 for i in places for k in range(8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated))


def test_quality_measures(spark):
    got = quality.judge(cases.docs(spark)).collect()
    want = Counter((r[0], *plain_measures(r[1])) for r in cases.rows())
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in got)
    assert not any(r.kept for r in got if r.base_failed)
    kept = quality.keep_good(cases.docs(spark))
    assert kept.columns == cases.docs(spark).columns and kept.count() == sum(r.kept for r in got)
    assert quality.judge(cases.empty(spark)).count() == 0


def test_bad_hosts_lose_their_doubtful_documents_only(spark):
    good = "one fine sentence of the good kind that " * 1
    clean = " ".join(f"word{i}" for i in range(60))
    doubtful = " ".join(f"word{i}" for i in range(30))
    rows = [(i, "bad one", "bad", "") for i in range(90)] + [(100, clean, "bad", ""), (101, doubtful, "bad", "")]
    rows += [(200 + i, clean, "good", good) for i in range(200)] + [(500, doubtful, "good", ""), (501, doubtful, "lone", "")]
    rows += [(600 + i, clean, f"host{i}", "") for i in range(20)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = {r.doc_id: r for r in quality.judge(table).collect()}
    assert got[100].kept and not got[101].kept and got[500].kept and got[501].kept
    assert got[101].host_rate > 0.8 and 0 < got[501].host_rate < 0.5


# ---- archives


PAGES = [
    (3, "http://a/", "<p>same</p>"), (1, "http://b/ü?q=1 2\r\n", "<p>same</p>"), (2, None, "<p>same</p>"), (4, "u", None), (5, "u", ""), (6, "u", "é" * 5000),
    (None, "u", "<p>same</p>"), (None, "v", "lone"), (7, "u", "x\r\n\r\nWARC/1.1\r\n\r\n"), (8, "u", "y" * 300_000), (8, "u", "y" * 300_000),
]


def test_archive_round_trip(spark):
    table = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "2 AS first").repartition(3)
    for smallest in (0, 10**6):
        got = warc.archive(table, least_bytes=smallest).collect()
        ids = defaultdict(list)
        for i, _, html in PAGES:
            ids[html or ""].append(i)
        want, seen = Counter(), set()
        for i, _, html in PAGES:
            data = (html or "").encode()
            first = least(ids[html or ""])
            # One row of a payload is the response, also where rows share their id.
            revisit = len(data) >= smallest and (i != first or html in seen)
            seen |= {html} if i == first else set()
            want[i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", first if revisit else None] += 1
        assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
        assert all(bytes(r.payload).decode() in ids for r in got if r.record_type == "response")
    assert warc.archive(table.limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["smallint", "decimal(20,3)", "date", "string"])
def test_archive_keeps_ids_of_any_type(spark, kind):
    value = "'2020-01-0' || id" if kind == "date" else "id"
    table = spark.range(1, 8).selectExpr(f"CASE WHEN id < 7 THEN cast({value} AS {kind}) END AS page_id", "'u' AS url", "'p' || id % 2 AS html")
    got = warc.archive(table)
    assert got.schema["page_id"].dataType == got.schema["refers_to"].dataType == table.schema["page_id"].dataType
    rows = got.collect()
    assert Counter(r.page_id for r in rows) == Counter(r.page_id for r in table.collect())
    first, second = sorted({r.page_id for r in rows} - {None})[:2]
    assert {r.page_id for r in rows if r.record_type == "response"} == {first, second}
    assert {r.refers_to for r in rows if r.record_type == "revisit"} == {first, second}


def test_archive_spreads_a_hot_payload(spark, monkeypatch):
    monkeypatch.setattr(warc, "HOT_ROWS", 5)
    table = spark.range(0, 300).selectExpr("id AS page_id", "'u' AS url", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE 'p' || id END AS html")
    rows = warc.archive(table).collect()
    assert len(rows) == 300 and sum(r.record_type == "response" for r in rows) == 201
    assert all(r.refers_to == 0 for r in rows if r.record_type == "revisit")


def read_at(data):
    return lambda size, offset: data[offset:offset + size]


@pytest.mark.parametrize("zip64", [False, True])
def test_packages_are_read_by_range(monkeypatch, zip64):
    if zip64:  # make the writer use the ZIP64 forms
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 0)
    sink = io.BytesIO()
    package = warc.Package(sink)
    digest = hashlib.sha1(b"body").hexdigest()
    for i in range(50):
        package.add(warc.record_id(i), warc.record(i, "http://x/", warc.base32(digest), 4, None, b"body"))
    package.close()
    data = sink.getvalue()
    assert (b"PK\x06\x06" in data) == zip64
    with zipfile.ZipFile(io.BytesIO(data)) as check:
        assert check.testzip() is None and set(check.namelist()) == {warc.ARCHIVE, warc.INDEX}
    fetched = []

    def counted(size, offset):
        fetched.append(size)
        return data[offset:offset + size]

    found = [warc._row(r) for r in warc.records(counted, len(data), range_bytes=1000)]
    assert [r["page_id"] for r in found] == list(range(50)) and {r["payload"] for r in found} == {b"body"}
    assert max(fetched[4:]) <= 1000
    with_comment = data[:-2] + struct.pack("<H", 5) + b"PK\x05\x06"[:4] + b"!"
    assert warc.Members(read_at(with_comment), len(with_comment)).places.keys() == {warc.ARCHIVE, warc.INDEX}


def test_broken_payloads_are_an_error():
    data = warc.record(1, None, "A" * 32, 4, None, b"body")
    with pytest.raises(ValueError):
        warc._row(data)
    with pytest.raises(ValueError):
        warc.Members(read_at(b"no zip at all" * 9), 117)


# ---- the pipeline


def test_pipeline_stages(spark, tmp_path):
    table = cases.docs(spark, n=300)
    table.write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, scratch = docs.columns, Scratch(spark)
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [tuple(r) for r in docs.collect()]
        docs = scratch.put(stage(spark, docs, str(tmp_path)), f"s{number}")
        after = [tuple(r) for r in docs.collect()]
        if number < 4:
            assert docs.columns == columns
        if number == 0:
            fails = [plain_measures(r[1]) for r in before]
            want = [r for r, m in zip(before, fails) if not (m[0] < 20 or 100 * m[4] > 30 * m[0])]
            assert Counter(after) == Counter(want)  # hosts are all fair here
        elif number == 1:
            texts = Counter(SPACE.sub(" ", r[1] or "") for r in after)
            assert texts.keys() == {SPACE.sub(" ", r[1] or "") for r in before} and set(texts.values()) == {1}
        elif number == 2:
            prints = [plain_fingerprint(r[1]) for r in before]
            root = plain_components(prints)
            assert len(after) == len(set(root.values())) and not Counter(after) - Counter(before)
        elif number == 3:
            total = sum(len(WORD.findall(r[1])) for r in before)
            assert abs(sum(len(WORD.findall(r[1])) for r in after) - 1.5 * total) < 0.02 * total
        else:
            assert sum(r[2] for r in after) >= sum(len(WORD.findall(r[1])) for r in before)
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert Counter(map(tuple, run.select("doc_id", "doc_tokens").distinct().collect())) == Counter((i, n) for i, n in {(r[0], r[4]) for r in after})
