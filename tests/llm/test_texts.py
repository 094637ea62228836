"""Token counts, packing, pages, toxicity and personal data, each against a plainer form."""

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from tests.llm import cases
from trellis.llm import html_text, packing, pii, token_counts, toxicity

# ---- token counts


def test_counts_are_the_tokenizers(spark):
    path = token_counts.vocabulary_path()
    vocabulary = token_counts.unigram_vocabulary(path)
    whole = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    whole.pre_tokenizer = pre_tokenizers.Metaspace(replacement=token_counts.MARK, prepend_scheme="always", split=True)
    rng = random.Random(4)
    odd = ["".join(rng.choice("abé 😀\n▁<unk>日.") for _ in range(40)) for _ in range(500)]
    counter = token_counts.TokenCounter(vocabulary)
    for text in odd:
        assert counter.text(text)[0] == len(whole.encode(text, add_special_tokens=False).ids), text
    table = cases.docs(spark)
    got = sorted((str(r.doc_id), r.n_tokens) for r in token_counts.token_counts(table, path).collect())
    want = sorted((str(r[0]), len(whole.encode(r[1] or "", add_special_tokens=False).ids)) for r in cases.rows())
    assert got == want


def test_ties_take_the_piece_that_starts_first():
    counter = token_counts.TokenCounter([("a", -1.0), ("b", -1.0), ("c", -1.0), ("ab", -2.0), ("bc", -2.0), (token_counts.MARK, 0.0)])
    assert counter.word(token_counts.MARK + "abc") == (3, -3.0)  # mark, then ab c and a bc and a b c tie


# ---- packing


def test_the_whole_vocabulary_is_reached_by_its_own_pairs():
    import json

    with open(packing.tokenizer_path(), encoding="utf-8") as file:
        model = json.load(file)["model"]
    pairs = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(model["merges"])}
    for left, right in pairs:
        piece = left + right
        ends = piece.endswith("</w>")
        plain = piece[:-4] if ends else piece
        parts = [*plain[:-1], plain[-1] + "</w>"] if ends else [*plain]
        while len(parts) > 1:
            rank, i = min((pairs.get((a, b), 10**9), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 10**9:
                break
            parts[i:i + 2] = ["".join(parts[i:i + 2])]
        assert parts == [piece]


def test_word_table_gives_the_tokenizers_ids():
    words, whole = packing.WordIds(packing.tokenizer_path()), Tokenizer.from_file(packing.tokenizer_path())
    rng = random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyzABCéèüßñœłÅİŉ'.,!?#&%$*123 \n\t \x1ćΣςж日<|>"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    texts += ["", "ΑΣ don't <|endoftext|> x" + "y" * 300, "İstanbul naïve été don't O'Neil's"]
    for text, (ids, _) in zip(texts, packing.tokenise(words, texts)):
        assert np.frombuffer(ids, "<u4")[:-1].tolist() == whole.encode(text, add_special_tokens=False).ids, text


def brute_cost(places, penalties, length):
    cost = [0.0] + [None] * (len(places) - 1)
    for j in range(1, len(places)):
        options = []
        for i in range(j):
            size = places[j] - places[i]
            if size <= length:
                padding = 0 if size & (size - 1) == 0 else length - size
                options.append(cost[i] + padding + penalties[j] + packing.PER_SEQUENCE)
        cost[j] = min(options)
    return cost[-1]


@pytest.mark.parametrize("seed", range(20))
def test_cuts_cost_the_least(seed):
    rng, length = random.Random(seed), 64
    places, penalties = [0], [0.0]
    while places[-1] < 900:
        places.append(places[-1] + rng.randint(1, 30))
        penalties.append(rng.choice([0.0, 8.0, 64.0]))
    path = packing.best_cuts(places, penalties, length, 1)
    cost = 0.0
    for i, j in zip(path, path[1:]):
        size = places[j] - places[i]
        assert size <= length
        cost += (0 if size & (size - 1) == 0 else length - size) + penalties[j] + packing.PER_SEQUENCE
    assert path[0] == 0 and path[-1] == len(places) - 1
    assert cost == pytest.approx(brute_cost(places, penalties, length))


def check_pieces(found, texts, whole, length):
    ids = [[*whole.encode(t or "", add_special_tokens=False).ids, packing.END_TOKEN] for t in texts]
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id, r.doc_tokens].append(r)
    for pieces in sequences.values():
        place = 0
        for offset, size in sorted(pieces):
            assert offset == place and size > 0
            place += size
        assert place <= length
    total = sum(len(i) for i in ids)
    assert sum(r.length for r in found) == total
    want = sorted(zlib.crc32(np.array(i[a:a + n], dtype="<u4").tobytes()) for i in ids for a, n in [(0, len(i))])
    whole_pieces = [r for r in found if r.start == 0 and r.length == r.doc_tokens]
    assert all(r.ids_crc32 in want for r in whole_pieces)
    return {k: sum(n for _, n in p) for k, p in sequences.items()}, total


def test_packing_keeps_each_id_once(spark):
    whole = Tokenizer.from_file(packing.tokenizer_path())
    table = cases.docs(spark, n=400)
    found = packing.pack(table, packing.tokenizer_path()).collect()
    sizes, total = check_pieces(found, [r[1] for r in cases.rows(n=400)], whole, 2048)
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in sizes.values())
    assert padding < 0.05 * total
    assert packing.pack(cases.empty(spark), packing.tokenizer_path()).count() == 0
    small = packing.pack(table, packing.tokenizer_path(), length=256).collect()
    check_pieces(small, [r[1] for r in cases.rows(n=400)], whole, 256)


def test_stretches_and_sizes_of_memory_change_no_id(monkeypatch):
    texts = [r[1] or "" for r in cases.rows(n=300)]
    words = packing.WordIds(packing.tokenizer_path())
    plain = list(packing.tokenise(words, texts))
    monkeypatch.setattr(packing, "MEMO_WORDS", 50)
    monkeypatch.setattr(packing, "STRETCH", 10_000)
    again = packing.WordIds(packing.tokenizer_path())
    assert [a for a, _ in plain] == [a for k in range(0, len(texts), 7) for a, _ in packing.tokenise(again, texts[k:k + 7])]
    packer, rows = packing.Packer(2048, 0), []
    for i, (ids, ends) in enumerate(plain):
        rows += packer.add(i, ids, ends)
    rows += packer.finish()
    held = defaultdict(list)
    for doc, start, size, crc, _, _, _ in rows:
        assert crc == zlib.crc32(plain[doc][0][4 * start:4 * (start + size)])
        held[doc].append((start, size))
    for doc, (ids, _) in enumerate(plain):
        place = 0
        for start, size in sorted(held[doc]):
            assert start == place
            place += size
        assert place == len(ids) // 4


# ---- pages


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a = "</p><p>no";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Menu</a></ul></nav><div id="cookie-notice">We use cookies</div>
<div class="ad">Buy now</div><div class="sidebar"><p>Side text without any tags that goes on for long enough to count as text.</p></div>%s
<form><p>Sign up</p><input></form><footer>&copy; all rights</footer></body></html>"""
ARTICLE = """<h1>Head &amp; line</h1><p>First <b>bold</b> para&shy;graph,&nbsp;with
  a break<br>here.<p>Short.<ul><li>One<li>Two</ul><aside>aside</aside><blockquote>Cited &lt;b&gt; words &#x41;</blockquote>
<!-- no --><section class="comments"><article><p>A reader's comment of some length, well over the usual.</p></article></section>"""
WANT = "Head & line\n\nFirst bold para­graph, with a break here.\n\nShort.\n\nOne\n\nTwo\n\nCited <b> words A"


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<main>%s</main>", "<div class='content'>%s</div>", "<div class='with-sidebar'><article>%s</article></div>"])
def test_article_and_nothing_else(wrap):
    assert html_text.main_text(PAGE % (wrap % ARTICLE)) == WANT


BODY = "".join(f"<p>Paragraph {i} of the text goes on for quite some words, as paragraphs do, and ends here.</p>" for i in range(6))
LINES = [f"Paragraph {i} of the text goes on for quite some words, as paragraphs do, and ends here." for i in range(6)]


@pytest.mark.parametrize("page", [
    "<head><title>T</title><body><article>%s</article>", "<head><title>T</title><meta charset=utf-8><div>%s</div>", "<body><div class='has-sidebar'>%s</div>",
    "<body><div id='content-form'><nav>Menu</nav><div>%s</div></div>", "<body><form action=x><input><div>%s</div></form>",
    "<body><form><article>%s</article></form>", "<body><div class='no-sidebar'><form>%s<div class='sidebar'><p>Side text of some length</p></div></form></div>",
])
def test_wrappers_do_not_hide_the_page(page):
    assert html_text.main_text(page % BODY).split("\n\n") == LINES


def test_names_within_the_article_hide_nothing():
    page = f"<body><article>{BODY}<section id='related-work'><h2 id='legal-notice'>Legal notice</h2><p>Earlier work.</p></section><div class='ad-hoc'>Ad hoc</div><div class='ad'>Buy</div></article>"
    assert html_text.main_text(page).split("\n\n") == [*LINES, "Legal notice", "Earlier work.", "Ad hoc"]


def test_no_content_line_is_dropped():
    lead = "The lead says in one long sentence what all of the text below is about, and why it matters, and goes on to name those who were there and what they did."
    long = BODY * 5
    page = f"<body><nav>Menu</nav><div id=page><div class=lead><h1>Headline</h1><p>{lead}</p></div><div class=text>{long}</div></div>"
    assert html_text.main_text(page).split("\n\n") == ["Headline", lead, *LINES * 5]
    page = f"<body><nav>Menu</nav><div class=lead><h1>Headline</h1><p>{lead}</p></div><article>{long}</article><article><p>Short.</p></article><div>Imprint</div>"
    assert html_text.main_text(page).split("\n\n") == ["Headline", lead, *LINES * 5, "Short."]
    assert html_text.main_text(f"<body><p>{lead}</p><main>{long}</main><div>Imprint</div>").split("\n\n") == [lead, *LINES * 5]


def test_pages_of_every_kind(spark):
    odd = [(1, "u", None), (2, None, ""), (3, "u", "   "), (4, "u", "plain &amp; text"), (5, "u", "<p>a<p>b<div>c"), (None, "u", "<<<>><p"),
           (6, "u", "<p>" + "w " * 50000), (7, "u", "<div>" * 3000 + "deep"), (1, "u", None)]
    table = spark.createDataFrame(odd, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars")
    got = {(r.page_id, r.url): r for r in html_text.extract(table).collect()}
    assert html_text.extract(table).count() == 9 and html_text.extract(table.limit(0)).count() == 0
    assert [got[k].text for k in ((1, "u"), (2, None), (3, "u"))] == ["", "", ""]
    assert got[4, "u"].text == "plain & text" and got[5, "u"].text == "a\n\nb\n\nc"
    assert got[6, "u"].n_chars == 99_999 and got[7, "u"].text == "deep"


def test_smoothing_and_threshold():
    assert html_text.smoothed(np.full(9, 3.0)) == pytest.approx(np.full(9, 3.0))
    assert 1 < html_text.threshold(np.array([1.0, 1.0, 9.0, 9.0])) < 9
    assert html_text.threshold(np.array([2.0, 2.0])) == 2.0


# ---- toxicity


def labelled(spark):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(1600):
        words = [rng.choice("sun moon tree river stone cloud field house road light".split()) for _ in range(30)]
        toxic = i % 5 == 0
        if toxic:
            words[rng.randrange(30)] = rng.choice(["vile", "rotten", "wretchy", "wretchful", "wretched"])
            words[rng.randrange(30)] = rng.choice(["vile", "rotten"])
        # Groups are named more often in toxic texts: a biased sample.
        if rng.random() < (0.5 if toxic else 0.02):
            words[rng.randrange(30)] = "muslims"
        docs.append((i, " ".join(words) + "."))
        labels.append((i, 1, int(toxic)))
    return (spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_toxic_texts_are_found_and_mentions_are_not(spark, monkeypatch):
    docs, labels = labelled(spark)
    weights, bias = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, weights, bias).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    held = [(i % 5 == 0, r.predicted) for i, r in got.items() if r.held_out]
    assert sum(p for t, p in held if t) >= 0.95 * sum(t for t, _ in held)
    monkeypatch.setattr(toxicity, "COUNTERFACTUAL", 0.0)
    biased, plain_bias = toxicity.fit(docs, labels)
    neutral = "many muslims and the sun over the river."
    fair, unfair = toxicity.Scorer(weights, bias)(neutral), toxicity.Scorer(biased, plain_bias)(neutral)
    assert fair < toxicity.THRESHOLD and fair < unfair
    swapped = toxicity.Scorer(weights, bias)(neutral.replace("muslims", "christians"))
    assert abs(fair - swapped) < abs(unfair - toxicity.Scorer(biased, plain_bias)(neutral.replace("muslims", "christians")))


def test_held_out_labels_change_nothing(spark):
    docs, labels = labelled(spark)
    from pyspark.sql import functions as F

    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, labels) == toxicity.fit(docs, flipped)


def test_scores_of_awkward_rows(spark):
    table = cases.docs(spark).withColumnRenamed("kept", "score")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    weights, bias = toxicity.fit(table.select("doc_id", "text"), labels)
    found = toxicity.score(table, weights, bias).collect()
    assert len(found) == len(cases.rows()) and all(0 <= r.score <= 1 for r in found)
    assert toxicity.score(cases.empty(spark), weights, bias).count() == 0


# ---- personal data


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    found = [(m.start(), "email", m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), "ip", m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m[0])
        if 12 <= len(digits) <= 19 and pii.luhn(digits):
            found.append((m.start(), "card", m.end()))
    found += [(m.start(), "phone", m.end()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return pii.in_order(found)


def test_base_spans_are_the_patterns():
    rng = random.Random(5)
    parts = ["1", "2", "45", "255", "300", ".", ".", "@", "@", "a", "b-", "+", "(", ")", " ", "-", "x.y", "é", "\n", "4111111111111111"]
    for _ in range(15_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 24)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_boosting_adds_only_what_looks_certain(spark):
    rng = random.Random(9)
    rows, misses = [], []
    for i in range(3000):
        number = f"({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)}"
        kind = i % 4
        text = {0: f"please call +1 {number} today", 1: f"the sum of {rng.randint(1, 9)}.{rng.randint(0, 9)} and more", 2: "nothing here",
                3: f"order {rng.randint(10**7, 10**8)} of stock"}[kind]
        rows.append((i, text))
    rows += [(10_000, "please call 1 (212) 555-0123 today"), (10_001, None), (10_002, ""), (None, "a@b.de"), (10_003, "1" * 50_000)]
    table = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS spans", "1 AS n_ip")
    got = {r.doc_id: r for r in pii.find(table).collect()}
    assert got[10_000].n_phone == 0 and got[10_000].spans.startswith("phone:12:")  # no plus sign, same shape and company
    misses = [r for i, r in got.items() if i is not None and i < 3000 and i % 4 in (1, 2, 3) and r.spans]
    assert not misses
    assert got[None].spans == "email:0:6" and got[10_001].spans == "" and got[10_003].spans == ""
    assert pii.find(table.limit(0)).count() == 0


def test_other_forms_of_certain_spans_are_added(spark):
    rng = random.Random(12)
    rows, added = [], set()
    for i in range(4000):
        name, number = f"{rng.choice('kim lee ana ben'.split())}{rng.randint(1, 99)}", f"({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
        other = rng.random() < 0.3  # far more than 5% of the true ones have no base form
        text = {
            0: f"please mail {name}{' (at) ' if other else '@'}example{' (dot) ' if other else '.'}com today",
            1: f"please call {'' if other else '+'}1 {number} today", 2: f"order {rng.randint(10**7, 10**8)} of stock",
            3: f"we met at noon at {rng.choice('north south east west'.split())}.side in town",
        }[i % 4]
        rows.append((i, text))
        if other and i % 4 < 2:
            added.add(i)
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i for i, r in got.items() if r.spans and r.n_email + r.n_phone == 0} == added
    assert all(got[i].spans.startswith(("email:12:", "phone:12:")) for i in added)


def test_calibration_takes_uncovered_proposals_as_unlabelled():
    assert pii.calibrated([(9, 300, 200), (-9, 0, 5000)]) == 9  # two of five look-alikes without a label
    assert pii.calibrated([(9, 19, 0)]) == float("inf")


def test_proposals_stay_linear():
    for text in ("1" * 50_000, "1." * 30_000, "a@" * 30_000, "1 " * 30_000, "at " * 30_000, "x@y." * 20_000, "1.1.1.1" * 8_000):
        pii.all_spans(text, pii.base_spans(text), None)
        pii.proposals(text)
