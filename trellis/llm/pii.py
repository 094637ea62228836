"""Personal data: fixed patterns, and further spans that boosted trees select from generous candidates.

The base spans follow exact rules and always stand. Beside them generators propose anything shaped
like an address, a network address, a card or a telephone number, written with other marks, spelled-out signs or failing
a check; proposals may overlap. Gradient-boosted trees, fitted on a bounded sample of documents, judge each proposal by
its shape and the text around it. They tell the proposals that cover a base span from all others, which are unlabelled and not
negative: true ones may be among them. Only a proposal that fails what every true form must pass (check digit, number range, number of
digits), or that covers a base span of another kind, is known to be wrong: it is learned as such, left out of the calibration and never
selected. What sets a base form apart from its other forms (signs and separators, plus sign) is withheld from the features, so a true
proposal in another form scores as the certain ones do. Each kind's threshold is calibrated
on all documents not learned from, by counts of scores: as many unlabelled ones are taken to be true at a score as the covering
ones there let expect (Elkan and Noto), and from the threshold on that is ``PRECISION`` of them. Of overlapping selected ones the best stays.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trellis.llm.common import body, text_chunks

PARTS = 1 << 62
KINDS = ("email", "ip", "card", "phone")
SAMPLE = 8_000  # documents learned from, about
LEAST_PROPOSALS = 100
PRECISION = 0.95
LEAST_CONFIDENT = 20  # certain proposals, not learned from, that a threshold must rest on
LEVELS = 4  # of scores, per unit of log odds
TREES, DEPTH, RATE, BINS = 40, 3, 0.2, 32

# Base rules. Equivalent to their plain forms (see ``base_spans``), but linear on long runs.
EMAIL_RIGHT = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
MAYBE = re.compile(r"[0-9@]")

# Generators.
AT = re.compile(r"[@＠]|\s?[(\[{<]\s?at\s?[)\]}>]\s?|\sat\s", re.IGNORECASE)
AT_LEFT = re.compile(r"[\w.%+-]{1,64}$")
AT_RIGHT = re.compile(r"[\w-]{1,63}(?:(?:\.|\s?[(\[{<]\s?dot\s?[)\]}>]\s?|\sdot\s)[\w-]{1,63})+", re.IGNORECASE)
DOT = re.compile(r"\s?[(\[{<]\s?dot\s?[)\]}>]\s?|\sdot\s", re.IGNORECASE)
WIDE = {
    "ip": re.compile(r"(?<![0-9])[0-9]{1,4}+(?:[.,:_-][0-9]{1,4}+){3,7}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9](?:[ ./_-]?[0-9]){11,18}+(?![0-9])"),
    "phone": re.compile(r"(?<![\w+])(?:\+|00)?[0-9(](?:[ ()./-]{0,2}[0-9]){6,15}+(?![0-9])"),
}
CUES = {
    "email": ("mail", "contact", "write", "correo", "schreib"), "ip": ("ip", "host", "server", "addr", "network"),
    "card": ("card", "visa", "pay", "karte", "carte", "tarjeta"), "phone": ("tel", "phone", "call", "fax", "mobil", "llam", "appel"),
}
LEFT_CONTEXT = 24


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base rules, leftmost and non-overlapping within a kind, failing ones dropped:

    email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``; ip four dotted numbers to 255; card digits with single
    blanks or hyphens, 12 to 19 of them with a valid check digit; phone ``\\+[0-9][\\x20().0-9-]+[0-9]`` with 9 to 15 digits."""
    if not MAYBE.search(text):
        return []
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        right = EMAIL_RIGHT.match(text, at + 1) if start < at else None
        if right:
            end = right.end()
            found.append((start, "email", end))
        at = text.find("@", max(at + 1, end))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            found.append((m.start(), "ip", m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), "card", m.end()))
    for m in PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            found.append((m.start(), "phone", m.end()))
    return in_order(found)


def in_order(spans: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def proposals(text: str) -> list[tuple[int, str, int]]:
    found = []
    for m in AT.finditer(text):
        left = AT_LEFT.search(text, max(0, m.start() - 64), m.start())
        right = AT_RIGHT.match(text, m.end()) if left else None
        if right:
            found.append((left.start(), "email", right.end()))
    if MAYBE.search(text):
        for kind, pattern in WIDE.items():
            found.extend((m.start(), kind, m.end()) for m in pattern.finditer(text))
    return in_order(found)


def one_form(piece: str, kind: str) -> str:
    """The piece in the one form that all its forms share: plain signs in an address, groups of digits between single blanks."""
    if kind == "email":
        at = AT.search(piece)
        return f"{piece[:at.start()]}@{DOT.sub('.', piece[at.end():])}" if at else piece
    groups = " ".join(re.findall(r"\d+", piece))
    return groups.removeprefix("00").lstrip() if kind == "phone" else groups


def impossible(piece: str, kind: str) -> bool:
    """Whether the piece fails a check that every true form of its kind passes: check digit, range or number of digits."""
    if kind == "email":
        return False
    groups = ["".join(str(int(c)) for c in g) for g in re.findall(r"\d+", one_form(piece, kind))]
    digits = "".join(groups)
    if kind == "card":
        return not (12 <= len(digits) <= 19 and luhn(digits))
    if kind == "ip":
        return len(groups) != 4 or any(len(g.lstrip("0")) > 3 or int(g) > 255 for g in groups)
    return not 9 <= len(digits) <= 15


def features(text: str, span: tuple[int, str, int]) -> list[float]:
    """Shape and context; without what sets a base form apart from its other forms."""
    start, kind, end = span
    piece = one_form(text[start:end], kind)
    digits = sum(c.isdigit() for c in piece)
    groups = [len(g) for g in re.findall(r"\d+", piece)]
    before, after = text[max(0, start - LEFT_CONTEXT):start], text[end:end + LEFT_CONTEXT]
    near, here = before.lower(), before[-1:]
    return [
        len(piece), digits, digits / max(1, len(piece)), len(groups), max(groups, default=0), min(groups, default=0), groups[-1] if groups else 0,
        piece.count("."), piece.count("-"), sum(c.isalpha() for c in piece), len(set(piece)),
        float(here.isalnum()), float(here.isspace()), float(bool(here) and not here.isalnum() and not here.isspace()),
        float(after[:1].isalnum()), float(after[:1].isspace()), sum(c.isalpha() for c in before), sum(c.isdigit() for c in before),
        sum(c.isalpha() for c in after), sum(c.isdigit() for c in after), float(any(cue in near for cue in CUES[kind])),
        float(start == 0 or "\n" in before), float(piece[:1] == "0"), float(KINDS.index(kind)),
    ]


class Taken:
    """Spans that do not overlap within a kind, to be asked whether another would."""

    def __init__(self, spans: list[tuple[int, str, int]]):
        self.starts: dict[str, list[int]] = {kind: [] for kind in KINDS}
        self.ends: dict[str, list[int]] = {kind: [] for kind in KINDS}
        for start, kind, end in spans:
            self.starts[kind].append(start)
            self.ends[kind].append(end)

    def overlaps(self, span: tuple[int, str, int]) -> bool:
        start, kind, end = span
        i = bisect_left(self.starts[kind], end)  # the last that starts before the end
        return i > 0 and self.ends[kind][i - 1] > start

    def overlaps_any(self, span: tuple[int, str, int]) -> bool:
        return any(self.overlaps((span[0], kind, span[2])) for kind in KINDS)

    def add(self, span: tuple[int, str, int]) -> None:
        start, kind, end = span
        i = bisect_left(self.starts[kind], start)
        self.starts[kind].insert(i, start)
        self.ends[kind].insert(i, end)


class Boosted:
    """Gradient-boosted regression trees for the logistic loss, on binned features."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
        self.bias = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
        self.trees: list[list[tuple]] = []
        bins, z = self._bins(x), np.full(len(y), self.bias)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-z))
            z += self._grow(bins, y - p, p * (1 - p))

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, column, side="left") for e, column in zip(self.edges, x.T)], axis=1)

    def _grow(self, bins: np.ndarray, slope: np.ndarray, curve: np.ndarray) -> np.ndarray:
        """One tree, as rows (feature, bin, value) by heap position; inner nodes have no value, leaves no feature."""
        tree: list[tuple] = [(-1, 0, 0.0)] * (2 ** (DEPTH + 1))
        node, out = np.ones(len(slope), dtype=np.int64), np.zeros(len(slope))
        for position in range(1, 2 ** (DEPTH + 1)):
            own = np.flatnonzero(node == position)
            if not len(own):
                continue
            g, h = slope[own], curve[own]
            total_g, total_h = g.sum(), h.sum()
            best = (1e-3, -1, 0)
            for feature in range(bins.shape[1]) if position < 2 ** DEPTH and len(own) >= 20 else ():
                left_g = np.cumsum(np.bincount(bins[own, feature], g, BINS))[:-1]
                left_h = np.cumsum(np.bincount(bins[own, feature], h, BINS))[:-1]
                gain = left_g**2 / (left_h + 1) + (total_g - left_g) ** 2 / (total_h - left_h + 1) - total_g**2 / (total_h + 1)
                cut = int(np.argmax(gain))
                if gain[cut] > best[0]:
                    best = (float(gain[cut]), feature, cut)
            if best[1] < 0:
                tree[position] = (-1, 0, RATE * float(total_g / (total_h + 1)))
                out[own] = tree[position][2]
                node[own] = 0
            else:
                tree[position] = (best[1], best[2], 0.0)
                node[own] = 2 * position + (bins[own, best[1]] > best[2])
        self.trees.append(tree)
        return out

    def __call__(self, x: np.ndarray) -> np.ndarray:
        bins, z = self._bins(x), np.full(len(x), self.bias)
        for tree in self.trees:
            feature, cut, value = (np.array(c) for c in zip(*tree))
            node = np.ones(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                inner = feature[node] >= 0
                right = bins[np.arange(len(x)), np.maximum(feature[node], 0)] > cut[node]
                node = np.where(inner, 2 * node + right, node)
            z += value[node]
        return 1 / (1 + np.exp(-z))


def _proposed(text: str) -> tuple[list[list[float]], list[int]]:
    """Features of the text's proposals, and what is known of them: 1 covers a base span of its kind, -1 fails a check or covers one of
    another kind only, 0 is unlabelled."""
    spans, found = base_spans(text), proposals(text)
    base = Taken(spans)

    def known(span: tuple[int, str, int]) -> int:
        if base.overlaps(span):
            return 1
        return -1 if impossible(text[span[0]:span[2]], span[1]) or base.overlaps_any(span) else 0

    return [features(text, s) for s in found], [known(s) for s in found]


def _sampled(docs: DataFrame, learned: Column) -> np.ndarray:
    """Rows of features and label of the proposals in the documents to learn from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text"):
            rows = []
            for text in batch.column(0).to_pylist():
                rows.extend([*x, float(y > 0)] for x, y in zip(*_proposed(text)))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64()))], names=["row"])

    sample = docs.filter(learned).select("text")
    return np.array(sorted(r["row"] for r in sample.mapInArrow(run, "row array<double>").collect()))


def level(scores: np.ndarray) -> np.ndarray:
    """Scores in steps of their log odds."""
    clipped = np.clip(scores, 1e-9, 1 - 1e-9)
    return np.floor(LEVELS * np.log(clipped / (1 - clipped))).astype(np.int64)


def _counted(docs: DataFrame, learned: Column, trees: Boosted) -> dict[int, list[tuple[int, int, int]]]:
    """By kind ``(level, certain, unlabelled)``, counted over all documents not learned from."""
    model = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text"):
            counts: Counter = Counter()
            for text in batch.column(0).to_pylist():
                x, known = _proposed(text)
                if x:
                    levels = level(model.value(np.array(x))).tolist()
                    counts.update((int(row[-1]), at, label > 0) for row, at, label in zip(x, levels, known) if label >= 0)
            columns = list(zip(*[(*key, n) for key, n in counts.items()])) or [(), (), (), ()]
            types = (pa.int64(), pa.int64(), pa.bool_(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["kind", "level", "certain", "n"])

    found = docs.filter(~learned).select("text").mapInArrow(run, "kind long, level long, certain boolean, n long")
    both = found.groupBy("kind", "level").agg(
        F.coalesce(F.sum(F.when(F.col("certain"), F.col("n"))), F.lit(0)).alias("certain"),
        F.coalesce(F.sum(F.when(~F.col("certain"), F.col("n"))), F.lit(0)).alias("unlabelled"),
    )
    counts: dict[int, list[tuple[int, int, int]]] = {k: [] for k in range(len(KINDS))}
    for row in both.collect():  # a few dozen levels
        counts[row["kind"]].append((row["level"], row["certain"], row["unlabelled"]))
    return counts


def learned_from(rows: int, most: int = SAMPLE) -> Column:
    """Whether a document is one of about ``3/4 * most``, at any number of rows: its hash lies in a share of 2^62 parts."""
    by_id = F.xxhash64("doc_id").bitwiseAND(F.lit(PARTS - 1))
    return (by_id < F.lit(int(PARTS * min(1.0, most / max(1, rows))))) & (by_id % 4 != 0)


def fit(docs: DataFrame, most: int = SAMPLE) -> tuple[Boosted, list[float]] | None:
    """The trees and the least level of each kind; none if the sample has too little to learn from."""
    learned = learned_from(docs.count(), most)
    rows = _sampled(docs, learned)
    if len(rows) < LEAST_PROPOSALS:
        return None
    x, y = rows[:, :-1], rows[:, -1]
    if not 0 < y.sum() < len(y):
        return None
    trees = Boosted(x, y)
    counts = _counted(docs, learned, trees)
    return trees, [calibrated(counts[k]) for k in range(len(KINDS))]


def calibrated(counts: list[tuple[int, int, int]]) -> float:
    """The lowest level from which on ``PRECISION`` of the unlabelled proposals are true by estimate; else infinite.

    ``counts`` are ``(level, certain, unlabelled)``. The share of certain ones among all true ones is the mean, over the certain, of
    their share at their level; it gives how many true ones stand unlabelled for each certain one."""
    certain = sum(p for _, p, _ in counts)
    if certain < LEAST_CONFIDENT:
        return math.inf
    share = sum(p * p / (p + u) for _, p, u in counts if p) / certain
    least, above, others = math.inf, 0, 0
    for at, p, u in sorted(counts, reverse=True):
        above, others = above + p, others + u
        if above >= LEAST_CONFIDENT and (1 - share) / share * above >= PRECISION * others * (1 - 1e-9):
            least = at
    return least


def all_spans(text: str, base: list[tuple[int, str, int]], model: tuple[Boosted, list[float]] | None) -> list[tuple[int, str, int]]:
    """The base spans and the selected proposals that overlap no base span, nor a better one of their kind."""
    taken = Taken(base)
    new = [s for s in proposals(text) if not taken.overlaps_any(s) and not impossible(text[s[0]:s[2]], s[1])] if model else []
    if not new:
        return base
    trees, least = model
    scores = trees(np.array([features(text, s) for s in new]))
    levels = level(scores)
    chosen = list(base)
    for i in sorted(range(len(new)), key=lambda i: (-scores[i], new[i][0], KINDS.index(new[i][1]))):
        if levels[i] >= least[KINDS.index(new[i][1])] and not taken.overlaps(new[i]):
            taken.add(new[i])
            chosen.append(new[i])
    return in_order(chosen)


def written(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def find(docs: DataFrame, id: str = "doc_id", text: str = "text", most: int = SAMPLE) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` for every row: counts and digest of the base spans,
    and all spans as ``kind:start:end``, in code points with the end exclusive.

    Null and empty texts have no spans; repeated rows are searched each; other columns are not read; an empty table gives no
    rows. Whole texts are searched, without a shuffle; the model is a few kilobytes."""
    rows = docs.select(F.col(id).alias("doc_id"), body(F.col(text)).alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(fit(rows, most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text"):
            texts = batch.column(1).to_pylist()
            base = [base_spans(t) for t in texts]
            counts = [pa.array([sum(s[1] == kind for s in b) for b in base], pa.int64()) for kind in KINDS]
            digests = pa.array([hashlib.sha256(written(b).encode()).hexdigest() for b in base])
            spans = pa.array([written(all_spans(t, b, model.value)) for t, b in zip(texts, base)], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, digests, spans], names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")
