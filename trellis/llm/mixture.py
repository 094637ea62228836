"""Language-model scores by online logistic mixing of hashed-context bit predictors.

A text is a sequence of words, ASCII letters lower-cased, and one end mark. A word and a blank behind it are coded bit by bit, the
highest bit of each byte first. Each predictor looks up how often the next bit was 0 and 1 in its context: the last one to
four bytes of the word, all its bytes so far, and for its first three bytes these with a class of the word before, for others the last
six. Contexts are hashed into ``2 ** SLOT_BITS`` pairs of counts
per predictor. The logarithms of the odds are combined by weights that a gate selects, by how often the whole
word so far was seen and by the half of the byte, and the result is refined by a table of what really followed such a prediction.

What is asked of a word's head depends on the head and the class before it, and what is asked of its tail on the word only, so the corpus
is first gathered into one row per different word with its counts by class; learning and scoring run over these rows, each weighing
as often as it stands in the corpus.

1. Counts of words by class of the word before, over all documents learned from (combined per task, then shuffled).
2. Predictors: every task counts bits for its words; the tables of all tasks are added up block by block.
3. Mixing weights: every task goes over its words in small steps, each predicting before it adapts the weights, with the word's
   own last occurrence taken out of the counts; the tasks' weights are averaged by their bits. The refinement is counted meanwhile.
4. Every word's log-probability by class, and the sum over each document. Words that make up more than ``SHARE`` of all training
   tokens, of which there are fewer than ``1 / SHARE``, are looked up in place; the tokens of the others are joined by word, and no such
   word can be a hot key.

The model has a fixed size (the slots and some weights) and is the only thing broadcast besides the frequent words.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trellis.llm.common import body, text_chunks
from trellis.llm.periodic import split_words
from trellis.session import Scratch

ORDERS = (1, 2, 3, 4)
LONGEST = 6  # the bytes of the longest context in a word's tail
HEAD = 3  # bytes of a word that are predicted from the class of the word before, too
PREDICTORS = len(ORDERS) + 2
SLOT_BITS = (16, 18, 19, 20, 21, 21)  # by predictor: contexts of few bytes have fewer values
STARTS = [0, *itertools.accumulate(1 << b for b in SLOT_BITS)]  # where each predictor's slots begin; their number
CLASSES = 9  # the start of a text, and eight classes of a word by its last two bytes
SHARE = 1e-6
END = "\n"  # no word holds it
PRIOR = 0.4  # added to both counts of a context
STEP = 1 << 13  # bytes between two changes of the weights
KEEP = 0.98  # how much of the curvature seen so far a step keeps
LEVELS = 33  # steps of the refinement between odds of e^-8 and e^8
REACH = 8.0
TRUST = 64.0  # bits after which the refinement counts as much as the prediction it refines
FLOOR = 1e-7
CHUNK = 10 << 20  # bytes of text held at a time
WORDS_PER_TASK = 500_000
BLOCK_BITS = 14
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)
_B_BACK = np.uint64(pow(int(_B), -1, 1 << 64))
WHOLE = len(ORDERS)  # the predictor whose context is the whole word so far
GATES = 16 * 2
COUNTS = [f"n{i}" for i in range(CLASSES)]
LOGS = [f"p{i}" for i in range(CLASSES)]


def held_out(id: Column) -> Column:
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


class Tokens:
    """The tokens of some texts: number in the list of different words, class of the word before, and text of each."""

    def __init__(self, texts: pa.Array):
        bounds, words = split_words(texts)
        # Lower-cased after the split: pyarrow's ascii_lower misreads slices of a larger array.
        listed = pc.ascii_lower(words).dictionary_encode()
        self.words = pa.concat_arrays([listed.dictionary, pa.array([END], pa.large_string())])
        lengths = np.diff(bounds)
        n, at = len(words), np.arange(len(words)) + np.repeat(np.arange(len(lengths)), lengths)
        self.word = np.full(n + len(lengths), len(listed.dictionary), dtype=np.int64)
        self.word[at] = listed.indices.to_numpy()
        self.text = np.repeat(np.arange(len(lengths)), lengths + 1)
        own = classes_of(self.words)
        before = np.zeros(len(self.word), dtype=np.int64)
        before[1:] = own[self.word[:-1]]
        before[bounds[:-1] + np.arange(len(lengths))] = 0
        self.before = before
        self.n_texts = len(lengths)

    def per_text(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.text, values, self.n_texts)


def _bytes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of large strings, and where each begins (and the last one ends)."""
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64, count=len(words) + 1, offset=8 * words.offset)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[ends[0]:ends[-1]], ends - ends[0]


def classes_of(words: pa.Array) -> np.ndarray:
    raw, ends = _bytes_of(words)
    last = raw[ends[1:] - 1].astype(np.uint64)
    second = np.where(np.diff(ends) > 1, raw[np.maximum(ends[1:] - 2, 0)], 0).astype(np.uint64)
    return 1 + (((last * np.uint64(256) + second + np.uint64(1)) * _A) >> np.uint64(61)).astype(np.int64)


def word_counts(docs: DataFrame, text: str, learned: Column, scratch: Scratch) -> DataFrame:
    """``word, n0, n1, ..., used``: how often each word stands behind each class in the texts learned from, and a bit for every class
    that it stands behind in any text. The end mark is a word."""
    rows = docs.select(learned.alias("learned"), body(F.col(text)).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text", CHUNK):
            tokens = Tokens(batch.column(1))
            cell, size = tokens.word * CLASSES + tokens.before, len(tokens.words) * CLASSES
            used = np.bincount(cell, minlength=size).reshape(-1, CLASSES) > 0
            learned = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
            counts = np.bincount(cell[learned[tokens.text]], minlength=size).reshape(-1, CLASSES)
            masks = used @ (1 << np.arange(CLASSES))
            yield pa.RecordBatch.from_arrays(
                [tokens.words.cast(pa.string()), *[pa.array(counts[:, i]) for i in range(CLASSES)], pa.array(masks, pa.int64())],
                names=["word", *COUNTS, "used"],
            )

    found = rows.mapInArrow(run, "word string, " + ", ".join(f"{c} long" for c in COUNTS) + ", used long")
    found = found.groupBy("word").agg(*[F.sum(c).alias(c) for c in COUNTS], F.bit_or("used").alias("used"))
    # In one order however the rows came, since the mixing weights depend on it.
    return scratch.put(found.sortWithinPartitions(F.xxhash64("word"), "word"), "words")


class Bits:
    """The bits of byte strings from place ``low`` on: for each predictor the slot of its counts, the bit itself, the bits of its byte
    before it, and whose it is. ``classes``: of the word before, where the strings are heads of words."""

    def __init__(self, value: np.ndarray, lengths: np.ndarray, low: int, classes: np.ndarray | None):
        starts = np.cumsum(lengths) - lengths
        unit = np.repeat(np.arange(len(lengths)), lengths)
        place = np.arange(len(value)) - starts[unit]
        value = value.astype(np.uint64)
        wanted = np.flatnonzero(place >= low)
        contexts, key = [], np.zeros(len(value), dtype=np.uint64)
        for order in range(1, LONGEST + 1):
            before = np.zeros(len(value), dtype=np.uint64)
            before[order:] = value[:-order]
            key = key * np.uint64(257) + np.where(place >= order, before + np.uint64(1), np.uint64(0))
            if order in ORDERS:
                contexts.append(key[wanted] + np.uint64(order << 56))
        # All bytes so far: sums of byte times power, brought to the word's start by the inverse power.
        power = np.cumprod(np.concatenate(([np.uint64(1)], np.full(max(len(value) - 1, 0), _B))))
        total = np.concatenate(([np.uint64(0)], np.cumsum((value + np.uint64(1)) * power)))
        back = np.cumprod(np.concatenate(([np.uint64(1)], np.full(max(len(value) - 1, 0), _B_BACK))))[starts]
        prefix = ((total[:-1] - total[starts][unit]) * back[unit])[wanted]
        prefix ^= prefix >> np.uint64(31)
        contexts.append(prefix + np.uint64(9 << 56))
        contexts.append(key[wanted] + np.uint64(10 << 56) if classes is None else prefix * _C + classes.astype(np.uint64)[unit[wanted]] + np.uint64(11 << 56))
        value = value[wanted]
        # The half bytes of a context have 16 slots side by side: one reading of memory serves four bits.
        upper = value >> np.uint64(4)
        sides = (np.uint64(1), upper + np.uint64(17))
        shift = np.arange(4, dtype=np.uint64)
        halves = np.stack((upper, value & np.uint64(15)), axis=1)[:, :, None] | np.uint64(16)
        within = (halves >> (np.uint64(4) - shift)).astype(np.int64)
        self.bit = ((halves >> (np.uint64(3) - shift)) & np.uint64(1)).astype(np.int64).ravel()
        self.node = ((value[:, None] | np.uint64(256)) >> (np.uint64(8) - np.arange(8, dtype=np.uint64))).astype(np.int64).ravel()
        self.unit = np.repeat(unit[wanted], 8)
        self.slots = []
        for context, first, bits in zip(contexts, STARTS, SLOT_BITS):
            context = context * _A
            context ^= context >> np.uint64(29)
            group = np.stack([((context + side * _C) * _B) >> np.uint64(64 - bits + 4) for side in sides], axis=1).astype(np.int64)
            self.slots.append((group[:, :, None] * 16 + within + first).ravel())


class Words:
    """A batch of ``word, n0, ..., used`` as byte strings with a blank at the end, and their heads."""

    def __init__(self, batch: pa.RecordBatch):
        raw, ends = _bytes_of(batch.column(0).cast(pa.large_string()))
        self.lengths = np.diff(ends) + 1
        self.ends = np.concatenate(([0], np.cumsum(self.lengths)))
        self.value = np.full(self.ends[-1], 32, dtype=np.uint8)
        self.value[np.arange(len(raw)) + np.repeat(np.arange(len(self.lengths)), self.lengths - 1)] = raw
        self.counts = np.stack([batch.column(1 + i).to_numpy() for i in range(CLASSES)], axis=1)
        self.total = self.counts.sum(axis=1)
        self.used = (batch.column(1 + CLASSES).to_numpy()[:, None] >> np.arange(CLASSES)) & 1
        self.head = np.zeros(len(self.lengths), dtype=np.int64)  # nine bits a byte, zero where there is none
        for i in range(HEAD):
            own = self.value[np.minimum(self.ends[:-1] + i, self.ends[-1] - 1)].astype(np.int64) + 1
            self.head = self.head * 512 + np.where(self.lengths > i, own, 0)

    def tails(self, learned: bool, most: int) -> Iterator[tuple[np.ndarray, Bits]]:
        """Rows and bits behind the heads, some ``most`` bytes at a time: of words learned from, or of all."""
        rows = np.flatnonzero((self.lengths > HEAD) & ((self.total > 0) | (not learned)))
        filled = np.cumsum(self.lengths[rows])
        at = 0
        while at < len(rows):
            stop = max(at + 1, int(np.searchsorted(filled, (filled[at - 1] if at else 0) + most, side="right")))
            own = rows[at:stop]
            sizes = self.lengths[own]
            place = np.arange(sizes.sum()) + np.repeat(self.ends[own] - (np.cumsum(sizes) - sizes), sizes)
            yield own, Bits(self.value[place], sizes, HEAD, None)
            at = stop

    def heads(self, learned: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, Bits]:
        """Row and class of the cells learned from, or used; for each the number of its different head and class, and their bits."""
        row, kind = np.nonzero(self.counts if learned else self.used)
        different, number = np.unique(self.head[row] * 16 + kind, return_inverse=True)
        digits = np.stack([(different >> (4 + 9 * (HEAD - 1 - i))) & 511 for i in range(HEAD)], axis=1)
        return row, kind, number, Bits((digits[digits > 0] - 1).astype(np.uint8), (digits > 0).sum(axis=1), 0, different & 15)


def predictors(words: DataFrame, scratch: Scratch) -> np.ndarray:
    """Counts of zeros and ones by slot, all predictors' slots in one table."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(2 * STARTS[-1])

        def add(bits: Bits, times: np.ndarray) -> None:
            weight = times[bits.unit]
            for slots in bits.slots:
                np.add.at(table, 2 * slots + bits.bit, weight)

        for batch in batches:
            words = Words(batch)
            for rows, bits in words.tails(True, STEP):
                add(bits, words.total[rows].astype(float))
            row, kind, number, bits = words.heads(True)
            add(bits, np.bincount(number, words.counts[row, kind]))
        for number, block in enumerate(table.reshape(-1, 2 << BLOCK_BITS)):
            if block.any():
                yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([block.astype(np.float32).tobytes()], pa.binary())], names=["block", "counts"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, total = None, None

        def done():
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([total.astype(np.float32).tobytes()], pa.binary())], names=["block", "counts"])

        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                if block != number:
                    if number is not None:
                        yield done()
                    number, total = block, np.zeros(2 << BLOCK_BITS)
                total += np.frombuffer(counts.as_buffer(), dtype=np.float32)
        if number is not None:
            yield done()

    own = words.mapInArrow(count, "block long, counts binary")
    summed = own.repartition("block").sortWithinPartitions("block").mapInArrow(add_up, "block long, counts binary")
    table = np.zeros((STARTS[-1] >> BLOCK_BITS, 2 << BLOCK_BITS), dtype=np.float32)
    for row in scratch.put(summed, "predictors").collect():  # a model of fixed size
        table[row["block"]] = np.frombuffer(row["counts"], dtype=np.float32)
    return table.reshape(-1, 2)


def odds_of(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return np.log((n1 + np.float32(PRIOR)) / (n0 + np.float32(PRIOR))).astype(np.float16)


def trust_of(table: np.ndarray, less: int) -> np.ndarray:
    """For the slots of the whole-word predictor: the binary logarithm of what they count, rounded, ``less`` taken out before."""
    n = np.maximum(table[STARTS[WHOLE]:STARTS[WHOLE + 1]].sum(axis=1) - less, 0)
    return np.minimum(np.ceil(np.log2(n + 1)), 15).astype(np.uint8)


def odds_without_one(table: np.ndarray) -> np.ndarray:
    """For both bits of every slot: the odds when one such bit is taken out of the counts."""
    n0, n1 = table[:, 0], table[:, 1]
    return np.stack((odds_of(np.maximum(n0 - 1, 0), n1), odds_of(n0, np.maximum(n1 - 1, 0))), axis=1).ravel()


class Inputs:
    """Bits in the order of their gates: for each, the logarithms of the odds by predictor and a constant. ``known``: ``table`` has
    the odds without the bit itself, for bits learned from."""

    def __init__(self, table: np.ndarray, trust: np.ndarray, bits: Bits, known: bool):
        n = len(bits.bit)
        odds = np.ones((PREDICTORS + 1, n), dtype=np.float32)
        for i, slots in enumerate(bits.slots):
            odds[i] = table[2 * slots + bits.bit if known else slots]
        half = np.tile(np.repeat(np.arange(2, dtype=np.uint8), 4), n // 8)
        gate = trust[bits.slots[WHOLE] - STARTS[WHOLE]] * np.uint8(2) + half
        order = np.argsort(gate, kind="stable")
        self.odds, self.bit, self.unit, self.node = np.take(odds, order, axis=1), bits.bit[order], bits.unit[order], bits.node[order]
        ends = np.concatenate(([0], np.cumsum(np.bincount(gate, minlength=GATES))))
        self.gates = [(g, slice(int(ends[g]), int(ends[g + 1]))) for g in range(GATES) if ends[g] < ends[g + 1]]

    def mixed(self, weights: np.ndarray) -> np.ndarray:
        total = np.empty(len(self.bit), dtype=np.float32)
        for g, own in self.gates:
            total[own] = weights[g].astype(np.float32) @ self.odds[:, own]
        return np.clip(total, -16, 16)


def _level(total: np.ndarray, node: np.ndarray) -> np.ndarray:
    """The cell of the refinement: the bits of the byte so far, and the rounded prediction."""
    steps = np.rint((np.clip(total, -REACH, REACH) + np.float32(REACH)) * np.float32((LEVELS - 1) / (2 * REACH))).astype(np.int64)
    return node.astype(np.int64) * LEVELS + steps


def first_weights() -> np.ndarray:
    weights = np.full((GATES, PREDICTORS + 1), 1.0 / PREDICTORS)
    weights[:, -1] = 0
    return weights


def mixing(words: DataFrame, table: np.ndarray, scratch: Scratch) -> tuple[np.ndarray, np.ndarray]:
    """The mixing weights (gates x inputs), and the refinement's counts of zeros and ones.

    A step moves a gate's weights by the gradient of its bits, scaled by the inverse of their curvature, which fades from step to step."""
    held = words.sparkSession.sparkContext.broadcast((odds_without_one(table), trust_of(table, 1)))
    cells, width = 256 * LEVELS, PREDICTORS + 1

    def adapt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, mass = first_weights(), np.zeros(GATES)
        curve = np.tile(np.eye(width), (GATES, 1, 1))
        follow = np.zeros(2 * cells)

        def step(bits: Bits, counts: np.ndarray) -> None:
            seen = Inputs(*held.value, bits, known=True)
            times = counts.astype(np.float32)[seen.unit]
            total = seen.mixed(weights)
            p = 1 / (1 + np.exp(-total))
            error, soft = times * (seen.bit - p), times * p * (1 - p)
            for g, own in seen.gates:
                x = seen.odds[:, own]
                curve[g] = KEEP * curve[g] + (x * soft[own]) @ x.T
                weights[g] += np.linalg.solve(curve[g] + np.eye(width), x @ error[own])
                mass[g] += times[own].sum(dtype=float)
            follow[:] += np.bincount(2 * _level(total, seen.node) + seen.bit, times, 2 * cells)

        for batch in batches:
            words = Words(batch)
            for rows, bits in words.tails(True, STEP):
                step(bits, words.total[rows])
            row, kind, number, bits = words.heads(True)
            step(bits, np.bincount(number, words.counts[row, kind]))
        sums = np.concatenate(((weights * mass[:, None]).ravel(), mass, follow))
        filled = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(filled), pa.array(sums[filled])], names=["place", "value"])

    found = words.mapInArrow(adapt, "place long, value double").groupBy("place").agg(F.sum("value").alias("value"))
    sums = np.zeros((width + 1) * GATES + 2 * cells)
    for row in scratch.put(found, "mixing").collect():  # a model of fixed size
        sums[row["place"]] = row["value"]
    held.unpersist()
    inner = width * GATES
    mass = sums[inner:inner + GATES, None]
    weights = np.where(mass > 0, sums[:inner].reshape(GATES, width) / np.maximum(mass, 1e-300), first_weights())
    return weights, sums[inner + GATES:].reshape(-1, 2)


class Model:
    def __init__(self, table: np.ndarray, weights: np.ndarray, follow: np.ndarray):
        self.table, self.trust, self.weights = odds_of(table[:, 0], table[:, 1]), trust_of(table, 0), weights
        middle = np.linspace(-REACH, REACH, LEVELS)
        prior = np.tile(1 / (1 + np.exp(-middle)), len(follow) // LEVELS)
        self.refined = (follow[:, 1] + TRUST * prior) / (follow.sum(axis=1) + TRUST)

    def logs(self, bits: Bits, n_units: int) -> np.ndarray:
        """log10 of each unit's probability."""
        seen = Inputs(self.table, self.trust, bits, known=False)
        total = seen.mixed(self.weights)
        p = (1 / (1 + np.exp(-total)) + self.refined[_level(total, seen.node)]) / 2
        p = np.clip(np.where(seen.bit == 1, p, 1 - p), FLOOR, 1 - FLOOR)
        return np.bincount(seen.unit, np.log10(p), n_units)


def word_scores(words: DataFrame, model: Model, scratch: Scratch) -> DataFrame:
    """``word, c, p0, p1, ...``: the training count of every word, and its log10 probability behind each class where it is used."""
    held = words.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, tail = Words(batch), np.zeros(batch.num_rows)
            for rows, bits in words.tails(False, STEP):
                tail[rows] = held.value.logs(bits, len(rows))
            row, kind, number, bits = words.heads(False)
            logs = np.zeros((batch.num_rows, CLASSES), dtype=np.float32)
            logs[row, kind] = held.value.logs(bits, bits.unit[-1] + 1)[number] + tail[row]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words.total), *[pa.array(logs[:, i]) for i in range(CLASSES)]], names=["word", "c", *LOGS])

    found = scratch.put(words.mapInArrow(run, "word string, c long, " + ", ".join(f"{p} float" for p in LOGS)), "scores")
    held.unpersist()
    return found


def _summed(docs: DataFrame, id: str, text: str, scores: DataFrame, tokens_seen: int, types_seen: int, scratch: Scratch) -> DataFrame:
    """Every document's sums: frequent words are looked up in place, the tokens of all others are joined by word."""
    frequent = scores.filter(F.col("c") > SHARE * tokens_seen).toArrow()  # under 1 / SHARE words
    table = np.stack([frequent.column(p).to_numpy() for p in LOGS], axis=1) if len(frequent) else np.zeros((0, CLASSES), dtype=np.float32)
    listed = frequent.column("word").combine_chunks().cast(pa.large_string())
    held = docs.sparkSession.sparkContext.broadcast((listed, np.append(frequent.column("c").to_numpy(), 0), np.vstack((table, np.zeros(CLASSES, dtype=np.float32)))))
    rows = docs.select(F.struct(F.col(id).alias("doc_id")).alias("row"), body(F.col(text)).alias("text"), F.monotonically_increasing_id().alias("number"))
    kind = rows.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, counts, logs = held.value
        names = ["number", "row", "word", "before", "base", "model", "n_tokens", "n_known", "bytes"]
        for batch in text_chunks(batches, "text", CHUNK):
            tokens = Tokens(batch.column(1))
            place = pc.index_in(tokens.words, value_set=listed)
            place = pc.fill_null(place, len(listed)).to_numpy(zero_copy_only=False)  # others: the last entry, zero
            own = place[tokens.word]
            count, n = counts[own], batch.num_rows
            size = np.diff(_bytes_of(tokens.words)[1])[tokens.word] + 1
            base = np.where(own < len(listed), np.log10(count + 1.0), 0.0)
            yield pa.RecordBatch.from_arrays([
                batch.column(2), batch.column(0), pa.nulls(n, pa.string()), pa.nulls(n, pa.int32()), pa.array(tokens.per_text(base)),
                pa.array(tokens.per_text(logs[own, tokens.before])), pa.array(tokens.per_text(np.ones(len(own))).astype(np.int64)),
                pa.array(tokens.per_text(count > 0).astype(np.int64)), pa.array(tokens.per_text(size).astype(np.int64)),
            ], names=names)
            other = np.flatnonzero(own == len(listed))
            for k in range(0, len(other), 1 << 17):
                part = other[k:k + (1 << 17)]
                m = len(part)
                yield pa.RecordBatch.from_arrays([
                    batch.column(2).take(pa.array(tokens.text[part])), pa.nulls(m, batch.column(0).type), tokens.words.take(pa.array(tokens.word[part])).cast(pa.string()),
                    pa.array(tokens.before[part], pa.int32()), pa.nulls(m, pa.float64()), pa.nulls(m, pa.float64()), *[pa.nulls(m, pa.int64())] * 3,
                ], names=names)

    found = rows.mapInArrow(run, f"number long, row {kind}, word string, before int, base double, model double, n_tokens long, n_known long, bytes long")
    found = scratch.put(found, "tokens")
    log = F.element_at(F.array(*LOGS), F.col("before") + 1).cast("double")
    rare = found.filter("word IS NOT NULL").select("number", "word", "before").join(scores, "word").select(
        "number", F.lit(None).cast(kind).alias("row"), F.log10(F.col("c") + F.lit(1.0)).alias("base"), log.alias("model"),
        F.lit(0).cast("long").alias("n_tokens"), (F.col("c") > 0).cast("long").alias("n_known"), F.lit(0).cast("long").alias("bytes"),
    )
    whole = found.filter("word IS NULL").select(*rare.columns).unionByName(rare)
    sums = whole.groupBy("number").agg(F.first("row", ignorenulls=True).alias("row"), *[F.sum(c).alias(c) for c in rare.columns[2:]])
    total = float(np.log10(tokens_seen + types_seen + 1.0))
    return sums.withColumn("base", F.col("base") - F.col("n_tokens") * total)


def scored(docs: DataFrame, id: str = "doc_id", text: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """For every row ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte``.

    ``score`` is the model's log10 probability of the words and the end mark, ``base_score`` that of counted words with one added.
    Null and empty texts consist of the end mark; a null id is learned from; repeated rows are learned from and scored each;
    other columns are not read; an empty table gives no rows, and if all rows are held out every bit counts as even odds."""
    scratch = scratch or Scratch(docs.sparkSession)
    words = word_counts(docs, text, ~held_out(F.col(id)), scratch)
    count = sum((F.col(c) for c in COUNTS[1:]), F.col(COUNTS[0]))
    n, types, rows = words.agg(F.coalesce(F.sum(count), F.lit(0)), F.count(F.when(count > 0, 1)), F.count("*")).first()
    dealt = words.coalesce(rows // WORDS_PER_TASK + 1)  # a task's tables have a fixed size, whatever its words
    table = predictors(dealt, scratch)
    model = Model(table, *mixing(dealt, table, scratch))
    scores = word_scores(words, model, scratch)
    sums = _summed(docs, id, text, scores, n, types, scratch)
    bits = -F.col("model") * float(np.log2(10)) / F.col("bytes")
    return sums.select(
        F.col("row.doc_id").alias("doc_id"), held_out(F.col("row.doc_id")).alias("held_out"), "n_tokens", "n_known",
        F.lit(n).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), F.col("model").alias("score"), bits.alias("bits_per_byte"),
    )
