"""Periodic runs in word sequences by online dyadic square catching.

A run of period ``q`` is a longest stretch in which every word equals the word ``q`` places on. Its words that have such
a partner form an unbroken row of at least ``max(least - q, q)`` places, and any row of ``2b - 1`` places holds a whole
block of ``b`` words that begins at a multiple of ``b``. So for every period there is a block size, a power of two, of
which some completed block returns ``q`` words later if the run is there.

Words are appended in pieces of any size. Each level of block size ``b`` keeps the names (hashes) of its latest blocks, the
catchers, and of the latest suffixes of ``b`` words. With every appended word the suffix that it completes is compared with the
blocks that lie back by the level's periods: those with its own remainder by ``b``, two a word from ``b = 8`` on. A level
holds names for a few blocks only, so an appended word costs a fixed number of comparisons per level, and there are
log(n) levels. A piece is compared by whole arrays, and the result does not depend on how the words are cut into pieces.

Blocks caught next to each other at one period belong to one row of partners; the row goes less than a block beyond them on
either side, which is compared word by word, as the whole row is: names only propose. Rows of at least ``q`` partners are
squares grown to runs. Of several periods over one stretch the smallest is the run's.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trellis.llm.common import body, text_chunks, whole_rows

BLANKS = " \t\n\x0b\x0c\r"
LEAST = 12  # words of a run, at least
PIECE = 1 << 18  # words appended at a time
GATHER = 1 << 21  # words compared at a time where rows are grown
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _named(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Names of joined blocks from the names of their halves."""
    found = (left * _MIX) ^ ((right + _MIX) * np.uint64(0xC2B2AE3D27D4EB4F))
    found ^= found >> np.uint64(29)
    found *= np.uint64(0xBF58476D1CE4E5B9)
    found ^= found >> np.uint64(32)
    return found


class Level:
    """The catchers of one block size, and the names of the suffixes of that many words."""

    def __init__(self, size: int, laps: list[int]):
        self.size, self.laps = size, laps  # periods lie in [lap * size, lap * size + size)
        self.base = 0  # position of names[0], a multiple of size
        self.names = np.zeros(0, dtype=np.uint64)
        self.seen = 0  # suffixes compared so far

    def advance(self, new: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Append suffix names; the blocks that return, adjacent ones as one: first and last place, and period."""
        b, hits = self.size, []
        self.names = np.concatenate((self.names, new))
        end = self.base + len(self.names)
        first = self.seen - self.seen % b
        rows = -(-(end - first) // b)
        at = first - self.base
        fresh = np.zeros(rows * b, dtype=np.uint64)
        fresh[:end - first] = self.names[at:]
        fresh = fresh.reshape(rows, b)
        for lap in self.laps:
            blocks = first // b - lap + np.arange(rows)
            usable = np.flatnonzero((blocks * b >= self.base))
            if not len(usable):
                continue
            caught = self.names[blocks[usable] * b - self.base]
            row, rest = np.nonzero(fresh[usable] == caught[:, None])
            row = usable[row]
            place = first + row * b + rest
            good = (place >= self.seen) & (place < end) & ((lap > 0) | (rest > 0))
            if good.any():
                row, rest = row[good], rest[good]
                order = np.lexsort((row, rest))
                row, rest = row[order], rest[order]
                # Adjacent blocks of one period make one row of partners.
                new = np.flatnonzero((np.diff(rest, prepend=-1) != 0) | (np.diff(row, prepend=-2) != 1))
                last = np.concatenate((new[1:], [len(row)])) - 1
                low = first // b - lap + row
                hits.append((low[new] * b, low[last] * b + b, lap * b + rest[new]))
        self.seen = end
        return hits

    def trim(self) -> None:
        """Forget names that neither this level's periods nor the next level's blocks reach back to."""
        b, end = self.size, self.base + len(self.names)
        keep = max(self.base, end - end % b - (max(self.laps, default=0) + 1) * b - 2 * b)
        keep -= keep % b
        self.names = self.names[keep - self.base:]
        self.base = keep


class SquareCatcher:
    """Runs of a growing sequence of word numbers."""

    def __init__(self, longest: int, least: int = LEAST):
        """``longest``: no run sought is longer than that many words."""
        self.least, self.pieces, self.length = least, [], 0
        laps: dict[int, set[int]] = defaultdict(set)
        size = 1
        for q in range(1, min(2 * least, longest) + 1):
            laps[self.block_of(q)].add(q // self.block_of(q))
        while 4 * size <= max(longest, 4):  # a run of period 2 * size has 4 * size words
            if 2 * size > least:
                laps[size] |= {2, 3}
            size *= 2
        self.levels = [Level(s, sorted(laps.get(s, ()))) for s in (1 << k for k in range(max(laps).bit_length()))]
        self.caught: dict[int, list] = defaultdict(list)

    def block_of(self, q: int) -> int:
        """The block size for a period: a row of that many partners holds a whole block."""
        size = 1
        while 4 * size - 1 <= self.least - q or 4 * size <= q:
            size *= 2
        return size

    def append(self, words: np.ndarray) -> None:
        words = words.astype(np.int64)
        self.pieces.append(words)
        self.length += len(words)
        names, below = words.view(np.uint64) * _MIX, None
        for level in self.levels:
            if below is not None:
                # Suffixes that end in this piece: left halves from the level below, up to where right halves are known.
                half = below.size
                done = level.base + len(level.names)
                ready = below.base + len(below.names) - half
                if ready <= done:
                    break
                left = below.names[done - below.base:ready - below.base]
                right = below.names[done + half - below.base:ready + half - below.base]
                names = _named(left, right)
            for hit in level.advance(names):
                self.caught[level.size].append(hit)
            below = level
        for level in self.levels:
            level.trim()

    def runs(self) -> np.ndarray:
        """Rows of ``start, length, period`` by start, then period."""
        x = np.concatenate(self.pieces) if self.pieces else np.zeros(0, dtype=np.int64)
        found = np.zeros((0, 3), dtype=np.int64)
        for size in sorted(self.caught):
            low, high, period = (np.concatenate(part) for part in zip(*self.caught[size]))
            order = np.lexsort((low, period))
            low, high, period = low[order], high[order], period[order]
            # Blocks caught in one piece may go on in the next.
            new = np.flatnonzero((np.diff(period, prepend=-1) != 0) | (low != np.concatenate(([-1], high[:-1]))))
            last = np.concatenate((new[1:], [len(low)])) - 1
            low, high, period = low[new], high[last], period[new]
            apart = ~_covered(found[found[:, 1] >= 3 * size], low, high, period)
            found = np.concatenate((found, _grown(x, low[apart], high[apart], period[apart], size, self.least)))
            found = self._checked(x, _smallest(found))
        return found[np.lexsort((found[:, 2], found[:, 0]))]

    def _checked(self, x: np.ndarray, rows: np.ndarray) -> np.ndarray:
        wrong = [i for i, (s, n, q) in enumerate(rows.tolist()) if not np.array_equal(x[s:s + n - q], x[s + q:s + n])]
        if wrong:  # different blocks had one name: look at every partner of these periods
            again = [_rows_of_period(x, int(q), self.least) for q in np.unique(rows[wrong, 2])]
            rows = _smallest(np.concatenate([np.delete(rows, wrong, axis=0), *again]))
        return rows


def _smallest(rows: np.ndarray) -> np.ndarray:
    """Of several periods over one stretch the smallest."""
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.ones(len(rows), dtype=bool)
    first[1:] = np.any(np.diff(rows[:, :2], axis=0) != 0, axis=1)
    return rows[first]


def _covered(runs: np.ndarray, low: np.ndarray, high: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which rows of partners lie, partners included, in a run whose period divides theirs. Such a row ends where the run does, so it
    is the same run or too short to be one."""
    covered = np.zeros(len(low), dtype=bool)
    if not len(runs) or not len(low):
        return covered
    order = np.argsort(low, kind="stable")
    starts = low[order]
    a, b = np.searchsorted(starts, runs[:, 0]), np.searchsorted(starts, runs[:, 0] + runs[:, 1])
    for i in np.flatnonzero(a < b).tolist():
        own = order[a[i]:b[i]]
        start, length, q = runs[i]
        covered[own] |= (high[own] + period[own] <= start + length) & (period[own] % q == 0)
    return covered


def _reach(x: np.ndarray, place: np.ndarray, period: np.ndarray, sign: int, most: int) -> np.ndarray:
    """How many places from ``place`` on, in the direction of ``sign``, have equal partners; fewer than ``most``."""
    reach, open_, step = np.zeros(len(place), dtype=np.int64), np.arange(len(place)), 8
    while len(open_):
        going = []
        for k in range(0, len(open_), max(1, GATHER // step)):
            own = open_[k:k + max(1, GATHER // step)]
            at = (place[own] + sign * reach[own])[:, None] + sign * np.arange(step)
            to = at + period[own][:, None]
            inside = (at >= 0) & (to < len(x))
            equal = inside & (x[np.where(inside, at, 0)] == x[np.where(inside, to, 0)])
            whole = equal.all(axis=1)
            reach[own] += np.where(whole, step, np.argmin(equal, axis=1))
            going.append(own[whole & (reach[own] < most)])
        open_, step = np.concatenate(going), min(2 * step, GATHER)
    return reach


def _grown(x: np.ndarray, low: np.ndarray, high: np.ndarray, period: np.ndarray, size: int, least: int) -> np.ndarray:
    high = high + _reach(x, high, period, 1, size)
    low = low - _reach(x, low - 1, period, -1, size)
    rows = np.stack((low, high - low + period, period), axis=1)
    return rows[rows[:, 1] >= np.maximum(least, 2 * period)]


def _rows_of_period(x: np.ndarray, q: int, least: int) -> np.ndarray:
    edges = np.diff(np.concatenate(([0], (x[:-q] == x[q:]).astype(np.int8), [0])))
    start, stop = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    rows = np.stack((start, stop - start + q, np.full(len(start), q)), axis=1)
    return rows[rows[:, 1] >= max(least, 2 * q)]


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Where each text's words begin among all words (and the end), and all words."""
    trimmed = pc.ascii_trim(texts.cast(pa.large_string()), BLANKS)
    lists = pc.ascii_split_whitespace(trimmed)
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).copy()
    sizes[pc.equal(pc.binary_length(trimmed), 0).to_numpy(zero_copy_only=False)] = 0  # an empty text splits into one empty word
    words = lists.flatten()
    if len(words) > sizes.sum():
        words = words.filter(pc.greater(pc.binary_length(words), 0))
    return np.concatenate(([0], np.cumsum(sizes))), words


def runs_of_texts(texts: pa.Array, least: int = LEAST, piece: int = PIECE) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Text bounds and words as in ``split_words``, the runs (``start`` among all words, ``length, period``), and each run's text.
    The texts go through one catcher, one behind the other, each followed by a word that stands nowhere else, over
    which no run can go."""
    bounds, words = split_words(texts)
    if not len(words):
        return bounds, words, np.zeros((0, 3), dtype=np.int64), np.zeros(0, dtype=np.int64)
    lengths = np.diff(bounds)
    text = np.repeat(np.arange(len(lengths)), lengths)
    ids = np.empty(len(words) + len(lengths), dtype=np.int64)
    ids[np.arange(len(words)) + text] = words.dictionary_encode().indices.to_numpy()
    ids[bounds[1:] + np.arange(len(lengths))] = -1 - np.arange(len(lengths))
    catcher = SquareCatcher(int(lengths.max()), least)
    for at in range(0, len(ids), piece):
        catcher.append(ids[at:at + piece])
    rows = catcher.runs()
    own = np.searchsorted(bounds[:-1] + np.arange(len(lengths)), rows[:, 0], side="right") - 1
    rows[:, 0] -= own
    return bounds, words, rows, own


def collapse(bounds: np.ndarray, words: pa.Array, runs: np.ndarray) -> pa.Array:
    """Each text's words joined by one blank, of each run only its first period."""
    if len(runs):
        edge = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
        np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
        kept = np.cumsum(edge[:-1]) == 0
        words = words.filter(pa.array(kept))
        bounds = np.concatenate(([0], np.cumsum(kept)))[bounds]
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), words), pa.scalar(" ", pa.large_string())).cast(pa.string())


def find(docs: DataFrame, text: str = "text", least: int = LEAST) -> DataFrame:
    """For every row ``row`` (a struct of all its columns), ``n_words``, ``runs`` (structs of ``start, length, period`` by
    start, then period) and ``collapsed``: the words joined by blanks, of each run only its first period.

    Words are what ASCII white space separates, and are compared whole. Null and empty texts have no words, no runs and an
    empty collapsed text; repeated rows are found each; other columns go along untouched; an empty table gives no
    rows. No shuffle; a task holds a few MB of texts, or one longer text, and a fixed multiple of their words."""
    rows = whole_rows(docs, body(F.col(text)).alias("text"))
    kind = rows.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text"):
            bounds, words, found, own = runs_of_texts(batch.column(1), least)
            starts = found[:, 0] - bounds[own]
            parts = [pa.array(part) for part in (starts, found[:, 1], found[:, 2])]
            ends = np.searchsorted(own, np.arange(len(bounds)))
            listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(parts, names=["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(np.diff(bounds), pa.int64()), listed, collapse(bounds, words, found),
            ], names=["row", "n_words", "runs", "collapsed"])

    return rows.mapInArrow(run, f"row {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
