"""Packing documents into training sequences, in order, by dynamic programming.

The documents of a partition, tokenised and each closed by an end token, form one stream. Sequences are
consecutive windows of that stream of at most ``length`` tokens. Where to cut is a shortest path over the
allowed cut points: a window costs its padding (none if its length is a power of two), ``per_sequence``,
and a truncation penalty for the place where it ends: nothing at the end of a document, ``in_document`` at the
end of a sentence, ``in_sentence`` inside one. The last kind exists only in sentences over ``2 * stride``
tokens, every ``stride`` tokens, and in the last window of a partition, whose rest may so be
cut into lengths that need no padding.

With ``cost[j] = min over i of cost[i] + position[i]`` plus terms of ``j`` alone, over the ``i`` within a
window of ``j``, a monotone queue gives each minimum in constant time; the lengths that are powers of two are
looked up one by one. The stream is solved in stretches: all but the last sequences of a stretch are final,
the rest starts the next stretch, so only the end of a partition is padded for want of text.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress, filterfalse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trellis.llm.common import body, text_chunks

END_TOKEN = 1
LENGTH = 2048
IN_DOCUMENT = 8.0
IN_SENTENCE = 64.0
PER_SEQUENCE = 64.0
STRIDE = 128
BLOCK = 16
STRETCH = 1 << 19  # tokens solved at once
CARRY = 4  # sequences at the end of a stretch that are decided with the next one
SENTENCE_ENDS = (".", "!", "?", "…", "。", "！", "？")
CLOSERS = "\"'”’»)]*_"
PLAIN_MARKS = ".,;:!?*#$%&"  # a run of these after a word is one piece of its own
FAR = re.compile("[^\x00-\u024f]")  # beyond Latin letters
SENTENCE_BIT = np.uint32(1 << 31)
# Words kept with their ids per Python worker; a full table is emptied, which changes no result. Longer
# words are only kept for the texts at hand.
MEMO_WORDS = 600_000
MEMO_BYTES = 64


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordIds(dict):
    """UTF-8 word -> its ids as little-endian uint32 bytes; the top bit of the last marks a sentence end.

    The tokenizer drops white space and never joins what stands on its two sides, so a text's ids are its
    words' ids in a row, and each different word is tokenised once. Two ways lead to the same ids. Any word
    can take the whole tokenizer. Words of Latin letters, with marks behind or not, are nearly all: the
    tokenizer's splitting leaves their letters in one piece, whose BPE merges ``tiktoken`` runs for many words
    in one call, the blank behind each word standing for the vocabulary's word end. It merges any two neighbours
    whose union is in the vocabulary, where the file lists pairs; both are the same if each vocabulary entry
    is reached by its own listed pair, which ``tests/llm`` verifies for the whole file."""

    def __init__(self, path: str):
        super().__init__()
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        ranks, ids = word_end_ranks(model)
        self.merger = tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})
        self.own_ids = np.zeros(max(ids) + 1, dtype="<u4")
        self.ends_word = np.zeros(max(ids) + 1, dtype=bool)
        for number, (own, ends) in ids.items():
            self.own_ids[number], self.ends_word[number] = own, ends
        self.marks: dict[str, bytes] = {"": b""}
        self.long: list[bytes] = []

    def _whole(self, text: str) -> bytes:
        found = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")
        if len(found) and text.rstrip(CLOSERS).endswith(SENTENCE_ENDS):
            found[-1] |= SENTENCE_BIT
        return found.tobytes()

    def need(self, texts: list[list[bytes]]) -> None:
        """Make sure that all words of these texts are known."""
        new = set(filterfalse(self.__contains__, chain.from_iterable(texts)))
        if len(self) + len(new) > MEMO_WORDS:
            self.clear()
            new = set(chain.from_iterable(texts))
        for word in [w for w in new if len(w) > MEMO_BYTES]:
            new.discard(word)
            self.long.append(word)
            self[word] = self._whole(word.decode("utf-8", "replace"))
        self._learn(list(new))

    def forget_long(self) -> None:
        for word in self.long:
            self.pop(word, None)
        self.long = []

    def _learn(self, new: list[bytes]) -> None:
        if not new:
            return
        joined = b" ".join(new).decode("utf-8", "replace")
        if FAR.search(joined) or not unicodedata.is_normalized("NFC", joined):
            near = [w for w in new if not FAR.search(t := w.decode("utf-8", "replace")) and unicodedata.is_normalized("NFC", t)]
            for word in set(new).difference(near):
                self[word] = self._whole(word.decode("utf-8", "replace"))
            new, joined = near, b" ".join(near).decode("utf-8", "replace")
        lower = joined.lower().split(" ") if new else []
        cores = [word.rstrip(PLAIN_MARKS) for word in lower]
        plain = [core.isalpha() for core in cores]
        text = " ".join(compress(cores, plain))
        found = self.merger.encode_to_numpy(text + " ", disallowed_special=()) if text else np.zeros(0, dtype="<u4")
        stops = ((np.flatnonzero(self.ends_word[found]) + 1) * 4).tolist()
        ids, marks, start, at = self.own_ids[found].tobytes(), self.marks, 0, iter(stops)
        for word, low, core, is_plain in zip(new, lower, cores, plain):
            if not is_plain:
                self[word] = self._whole(word.decode("utf-8", "replace"))
                continue
            stop = next(at)
            entry = ids[start:stop]
            start = stop
            if len(low) > len(core):
                tail = low[len(core):]
                if tail not in marks:
                    marks[tail] = self._whole(tail)
                entry += marks[tail]
            self[word] = entry


def word_end_ranks(model: dict) -> tuple[dict[bytes, int], dict[int, tuple[int, bool]]]:
    """A BPE vocabulary with word ends as ranks over bytes, a blank for the word end; and for each rank the
    vocabulary's id and whether it ends a word."""
    # Byte-level BPE names each byte by a character: printable ones by themselves, the rest from U+0100 on.
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}

    def spelled(piece: str) -> bytes:
        ends = piece.endswith("</w>")
        return bytes(byte_of[c] for c in (piece[:-4] if ends else piece)) + b" " * ends

    ranks = {bytes([b]): b for b in range(256)}
    for b in range(256):
        if b != 0x20:
            ranks[bytes([b, 0x20])] = len(ranks)
    for left, right in (m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
        ranks[spelled(left) + spelled(right)] = len(ranks)
    ids = {}
    for piece, number in model["vocab"].items():
        if not piece.startswith("<|") and (rank := ranks.get(spelled(piece))) is not None:
            ids[rank] = (number, piece.endswith("</w>"))
    return ranks, ids


@lru_cache(maxsize=2)
def _words(path: str) -> WordIds:
    return WordIds(path)


def tokenise(words: WordIds, texts: list[str]) -> Iterator[tuple[bytes, np.ndarray]]:
    """For each text its ids with the end token, and how many ids stand before each sentence end."""
    split = [text.encode("utf-8", "replace").split() for text in texts]
    words.need(split)
    for found in split:
        marked = np.frombuffer(b"".join(map(words.__getitem__, found)), dtype="<u4")
        ends = np.flatnonzero(marked & SENTENCE_BIT) + 1
        yield (marked & ~SENTENCE_BIT).tobytes() + END_TOKEN.to_bytes(4, "little"), ends


def cut_points(size: int, sentence_ends: np.ndarray, stride: int = STRIDE, block: int = BLOCK) -> tuple[list[int], list[float]]:
    """Allowed cuts of a document of ``size`` ids with the end token, and their penalties."""
    inner = sentence_ends[sentence_ends < size - 1]
    if len(inner) > 1:  # of the sentence ends within a block of ids, the last will do
        inner = inner[np.flatnonzero(np.diff(inner // block, append=-1))]
    points = np.concatenate((inner, [size]))
    gaps = np.diff(points, prepend=0)
    if gaps.max() <= 2 * stride:
        return points.tolist(), [IN_DOCUMENT] * len(inner) + [0.0]
    places, penalties, before = [], [], 0
    for point in points.tolist():
        if point - before > 2 * stride:
            extra = range(before + stride, point - stride // 2, stride)
            places.extend(extra)
            penalties.extend([IN_SENTENCE] * len(extra))
        places.append(point)
        penalties.append(IN_DOCUMENT)
        before = point
    penalties[-1] = 0.0
    return places, penalties


def best_cuts(places: list[int], penalties: list[float], length: int = LENGTH, shortest: int = 1024) -> list[int]:
    """Indices of the chosen cuts, the first and the last place among them. ``places`` ascend, no two
    neighbours are over ``length`` apart. Lengths that are powers of two are tried from ``shortest`` on."""
    at = dict(zip(places, range(len(places))))
    powers = [1 << k for k in range(length.bit_length()) if shortest <= 1 << k <= length]
    cost, back = [0.0], [0]
    # The monotone queue: indices and their keys, keys ascending from ``head`` on.
    queue, keys, head = [0], [float(places[0])], 0
    find = at.get
    for j in range(1, len(places)):
        place = places[j]
        oldest = place - length
        while places[queue[head]] < oldest:
            head += 1
        best = queue[head]
        least = keys[head] - oldest
        for power in powers:
            i = find(place - power)
            if i is not None and cost[i] < least:
                best, least = i, cost[i]
        least += penalties[j] + PER_SEQUENCE
        cost.append(least)
        back.append(best)
        new = least + place
        while len(keys) > head and keys[-1] >= new:
            keys.pop()
            queue.pop()
        keys.append(new)
        queue.append(j)
    path, j = [len(places) - 1], len(places) - 1
    while j:
        j = back[j]
        path.append(j)
    return path[::-1]


class Packer:
    """The stream of one partition; ``add`` and ``finish`` return rows of pieces that are final."""

    def __init__(self, length: int, first_sequence: int):
        self.length, self.sequence = length, first_sequence
        self.docs: deque = deque()  # (doc_id, ids, place of its first id in the stream)
        self.places, self.penalties = [0], [0.0]
        self.end = 0

    def add(self, doc_id, ids: bytes, sentence_ends: np.ndarray) -> list[tuple]:
        size = len(ids) // 4
        self.docs.append((doc_id, ids, self.end))
        places, penalties = cut_points(size, sentence_ends, min(STRIDE, self.length // 2))
        self.places.extend([p + self.end for p in places])
        self.penalties.extend(penalties)
        self.end += size
        return self._solve(False) if self.end - self.places[0] >= STRETCH else []

    def finish(self) -> list[tuple]:
        if self.end == self.places[0]:
            return []
        known = dict(zip(self.places, self.penalties))
        for place in range(max(self.places[0], self.end - self.length) + 1, self.end):
            known.setdefault(place, IN_SENTENCE)
        self.places, self.penalties = sorted(known), [known[p] for p in sorted(known)]
        return self._solve(True)

    def _solve(self, last: bool) -> list[tuple]:
        path = best_cuts(self.places, self.penalties, self.length, 1 if last else self.length // 2)
        final = path if last else path[:-CARRY]
        rows: list[tuple] = []
        for a, b in zip(final, final[1:]):
            self._sequence(self.places[a], self.places[b], rows)
        if final:
            self.places, self.penalties = self.places[final[-1]:], self.penalties[final[-1]:]
        return rows

    def _sequence(self, start: int, stop: int, rows: list[tuple]) -> None:
        place = start
        while place < stop:
            doc_id, ids, first = self.docs[0]
            size = len(ids) // 4
            until = min(stop, first + size)
            piece = memoryview(ids)[4 * (place - first):4 * (until - first)]
            rows.append((doc_id, place - first, until - place, zlib.crc32(piece), size, self.sequence, place - start))
            place = until
            if until == first + size:
                self.docs.popleft()
        self.sequence += 1


PIECES = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def pack(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per piece of a document: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    The order that is kept is that of the rows in the input's partitions; there is no shuffle, and at most a
    stretch of tokens and one document are in memory. ``sequence_id`` has the partition in its upper half, so
    a task that is run again gives the same rows, if ``docs`` is read from files (or any
    frame whose partitions are the same each time). Null and empty texts are one piece with the end token only; a repeated row is
    packed each time; a text over ``length`` tokens spans several sequences; other columns are not read; an
    empty table gives no rows. ``path`` must name the tokenizer file on every executor."""
    rows = docs.select(F.col(id).alias("doc_id"), body(F.col(text)).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(path)
        packer = Packer(length, TaskContext.get().partitionId() << 32)
        id_type = pa.null()

        def table(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found))
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], id_type)] + [pa.array(c, pa.int64()) for c in columns[1:]], names=["doc_id", *PIECES]
            )

        for batch in text_chunks(batches, "text", 2 << 20):
            id_type = batch.column(0).type
            for doc_id, tokens in zip(batch.column(0).to_pylist(), tokenise(words, batch.column(1).to_pylist())):
                if found := packer.add(doc_id, *tokens):
                    yield table(found)
            words.forget_long()
        if found := packer.finish():
            yield table(found)

    return rows.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"`{c}` long" for c in PIECES))
