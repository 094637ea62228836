"""Token counts of a unigram tokenizer, without making the tokens.

A unigram tokenizer cuts each word into the vocabulary pieces of the highest total score. Counting
needs no pieces: Aho-Corasick lists all vocabulary matches of a word in one pass, and dynamic
programming over the characters carries two numbers, the best score and the pieces on that path.

Tie rules, as in the ``tokenizers`` library's Unigram model: scores add up from the left in double
precision; of equal scores the path whose last piece starts first wins, since a later candidate must be
strictly better; a character that is no piece by itself is unknown, at 10 below the lowest score, and
counts one token per UTF-8 byte (byte fallback). White space is as in that library's Metaspace: a blank
becomes U+2581 and starts a word, one is put in front of the text, other white space is ordinary.

The vocabulary comes from a public sentencepiece file whose pieces are in order of frequency and whose
scores are bare ranks. Log-probabilities follow from the rank by Zipf's law: ``-ln(rank + offset)``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trellis.llm.common import body, text_chunks

MARK = "▁"
UNKNOWN_PENALTY = 10.0
ZIPF_OFFSET = 2.7
# Words kept with their counts per Python worker; a full table is emptied, which changes no result.
MEMO_WORDS = 200_000
MEMO_LENGTH = 64


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def unigram_vocabulary(path: str, offset: float = ZIPF_OFFSET) -> list[tuple[str, float]]:
    """(piece, score) by id. The unknown piece gets a name no text can hold."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        ("\U0010ffff\U0010fffe" if model.is_unknown(i) else model.id_to_piece(i), -math.log(i + offset))
        for i in range(model.get_piece_size())
    ]


class TokenCounter:
    """Counts and best scores of texts under one vocabulary."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        import ahocorasick

        self.matcher = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.matcher.add_word(piece, (len(piece), score))
        self.matcher.make_automaton()
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.memo: dict[str, tuple[int, float]] = {}

    def word(self, word: str) -> tuple[int, float]:
        """(pieces, score) of the best path through one word."""
        size = len(word)
        best, pieces = [0.0] * (size + 1), [0] * (size + 1)
        at, reached, single = 1, False, False  # position being settled; has it a path; is its last character a piece
        for end, (length, score) in self.matcher.iter(word):
            end += 1
            while at < end:
                self._settle(word, at, reached, single, best, pieces)
                at, reached, single = at + 1, False, False
            start = end - length  # matches of one end come longest first, so the first of equals starts first
            total = score + best[start]
            if not reached or total > best[end]:
                best[end], pieces[end], reached = total, pieces[start] + 1, True
            single = single or length == 1
        while at <= size:
            self._settle(word, at, reached, single, best, pieces)
            at, reached, single = at + 1, False, False
        return pieces[size], best[size]

    def _settle(self, word, at, reached, single, best, pieces) -> None:
        if single:
            return
        total = self.unknown + best[at - 1]
        if not reached or total > best[at]:
            best[at], pieces[at] = total, pieces[at - 1] + len(word[at - 1].encode("utf-8", "surrogatepass"))

    def text(self, text: str) -> tuple[int, float]:
        text = text.replace(MARK, " ")
        if not text:
            return 0, 0.0
        if text[0] != " ":
            text = " " + text
        count, score, memo = 0, 0.0, self.memo
        for part in text.split(" ")[1:]:
            known = memo.get(part)
            if known is None:
                known = self.word(MARK + part)
                if len(part) <= MEMO_LENGTH:
                    if len(memo) >= MEMO_WORDS:
                        memo.clear()
                    memo[part] = known
            count += known[0]
            score += known[1]
        return count, score


@lru_cache(maxsize=2)
def _counter(path: str, offset: float) -> TokenCounter:
    return TokenCounter(unigram_vocabulary(path, offset))


def token_counts(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", offset: float = ZIPF_OFFSET) -> DataFrame:
    """``doc_id, n_tokens, score`` for every row; ``score`` is the log-probability of the best cut.

    Null and empty texts have no tokens and score 0; repeated rows are counted each; other columns are
    not read. Each scan task works alone: no shuffle, one vocabulary per Python worker, and texts come in
    slices of a few MB. ``path`` must name the vocabulary file on every executor."""
    rows = docs.select(F.col(id).alias("doc_id"), body(F.col(text)).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path, offset)
        for batch in text_chunks(batches, "text"):
            found = [counter.text(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for n, _ in found], pa.int64()), pa.array([s for _, s in found], pa.float64())],
                names=["doc_id", "n_tokens", "score"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(count, f"doc_id {kind}, n_tokens long, score double")
