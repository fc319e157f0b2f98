"""Token counts of a unigram vocabulary, without building the tokens.

A pyahocorasick automaton enumerates the pieces that end at each character of
a word; dynamic programming carries the best score and the number of pieces up
to there. Ties and unknown characters follow the tokenizer's rules: pieces are
offered by rising start, and a later one replaces an earlier one only with a
strictly better score; a character that is no piece by itself is offered as
unknown, at the lowest score less ten, and stands for its UTF-8 bytes if the
vocabulary has pieces for them.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bundleflow.llm.common import small_batches, whole_text

#: Largest vocabulary file that is sent to the executors.
MAX_MODEL_BYTES = 64 << 20
#: Stands for a space in pieces, and starts every word.
SPACE = "▁"
#: The unknown piece's score is this much below the lowest.
UNKNOWN_PENALTY = 10.0
#: Words that a worker remembers, and the longest of them; the results do not depend on it.
MEMO, MEMO_CHARS = 1 << 18, 64


class Vocabulary:
    """Pieces and their scores, as a unigram model."""

    def __init__(self, pieces: list[tuple[str, float]]):
        scores: dict[str, float] = {}
        for piece, score in pieces:
            scores[piece] = score
        self.scores = scores
        self.unknown = min(s for _, s in pieces) - UNKNOWN_PENALTY
        self.bytes = all(f"<0x{b:02X}>" in scores for b in range(256))
        self.automaton = ahocorasick.Automaton()
        for piece, score in scores.items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.memo = Memo(self.best)

    def best(self, word: str) -> tuple[int, float]:
        """Number of pieces and score of the best segmentation of one word."""
        n = len(word)
        score = [0.0] + [-math.inf] * n
        count = [0] * (n + 1)
        single = bytearray(n + 1)
        unknown = bytearray(n + 1)
        known = 0  # up to here all pieces and unknown characters have been offered
        # the automaton gives pieces by rising end and, of one end, the longest
        # first, so by rising start
        for last, (size, own) in self.automaton.iter(word):
            while known < last:
                known += 1
                if not single[known]:
                    self._offer_unknown(word, known, score, count, unknown)
            total = score[last + 1 - size] + own
            if total > score[last + 1]:
                score[last + 1] = total
                count[last + 1] = count[last + 1 - size] + 1
            if size == 1:
                single[last + 1] = 1
        while known < n:
            known += 1
            if not single[known]:
                self._offer_unknown(word, known, score, count, unknown)
        return count[n], score[n]

    def _offer_unknown(self, word: str, end: int, score: list[float], count: list[int], unknown: bytearray) -> None:
        total = score[end - 1] + self.unknown
        if total > score[end]:
            score[end] = total
            unknown[end] = 1
            if self.bytes:
                count[end] = count[end - 1] + len(word[end - 1].encode())
            else:  # unknown characters in a row are one piece
                count[end] = count[end - 1] + (not unknown[end - 1])

    def count(self, text: str) -> tuple[int, float]:
        """Number of pieces and score of a text: the sum over its words, each
        with the space before it. No piece reaches over the start of a word."""
        found = [*map(self.memo.__getitem__, words(text))] if text else []
        return sum(n for n, _ in found), math.fsum(s for _, s in found)


class Memo(dict):
    """Word to its pieces and score, in two generations: when the young one is
    full it becomes the old one, and what is in use moves over from there."""

    def __init__(self, best: Callable[[str], tuple[int, float]]):
        super().__init__()
        self.best, self.old = best, {}

    def __missing__(self, word: str) -> tuple[int, float]:
        found = self.old.get(word) or self.best(word)
        if len(word) <= MEMO_CHARS:
            if len(self) >= MEMO:
                self.old = dict(self)
                self.clear()
            self[word] = found
        return found


def words(text: str) -> list[str]:
    """Spaces written as SPACE, one put in front unless there is one; every
    SPACE starts a word."""
    marked = text.replace(" ", SPACE)
    return [SPACE + w for w in (marked if marked.startswith(SPACE) else SPACE + marked).split(SPACE)[1:]]


def read_model(path: str) -> bytes:
    """A sentencepiece file, whose size is checked."""
    with open(path, "rb") as f:
        data = f.read(MAX_MODEL_BYTES + 1)
    if len(data) > MAX_MODEL_BYTES:
        raise ValueError(f"{path} has more than {MAX_MODEL_BYTES} bytes")
    return data


def model_pieces(data: bytes) -> list[tuple[str, float]]:
    model = sentencepiece.SentencePieceProcessor(model_proto=data)
    ids = range(model.get_piece_size())
    return [(model.id_to_piece(i), model.get_score(i)) for i in ids]


@lru_cache(maxsize=2)
def vocabulary(data: bytes) -> Vocabulary:
    return Vocabulary(model_pieces(data))


def count_column(spark: SparkSession, text: Column, model_path: str) -> Column:
    """Text column to struct(n_tokens, score); NULL counts as empty."""
    shared = spark.sparkContext.broadcast(read_model(model_path))

    def run(texts: pa.Array) -> pa.Array:
        vocab = vocabulary(shared.value)
        found = [vocab.count(t.as_py() or "") for t in texts]
        return pa.StructArray.from_arrays([pa.array([n for n, _ in found], pa.int64()),
                                           pa.array([s for _, s in found], pa.float64())], ["n_tokens", "score"])

    return F.arrow_udf(run, T.StructType().add("n_tokens", "long").add("score", "double"))(whole_text(text))


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, score (of the best
    segmentation, summed over its words).

    NULL and empty texts have no tokens and the score 0. Repeated rows and NULL
    ids each get their row; other columns are not read; an empty table gives
    no rows. Texts are counted whole.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       count_column(docs.sparkSession, F.col(text_col), model_path).alias("found"))
    return rows.select("doc_id", "found.n_tokens", "found.score")
