"""Byte-level BPE encoding and decoding by backtracking over longest matches.

The bytes of a pre-token are mapped to Latin-1, so that a pyahocorasick
automaton of all tokens finds the matches at every position. Encoding takes
the longest match, falls back to shorter ones where two adjacent tokens
cannot stand side by side in a BPE result, and steps back where no match is
left; a position that was left once is never entered again, so the work is
linear in the number of matches. Whether two tokens can be adjacent depends on
the ranks alone: undoing their merges from the highest rank down must not meet
a pair that BPE would have merged earlier. Those answers are memoised.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bundleflow.llm import unicode_later as later
from bundleflow.llm.common import slices, small_batches, whole_text

#: Largest rank file that is sent to the executors.
MAX_RANK_BYTES = 64 << 20
#: Memoised adjacent pairs and pre-tokens of a worker; beyond that the memo
#: starts anew. The results do not depend on it.
MEMO = 1 << 18
#: Longer pre-tokens are encoded each time instead of being memoised.
MEMO_BYTES = 64


class RankTable:
    """Ranks (token bytes to rank) with what encoding and decoding need."""

    def __init__(self, ranks: dict[bytes, int]):
        self.size = max(ranks.values()) + 1
        self.token: list[bytes | None] = [None] * self.size
        for data, rank in ranks.items():
            self.token[rank] = data
        self.rank = ranks
        self.length = [len(t or b"") for t in self.token]
        self.bytes = pa.array(self.token, pa.large_binary())
        self.automaton = ahocorasick.Automaton()
        for data, rank in ranks.items():
            self.automaton.add_word(data.decode("latin-1"), (len(data), rank))
        self.automaton.make_automaton()
        # the longest other token that a token starts with, or -1
        self.shorter = [-1] * self.size
        for data, rank in ranks.items():
            for end in range(len(data) - 1, 0, -1):
                if (found := ranks.get(data[:end])) is not None:
                    self.shorter[rank] = found
                    break
        # the two tokens that a token is merged from, by rising rank; a token
        # that no merge makes (a single byte) stands for itself
        self.parts = [(r, r) for r in range(self.size)]
        self.merged: dict[tuple[int, int], int] = {}
        self.memo: dict[tuple[int, int], bool] = {}
        for data, rank in sorted(ranks.items(), key=lambda x: x[1]):
            left = self.shorter[rank]
            while left >= 0:
                right = ranks.get(data[len(self.token[left]):], self.size)
                if left < rank and right < rank and self._adjacent(left, right):
                    self.parts[rank] = (left, right)
                    self.merged[left, right] = rank
                    break
                left = self.shorter[left]
        self.memo.clear()

    def adjacent(self, left: int, right: int) -> bool:
        known = self.memo.get((left, right))
        if known is None:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            known = self.memo[left, right] = self._adjacent(left, right)
        return known

    def _adjacent(self, left: int, right: int) -> bool:
        """Whether BPE leaves ``left`` and ``right`` side by side: no pair that
        touches across their border, while their merges are undone from the
        last one on, would have been merged before what was merged instead."""
        merged, parts, limit = self.merged, self.parts, self.size
        while True:
            if merged.get((left, right), limit) < limit:
                return False
            undo_left = left > right
            for _ in range(2):  # the later merge first; if that side is a byte, the other
                if undo_left and parts[left][1] != left:
                    limit, left = left, parts[left][1]
                    break
                if not undo_left and parts[right][0] != right:
                    limit, right = right + 1, parts[right][0]
                    break
                undo_left = not undo_left
            else:
                return True

    def encode(self, piece: bytes) -> list[int]:
        """The ranks that BPE gives for one pre-token."""
        if (whole := self.rank.get(piece)) is not None:
            return [whole]
        n = len(piece)
        longest = [-1] * n
        for end, (size, rank) in self.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - size] = rank  # ends rise, so a later match is a longer one
        open_at = bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        at, last, token = 0, -1, longest[0]
        shorter, size_of, memo, adjacent = self.shorter, self.length, self.memo, self.adjacent
        while at < n:
            while token >= 0:
                end = at + size_of[token]
                if open_at[end]:
                    if last < 0:
                        break
                    fits = memo.get((last, token))
                    if fits or fits is None and adjacent(last, token):
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at, last = end, token
                token = longest[at] if at < n else -1
            elif out:
                open_at[at] = 0
                token = out.pop()
                at -= size_of[token]
                token = shorter[token]
                last = out[-1] if out else -1
            else:
                raise ValueError("the ranks do not cover the bytes of the text")
        return out


def read_ranks(path: str) -> bytes:
    """The rank file (``base64 rank`` per line), whose size is checked."""
    with open(path, "rb") as f:
        data = f.read(MAX_RANK_BYTES + 1)
    if len(data) > MAX_RANK_BYTES:
        raise ValueError(f"{path} has more than {MAX_RANK_BYTES} bytes")
    return data


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}


@lru_cache(maxsize=2)
def rank_table(data: bytes) -> RankTable:
    return RankTable(parse_ranks(data))


_LATIN_LETTERS, _LATIN_NUMBERS = r"a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", r"0-9\xb2\xb3\xb9\xbc-\xbe"


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """``findall`` of a split pattern, with the classes of its own dialect: \\s
    is Unicode's White_Space (the separators U+001C to U+001F are none), \\p{L}
    and \\p{N} are those of Unicode 16. Texts up to U+00FF, and texts without
    characters of later versions, take shorter ways to the same pieces."""
    space = later.SPACE
    own = (pattern.replace(r"[^\s", f"[^{space}").replace(r"\s+(?!\S)", f"[{space}]+(?![^{space}])")
           .replace(r"\s+", f"[{space}]+"))
    any_text = regex.compile(own).findall
    letters, numbers = later.class_body(later.LATER_LETTERS), later.class_body(later.LATER_NUMBERS)
    later_text = regex.compile(
        own.replace(rf"[^{space}\p{{L}}\p{{N}}]", rf"(?:[^{space}\p{{L}}\p{{N}}]|[{letters}{numbers}])")
        .replace(r" ?\p{L}+", rf" ?[\p{{L}}--[{letters}]]+").replace(r" ?\p{N}+", rf" ?[\p{{N}}--[{numbers}]]+"),
        regex.V1).findall
    latin = (pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^\t-\r\x20\x85\xa0{_LATIN_LETTERS}{_LATIN_NUMBERS}]")
             .replace(r"\p{L}", f"[{_LATIN_LETTERS}]").replace(r"\p{N}", f"[{_LATIN_NUMBERS}]")
             .replace(r"\s", r"[\t-\r\x20\x85\xa0]").replace(r"\S", r"[^\t-\r\x20\x85\xa0]"))
    latin_text = re.compile(latin).findall if "\\p" not in latin else any_text

    def split(text: str) -> list[str]:
        if text.isascii():
            return latin_text(text)
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return later_text(text) if later.has_later(text) else any_text(text)
        return latin_text(text)

    return split


class Pieces(dict):
    """Pre-token to the bytes of its ranks (int32), memoised in two
    generations: when the young one is full it becomes the old one, and what
    is still in use moves over from there."""

    def __init__(self, table: RankTable):
        super().__init__()
        self.table, self.old = table, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = array("i", self.table.encode(piece.encode())).tobytes()
        if len(piece) <= MEMO_BYTES:
            if len(self) >= MEMO:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    """Texts to ranks."""

    def __init__(self, table: RankTable, pattern: str):
        self.split, self.pieces = splitter(pattern), Pieces(table)

    def __call__(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, self.split(text))), dtype=np.int32)


_ENCODERS: dict[tuple[bytes, str], Encoder] = {}


def _encoder(data: bytes, pattern: str) -> Encoder:
    """One encoder a worker process; its memo serves all its tasks."""
    if (data, pattern) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[data, pattern] = Encoder(rank_table(data), pattern)
    return _ENCODERS[data, pattern]


def encode_texts(encode: Encoder, texts: pa.Array) -> pa.LargeListArray:
    """The ids of each text; NULL counts as empty."""
    ids = [encode(t.as_py() or "") for t in texts]
    offsets = np.cumsum([0, *map(len, ids)], dtype=np.int64)
    values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    return pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(values))


def decode_ids(table: RankTable, ids: pa.ListArray | pa.LargeListArray) -> pa.LargeBinaryArray:
    """The bytes that each list of ids stands for; NULL stays NULL."""
    ids = ids.cast(pa.large_list(pa.int32()))
    parts = table.bytes.take(ids.values)
    lists = pa.LargeListArray.from_arrays(ids.offsets, parts)
    joined = pc.binary_join(lists, pa.scalar(b"", pa.large_binary()))
    return pc.if_else(pc.is_valid(ids), joined, pa.scalar(None, pa.large_binary())) if ids.null_count else joined


def encode_column(spark: SparkSession, text: Column, ranks_path: str, pattern: str) -> Column:
    """Text column to its token ids, array<int>; NULL counts as empty."""
    shared = spark.sparkContext.broadcast(read_ranks(ranks_path))

    def run(texts: pa.Array) -> pa.Array:
        return encode_texts(_encoder(shared.value, pattern), texts).cast(pa.list_(pa.int32()))

    return F.arrow_udf(run, T.ArrayType(T.IntegerType(), False))(whole_text(text))


def decode_column(spark: SparkSession, ids: Column, ranks_path: str) -> Column:
    """Token ids, array<int>, to the bytes they stand for; NULL stays NULL."""
    shared = spark.sparkContext.broadcast(read_ranks(ranks_path))

    def run(rows: pa.Array) -> pa.Array:
        return decode_ids(rank_table(shared.value), rows).cast(pa.binary())

    return F.arrow_udf(run, T.BinaryType())(ids)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (array<int>), decoded (binary,
    the bytes that the ids stand for).

    NULL and empty texts have no ids and decode to no bytes. Repeated rows and
    NULL ids each get their row; other columns are not read; an empty table
    gives no rows. A text is encoded whole, whatever its length, and once: one
    function does both ways, as two chained ones would encode again to decode.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for batch in batches for part in slices(batch, 1)):
            encode = _encoder(shared.value, pattern)
            ids = encode_texts(encode, batch.column(1))
            decoded = decode_ids(encode.pieces.table, ids)
            yield pa.RecordBatch.from_arrays([batch.column(0), ids.cast(pa.list_(pa.int32())), decoded.cast(pa.binary())],
                                             ["doc_id", "ids", "decoded"])

    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded binary")


def encoding_digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the decimal ids joined by a space and
    of the decoded bytes."""
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
