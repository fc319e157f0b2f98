"""BPE of words through a minimal acyclic transducer.

Texts are normalised and cut into words as the tokenizer file says. The
corpus' frequent words and the ids they merge to are compiled into a
transducer: an acyclic automaton over the words' bytes whose arcs carry ids as
early as a prefix fixes them, and whose equal suffixes are one and the same
state. It is written as flat arrays to the shared folder, shipped to every
executor with Spark's own file distribution and memory-mapped there, so all
Python workers of a machine share its pages. A batch's distinct words walk
through it together, one byte a step. Words that it does not have are merged
one pair at a time, lowest rank first, so results do not depend on what it
holds.
"""

from __future__ import annotations

import heapq
import json
import mmap
import re
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bundleflow.llm import unicode_later as later
from bundleflow.llm.common import materialise, slices, small_batches, whole_text
from bundleflow.session import scratch_path

#: Largest tokenizer file that is sent to the executors.
MAX_FILE_BYTES = 64 << 20
#: Frequent words in the transducer at most, and the bytes of the longest.
MAX_LEXICON, MAX_WORD_BYTES = 1 << 18, 64
#: A word that stands only once needs no place there.
MIN_COUNT = 2
#: Merged words that a worker remembers, and the bytes of the longest; results do not depend on it.
MEMO, MEMO_BYTES = 1 << 17, 64
WORD_END = "</w>"

# How the tokenizer file must normalise and split, as this module does it.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_ENDINGS = r"'(?:s|t|re|ve|m|ll|d)"
_LATIN_LETTERS, _LATIN_NUMBERS = r"a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", r"0-9\xb2\xb3\xb9\xbc-\xbe"
#: For lower-case text up to U+00FF.
_split_latin = re.compile(f"{_ENDINGS}|[{_LATIN_LETTERS}]+|[{_LATIN_NUMBERS}]"
                          rf"|[^\t-\r\x20\x85\xa0{_LATIN_LETTERS}{_LATIN_NUMBERS}]+").findall
_split_any = regex.compile(f"{_ENDINGS}|" r"\p{L}+|\p{N}" f"|[^{later.SPACE}" r"\p{L}\p{N}]+").findall
_NO_LETTERS, _NO_NUMBERS = later.class_body(later.LATER_LETTERS), later.class_body(later.LATER_NUMBERS)
#: With the letters and numbers of later versions as other characters.
_split_later = regex.compile(
    f"{_ENDINGS}|" rf"[\p{{L}}--[{_NO_LETTERS}]]+|[\p{{N}}--[{_NO_NUMBERS}]]"
    rf"|(?:[^{later.SPACE}\p{{L}}\p{{N}}]|[{_NO_LETTERS}{_NO_NUMBERS}])+", regex.V1).findall

_marks_apart = re.compile(f"([{later.class_body(later.MARKS_APART)}])")
_CAPITALS = {a + i: b + i for a, z, b in later.LATER_CAPITALS for i in range(z - a + 1)}
_CAPITALS[ord("Σ")] = ord("σ")  # Python writes a final one in another way
_odd_capital = re.compile("[" + "".join(map(chr, _CAPITALS)) + "]").search


def normalise(text: str) -> str:
    """NFC and lower case, letter by letter. White space is left to the split."""
    if _is_latin(text):
        return text.lower()
    if _marks_apart.search(text):
        text = "".join(unicodedata.normalize("NFC", part) for part in _marks_apart.split(text))
    else:
        text = unicodedata.normalize("NFC", text)
    if _odd_capital(text):
        text = text.translate(_CAPITALS)
    return text.lower()


def _is_latin(text: str) -> bool:
    """Whether no character lies beyond U+00FF; such a text is in NFC."""
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def split_words(text: str) -> list[str]:
    """The words of a text."""
    text = normalise(text)
    if _is_latin(text):
        return _split_latin(text)
    return _split_later(text) if later.has_later(text) else _split_any(text)


class Merges:
    """Vocabulary and merges of a tokenizer file."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model = spec["model"]
        steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", ())]
        split = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0].get("pattern", {}).get("Regex")
        if (model["type"], model["end_of_word_suffix"], steps, split) != ("BPE", WORD_END, _NORMALIZERS, _SPLIT):
            raise ValueError("not a word-level BPE file of the kind that this module reads")
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: t for t, i in (vocab | self.special).items()}
        self.token = [names.get(i, "") for i in range(max(names) + 1)]
        self.rank: dict[tuple[int, int], int] = {}
        self.result: list[int] = []  # what the merge of a rank gives
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[vocab[a], vocab[b]] = rank
            self.result.append(vocab[a + b])
        letters = _byte_letters()
        self.inner = [vocab[c] for c in letters]
        self.last = [vocab[c + WORD_END] for c in letters]
        self.special_split = re.compile("(" + "|".join(
            re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")").split if self.special else None

    def merge(self, word: bytes) -> tuple[int, ...]:
        """The ids of one word: of all neighbours that merge, those of the
        lowest rank do so first, the leftmost of them before the others."""
        ids = [self.inner[b] for b in word]
        ids[-1] = self.last[word[-1]]
        if len(ids) > 32:
            return self._merge_long(ids)
        get, none, result = self.rank.get, len(self.result), self.result
        found = [get(pair, none) for pair in zip(ids, ids[1:])]
        while found and (best := min(found)) < none:
            at = found.index(best)
            ids[at] = result[best]
            del ids[at + 1], found[at]
            if at < len(found):
                found[at] = get((ids[at], ids[at + 1]), none)
            if at:
                found[at - 1] = get((ids[at - 1], ids[at]), none)
        return tuple(ids)

    def _merge_long(self, ids: list[int]) -> tuple[int, ...]:
        """The same with a heap of candidates and links between neighbours, in
        n log n steps."""
        n, get = len(ids), self.rank.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank, i) for i in range(n - 1) if (rank := get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, at = heapq.heappop(heap)
            right = after[at] if ids[at] >= 0 else n
            if right >= n or get((ids[at], ids[right])) != rank:
                continue
            ids[at], ids[right] = self.result[rank], -1
            after[at] = after[right]
            if after[at] < n:
                before[after[at]] = at
                if (rank := get((ids[at], ids[after[at]]))) is not None:
                    heapq.heappush(heap, (rank, at))
            if before[at] >= 0 and (rank := get((ids[before[at]], ids[at]))) is not None:
                heapq.heappush(heap, (rank, before[at]))
        return tuple(i for i in ids if i >= 0)


def _byte_letters() -> list[str]:
    """The character that stands for each byte: itself where it is printable,
    else the next free one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(free)) for b in range(256)]


# --- the transducer --------------------------------------------------------

class _State:
    __slots__ = ("arcs", "final", "tail")

    def __init__(self):
        self.arcs: dict[int, list] = {}  # byte -> [target, ids]
        self.final = False
        self.tail: tuple[int, ...] = ()


def compile_lexicon(entries: dict[bytes, tuple[int, ...]]) -> bytes:
    """The minimal transducer from words to ids as bytes, see ``Lexicon``.

    Words are added in order. The states after the prefix that a word shares
    with the next one can change no more: they are replaced by an equal state
    where there is one. Ids move to the first arc at which all words beyond it
    agree on them.
    """
    register: dict[tuple, int] = {}
    frozen: list[tuple] = []
    path = [_State()]
    previous = b""

    def freeze(down_to: int) -> None:
        while len(path) > down_to + 1:
            state = path.pop()
            key = (state.final, state.tail, tuple((c, *arc) for c, arc in state.arcs.items()))
            number = register.get(key)
            if number is None:
                number = register[key] = len(frozen)
                frozen.append(key)
            path[-1].arcs[previous[len(path) - 1]][0] = number

    for word in sorted(entries):
        ids = entries[word]
        shared = 0
        for a, b in zip(previous, word):
            if a != b:
                break
            shared += 1
        freeze(shared)
        for i in range(shared):
            arc, state = path[i].arcs[word[i]], path[i + 1]
            old = arc[1]
            same = 0
            for a, b in zip(old, ids):
                if a != b:
                    break
                same += 1
            if rest := old[same:]:
                arc[1] = old[:same]
                for below in state.arcs.values():
                    below[1] = rest + below[1]
                if state.final:
                    state.tail = rest + state.tail
            ids = ids[same:]
        for i in range(shared, len(word)):
            path[-1].arcs[word[i]] = [-1, ids if i == shared else ()]
            path.append(_State())
        path[-1].final = True
        if shared == len(word):  # the empty word alone
            path[-1].tail = ids
        previous = word
    freeze(0)
    root = path[0]
    frozen.append((root.final, root.tail, tuple((c, *arc) for c, arc in root.arcs.items())))
    return _flat(frozen)


def _flat(states: list[tuple]) -> bytes:
    pool: list[int] = []
    places: dict[tuple[int, ...], int] = {(): 0}

    def place(ids: tuple[int, ...]) -> int:
        at = places.get(ids)
        if at is None:
            at = places[ids] = len(pool)
            pool.extend(ids)
        return at

    keys, targets, starts, sizes, finals, tails, tail_sizes = [], [], [], [], [], [], []
    for number, (final, tail, arcs) in enumerate(states):
        finals.append(final)
        tails.append(place(tail))
        tail_sizes.append(len(tail))
        for c, target, ids in arcs:
            keys.append(number << 8 | c)
            targets.append(target)
            starts.append(place(ids))
            sizes.append(len(ids))
    columns = [np.array(x, t) for x, t in zip((keys, targets, starts, sizes, tails, tail_sizes, finals, pool), Lexicon.TYPES)]
    return struct.pack("<8q", *map(len, columns)) + b"".join(
        c.tobytes() + b"\0" * (-c.nbytes % 8) for c in columns)


class Lexicon:
    """A transducer over flat arrays: arcs by (state, byte) with their target
    and where their ids start in the pool, states with the ids that end a word
    there. The last state is the first one of every word."""

    TYPES = (np.int64, np.int32, np.int32, np.int32, np.int32, np.int32, np.bool_, np.int32)

    def __init__(self, data: bytes | mmap.mmap):
        columns, at = [], 64
        for n, t in zip(struct.unpack_from("<8q", data), self.TYPES):
            columns.append(np.frombuffer(data, t, n, at))
            at += -(-n * np.dtype(t).itemsize // 8) * 8
        self.keys, self.targets, self.starts, self.sizes, self.tails, self.tail_sizes, self.finals, self.pool = columns

    @classmethod
    def open(cls, path: str) -> Lexicon:
        with open(path, "rb") as f:
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    def look_up(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For words given as bytes and offsets: whether each is there, how
        many ids it has, and the ids of those that are, in order."""
        n = len(offsets) - 1
        length = np.diff(offsets)
        state = np.full(n, len(self.finals) - 1)
        words, starts, sizes = [], [], []
        alive = np.flatnonzero((length > 0) & (length <= MAX_WORD_BYTES))
        found = np.zeros(n, bool)
        if not len(self.keys):
            alive = alive[:0]
        step = 0
        while len(alive):
            key = state[alive] << 8 | data[offsets[alive] + step]
            arc = np.searchsorted(self.keys, key)
            arc[arc == len(self.keys)] = 0
            there = self.keys[arc] == key
            alive, arc = alive[there], arc[there]
            state[alive] = self.targets[arc]
            says = self.sizes[arc] > 0
            words.append(alive[says])
            starts.append(self.starts[arc[says]])
            sizes.append(self.sizes[arc[says]])
            step += 1
            over = length[alive] == step
            ended = alive[over]
            ended = ended[self.finals[state[ended]]]
            found[ended] = True
            says = self.tail_sizes[state[ended]] > 0
            words.append(ended[says])
            starts.append(self.tails[state[ended[says]]])
            sizes.append(self.tail_sizes[state[ended[says]]])
            alive = alive[~over]
        if not words:
            return found, np.zeros(n, np.int64), np.zeros(0, np.int32)
        word, start, size = np.concatenate(words), np.concatenate(starts), np.concatenate(sizes)
        keep = found[word]
        word, start, size = word[keep], start[keep], size[keep]
        order = np.argsort(word, kind="stable")
        word, start, size = word[order], start[order], size[order]
        return found, np.bincount(word, size, n).astype(np.int64), self.pool[spans(start, size)]


def spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places start, start + 1, … of each span, one span after the other."""
    total = int(size.sum())
    before = np.cumsum(size) - size
    return np.arange(total) + np.repeat(start.astype(np.int64) - before, size)


# --- encoding --------------------------------------------------------------

class WordEncoder:
    """Texts to ids and back, through a lexicon."""

    def __init__(self, merges: Merges, lexicon: Lexicon):
        self.merges, self.lexicon = merges, lexicon
        self.young: dict[bytes, tuple[int, ...]] = {}
        self.old: dict[bytes, tuple[int, ...]] = {}
        self.tokens = pa.array(merges.token, pa.string())

    def words(self, text: str) -> list[str]:
        """The words of a text, each special token in it as it is."""
        special = self.merges.special_split
        if special is None or "<|" not in text and not any(s in text for s in self.merges.special):
            return split_words(text)
        out: list[str] = []
        for i, part in enumerate(special(text)):
            out += [part] if i % 2 else split_words(part)
        return out

    def _merged(self, word: bytes) -> tuple[int, ...]:
        ids = self.young.get(word)
        if ids is None:
            ids = self.old.get(word)
            if ids is None:
                special = self.merges.special.get(word.decode())
                ids = self.merges.merge(word) if special is None else (special,)
            if len(word) <= MEMO_BYTES:
                if len(self.young) >= MEMO:
                    self.young, self.old = {}, self.young
                self.young[word] = ids
        return ids

    def word_ids(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each word, their ids one after the other)."""
        offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1]
        data = np.frombuffer(words.buffers()[2] or b"\0", np.uint8)
        found, counts, ids = self.lexicon.look_up(data, offsets)
        missing = np.flatnonzero(~found)
        if not len(missing):
            return counts, ids
        merged = [self._merged(data[offsets[i]:offsets[i + 1]].tobytes()) for i in missing]
        counts[missing] = [len(m) for m in merged]
        out = np.empty(int(counts.sum()), np.int32)
        start = np.cumsum(counts) - counts
        out[spans(start[found], counts[found])] = ids
        out[spans(start[missing], counts[missing])] = [i for m in merged for i in m]
        return counts, out

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids): text i has ids[offsets[i]:offsets[i + 1]]."""
        words: list[str] = []
        ends = [0]
        for text in texts:
            words += self.words(text)
            ends.append(len(words))
        if not words:
            return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.int32)
        coded = pa.array(words, pa.large_string()).dictionary_encode()
        at = coded.indices.to_numpy()
        counts, ids = self.word_ids(coded.dictionary.cast(pa.string()))
        start = np.cumsum(counts) - counts
        size = counts[at]
        token_ends = np.concatenate([[0], np.cumsum(size)])
        return token_ends[np.array(ends)], ids[spans(start[at], size)]

    def decode(self, offsets: np.ndarray, ids: np.ndarray) -> pa.LargeStringArray:
        """The tokens of each text joined by spaces, as the file names no decoder."""
        tokens = self.tokens.take(pa.array(ids)).cast(pa.large_string())
        return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), tokens),
                              pa.scalar(" ", pa.large_string()))


def read_file(path: str) -> bytes:
    """The tokenizer file, whose size is checked."""
    with open(path, "rb") as f:
        data = f.read(MAX_FILE_BYTES + 1)
    if len(data) > MAX_FILE_BYTES:
        raise ValueError(f"{path} has more than {MAX_FILE_BYTES} bytes")
    return data


@lru_cache(maxsize=2)
def merges_of(data: bytes) -> Merges:
    return Merges(data)


_ENCODERS: dict[tuple[bytes, str], WordEncoder] = {}


def _encoder(data: bytes, file: str) -> WordEncoder:
    """One encoder a worker process; its memo serves all its tasks."""
    if (data, file) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[data, file] = WordEncoder(merges_of(data), Lexicon.open(SparkFiles.get(file)))
    return _ENCODERS[data, file]


def frequent_words(docs: DataFrame, text_col: str = "text", limit: int = MAX_LEXICON,
                   min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the most frequent lower-case runs of letters of all
    documents, counted with map-side aggregation; ``limit`` at most. What
    stands fewer than ``min_count`` times or is longer than MAX_WORD_BYTES is
    left out. The least count is found on a histogram of the counts (sixteen
    bars to each power of two), so no task or driver gathers and sorts words."""
    words = docs.select(F.explode(F.split(F.lower(text_col), r"[^\p{L}]+")).alias("word"))
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    counted = materialise(counted.filter((F.col("n") >= min_count) & F.octet_length("word").between(1, MAX_WORD_BYTES)),
                          "words")
    bar = F.floor(F.log2("n") * 16)
    bars = {r.bar: r["count"] for r in counted.groupBy(bar.alias("bar")).count().collect()}
    least, total = max(bars, default=0) + 1, 0
    for height in sorted(bars, reverse=True):
        total += bars[height]
        if total > limit:
            break
        least = height
    return counted.filter(bar >= least)


def ship_lexicon(spark: SparkSession, words: list[str], merges: Merges) -> str:
    """Compiles the words, writes the transducer below ``spark.checkpoint.dir``
    (on whatever file system that is) and gives it to Spark for distribution.
    Returns the name under which executors find it."""
    data = compile_lexicon({w.encode(): merges.merge(w.encode()) for w in words if w})
    path = scratch_path(spark, "llm-lexicon")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[1]


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                     lexicon_words: int = MAX_LEXICON) -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (array<int>), decoded (the
    tokens' strings joined by spaces).

    ``path`` is a word-level BPE file of the tokenizers library. The most
    frequent words of all documents, ``lexicon_words`` at most, are compiled
    into the lexicon and pass the driver; all others are merged where they
    stand. NULL and empty texts have no ids and decode to an empty string.
    Repeated rows and NULL ids each get their row; other columns are not read;
    an empty table gives no rows. Texts are encoded whole.
    """
    def give(encode: WordEncoder, offsets: np.ndarray, ids: np.ndarray) -> list[pa.Array]:
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))
        return [lists, encode.decode(offsets, ids).cast(pa.string())]

    return _encoded(docs, path, id_col, text_col, lexicon_words, give, "ids array<int>, decoded string")


def encoding_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                     lexicon_words: int = MAX_LEXICON) -> DataFrame:
    """``encode_documents`` with its results as digests, taken where they
    arise: doc_id, n_tokens, SHA-256 of the ids as little-endian unsigned
    32-bit integers and of the decoded text."""
    import hashlib

    def give(encode: WordEncoder, offsets: np.ndarray, ids: np.ndarray) -> list[pa.Array]:
        raw, decoded = ids.astype("<u4").tobytes(), encode.decode(offsets, ids)
        ends = np.frombuffer(decoded.buffers()[1], np.int64)[:len(decoded) + 1]
        text = memoryview(decoded.buffers()[2] or b"")
        return [pa.array(np.diff(offsets)),
                pa.array([hashlib.sha256(raw[4 * a:4 * b]).hexdigest() for a, b in zip(offsets, offsets[1:])], pa.string()),
                pa.array([hashlib.sha256(text[a:b]).hexdigest() for a, b in zip(ends, ends[1:])], pa.string())]

    return _encoded(docs, path, id_col, text_col, lexicon_words, give,
                    "n_tokens long, ids_sha256 string, decoded_sha256 string")


def _encoded(docs: DataFrame, path: str, id_col: str, text_col: str, lexicon_words: int, give, columns: str) -> DataFrame:
    spark = docs.sparkSession
    small_batches(spark)
    data = read_file(path)
    words = [r.word for r in frequent_words(docs, text_col, min(lexicon_words, MAX_LEXICON)).select("word").collect()]
    file = ship_lexicon(spark, words, merges_of(data))
    shared = spark.sparkContext.broadcast(data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = None
        for batch in (part for batch in batches for part in slices(batch, 1)):
            encode = encode or _encoder(shared.value, file)
            offsets, ids = encode(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), *give(encode, offsets, ids)], names)

    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    names = ["doc_id", *(c.split()[0] for c in columns.split(", "))]
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {columns}")
