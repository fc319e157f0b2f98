"""Runs of repeated words: maximal stretches with a period.

The suffixes of a text's words are sorted by prefix doubling and linked where
neighbours in that order share a prefix. Taking the links by decreasing length
of that prefix (LCP), union-find joins the classes of suffixes that begin
alike; each class keeps its positions in order. Two positions that become
neighbours in a class at a distance within the current LCP repeat at that
distance: they seed a run. Its start is known when the word before differs
from the one a period later, its end from the LCP, and of several periods of
the same stretch the smallest holds.

Words are numbered per batch by Arrow's kernels. Texts in which no sequence of
words repeats that would be long enough for a run are found by the first
rounds of the doubling, a whole batch at a time.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bundleflow.llm.common import cut_at_spaces, slices, small_batches, whole_text

#: A run has this many words at least, and this many times its period.
MIN_LENGTH, MIN_REPEATS = 6, 4
#: Words whose suffixes are sorted at once (a longer text is alone).
CHUNK_WORDS = 1 << 16
#: Positions of a block of an ordered set.
BLOCK = 512


def least_prefix(min_length: int, min_repeats: int) -> int:
    """The shortest prefix that two suffixes can share at both ends of a period of a run."""
    return min(max((min_repeats - 1) * q, min_length - q) for q in range(1, min_length + 1))


class Positions:
    """An ordered set of numbers in blocks."""

    __slots__ = ("blocks", "firsts", "size")

    def __init__(self, only: int):
        self.blocks, self.firsts, self.size = [[only]], [only], 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def add(self, x: int) -> tuple[int, int]:
        """Puts in ``x``, which is new; its neighbours, -1 where there is none."""
        at = max(0, bisect_right(self.firsts, x) - 1)
        block = self.blocks[at]
        j = bisect_left(block, x)
        before = block[j - 1] if j else self.blocks[at - 1][-1] if at else -1
        after = block[j] if j < len(block) else self.blocks[at + 1][0] if at + 1 < len(self.blocks) else -1
        block.insert(j, x)
        self.firsts[at] = block[0]
        if len(block) > 2 * BLOCK:
            self.blocks[at:at + 1] = [block[:BLOCK], block[BLOCK:]]
            insort(self.firsts, block[BLOCK])
        self.size += 1
        return before, after


def sorted_suffixes(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix order of ``symbols`` (numbers from 0) by prefix doubling, and
    after each round the ranks of the prefixes of 1, 2, 4, … symbols. Equal
    prefixes have equal ranks; only suffixes that others equal are sorted on."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank, active = _ranks(order, symbols[order], np.zeros(n, np.int64), None)
    levels = [rank]
    width = 1
    while len(active):
        ahead = active + width
        after = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        key = rank[active] * (n + 1) + after
        by = np.argsort(key, kind="stable")
        rank, active = _ranks(active[by], key[by], rank, rank[active[by]])
        levels.append(rank)
        width *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order, levels


def _ranks(at: np.ndarray, key: np.ndarray, rank: np.ndarray, base: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """New ranks of the positions ``at``, sorted by ``key``: the place of the
    first of equal keys, counted from the first of those with the same old
    rank ``base``. Also the positions whose keys others equal."""
    n = len(at)
    new = np.concatenate([[True], key[1:] != key[:-1]]) if n else np.zeros(0, bool)
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    if base is None:
        place = first
    else:
        fresh = np.concatenate([[True], base[1:] != base[:-1]]) if n else np.zeros(0, bool)
        place = base + first - np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    out = rank.copy()
    out[at] = place
    alone = new & np.concatenate([new[1:], [True]]) if n else new
    return out, at[~alone]


def shared_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """LCP of each suffix in the order and the next one, from the ranks."""
    n = len(order)
    a, b = order[:-1].copy(), order[1:].copy()
    out = np.zeros(max(0, n - 1), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        rank = np.append(levels[level], -1)
        inside = (a < n) & (b < n)
        same = inside & (rank[np.minimum(a, n)] == rank[np.minimum(b, n)])
        step = np.where(same, 1 << level, 0)
        out += step
        a += step
        b += step
    return out


def runs_of(symbols: np.ndarray, min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs, by start and period. Symbols that
    occur once may separate texts."""
    least = least_prefix(min_length, min_repeats)
    order, levels = sorted_suffixes(symbols)
    lcp = shared_prefixes(order, levels)
    links = np.flatnonzero(lcp >= least)
    links = links[np.argsort(-lcp[links], kind="stable")]
    parent: dict[int, int] = {}
    classes: dict[int, Positions] = {}
    found: dict[tuple[int, int], int] = {}
    word = symbols.tolist()

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    def seed(i: int, j: int, shared: int) -> None:
        period = j - i
        if (period > shared or shared < (min_repeats - 1) * period or period + shared < min_length
                or i and word[i - 1] == word[j - 1]):
            return
        stretch = (i, period + shared)
        if found.get(stretch, period) >= period:
            found[stretch] = period

    places = order.tolist()
    for link, shared in zip(links.tolist(), lcp[links].tolist()):
        x, y = root(link), root(link + 1)
        one = classes.pop(x, None) or Positions(places[x])
        two = classes.pop(y, None) or Positions(places[y])
        if one.size < two.size:
            one, two, x, y = two, one, y, x
        last = -1
        for position in two:
            before, after = one.add(position)
            if before >= 0 and before != last:
                seed(before, position, shared)
            if after >= 0:
                seed(position, after, shared)
            last = position
        parent[y] = x
        classes[x] = one
    return sorted((start, length, period) for (start, length), period in found.items())


def _with_repeats(word: np.ndarray, text: np.ndarray, least: int) -> np.ndarray:
    """The texts in which some sequence of ``least`` words, or of a power of
    two below that, stands twice."""
    n = len(word)
    if not n:
        return np.zeros(0, np.int64)
    width = 1
    _, rank, count = np.unique(text * (int(word.max()) + 1) + word, return_inverse=True, return_counts=True)
    at = np.flatnonzero(count[rank] > 1)
    while len(at) and 2 * width <= least:
        ahead = at + width
        inside = ahead < n
        at, ahead = at[inside], ahead[inside]
        key = rank[at] * (n + 1) + rank[ahead]  # ranks differ from text to text
        _, part, count = np.unique(key, return_inverse=True, return_counts=True)
        again = count[part] > 1
        # a rank for those that others equal; the rest cannot be in a longer one
        rank = np.full(n, -1)
        rank[at[again]] = part[again]
        at = at[again]
        width *= 2
        at = at[(at + width < n)]
        if 2 * width <= least:
            at = at[rank[np.minimum(at + width, n - 1)] >= 0]
    return np.unique(text[at]) if len(at) else np.zeros(0, np.int64)


class RunFinder:
    """Runs of the texts of a batch."""

    def __init__(self, min_length: int, min_repeats: int):
        if min_length < 2 or min_repeats < 2:
            raise ValueError("a run has two words and two periods at least")
        self.min_length, self.min_repeats = min_length, min_repeats
        self.least = least_prefix(min_length, min_repeats)

    def __call__(self, texts: pa.Array) -> tuple[list[list[tuple[int, int, int]]], pa.LargeStringArray]:
        """(runs of each text, the texts with their runs cut to one period)."""
        words, ends = cut_at_spaces(texts.cast(pa.large_string()))
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        word = words.dictionary_encode().indices.to_numpy().astype(np.int64)
        text = np.repeat(np.arange(len(ends)), ends - starts)
        runs: list[list[tuple[int, int, int]]] = [[] for _ in range(len(ends))]
        chunk: list[int] = []
        size = 0
        for t in _with_repeats(word, text, self.least).tolist():
            if chunk and size + ends[t] - starts[t] > CHUNK_WORDS:
                self._find(word, starts, ends, chunk, runs)
                chunk, size = [], 0
            chunk.append(t)
            size += ends[t] - starts[t]
        if chunk:
            self._find(word, starts, ends, chunk, runs)
        drop = np.zeros(len(word) + 1, np.int64)
        for t, found in enumerate(runs):
            for start, length, period in found:
                drop[starts[t] + start + period] += 1
                drop[starts[t] + start + length] -= 1
        keep = np.cumsum(drop[:-1]) == 0
        kept_ends = np.concatenate([[0], np.cumsum(keep)])[np.concatenate([[0], ends])]
        lists = pa.LargeListArray.from_arrays(pa.array(kept_ends, pa.int64()), words.filter(pa.array(keep)))
        return runs, pc.binary_join(lists, pa.scalar(" ", pa.large_string()))

    def _find(self, word: np.ndarray, starts: np.ndarray, ends: np.ndarray, chunk: list[int], runs: list[list]) -> None:
        """Runs of several texts, each followed by a symbol of its own."""
        parts, place = [], 0
        firsts = []
        base = 0
        top = int(word.max()) + 1
        for t in chunk:
            part = word[starts[t]:ends[t]] + base  # no word of one text is one of another
            base += top
            parts.append(part)
            firsts.append(place)
            place += len(part) + 1
        symbols = np.concatenate([np.append(p, base + i) for i, p in enumerate(parts)])
        _, symbols = np.unique(symbols, return_inverse=True)
        for start, length, period in runs_of(symbols, self.min_length, self.min_repeats):
            i = bisect_right(firsts, start) - 1
            runs[chunk[i]].append((start - firsts[i], length, period))


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, runs (array of start, length and
    period in words, by start and period), collapsed (the words joined by a
    space, without those that any run has after its first period).

    Words are what stands between ASCII white space. A run is a stretch of
    ``min_length`` words and ``min_repeats`` times its smallest period or more
    that no neighbouring word prolongs. NULL and empty texts have no runs and
    collapse to an empty string. Repeated rows and NULL ids each get their row;
    other columns are not read; an empty table gives no rows. Texts are taken
    whole, in n log n steps for n sorted words and n log² n at worst.
    """
    small_batches(docs.sparkSession)
    finder = RunFinder(min_length, min_repeats)
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for batch in batches for part in slices(batch, 1)):
            runs, collapsed = finder(batch.column(1))
            rows = [[{"start": s, "length": n, "period": p} for s, n, p in found] for found in runs]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind), collapsed.cast(pa.string())],
                                             ["doc_id", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, "
                                "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")


def run_digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (the first one of equally long ones, the
    smallest period of these; NULLs without a run), its exponent in thousandths,
    and SHA-256 of all runs and of the collapsed text."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]),
                                                               F.lit("\n"))), "")
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"), (-F.col("longest.period")).alias("period"),
        F.expr("longest.length * 1000 div -longest.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
