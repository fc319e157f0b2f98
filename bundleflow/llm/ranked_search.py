"""Ranked lexical search, reversed: the items are indexed, the documents pass.

The index of a block of items (term to the items that hold it) is small and
goes to every task. Each document's term counts are streamed through it: a
document meets only the postings of terms that it has. Every task keeps a
bounded heap of the best documents per item; the heaps of all tasks are merged
by Spark. Neither documents nor their term counts are shuffled.

Terms are cut by Arrow's kernels on the UTF-8 bytes of a whole batch: a table
maps A-Z to a-z and every ASCII byte that is no letter or digit to a space.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bundleflow.llm.common import cut_at_spaces, slices, small_batches, whole_text

#: Documents returned per item.
TOP = 20
#: A block of items ends at this many items, or at this many bytes of text
#: (an item longer than that is a block of its own).
BLOCK_ITEMS, BLOCK_BYTES = 2_000, 8 << 20
#: Postings times documents that are scored at once.
CHUNK = 1 << 22
#: Up to here a double holds every integer.
EXACT = 1 << 53

_BYTES = np.array([b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
                   for b in range(256)], np.uint8)


def split_terms(texts: pa.Array) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The terms of the texts, one text after the other, and for each text
    where its terms end."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    plain = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(np.ascontiguousarray(offsets)),
                                             pa.py_buffer(_BYTES[data]))
    return cut_at_spaces(plain)


class ItemIndex:
    """Inverted index of a block of items: for each term the items that hold
    it, and how often."""

    def __init__(self, texts: list[str | None]):
        self.items = len(texts)
        words, ends = split_terms(pa.array([t or "" for t in texts], pa.string()))
        coded = words.dictionary_encode()
        self.terms = coded.dictionary
        item = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))
        key, self.repeats = np.unique(coded.indices.to_numpy().astype(np.int64) * max(1, len(texts)) + item,
                                      return_counts=True)
        term, self.item = key // max(1, len(texts)), key % max(1, len(texts))
        self.start = np.searchsorted(term, np.arange(len(self.terms) + 1))

    def hits(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(number of terms per text, and for each pair of a text and a term of
        the index that it holds: text, term, occurrences)."""
        words, ends = split_terms(texts)
        counts = np.diff(ends, prepend=0)
        term = pc.index_in(words, value_set=self.terms).fill_null(-1).to_numpy(zero_copy_only=False)
        known = term >= 0
        key = np.repeat(np.arange(len(counts)), counts)[known] * len(self.terms) + term[known]
        key, tf = np.unique(key, return_counts=True)
        return counts, key // max(1, len(self.terms)), key % max(1, len(self.terms)), tf


class Statistics:
    """N, L and the weight of each term of an index."""

    def __init__(self, documents: int, terms: int, frequencies: np.ndarray):
        self.documents, self.terms = documents, terms
        self.weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1)))
                                for df in frequencies], np.int64)


def best_documents(index: ItemIndex, stats: Statistics, top: int,
                   batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, int | None]]]]:
    """For each item with a match the (score, document id) of its ``top`` best
    documents among those of the batches, held in one bounded heap an item."""
    heaps: list[list[tuple]] = [[] for _ in range(index.items)]
    least = np.zeros(index.items, np.int64)  # what a document must reach
    for batch in (part for batch in batches for part in slices(batch, 1)):
        ids = batch.column(0).to_pylist()
        counts, text, term, tf = index.hits(batch.column(1))
        m = np.array([75 + 25 * int(n) * stats.documents // max(1, stats.terms) for n in counts], np.int64)
        value = stats.weight[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m[text]))
        size = np.diff(index.start)[term]
        # whole texts at a time, so many that their postings stay within bounds
        reach = np.cumsum(np.bincount(text, size, len(counts)))
        first = 0
        while first < len(counts):
            done = reach[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(reach, done + CHUNK, "right")))
            a, b = np.searchsorted(text, [first, last])
            for item, doc, score in _scores(index, text[a:b] - first, term[a:b], value[a:b], last - first, least):
                entry = _entry(score, ids[first + doc])
                heap = heaps[item]
                if len(heap) < top:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
                if len(heap) == top:
                    least[item] = heap[0][0]
            first = last
    for item, heap in enumerate(heaps):
        if heap:
            yield item, [(score, None if missing else -negative) for score, missing, negative in sorted(heap, reverse=True)]


def _entry(score: int, doc_id: int | None) -> tuple[int, int, int]:
    """Greater is better: higher scores, then smaller ids, those without one last."""
    return (score, 0, -doc_id) if doc_id is not None else (score, -1, 0)


def _scores(index: ItemIndex, text: np.ndarray, term: np.ndarray, value: np.ndarray, texts: int,
            least: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(item, text, score) of those texts that reach what the item asks for."""
    start, size = index.start[term], np.diff(index.start)[term]
    total = int(size.sum())
    place = np.arange(total) + np.repeat(start - (np.cumsum(size) - size), size)
    gain = np.repeat(value, size) * index.repeats[place]
    key = np.repeat(text, size) * index.items + index.item[place]
    if float(gain.sum(dtype=np.float64)) < EXACT:
        score = np.bincount(key, gain, texts * index.items).astype(np.int64)
    else:
        score = np.zeros(texts * index.items, np.int64)
        np.add.at(score, key, gain)
    score = score.reshape(texts, index.items)
    doc, item = np.nonzero((score > 0) & (score >= least))
    yield from zip(item.tolist(), doc.tolist(), score[doc, item].tolist())


def statistics(docs: DataFrame, index: Broadcast, size: int) -> Statistics:
    """Counts over all documents: each task adds up its own and sends one row
    per term of the index, all terms being those of one block."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = terms = 0
        found = np.zeros(size, np.int64)
        for batch in (part for batch in batches for part in slices(batch, 0)):
            counts, _, term, _ = index.value.hits(batch.column(0))
            documents += int((counts > 0).sum())
            terms += int(counts.sum())
            found += np.bincount(term, minlength=size)
        held = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-2, -1], held])),
                                          pa.array(np.concatenate([[documents, terms], found[held]]))], ["term", "n"])

    rows = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    total = {r.term: r.n for r in rows}
    return Statistics(total.pop(-2, 0), total.pop(-1, 0), np.array([total.get(t, 0) for t in range(size)], np.int64))


def _blocks(items: DataFrame) -> Iterator[list]:
    """The items in blocks of bounded size; no more than one block and one
    partition of items are on the driver at a time."""
    block, size = [], 0
    for row in items.toLocalIterator():
        grown = size + len((row.text or "").encode())
        if block and (len(block) == BLOCK_ITEMS or grown > BLOCK_BYTES):
            yield block
            block, grown = [], grown - size
        block.append(row)
        size = grown
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``top`` best documents of
    each item among all documents, those with a score of 0 left out.

    Items are taken in blocks; the documents are read twice per block, once
    for the statistics and once for the scores. Terms, lower-casing and scores
    are those of the module: weight w = floor(1000 ln((2N+2) / (2df+1))) and
    w * (10^9 tf div (1000 tf + 12 m)) for each term of the item, repeats
    included, where m = 75 + 25 n N div L. Equal scores go by rising doc_id,
    NULL ids last. NULL texts have no terms. Each row of ``items`` is searched
    by itself, also where ids repeat or are NULL; repeated documents are
    ranked one by one. An item without a matching document has no rows; empty
    tables give no rows; other columns are not read. Ids of documents are integers.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    asked = items.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).alias("text"))
    parts = [_search_block(spark, texts, block, asked.schema["item_id"].dataType, top) for block in _blocks(asked)]
    if not parts:
        return docs.select(F.lit(None).cast(asked.schema["item_id"].dataType).alias("item_id"), F.lit(0).alias("rank"),
                           F.col(id_col).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).filter("false")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.select("item_id", "rank", "doc_id", "score")


def _search_block(spark: SparkSession, texts: DataFrame, block: list, id_type: T.DataType, top: int) -> DataFrame:
    index = ItemIndex([r.text for r in block])
    shared = spark.sparkContext.broadcast(index)
    stats = statistics(texts, shared, len(index.terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for item, best in best_documents(shared.value, stats, top, batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([item] * len(best), pa.int32()), pa.array([d for _, d in best], pa.int64()),
                 pa.array([s for s, _ in best], pa.int64())], ["item", "doc_id", "score"])

    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = (texts.mapInArrow(run, "item int, doc_id long, score long")
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top))
    names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(block)],
                                  T.StructType().add("item", T.IntegerType()).add("item_id", id_type))
    return best.join(names, "item")
