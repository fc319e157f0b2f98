"""SimHash near-duplicates with a tiled exact comparison.

Fingerprints are compared tile against tile with numpy's exclusive-or and bit
counts. A tile holds fingerprints with the same population count in each of
their four 16-bit quarters. Two fingerprints that differ in r bits have
population counts that differ by r at most, summed over the quarters, so a
pair of tiles whose counts differ by more is skipped; no pair within the
radius is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bundleflow.llm.common import fresh, join_groups, keep_rows, materialise, same, small_batches, whole_text
from bundleflow.llm.components import components

SHINGLE_WORDS = 3
MAX_DISTANCE = 3
SEED = 42
#: Fingerprints in a tile, about; a fuller cell is dealt over several tiles.
TILE = 2048
#: Entries of the difference matrix that are held at once.
BLOCK = 1 << 20
#: Shingles of a text that are hashed at once.
CHUNK = 1 << 16


def fingerprint(data: bytes, n: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The fingerprint of UTF-8 ``data``: ``bytes.lower`` and ``bytes.split``
    know just A-Z and the six ASCII white-space characters. No words: 0."""
    words = data.lower().split()
    if not words:
        return 0
    total = max(len(words) - n + 1, 1)
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, CHUNK):
        part = words[at:at + CHUNK + n - 1]
        if len(words) < n:
            grams = [b" ".join(part)]
        else:
            grams = map(b" ".join, zip(*(part[i:] for i in range(n))))
        h = np.array([digest(g, seed) for g in grams], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > total, bitorder="little")
    return int.from_bytes(bits.tobytes(), "little")


def fingerprint_column(text: Column, n: int = SHINGLE_WORDS, seed: int = SEED) -> Column:
    """Fingerprint of a text column as a long with the fingerprint's 64 bits."""
    def run(data: pa.Array) -> pa.Array:
        prints = [fingerprint(x.as_py() or b"", n, seed) for x in data]
        return pa.array(np.array(prints, dtype=np.uint64).view(np.int64), pa.int64())

    return F.arrow_udf(run, T.LongType())(whole_text(text).cast("binary"))


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _cell(fp: Column) -> Column:
    """The population counts of the four quarters as digits to the base 32,
    each raised by 4, so that adding a step never carries into another digit."""
    code = F.lit(0)
    for q in range(4):
        quarter = F.shiftrightunsigned(fp, 16 * q).bitwiseAND(F.lit(0xFFFF))
        code = code + (F.bit_count(quarter) + F.lit(4)) * F.lit(32 ** q)
    return code.cast("int")


def _steps(radius: int) -> list[int]:
    """Steps between the codes of cells that can hold pairs within the radius,
    one for each direction."""
    if not 0 <= radius <= 3:
        raise ValueError("the cells are laid out for a radius from 0 to 3")
    span = range(-radius, radius + 1)
    steps = {sum(d * 32 ** q for q, d in enumerate(ds)) for ds in product(span, repeat=4)
             if sum(map(abs, ds)) <= radius}
    return sorted(s for s in steps if s >= 0)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node that each of n nodes reaches over the links (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def tile_links(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of the tiles a and b (unsigned) within the radius, as links
    from each fingerprint to the first one it is connected with inside this
    pair of tiles: at most one link a fingerprint, and the same components."""
    both = np.concatenate([a, b])
    left, right = [], []
    rows = max(1, BLOCK // max(len(b), 1))
    for at in range(0, len(a), rows):
        i, j = np.nonzero(np.bitwise_count(a[at:at + rows, None] ^ b[None, :]) <= radius)
        # what this block links, as a forest, before the next block comes
        root = _roots(len(both), i + at, j + len(a))
        nodes = np.nonzero(root != np.arange(len(both)))[0]
        left.append(nodes)
        right.append(root[nodes])
    root = _roots(len(both), np.concatenate(left), np.concatenate(right)) if left else np.arange(0)
    nodes = np.nonzero(root != np.arange(len(both)))[0]
    u, v = both[nodes], both[root[nodes]]
    return u[u != v], v[u != v]


def _tiles(prints: DataFrame, tile: int) -> DataFrame:
    """Distinct fingerprints (fp) packed into rows (cell, sub, fps). A cell's
    number of tiles follows its count; there are at most 17**4 cells, so the
    counts are small whatever the input."""
    cells = prints.withColumn("cell", _cell(F.col("fp")))
    subs = cells.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("subs"))
    return (cells.join(F.broadcast(subs), "cell")
            .withColumn("sub", F.pmod(F.xxhash64("fp"), F.col("subs")).cast("int"))
            .groupBy("cell", "sub").agg(F.collect_list("fp").alias("fps")))


def near_links(prints: DataFrame, radius: int = MAX_DISTANCE, tile: int = TILE) -> DataFrame:
    """Distinct fingerprints (fp) to links (u, v) with the same connected
    components as all pairs within ``radius`` bits have. Which tiles meet is
    known from their names alone; only then are their fingerprints copied."""
    tiles = materialise(_tiles(prints, tile), "tiles")
    cells = tiles.groupBy("cell").agg(F.max("sub").alias("last"))  # at most 17**4
    names = tiles.select("cell", F.col("sub").alias("sub_a"),
                         F.explode(F.array(*(F.lit(s) for s in _steps(radius)))).alias("step"))
    names = names.withColumn("other", F.col("cell") + F.col("step")).join(
        F.broadcast(cells.withColumnRenamed("cell", "other")), "other")
    first = F.when(F.col("step") == 0, F.col("sub_a")).otherwise(F.lit(0))
    names = names.select("cell", "sub_a", "other", F.explode(F.sequence(first, F.col("last"))).alias("sub_b"))
    left = tiles.select("cell", F.col("sub").alias("sub_a"), F.col("fps").alias("a"))
    right = tiles.select(F.col("cell").alias("other"), F.col("sub").alias("sub_b"), F.col("fps").alias("b"))
    pairs = names.join(left, ["cell", "sub_a"]).join(right, ["other", "sub_b"]).select("a", "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs = [], []
            for a, b in zip(batch.column("a"), batch.column("b")):
                u, v = tile_links(*(x.values.to_numpy(zero_copy_only=False).view(np.uint64) for x in (a, b)), radius)
                us.append(u.view(np.int64))
                vs.append(v.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for x in (us, vs)],
                ["u", "v"])

    return pairs.mapInArrow(compare, "u long, v long")


def classes(prints: DataFrame, radius: int = MAX_DISTANCE) -> DataFrame:
    """Rows (doc_id, fp) to (fp, copies, root, component_id): for each
    fingerprint its number of rows, its group, and the smallest doc_id of all rows whose fingerprints it is linked
    with, directly or through others (NULL where they have no other id)."""
    own = materialise(prints.groupBy("fp").agg(
        F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("copies")), "prints")
    roots = components(near_links(own.select("fp"), radius))
    rooted = materialise(own.join(roots, own["fp"] == roots["u"], "left").select(
        "fp", "low", "copies", F.coalesce("root", "fp").alias("root")), "rooted")
    lows = materialise(rooted.groupBy("root").agg(
        F.min("low").alias("component_id"), F.count(F.lit(1)).alias("prints")), "lows")
    found = join_groups(rooted, lows, ["root"], "prints").select("fp", "copies", "root", "component_id")
    return materialise(found, "classes")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp (long), component_id.

    NULL and empty texts have the fingerprint 0 and are linked like any other.
    Repeated rows each get their row, with the same component. NULL ids take
    part; their component_id is the smallest id of their group, or NULL when
    it has none. Other columns are not read. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    prints = materialise(docs.select(
        F.col(id_col).alias("doc_id"),
        fingerprint_column(F.col(text_col), shingle_words).alias("fp")), "fingerprints")
    found = classes(prints, max_distance)
    return join_groups(prints, found, ["fp"], "copies").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, the one with the
    smallest id (a NULL id only where the group has no other; of rows that
    repeat that id any one). All columns come back as they were."""
    small_batches(docs.sparkSession)
    (name,) = fresh(docs, "fp")
    keyed = materialise(docs.withColumn(name, fingerprint_column(F.col(text_col), shingle_words)), "keyed")
    prints = keyed.select(F.col(id_col).alias("doc_id"), F.col(name).alias("fp"))
    found = classes(prints, max_distance)
    # where ids repeat, a group's smallest id can come with several fingerprints
    own = join_groups(prints, found, ["fp"], "copies").filter(same(F.col("doc_id"), F.col("component_id")))
    keepers = own.groupBy("root").agg(F.min("fp").alias("fp"), F.min("component_id").alias("component_id"))
    keepers = keepers.select(F.col("component_id").alias(id_col), F.col("fp").alias(name))
    return keep_rows(keyed, [id_col, name], keepers).drop(name)
