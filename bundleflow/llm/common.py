"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bundleflow.session import scratch_path, table  # noqa: F401  (table is re-exported)

#: Rows of an Arrow batch: with whole documents in them, the usual 10,000 rows
#: of a batch have no bound in bytes that a Python worker could rely on.
ARROW_ROWS = 500


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Arrow batches of ``rows`` rows at most, for the rest of the session."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, str(rows))


#: Bytes of text that are worked on at once in a task (a longer text is alone).
SLICE_BYTES = 8 << 20


def slices(batch: pa.RecordBatch, text: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in parts whose column ``text`` has at most ``limit`` bytes, a
    row with more being a part of its own. An empty batch has no parts."""
    size = np.cumsum(pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < len(size):
        done = size[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(size, done + limit, "right")))
        yield batch.slice(first, last - first)
        first = last


def cut_at_spaces(texts: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The words between ASCII spaces of the texts, one text after the other,
    and for each text where its words end."""
    lists = pc.ascii_split_whitespace(texts)
    words = lists.flatten()
    there = pc.greater(pc.binary_length(words), 0)
    before = np.concatenate([[0], np.cumsum(there.to_numpy(zero_copy_only=False))])
    ends = lists.offsets.to_numpy()
    return words.filter(there), before[ends[1:] - ends[0]]


def materialise(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet below ``spark.checkpoint.dir`` and read again.

    Cuts the lineage in the shared folder, so a lost executor costs no more
    than its running tasks, and every reader sees the same rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{label}")
    df.write.parquet(path)
    nullable = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in df.schema])
    return spark.read.schema(nullable).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names made from ``names`` that ``df`` has not (whatever their case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def same(a: Column, b: Column) -> Column:
    """Equality under which NULL equals NULL."""
    return a.eqNullSafe(b)


def whole_text(col: Column | str) -> Column:
    """The text, or the empty string for NULL."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only. ``lower`` does just that on text that is all
    ASCII, and much faster than ``translate``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (F.when(F.octet_length(text) == F.length(text), F.lower(text))
            .otherwise(F.translate(text, upper, upper.lower())))


def keep_rows(keyed: DataFrame, keys: list[str], keepers: DataFrame) -> DataFrame:
    """Of ``keyed``, one row for each row of ``keepers`` (the same columns
    ``keys``, no row twice); NULL keys match. Of rows that repeat all keys any
    one stays. The keys of ``keepers`` are unique, so no task gets a hot one;
    rows that repeat a key are cut to one before they are shuffled."""
    names = fresh(keyed, *(f"k{i}" for i in range(len(keys))))
    right = keepers.select(*(F.col(k).alias(n) for k, n in zip(keys, names)))
    cond = None
    for k, n in zip(keys, names):
        c = same(keyed[k], right[n])
        cond = c if cond is None else cond & c
    found = keyed.join(right, cond, "left_semi")
    return _first_of(found, keys)


#: A group with more than this part of all rows is spread over several tasks.
SPREAD = 1_000


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str) -> DataFrame:
    """``rows`` with the columns of their group; ``keys`` (never NULL) are
    unique in ``groups``, whose column ``size`` counts the group's rows. Both
    are written tables. A group of more than a thousandth of all rows, and
    there are fewer than a thousand of those, has its rows dealt to copies of
    its one row, so no task gets more of it than that part."""
    part = max(1, math.ceil(rows.count() / SPREAD))
    code, copies, salt, place = fresh(rows, "_code", "_copies", "_salt", "_place")
    large = groups.filter(F.col(size) > part).groupBy(F.xxhash64(*keys).alias(code)).agg(
        F.max(F.ceil(F.col(size) / part)).cast("int").alias(copies))
    large = F.broadcast(large)
    left = rows.withColumn(place, F.monotonically_increasing_id()).withColumn(code, F.xxhash64(*keys)).join(large, code, "left")
    left = left.withColumn(salt, F.pmod(F.col(place), F.coalesce(copies, F.lit(1))).cast("int")).drop(place, code, copies)
    right = groups.withColumn(code, F.xxhash64(*keys)).join(large, code, "left")
    right = right.withColumn(salt, F.explode(F.sequence(F.lit(0), F.coalesce(copies, F.lit(1)) - 1))).drop(code, copies)
    return left.join(right, [*keys, salt]).drop(salt)


def _first_of(df: DataFrame, keys: list[str]) -> DataFrame:
    (n,) = fresh(df, "n")
    w = Window.partitionBy(*keys).orderBy(*(F.col(k) for k in keys))
    return df.withColumn(n, F.row_number().over(w)).filter(F.col(n) == 1).drop(n)
