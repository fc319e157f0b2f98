"""Connected components as Spark joins: alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bundleflow.llm.common import materialise


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One round over edges (u, v) with u > v. Each node links what it sees to
    the smallest node it sees: in the large star the neighbours above it, in
    the small star those below it and itself. The smallest neighbour is an
    aggregate with map-side combination; the join back splits under skew."""
    seen = edges
    if large:
        seen = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = seen.groupBy("u").agg(F.min("v").alias("m"))
    low = low.select(F.col("u").alias("at"), F.least("u", "m").alias("m"))
    linked = seen.join(low, seen["u"] == low["at"])
    if large:
        out = linked.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select(F.col("at").alias("u"), F.col("m").alias("v")))
    return out.filter(F.col("u") > F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v, of one type that can be ordered; any direction,
    repeats and loops allowed) to (u, root): for each node with a link to
    another node the smallest node that it can reach. Roots have no row.

    The edge list is written to the shared folder after each pair of stars;
    only its row count and a checksum reach the driver. The number of rounds
    grows with the logarithm of the longest path.
    """
    cur = materialise(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .filter(F.col("u") > F.col("v")).distinct(), "edges")
    before = None
    while True:
        mark = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            return cur.select("u", F.col("v").alias("root"))
        before = mark
        cur = materialise(_stars(_stars(cur, True), False), "edges")
