"""Exact duplicates by content-defined chunk recipes.

A text is cut where its content says so, so equal texts give equal chunks. The
chunks of all texts are brought together once and compared as a whole, which
verifies that no two of them share an identifier; after that a text is its
recipe, the ordered list of its chunks' identifiers, and only recipes are
grouped and joined. A long text is never moved a second time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bundleflow.llm.common import ascii_lower, fresh, join_groups, keep_rows, materialise, same, whole_text

#: A chunk ends at the first border after 256 characters: a line's end, the end
#: of a sentence, or a space between two letters of these classes; without a
#: border it ends after 2,048 characters. The last branch takes the rest.
CHUNK_PATTERN = r"(?s).{256,2048}?(?:\n|[.!?;:] |[aeimnqu] (?=[acfgkpqt]))|.{1,2048}"


def normalise(text: Column) -> Column:
    """NULL as empty; A-Z in lower case."""
    return ascii_lower(whole_text(text))


def chunks(norm: Column) -> Column:
    """The chunks of a text in order; joined they are the text."""
    return F.regexp_extract_all(norm, F.lit(CHUNK_PATTERN), F.lit(0))


def shared_identifiers(parts: DataFrame) -> DataFrame:
    """Of chunks (ident, chunk), repeats allowed, those distinct ones whose
    identifier stands for another chunk too, numbered from 1 within it. Chunks
    are compared by their whole text; repeats meet before the shuffle."""
    distinct = parts.select("ident", "chunk").distinct()
    several = materialise(distinct.groupBy("ident").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("ident"), "idents")
    rank = F.row_number().over(Window.partitionBy("ident").orderBy("chunk"))
    if several.isEmpty():  # no chunk is moved again
        return several.select("ident", F.lit("").alias("chunk"), F.lit(0).alias("nth"))
    return parts.join(several, "ident", "left_semi").distinct().withColumn("nth", rank)


def recipes(docs: DataFrame, id_col: str, text_col: str,
            identify: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_sha256, recipe, exceptions.

    ``recipe`` lists the identifiers of the chunks, ``exceptions`` tells chunks
    apart that share one (pos:nth, comma-joined; empty for all but a handful of
    texts, if any). Two texts are equal if and only if both are equal.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), normalise(F.col(text_col)).alias("norm"))
    parts = base.select(F.explode(chunks(F.col("norm"))).alias("chunk"))
    shared = materialise(shared_identifiers(parts.select(identify(F.col("chunk")).alias("ident"), "chunk")), "shared")
    rows = base.select("doc_id", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
                       F.transform(chunks(F.col("norm")), lambda c: identify(c)).alias("recipe"))
    if shared.isEmpty():
        return rows.withColumn("exceptions", F.lit(""))
    places = base.select(F.sha2(F.col("norm").cast("binary"), 256).alias("sha"),
                         F.posexplode(chunks(F.col("norm"))).alias("pos", "chunk"))
    places = places.withColumn("ident", identify(F.col("chunk"))).join(shared, ["ident", "chunk"]).distinct()
    marks = places.groupBy("sha").agg(F.array_join(F.transform(
        F.sort_array(F.collect_set(F.struct("pos", "nth"))),
        lambda x: F.concat_ws(":", x["pos"], x["nth"])), ",").alias("exceptions"))
    return (rows.join(marks, F.col("text_sha256") == F.col("sha"), "left").drop("sha")
            .withColumn("exceptions", F.coalesce("exceptions", F.lit(""))))


def _groups(rows: DataFrame) -> DataFrame:
    """Groups of equal recipes: (recipe, exceptions), keep_id, group_size, and
    the digest that the group's texts share. Rows of a group meet before the
    shuffle."""
    return rows.groupBy("recipe", "exceptions").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"), F.max("text_sha256").alias("text_sha256"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     identify: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after A-Z are lower-cased; NULL
    counts as empty, and empty texts are equal. ``keep_id`` is the largest
    doc_id of the group, NULL ids counting as the smallest. Rows that repeat
    both that id and the text are one kept document: each of them says kept.
    Other columns are not read; an empty table gives no rows.
    """
    rows = materialise(recipes(docs, id_col, text_col, identify), "recipes")
    found = materialise(_groups(rows).drop("text_sha256"), "groups")
    joined = join_groups(rows, found, ["recipe", "exceptions"], "group_size")
    return joined.select("doc_id", "keep_id", "group_size", same(F.col("doc_id"), F.col("keep_id")).alias("kept"), "text_sha256")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts: that with the largest
    id (of rows that repeat that id any one). All columns come back as they
    were; NULL texts count as empty, NULL ids as the smallest. Recipes decide
    which texts are equal; the digest only tells rows of one id apart."""
    found = _groups(recipes(docs, id_col, text_col))
    (sha,) = fresh(docs, "sha")
    keyed = docs.withColumn(sha, F.sha2(normalise(F.col(text_col)).cast("binary"), 256))
    keepers = found.select(F.col("keep_id").alias(id_col), F.col("text_sha256").alias(sha)).distinct()
    return keep_rows(keyed, [id_col, sha], keepers).drop(sha)
