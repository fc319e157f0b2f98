"""Registered queries of this subpackage: one per operator, over whole tables,
and the pipeline. ``QUERIES`` and ``ORACLES`` as in the library's catalog."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bundleflow.llm import bpe, exact_dedup, hnsw, mixing, oracles, periodic_runs, pii, quality, ranked_search, simhash, token_counts, toxicity, warc, word_bpe
from bundleflow.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts, digests of the spans, and their scores."""
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    base = ("email", "ip", "card", "phone")
    return found.select("doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in pii.KINDS),
                        F.sha2(pii.span_list(base).cast("binary"), 256).alias("base_sha256"),
                        pii.span_list(pii.KINDS).alias("spans"), pii.score_list(pii.KINDS).alias("scores"))


@query
def op2_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    return hnsw.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of every page, blocks as digests."""
    records = warc.derive(warc.responses(table(spark, sf_dir, "pages")))
    return records.select(F.col("source_id").alias("page_id"), "record_type", "record_id", "refers_to", "target_uri",
                          "content_type", F.octet_length("block").cast("long").alias("content_length"),
                          "block_digest", "payload_digest", F.sha2(F.col("record").cast("binary"), 256).alias("record_sha256"))


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from the labels that are not held out."""
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the bytes they decode to, as digests."""
    encoded = bpe.encode_documents(table(spark, sf_dir, "documents"),
                                   public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.encoding_digests(encoded)


@query
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal texts among all documents: who stays, and in which group."""
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document once per block it stands in, at temperature weights."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"), target_entropy=0.5, max_repetition=4.0)
    return mixed.select("doc_id", F.col("mix_source").alias("source"), F.col("mix_tokens").alias("n_tokens"),
                        F.col("mix_block").alias("block"), F.col("mix_key").alias("block_key"),
                        F.col("mix_exponent").alias("exponent"), F.round("mix_weight", 9).alias("weight"))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learnt from the labels that are not held out."""
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram token counts of every document."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("piece_bpe_32k.model"))


def with_repeats(doc_id: Column, text: Column) -> Column:
    """The texts of operator 11's query: every tenth document by the checksum of
    its id repeats some of its words from some place on. Values are bound once
    as elements of one-element arrays."""
    h = F.crc32(doc_id.cast("string").cast("binary"))

    def repeated(words: Column) -> Column:
        n, g = F.size(words).cast("long"), F.floor(h / 10).cast("long")
        def from_place(x: Column) -> Column:
            place, period = x["place"], x["period"]
            return F.array_join(F.transform(words, lambda word, i: F.when(i < place, word).otherwise(
                F.get(words, (place + (i - place) % period).cast("int")))), " ")
        place = g % n
        values = F.struct(place.alias("place"), (1 + F.floor((n - place) / (3 + g % 8))).alias("period"))
        return F.when(n > 0, F.transform(F.array(values), from_place)[0]).otherwise("")

    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    return F.when(h % 10 == 0, F.transform(F.array(words), repeated)[0]).otherwise(text)


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", with_repeats(F.col("doc_id"), F.col("text")).alias("text"))
    return periodic_runs.run_digests(periodic_runs.find_runs(docs))


@query
def op12_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the words of every document and the text they decode to, as digests."""
    return word_bpe.encoding_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline.py over documents."""
    return corpus_pipeline.run(spark, sf_dir)


ORACLES["op1_pii"] = oracles.personal_data()
ORACLES["op6_exact_dedup"] = oracles.EXACT_DEDUP
ORACLES["op7_mixing"] = oracles.mixing(0.5, 4.0, mixing.SEED)
ORACLES["op13_ranked_search"] = oracles.RANKED_SEARCH
