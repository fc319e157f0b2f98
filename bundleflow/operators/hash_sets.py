"""Containment of hash sets as bitmaps (SC-6, AG-2).

All hashes are numbered once. A set is then rows of (set, bucket, bitmap),
32,768 numbers a bucket, so no row or task holds a whole set; sets that share
a hash by the million cost one bit each. A set contains another one when, in
every bucket of the smaller, as many bits are in both as in the smaller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bundleflow.operators.ordering import sequence_within


def number_hashes(*sets: DataFrame, hash_: str = "hash") -> DataFrame:
    """(hash, n): every distinct hash that is not NULL, numbered from 1."""
    every = sets[0].select(F.col(hash_).alias("hash"))
    for other in sets[1:]:
        every = every.unionByName(other.select(F.col(hash_).alias("hash")))
    return sequence_within(every.where(F.col("hash").isNotNull()).distinct(), [], ["hash"], out="n")


def as_bitmaps(sets: DataFrame, numbers: DataFrame, *, key: str, hash_: str = "hash") -> DataFrame:
    """(key, bucket, bits) of long sets (key, hash). Bitmaps of a bucket are
    combined before the shuffle, so a hot set costs each task one row a bucket."""
    rows = sets.select(F.col(key), F.col(hash_).alias("hash")).join(numbers, "hash")
    return rows.groupBy(key, F.bitmap_bucket_number("n").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bits"))


def contained_sets(pairs: DataFrame, smaller: DataFrame, larger: DataFrame, *, small_key: str, large_key: str,
                   hash_: str = "hash") -> DataFrame:
    """SC-6 for given pairs of sets: ``pairs`` (small_key, large_key) with
    ``contained``. ``smaller`` (small_key, hash) and ``larger`` (large_key,
    hash) are long. A set without rows is contained in every set; one with a
    NULL hash in none."""
    numbers = number_hashes(smaller, larger, hash_=hash_)
    need = pairs.select(small_key, large_key).distinct().join(as_bitmaps(smaller, numbers, key=small_key, hash_=hash_), small_key)
    have = as_bitmaps(larger, numbers, key=large_key, hash_=hash_)
    both = need.select(small_key, large_key, "bucket", "bits", F.lit(0).alias("side")).unionByName(
        need.drop("bits").join(have, [large_key, "bucket"]).select(small_key, large_key, "bucket", "bits", F.lit(1).alias("side")))
    buckets = both.groupBy(small_key, large_key, "bucket").agg(
        F.bitmap_count(F.bitmap_and_agg("bits")).alias("shared"), F.max("side").alias("met"),
        F.max(F.when(F.col("side") == 0, F.bitmap_count("bits"))).alias("wanted"))
    missing = (buckets.where((F.col("met") == 0) | (F.col("shared") < F.col("wanted"))).select(small_key, large_key)
               .unionByName(pairs.select(small_key, large_key).join(
                   smaller.where(F.col(hash_).isNull()).select(small_key).distinct(), small_key)
                   .select(small_key, large_key)).distinct().withColumn("_missing", F.lit(True)))
    return (pairs.join(missing, [small_key, large_key], "left")
            .withColumn("contained", F.col("_missing").isNull()).drop("_missing"))


def incomplete_sets(files: DataFrame, *, bundle: str = "bundle", digest: str = "sha256") -> DataFrame:
    """Bundles with a file that has no digest: their hash set (AG-2) is only a
    part of them, so promotion must treat them as unreadable."""
    return files.where(F.col(digest).isNull()).select(bundle).distinct()
