"""Aggregations (AG-1 .. AG-7). All are groupBy aggregates, so Spark combines
map-side before the shuffle and a hot bundle costs one partial row per task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bundleflow.functions.paths import CORE, AUX, JUNK, classify_file, with_default
from bundleflow.functions.records import manifest_to_json


def manifest_entries(files: DataFrame, *, tx: str = "tx", path: str = "rel_path",
                     digest: str = "sha256") -> DataFrame:
    """Long form of the manifests: one (tx, name, hash) row per core file."""
    return (files.where(classify_file(path) == CORE)
            .select(tx, F.col(path).alias("name"), F.col(digest).alias("hash")))


def build_manifest(files: DataFrame, requests: DataFrame, *, tx: str = "tx", path: str = "rel_path",
                   digest: str = "sha256") -> DataFrame:
    """AG-1: one manifest JSON per request.

    ``{job_id, name, source, type: null, files: [{name, hash}]}`` with core
    files only, sorted by name (the producer used directory order), ``[]``
    when a request has none, and name 'unknown' when empty. Each manifest is
    one row, so a bundle's file list is assembled in one task; that list is
    the manifest itself and is bounded by the files of one bundle.
    """
    entries = manifest_entries(files, tx=tx, path=path, digest=digest)
    lists = entries.groupBy(tx).agg(
        F.sort_array(F.collect_list(F.struct("name", "hash"))).alias("files"))
    req = requests.select(tx, "name", "orig_src")
    empty = F.array().cast("array<struct<name:string,hash:string>>")
    out = req.join(lists, tx, "left").select(
        F.col(tx).alias("tx"),
        manifest_to_json(F.col(tx), with_default("name", "unknown"), F.col("orig_src"),
                         F.coalesce(F.col("files"), empty)).alias("manifest_json"),
        F.coalesce(F.size("files"), F.lit(0)).alias("n_files"),
    )
    return out


def bundle_hash_set(files: DataFrame, *, bundle: str = "bundle", digest: str = "sha256") -> DataFrame:
    """AG-2: distinct content hashes per bundle, over all files (kept long)."""
    return files.select(bundle, F.col(digest).alias("hash")).where(F.col("hash").isNotNull()).distinct()


def empty_bundles(bundles: DataFrame, files: DataFrame, *, bundle: str = "bundle") -> DataFrame:
    """AG-3: bundles without files end with action 'hash', status 'error'."""
    return (bundles.select(bundle).distinct()
            .join(files.select(bundle).distinct(), bundle, "left_anti")
            .select(bundle, F.lit("hash").alias("action"), F.lit("error").alias("status")))


def bundle_verdict(files: DataFrame, verdicts: DataFrame | None = None, *, bundle: str = "bundle",
                   path: str = "rel_path", key: str | list[str] = "doc_id") -> DataFrame:
    """AG-4: fail-closed verdict per bundle.

    First failing check decides: any infected file (scan stage), then any
    core file whose decode check failed (validation stage); the whole bundle
    is quarantined. Otherwise 'passed', and only then are junk files
    isolated. ``first_bad`` is the smallest failing path (the producer's
    witness was directory order). ``files`` may already carry ``infected``
    and ``ok``; otherwise they come from ``verdicts`` (absent means clean).
    """
    keys = [key] if isinstance(key, str) else list(key)
    f = files
    if verdicts is not None:
        one = verdicts.groupBy(*keys).agg(F.bool_or("infected").alias("infected"), F.bool_and("ok").alias("ok"))
        f = f.join(one, keys, "left")
    cls = classify_file(path)
    infected = F.coalesce(F.col("infected"), F.lit(False))
    bad_core = (cls == CORE) & ~F.coalesce(F.col("ok"), F.lit(True))
    agg = f.groupBy(bundle).agg(
        F.min(F.when(infected, F.col(path))).alias("first_infected"),
        F.min(F.when(bad_core, F.col(path))).alias("first_corrupt"),
        F.count_if(cls == CORE).alias("n_core"),
        F.count_if(cls == AUX).alias("n_aux"),
        F.count_if(cls == JUNK).alias("n_junk"),
    )
    outcome = (F.when(F.col("first_infected").isNotNull(), "infected")
               .when(F.col("first_corrupt").isNotNull(), "corrupt").otherwise("passed"))
    failed_stage = (F.when(F.col("first_infected").isNotNull(), "security")
                    .when(F.col("first_corrupt").isNotNull(), "validation"))
    return agg.select(
        bundle, outcome.alias("outcome"), failed_stage.alias("failed_stage"),
        F.coalesce("first_infected", "first_corrupt").alias("first_bad"),
        "n_core", "n_aux",
        F.when(outcome == "passed", F.col("n_junk")).otherwise(F.lit(0)).alias("n_junk_isolated"),
    )


def bundle_size(files: DataFrame, *, bundle: str = "bundle", length: str = "length") -> DataFrame:
    """AG-5: total apparent bytes of the files below a target."""
    return files.groupBy(bundle).agg(F.sum(length).cast("bigint").alias("total_bytes"))


def class_counts(files: DataFrame, *, bundle: str = "bundle", path: str = "rel_path") -> DataFrame:
    """AG-6: per bundle counts by class; ``junk > 1`` is the collision case of WN-3."""
    return (files.withColumn("class", classify_file(path))
            .groupBy(bundle).pivot("class", [CORE, AUX, JUNK]).count()
            .na.fill(0, [CORE, AUX, JUNK]))


def stage_outcomes(logs: DataFrame, keys=("machine", "stage", "status")) -> DataFrame:
    """AG-7: log rows by machine, stage, status, with rollup subtotals."""
    return logs.rollup(*keys).agg(F.count(F.lit(1)).alias("n"))
