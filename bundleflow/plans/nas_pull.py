"""NAS pull as one plan (the DC-5 flow on real folders): registry
manifests -> jq-style fields -> valid ids -> ledger -> local folder present
-> readability pass -> ledger append."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bundleflow import schemas
from bundleflow.operators import decisions as DC
from bundleflow.operators.content import fingerprint_paths
from bundleflow.session import cut_lineage, read_if_there
from bundleflow.sources.files import deal_by_bytes, list_dirs, scan_paths
from bundleflow.sources.ledger import append_ledger, read_ledger
from bundleflow.sources.manifests import read_manifests


class PullResult(NamedTuple):
    decisions: DataFrame  # (manifest_file, job_id, local_type, decision, n_files, n_unreadable)
    completed: DataFrame  # (job_id) appended to the ledger


def pull_batch(spark: SparkSession, registry: str, ledger_path: str, local_roots: dict[str, str], *,
               batch_id: int, promotion: DataFrame | None = None, write: bool = True) -> PullResult:
    """Decide every manifest of the registry and verify present jobs.

    ``local_roots``: {'movies': folder, 'shows': folder}. A job is completed
    when its folder exists and every file in it could be read and hashed
    (the digests are not compared, as in the producer); it is then recorded
    in the ledger under ``batch_id``. Jobs whose folder is missing stay
    unrecorded and are retried on the next run.
    """
    m = read_manifests(spark, registry, include_empty=True).select(
        "manifest_file", F.coalesce(F.col("job_id"), F.lit("null")).alias("job_id"), "type")
    if read_if_there(spark, ledger_path, schemas.LEDGER) is None:  # first run
        ledger = spark.createDataFrame([], "job_id string")
    else:
        ledger = read_ledger(spark, ledger_path)
    present = list_dirs(spark, local_roots).select(F.col("label").alias("type"), F.col("name").alias("job_id"),
                                                   F.concat_ws("/", "folder", "name").alias("dir"))
    dec = DC.pull_decision(m, ledger, present.select("type", "job_id"), promotion=promotion)
    todo = dec.where(F.col("decision") == DC.PULL_COMPLETED).join(
        present.select(F.col("type").alias("local_type"), "job_id", "dir"), ["local_type", "job_id"])
    # Media are read once: the decisions returned and the ledger rows come from this table.
    files = fingerprint_paths(deal_by_bytes(scan_paths(todo.select(F.col("dir").alias("path")))))
    checks = files.groupBy(F.col("bundle").alias("dir")).agg(
        F.count(F.lit(1)).alias("n_files"), F.count_if(F.col("read_error").isNotNull()).alias("n_unreadable"))
    verified = todo.join(checks, "dir", "left").select("job_id", "local_type",
                                                       F.coalesce("n_files", F.lit(0)).alias("n_files"),
                                                       F.coalesce("n_unreadable", F.lit(0)).alias("n_unreadable"))
    out = (dec.join(verified, ["job_id", "local_type"], "left")
           .withColumn("decision", F.when((F.col("decision") == DC.PULL_COMPLETED) & (F.col("n_unreadable") > 0),
                                          F.lit("unreadable")).otherwise(F.col("decision")))
           .select("manifest_file", "job_id", "local_type", "decision", "n_files", "n_unreadable"))
    out = cut_lineage(out)
    completed = out.where(F.col("decision") == DC.PULL_COMPLETED).select("job_id").distinct()
    if write:
        append_ledger(completed, ledger_path, batch_id)
    return PullResult(out, completed)
