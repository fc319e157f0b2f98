"""Ledgers of completed work and request intake (IO-5, IO-7, IO-10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bundleflow import schemas
from bundleflow.session import read_if_there


def read_ledger(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """IO-5: set of completed job ids.

    ``fmt='text'``: one id per line (the pull side's file); ``'done_files'``:
    a folder of ``{job}.done`` files (the host side; the id is the name);
    ``'parquet'``: the table written by :func:`append_ledger`.
    """
    if fmt == "text":
        df = spark.read.text(path).select(F.trim("value").alias("job_id"))
    elif fmt == "done_files":
        from bundleflow.sources.files import list_names  # markers may be empty files
        df = list_names(spark, path, (".done",)).select(
            F.regexp_extract("file_name", r"^(.*)\.done\z", 1).alias("job_id"))
    else:
        df = dedupe_ledger(spark.read.schema(schemas.LEDGER).parquet(path)).select("job_id")
    return df.where(F.col("job_id").isNotNull() & (F.col("job_id") != "")).distinct()


def dedupe_ledger(ledger: DataFrame) -> DataFrame:
    """A replayed batch may append an id twice; the first batch wins."""
    return ledger.groupBy("job_id").agg(F.min("batch_id").alias("batch_id"))


def ledger_append_rows(ledger: DataFrame, new_ids: DataFrame, batch_id: int) -> DataFrame:
    """IO-10 core: ids not yet recorded, tagged with the batch id."""
    fresh = new_ids.select("job_id").distinct().join(ledger.select("job_id"), "job_id", "left_anti")
    return fresh.withColumn("batch_id", F.lit(batch_id).cast("bigint"))


def append_ledger(new_ids: DataFrame, path: str, batch_id: int) -> None:
    """IO-10: record job ids after their work succeeded. Idempotent per
    batch: rows of a batch that was already written are not appended again,
    and readers dedupe on job id."""
    spark = new_ids.sparkSession
    existing = read_if_there(spark, path, schemas.LEDGER)
    if existing is not None and not existing.where(F.col("batch_id") == batch_id).isEmpty():
        return
    rows = (new_ids.select("job_id").distinct().withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            if existing is None else ledger_append_rows(existing, new_ids, batch_id))
    rows.write.mode("append").parquet(path)


def read_requests(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """IO-7: one row per completed download: (name, orig_src, tx)."""
    reader = spark.read.schema(schemas.REQUEST)
    if fmt == "csv":
        return reader.option("header", "true").csv(path)
    if fmt == "parquet":
        return reader.parquet(path)
    return reader.json(path)
