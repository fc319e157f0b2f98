"""Stage logs: read both machines' JSONL permissively, write escaped (IO-4, IO-9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bundleflow import schemas
from bundleflow.functions.paths import with_default
from bundleflow.functions.records import JSON_KEEP_NULLS, iso_timestamp, parse_iso

# Defaults for unset or empty log fields.
LOG_DEFAULTS = {
    "tx": "none", "name": "none", "machine": "none", "action": "none", "status": "none",
    "stage": "none", "src": "", "dest": "",
}


def parse_log_lines(lines: DataFrame, *, text: str = "value") -> tuple[DataFrame, DataFrame]:
    """IO-4 core: JSONL text -> (logs, rejects).

    Only ``msg`` is escaped by the producers, so a quote in a name breaks a
    line; such lines go to ``rejects`` with their raw text. ``msg`` loses its
    trailing newline; ``ts`` is parsed from ISO-8601 with offset.
    """
    parsed = F.from_json(F.col(text), schemas.LOG_RAW_WITH_CORRUPT,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    df = lines.withColumn("_j", parsed)
    bad = F.col("_j").isNull() | F.col("_j._corrupt_record").isNotNull()
    keep = [c for c in lines.columns if c != text]
    logs = df.where(~bad).select(
        *keep,
        parse_iso(F.col("_j.ts")).alias("ts"),
        *[F.col(f"_j.{f}").alias(f) for f in schemas.LOG_FIELDS if f not in ("ts", "msg")],
        F.regexp_replace(F.col("_j.msg"), r"\n\z", "").alias("msg"),
    )
    rejects = df.where(bad).select(*keep, F.col(text).alias("raw"))
    return logs, rejects


def read_stage_logs(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """IO-4: all log files (a folder of per-tx logs or explicit files)."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_name").alias("log_file"), "value")
    return parse_log_lines(lines.where(F.trim("value") != ""))


def format_log_rows(df: DataFrame) -> DataFrame:
    """IO-9 core: one JSON line per row, defaults for unset or empty fields,
    every field escaped (a deliberate fix: the producer escaped only msg)."""
    cols = []
    for f in schemas.LOG_FIELDS:
        if f == "ts":
            c = iso_timestamp(F.col("ts")) if "ts" in df.columns else iso_timestamp(F.current_timestamp())
        elif f == "msg":
            c = F.concat(F.coalesce(F.col("msg"), F.lit("")), F.lit("\n")) if "msg" in df.columns else F.lit("\n")
        else:
            c = with_default(F.col(f) if f in df.columns else F.lit(None).cast("string"), LOG_DEFAULTS[f])
        cols.append(c.alias(f))
    return df.select(F.to_json(F.struct(*cols), JSON_KEEP_NULLS).alias("value"))


def append_log(df: DataFrame, path: str) -> None:
    """IO-9: append the rows to the log folder as JSONL text."""
    format_log_rows(df).write.mode("append").text(path)
