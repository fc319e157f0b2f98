"""The durable stage table of the VM flow: one row per (tx, stage).

Rows are written after a stage's work is done, one folder per run and stage,
so a stage that is written again replaces its own rows. Where a transaction
goes on is read from here and from the markers and state files of the registry.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bundleflow.functions.records import STAGE_MARKERS, STATE_ORDER, state_rank
from bundleflow.session import read_if_there
from bundleflow.sources.files import read_stage_markers

# The stages in order, and the state a transaction is in once a number of them are done.
STAGES = tuple(s for s, _ in STAGE_MARKERS)
STATE_AFTER = ("none", "scan", "validate", "manifest", "stage", "done")

STAGE_ROWS = ("tx string, stage string, status string, place string, detail string, n_files long, n_junk long, "
              "run string, stage_no int")


def write_started(txs: DataFrame, table: str, run: str) -> None:
    """Says of new transactions that their first stage is about to run: from
    then on their source may be gone."""
    none = F.lit(None)
    (txs.select("tx", F.lit(STAGES[0]).alias("stage"), F.lit("started").alias("status"), none.cast("string").alias("place"),
                none.cast("string").alias("detail"), none.cast("long").alias("n_files"), none.cast("long").alias("n_junk"))
     .write.mode("overwrite").parquet(f"{table.rstrip('/')}/run={run}/stage_no=0"))


def write_stage(rows: DataFrame, table: str, run: str, stage: str) -> None:
    """Writes the rows of a stage (tx, status, place, detail, n_files, n_junk)."""
    no = STAGES.index(stage) + 1
    (rows.select("tx", F.lit(stage).alias("stage"), "status", "place", "detail",
                 F.col("n_files").cast("long").alias("n_files"), F.col("n_junk").cast("long").alias("n_junk"))
     .write.mode("overwrite").parquet(f"{table.rstrip('/')}/run={run}/stage_no={no}"))


def read_stages(spark: SparkSession, table: str) -> DataFrame:
    """All rows of the stage table; none where nothing was written yet."""
    rows = read_if_there(spark, table.rstrip("/"), STAGE_ROWS)
    return spark.createDataFrame([], STAGE_ROWS) if rows is None else rows


def stages_done(spark: SparkSession, table: str, registry: str | None = None) -> DataFrame:
    """(tx, done, state, unknown): how many stages of each transaction are done
    by the table, the markers (IO-6) and the state files; the state that it
    is in ('ingest' once that was begun); and the text of a state file that
    names no state. Transactions that were never begun have no row."""
    at = F.create_map(*(x for i, s in enumerate(STAGES) for x in (F.lit(s), F.lit(i + 1))))
    rows = (read_stages(spark, table).where(F.col("status").isin("started", "done"))
            .select("tx", F.when(F.col("status") == "done", F.try_element_at(at, F.col("stage"))).alias("done"),
                    F.lit(None).cast("string").alias("unknown")))
    if registry is not None and os.path.isdir(registry):
        marked = F.create_map(*(x for i, (_, m) in enumerate(STAGE_MARKERS) for x in (F.lit(m), F.lit(i + 1))))
        # a state names the stage to run next, so those before it are done; 'none' says nothing
        rank = F.when(state_rank("state") > 0, state_rank("state") - 1)
        rows = rows.unionByName(read_stage_markers(spark, registry).select(
            "tx", F.when(F.col("kind") == "marker", F.try_element_at(marked, F.col("marker"))).otherwise(rank).alias("done"),
            F.when((F.col("kind") == "state") & state_rank("state").isNull(), F.col("state")).alias("unknown"))
            .where("done IS NOT NULL OR unknown IS NOT NULL"))
    done = rows.groupBy("tx").agg(F.coalesce(F.max("done"), F.lit(0)).alias("done"), F.min("unknown").alias("unknown"))
    return done.withColumn("state", F.when(F.col("done") == 0, STAGES[0]).otherwise(
        F.element_at(F.array(*map(F.lit, STATE_AFTER)), F.col("done") + 1)))


assert set(STATE_AFTER) <= set(STATE_ORDER)
