"""Outcome routing (IO-12): a batch split into staged / quarantine / export
datasets plus a (src, dest) move plan. The plan is data; ``apply_moves`` is a
mover for folders that all executors see."""

from __future__ import annotations

import errno
import os
import shutil
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bundleflow.functions.paths import JUNK, classify_file


def move_plan(files: DataFrame, verdicts: DataFrame, *, bundle: str = "bundle", path: str = "rel_path",
              bundle_root: str = "bundle_root", staging: str, quarantine: str) -> DataFrame:
    """Per file: where it goes after the verdict of its bundle.

    A failed bundle goes to quarantine whole (no junk row). A passed bundle
    goes to staging as ``{bundle}.dir``; its junk files go to quarantine
    keyed by bundle and name (a deliberate fix: the producer used one path
    per bundle, so a second junk file collided). Where a column
    ``isolate_junk`` of the verdicts is False, junk stays in its bundle.
    """
    isolate = F.col("isolate_junk") if "isolate_junk" in verdicts.columns else F.lit(True)
    v = verdicts.select(bundle, "outcome", isolate.alias("_isolate"))
    f = files.join(v, bundle, "left")
    passed = F.coalesce(F.col("outcome") == "passed", F.lit(False))  # without a verdict nothing is staged
    is_junk = (classify_file(path) == JUNK) & F.col("_isolate")
    outcome = (F.when(~passed, F.lit("quarantine")).when(is_junk, F.lit("quarantine_junk"))
               .otherwise(F.lit("staged")))
    q = F.lit(quarantine.rstrip("/") + "/")
    s = F.lit(staging.rstrip("/") + "/")
    dest = (F.when(~passed, F.concat(q, F.col(bundle), F.lit("/"), F.col(path)))
            .when(is_junk, F.concat(q, F.col(bundle), F.lit(".junk/"), F.col(path)))
            .otherwise(F.concat(s, F.col(bundle), F.lit(".dir/"), F.col(path))))
    return f.select(bundle, path, outcome.alias("route"), dest.alias("dest"))


def route_output(plan: DataFrame, base: str, batch_id: int) -> None:
    """IO-12 sink: the plan by batch and route. Written again, a batch replaces
    its own rows, so a repeated job adds none."""
    (plan.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id", "route").parquet(base))


def apply_moves(plan: DataFrame, *, src: str = "src", dest: str = "dest") -> DataFrame:
    """(src, dest, status) after moving each src to its dest: 'moved',
    'already' (done before: the source is gone, the destination there),
    'exists' (never overwritten), 'missing' (neither is there), 'collision'
    (several sources for one destination: none is moved) or 'error: …'. A
    repeated task or job moves nothing twice. Evaluate the result once."""
    shared = plan.groupBy(dest).agg(F.count_distinct(src).alias("_n")).where(F.col("_n") > 1)
    rows = plan.select(src, dest).distinct().join(shared, dest, "left").select(
        F.col(src).alias("src"), F.col(dest).alias("dest"), F.col("_n").isNotNull().alias("clash"))

    def move(a: str, b: str) -> str:
        if os.path.lexists(b):
            return "exists" if os.path.lexists(a) else "already"
        if not os.path.lexists(a):
            return "missing"
        try:
            os.makedirs(os.path.dirname(b), exist_ok=True)
            try:
                os.rename(a, b)
            except OSError as e:
                if e.errno != errno.EXDEV:
                    raise
                # another file system: copied beside the destination, shown at once, then taken away here
                part = f"{b}.copying"
                if os.path.isdir(part) and not os.path.islink(part):
                    shutil.rmtree(part)
                elif os.path.lexists(part):
                    os.unlink(part)
                whole = os.path.isdir(a) and not os.path.islink(a)
                (shutil.copytree if whole else shutil.copy2)(a, part, **({"symlinks": True} if whole else {}))
                os.rename(part, b)
                (shutil.rmtree if whole else os.unlink)(a)
            return "moved"
        except OSError as e:
            return f"error: {type(e).__name__}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            status = ["collision" if clash else move(a, b) for a, b, clash in zip(pdf["src"], pdf["dest"], pdf["clash"])]
            yield pd.DataFrame({"src": list(pdf["src"]), "dest": list(pdf["dest"]), "status": status})

    return rows.mapInPandas(run, "src string, dest string, status string")
