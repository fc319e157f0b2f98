"""Legacy drop watcher as data work on real folders: arrivals -> partial
and hidden names dropped -> size samples of each target -> stability ->
decision -> move plan and (folder, name) ledger rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bundleflow.operators import decisions as DC
from bundleflow.operators.aggregates import bundle_size
from bundleflow.operators.ordering import stable_targets
from bundleflow.session import cut_lineage
from bundleflow.sources.files import scan_paths


def sample_sizes(targets: DataFrame, *, path: str = "path", reading: int | None = None) -> DataFrame:
    """One size sample per target: the apparent bytes of every regular file
    below it (a file target is its own size), read on the executors. Targets
    that no longer exist give no row. ``ts`` is the sampling time; ``reading``
    (when given) numbers the round. The sample is taken when called (it is
    checkpointed into the shared folder), not when a later plan reads it."""
    walked = scan_paths(targets.select(F.col(path).alias("path")).distinct())
    sizes = bundle_size(walked).select(F.col("bundle").alias("target"), "total_bytes")
    out = sizes.select("target", F.current_timestamp().alias("ts"), F.col("total_bytes").alias("size"))
    if reading is not None:
        out = out.withColumn("event_id", F.lit(reading).cast("long"))
    # A sample is the state of the disk now: materialise it at call time.
    return cut_lineage(out)


def drop_batch(arrivals: DataFrame, samples: DataFrame, base: str, dest_base: str, *,
               ledger: DataFrame | None = None, dest_inventory: DataFrame | None = None,
               rounds: int = 3, max_samples: int = 100) -> DataFrame:
    """DC-6 over a batch of arrival events with the size samples taken so
    far. A target that left no sample in the latest round counts as removed
    while waiting. Returns the decisions with the move (src, dest)."""
    stab = stable_targets(samples, rounds=rounds, max_samples=max_samples)
    last = samples.agg(F.max("event_id").alias("r")).first()["r"]
    present = samples.where(F.col("event_id") == F.lit(last)).select(F.col("target").alias("path")).distinct()
    dec = DC.drop_decision(arrivals, base, ledger=ledger, existing=present, dest_inventory=dest_inventory,
                           stability=stab, dest_base=dest_base)
    return dec.select("path", "folder", "name", "decision", "stability", "unstable_warning", "dest")
