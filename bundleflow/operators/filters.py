"""Row filters and projections over whole DataFrames (PR-3, PR-5, PR-6, PR-8,
PR-9). The column-level pieces live in :mod:`bundleflow.functions.paths`."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bundleflow.functions.paths import (basename, is_partial_or_hidden, split_drop_path, within_boundary,
                                        wrap_bundle_root)
from bundleflow.functions.records import normalize_state

# Request reject reasons, in cascade order.
REJECT_ARGUMENTS = "usage: name, path and infohash required"
REJECT_NO_SOURCE = "missing source path"
REJECT_BOUNDARY = "must originate from download directory"
REJECT_NOT_FOUND = "input does not exist"


@dataclass(frozen=True)
class Layout:
    """Folder layout of one deployment (all paths absolute)."""

    download: str = "/srv/complete"
    processing: str = "/srv/processing"
    staging: str = "/srv/staging"
    quarantine: str = "/srv/quarantine"
    registry: str = "/srv/registry"
    incoming: str = "/ready"
    export_movies: str = "/export/movies"
    export_shows: str = "/export/shows"


def validate_request(requests: DataFrame, layout: Layout, inventory: DataFrame | None = None, *,
                     state: str = "state", inv_path: str = "path") -> DataFrame:
    """PR-3: first failing check, in order: all three arguments given, path
    non-empty, path inside the download folder, and (only for a request in
    state none) the source exists in ``inventory``. Adds ``reject_reason``
    (NULL = admitted)."""
    df = requests
    if inventory is not None:
        inv = inventory.select(F.col(inv_path).alias("_p")).distinct().withColumn("_exists", F.lit(True))
        df = df.join(inv, F.col("orig_src") == F.col("_p"), "left").drop("_p")
        exists = F.coalesce(F.col("_exists"), F.lit(False))
    else:
        exists = F.lit(True)
    st = normalize_state(state) if state in requests.columns else F.lit("none")
    reason = (F.when(F.col("name").isNull() | F.col("orig_src").isNull() | F.col("tx").isNull(),
                     F.lit(REJECT_ARGUMENTS))
              .when(F.col("orig_src") == "", F.lit(REJECT_NO_SOURCE))
              .when(~within_boundary("orig_src", layout.download), F.lit(REJECT_BOUNDARY))
              .when((st == "none") & ~exists, F.lit(REJECT_NOT_FOUND)))
    out = df.withColumn("reject_reason", reason)
    return out.drop("_exists") if inventory is not None else out


def drop_filter(arrivals: DataFrame, base: str, inventory: DataFrame | None = None, *,
                path: str = "path", inv_path: str = "path") -> DataFrame:
    """PR-5: drop arrivals whose relative name starts with '.', ends '.part'
    or '.tmp', or (with ``inventory``) no longer exists. Only the first
    character of the relative name is tested, so 'a/.b' is kept."""
    folder, name = split_drop_path(path, base)
    df = arrivals.withColumn("folder", folder).withColumn("name", name).where(~is_partial_or_hidden("name"))
    if inventory is not None:
        inv = inventory.select(F.col(inv_path).alias(path)).distinct()
        df = df.join(inv, path, "left_semi")
    return df


def directories_only(arrivals: DataFrame, *, is_dir: str = "is_dir") -> DataFrame:
    """PR-6: keep arrivals that are directories; the rest are ignored silently."""
    return arrivals.where(F.coalesce(F.col(is_dir), F.lit(False)))


def derive_paths(requests: DataFrame, layout: Layout, *, tx: str = "tx", src: str = "orig_src") -> DataFrame:
    """PR-8: processing, stage, quarantine, manifest, state and log paths."""
    base = basename(src)
    reg = F.lit(layout.registry.rstrip("/") + "/")
    return requests.select(
        "*",
        base.alias("basename"),
        F.concat(F.lit(layout.processing.rstrip("/") + "/"), base).alias("proc_path"),
        F.concat(F.lit(layout.staging.rstrip("/") + "/"), base, F.lit(".dir")).alias("stage_path"),
        F.concat(F.lit(layout.quarantine.rstrip("/") + "/"), base).alias("quar_path"),
        F.concat(reg, F.col(tx), F.lit(".json")).alias("manifest_path"),
        F.concat(reg, F.col(tx), F.lit(".state")).alias("state_path"),
    )


def normalize_bundle(df: DataFrame, *, path: str = "proc_path", is_dir: str = "is_dir") -> DataFrame:
    """PR-9: a single-file source is wrapped into ``{name}.dir``; the file's
    relative name is then its basename. Directories stay as they are."""
    return (df.withColumn("bundle_root", wrap_bundle_root(path, is_dir))
            .withColumn("wrapped_rel_path", F.when(~F.col(is_dir), basename(path))))
