"""VM ingestion as one plan over all pending transactions (DC-3).

read requests -> admit -> state -> classify -> signature scan -> verdicts ->
fail-closed bundle verdict -> manifest -> route. Every stage is a filter or
join on DataFrames; failing transactions drop to quarantine and the rest
move on, with no per-transaction loop on the driver.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bundleflow.operators import aggregates as AG
from bundleflow.operators.content import flag_signatures
from bundleflow.functions.records import STATE_ORDER, next_state, normalize_state, state_rank
from bundleflow.operators.filters import Layout

STATE_RANK = {s: i for i, s in enumerate(STATE_ORDER)}
# Fixed value: the reject text of a transaction whose bundle is in none of its places.
REJECT_NOWHERE = "context hydration failed: cannot resolve FILE_PATH"


class IngestResult(NamedTuple):
    results: DataFrame    # one row per tx: outcome, final state, destination
    manifests: DataFrame  # (tx, manifest_json, n_files) for passed transactions
    routes: DataFrame     # per file move plan
    logs: DataFrame       # stage log rows, as the producer writes them


# Per stage, (log stage word, action) in stage order.
STAGE_LOG = (("ingest", "ingest"), ("security", "scan"), ("validation", "validate"),
             ("metadata", "manifest"), ("export", "stage"))


def advance_batch(files: DataFrame, requests: DataFrame, verdicts: DataFrame | None = None, *,
                  deny_digests: DataFrame | None = None, patterns: DataFrame | None = None,
                  layout: Layout = Layout(), key: str | list[str] = "doc_id", done: DataFrame | None = None,
                  states: DataFrame | None = None, locations: DataFrame | None = None) -> IngestResult:
    """DC-3: run pending transactions through ingest, scan, validate,
    manifest and stage.

    ``files``: (tx, rel_path, content, sha256, <key>); ``requests``: (tx,
    name, orig_src); ``verdicts``: (<key>, infected, ok); ``done``: tx
    already finished (state done is final, so they are left out before any
    lookup — a deliberate fix); ``states``: (tx, state) stored state of
    each request. A transaction resumes from its own state: stages already
    marked done are skipped (scan done: no signature verdict; validate
    done: no decode verdict, junk was isolated before; manifest done: none is
    built again), a tx in state 'done' is left out, and one in an unknown
    state is rejected (outcome 'rejected', no file is touched).

    ``locations``: (tx, location), where the bundle of each tx is now. A tx
    that was found nowhere is rejected; one whose folder holds no file passes
    with an empty manifest. Without ``locations`` a tx is found if it has
    files. No verdict is ever filled in for a tx that nobody looked at.
    """
    rejected = None
    if states is not None:
        st = states.select("tx", normalize_state("state").alias("_state"))
        # An unknown state stops its transaction: nothing of it is scanned or moved.
        rejected = st.where(next_state("_state").isNull() & (F.col("_state") != "done")).select("tx", "_state").distinct()
        gone = rejected.select("tx").distinct()
        rejected = requests.join(rejected, "tx").select(
            "tx", F.lit("state").alias("failed_stage"), F.concat(F.lit("unknown state: "), F.col("_state")).alias("first_bad"),
            F.col("_state").alias("final_state"))
        requests = requests.join(gone, "tx", "left_anti")
        files = files.join(gone, "tx", "left_anti")
        finished = st.where(F.col("_state") == "done").select("tx")
        done = finished if done is None else done.select("tx").unionByName(finished)
    if done is not None:
        requests = requests.join(done.select("tx").distinct(), "tx", "left_anti")
        files = files.join(done.select("tx").distinct(), "tx", "left_anti")
    found = (files.select("tx") if locations is None else
             locations.where(F.col("location").isNotNull()).select("tx")).distinct()
    lost = requests.select("tx").join(found, "tx", "left_anti")
    if states is not None:
        lost = lost.join(st, "tx", "left").withColumn("_state", F.coalesce("_state", F.lit("none")))
    else:
        lost = lost.withColumn("_state", F.lit("none"))
    lost = lost.select("tx", F.lit("ingest").alias("failed_stage"), F.lit(REJECT_NOWHERE).alias("first_bad"),
                       F.col("_state").alias("final_state"))
    rejected = lost if rejected is None else rejected.unionByName(lost)
    requests = requests.join(found, "tx", "left_semi")
    f = flag_signatures(files, deny_digests, patterns, path="path" if "path" in files.columns else None)
    if verdicts is not None:
        keys = [key] if isinstance(key, str) else list(key)
        v = verdicts.groupBy(*keys).agg(F.bool_or("infected").alias("_vi"), F.bool_and("ok").alias("ok"))
        f = f.join(v, keys, "left")
        f = f.withColumn("infected", F.col("flagged") | F.coalesce(F.col("_vi"), F.lit(False))).drop("_vi")
    else:
        f = f.withColumn("infected", F.col("flagged")).withColumn("ok", F.lit(None).cast("boolean"))
    if states is not None:
        # Resume: a stage whose marker exists is not run again.
        f = (f.join(st, "tx", "left")
             .withColumn("_rank", F.coalesce(state_rank("_state"), F.lit(0)))
             .withColumn("infected", F.col("infected") & (F.col("_rank") < STATE_RANK["validate"]))
             .withColumn("ok", F.when(F.col("_rank") >= STATE_RANK["manifest"], F.lit(True)).otherwise(F.col("ok")))
             .drop("_state", "_rank"))
    verdict = AG.bundle_verdict(f.withColumnRenamed("tx", "bundle"), None).withColumnRenamed("bundle", "tx")
    # Every request left was found: one without a verdict has a folder without files.
    verdict = requests.select("tx").join(verdict, "tx", "left").fillna(
        {"outcome": "passed", "n_core": 0, "n_aux": 0, "n_junk_isolated": 0})
    if states is not None:
        verdict = verdict.join(st.withColumn("_rank", F.coalesce(state_rank("_state"), F.lit(0))), "tx", "left").drop("_state")
    else:
        verdict = verdict.withColumn("_rank", F.lit(0))
    verdict = verdict.withColumn("_rank", F.coalesce("_rank", F.lit(0)))
    early = F.col("_rank") < STATE_RANK["manifest"]
    verdict = (verdict.withColumn("n_junk_isolated", F.when(early, F.col("n_junk_isolated")).otherwise(F.lit(0)))
               .withColumn("isolate_junk", early))

    passed_tx = verdict.where((F.col("outcome") == "passed") & (F.col("_rank") <= STATE_RANK["manifest"])).select("tx")
    core = AG.manifest_entries(files).join(passed_tx, "tx", "left_semi")
    manifests = AG.build_manifest(files.join(passed_tx, "tx", "left_semi"), requests.join(passed_tx, "tx", "left_semi"))
    listed = (passed_tx.join(core.groupBy("tx").agg(F.count(F.lit(1)).alias("n_files")), "tx", "left")
              .fillna({"n_files": 0}))
    q = layout.quarantine.rstrip("/") + "/"
    s = layout.staging.rstrip("/") + "/"
    results = (verdict.join(listed, "tx", "left")
               .select("tx", "outcome", "failed_stage", "first_bad",
                       F.when(F.col("outcome") == "passed", "done").otherwise("quarantined").alias("final_state"),
                       F.when(F.col("outcome") == "passed", F.concat(F.lit(s), "tx", F.lit(".dir")))
                        .otherwise(F.concat(F.lit(q), "tx")).alias("dest"),
                       F.col("n_files").alias("n_manifest_files"), "n_junk_isolated"))
    from bundleflow.sources.routing import move_plan
    routes = move_plan(files.join(found, "tx", "left_semi").withColumnRenamed("tx", "bundle"), verdict.withColumnRenamed("tx", "bundle"),
                       staging=layout.staging, quarantine=layout.quarantine)
    start = None
    if states is not None:
        start = st.select("tx", F.coalesce(state_rank("_state"), F.lit(0)).alias("_state_rank"))
    logs = stage_logs(results, requests, start)
    results = results.unionByName(rejected.select(
        "tx", F.lit("rejected").alias("outcome"), "failed_stage", "first_bad", "final_state",
        F.lit(None).cast("string").alias("dest"), F.lit(None).cast("long").alias("n_manifest_files"),
        F.lit(0).cast("long").alias("n_junk_isolated")))
    return IngestResult(results, manifests, routes, logs)


def locate(requests: DataFrame, layout: Layout) -> DataFrame:
    """JN-8 on real folders: ``requests`` with location, location_kind and
    ``at_source`` (the source exists). Each distinct place that a request may
    be at is looked up once, by executor tasks."""
    from bundleflow.functions.paths import wrap_bundle_root
    from bundleflow.operators.filters import derive_paths
    from bundleflow.operators.matching import flag_existing, hydrate_location
    from bundleflow.session import cut_lineage
    from bundleflow.sources.files import existing_paths

    derived = derive_paths(requests, layout)
    options = derived.select(F.explode(F.array("proc_path", wrap_bundle_root("proc_path", F.lit(False)), "stage_path",
                                               "orig_src")).alias("path"))
    there = cut_lineage(existing_paths(options.where(F.coalesce("path", F.lit("")) != "").distinct()))
    placed = hydrate_location(derived, there)
    return flag_existing(placed, there, "orig_src", "path", "at_source").select(
        *requests.columns, "proc_path", "stage_path", "quar_path", "location", "location_kind", "at_source")


def stage_logs(results: DataFrame, requests: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """Log rows per tx: each stage reached logs 'running' and its end status;
    the failing stage ends 'failed' and later stages log nothing. Stages
    skipped on resume (``start``: tx, state rank) log a single 'running'
    row, as the producer does when a marker says the stage is done."""
    failed_rank = (F.when(F.col("failed_stage") == "security", 2)
                   .when(F.col("failed_stage") == "validation", 3).otherwise(99))
    stages = F.array(*[F.struct(F.lit(i + 1).alias("rank"), F.lit(st).alias("stage"), F.lit(act).alias("action"))
                       for i, (st, act) in enumerate(STAGE_LOG)])
    r = results.join(requests.select("tx", "name"), "tx", "left").withColumn("_fr", failed_rank)
    if start is not None:
        # a stored state's rank is the number of the stage that it resumes at
        r = r.join(start, "tx", "left").withColumn("_from", F.greatest(F.coalesce("_state_rank", F.lit(1)), F.lit(1)))
    else:
        r = r.withColumn("_from", F.lit(1))
    rows = r.select("tx", "name", "_fr", "_from", F.explode(stages).alias("s")).where(F.col("s.rank") <= F.col("_fr"))
    end_ok = (F.when(F.col("s.stage").isin("security", "validation"), "passed").otherwise("success"))
    end = F.when(F.col("s.rank") == F.col("_fr"), F.lit("failed")).otherwise(end_ok)
    both = F.when(F.col("s.rank") < F.col("_from"), F.array(F.lit("running"))).otherwise(F.array(F.lit("running"), end))
    return rows.select("tx", "name", F.lit("vm").alias("machine"), F.col("s.action").alias("action"),
                       F.col("s.stage").alias("stage"), F.explode(both).alias("status"))


def ingest_requests(requests: DataFrame, layout: Layout, *, registry: str | None = None,
                    verdicts: DataFrame | None = None, deny_digests: DataFrame | None = None,
                    patterns: DataFrame | None = None, states: DataFrame | None = None):
    """The VM flow for a batch of requests on real files.

    Admission (PR-3), the place where each bundle is now (JN-8: processing,
    staging or source; a transaction found nowhere is rejected), the walk of
    that place on the executors (a single file becomes a bundle holding it), SHA-256 and patterns of all files by path, the stage
    cascade of :func:`advance_batch` (``verdicts`` keyed by (tx, rel_path)),
    and, with ``registry``, publication of each passed manifest as
    ``{tx}.json`` written entry by entry. Returns (admission, IngestResult,
    publish statuses or None).
    """
    from bundleflow.functions.paths import CORE, classify_file
    from bundleflow.operators.content import fingerprint_paths
    from bundleflow.operators.filters import validate_request
    from bundleflow.session import cut_lineage
    from bundleflow.sources.files import deal_by_bytes, scan_paths
    from bundleflow.sources.manifests import stream_manifests

    if states is not None and "state" not in requests.columns:
        requests = requests.join(states.groupBy("tx").agg(F.min("state").alias("state")), "tx", "left")
    placed = cut_lineage(locate(requests, layout))
    at_source = placed.where(F.col("at_source")).select(F.col("orig_src").alias("path"))
    admission = validate_request(requests, layout, at_source)
    admitted = admission.where(F.col("reject_reason").isNull()).select("tx", "name", "orig_src")
    locations = placed.join(admitted.select("tx"), "tx", "left_semi").select("tx", "location")
    walked = scan_paths(locations.where(F.col("location").isNotNull()).select(F.col("location").alias("path")).distinct())
    files = (walked.join(locations.select("tx", F.regexp_replace("location", "/+\\z", "").alias("bundle")), "bundle")
             .select("tx", "rel_path", "path", "length"))
    # Every file is hashed, as the deny list covers aux and junk files too, and
    # read once: all outputs start from this table. Files are dealt by bytes.
    hashed = cut_lineage(fingerprint_paths(deal_by_bytes(files)))
    core = hashed.where(classify_file("rel_path") == CORE)
    hashed = hashed.withColumn("content", F.lit(None).cast("string"))
    if verdicts is not None:
        verdicts = verdicts.select("tx", "rel_path", "infected", "ok")
    res = advance_batch(hashed, admitted, verdicts, deny_digests=deny_digests, patterns=patterns,
                        layout=layout, key=["tx", "rel_path"], states=states, locations=locations)
    # A core file that cannot be hashed stops its transaction at the manifest
    # stage: no manifest, nothing moves, the state stays 'manifest'.
    broken = core.where(F.col("read_error").isNotNull()).select("tx").distinct().withColumn("_broken", F.lit(True))
    passed_ok = (F.col("outcome") == "passed") & F.col("_broken").isNotNull()
    results = (res.results.join(broken, "tx", "left")
               .withColumn("failed_stage", F.when(passed_ok, F.lit("metadata")).otherwise(F.col("failed_stage")))
               .withColumn("final_state", F.when(passed_ok, F.lit("manifest")).otherwise(F.col("final_state")))
               .withColumn("n_manifest_files", F.when(passed_ok, F.lit(None)).otherwise(F.col("n_manifest_files")))
               .withColumn("outcome", F.when(passed_ok, F.lit("unreadable")).otherwise(F.col("outcome")))
               .drop("_broken"))
    routes = res.routes.join(broken.select(F.col("tx").alias("bundle")), "bundle", "left_anti")
    ended = results.where(F.col("outcome") == "unreadable").select("tx").withColumn("_ended", F.lit(True))
    logs = (res.logs.join(ended, "tx", "left")
            .where(F.col("_ended").isNull() | (F.col("stage") != "export"))
            .withColumn("status", F.when(F.col("_ended").isNotNull() & (F.col("stage") == "metadata")
                                         & (F.col("status") == "success"), F.lit("failed")).otherwise(F.col("status")))
            .drop("_ended"))
    res = IngestResult(results, res.manifests.join(broken.select("tx"), "tx", "left_anti"), routes, logs)
    published = None
    if registry is not None:
        passed = res.results.where(F.col("outcome") == "passed").select("tx")
        from bundleflow.operators.aggregates import manifest_entries
        published = stream_manifests(manifest_entries(hashed.join(passed, "tx", "left_semi")),
                                     admitted.join(passed, "tx", "left_semi"), registry)
    return admission, res, published
