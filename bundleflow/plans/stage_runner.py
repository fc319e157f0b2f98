"""The VM flow on real files, stage by stage, with a durable stage table (DC-3).

Each of the five stages is one set operation over all transactions that have
reached it: decide, move, publish, then write the stage's rows and log. A run
that ends anywhere is taken up by the next one: every transaction goes on from
its own state (stage table, markers, state files) at the place where its
bundle is now. What a stage had done before it was written down is found done:
moves and manifests are not repeated.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bundleflow.functions.paths import CORE, JUNK, classify_file, wrap_bundle_root
from bundleflow.operators.aggregates import manifest_entries
from bundleflow.operators.content import fingerprint_paths, flag_signatures
from bundleflow.operators.filters import Layout, validate_request
from bundleflow.operators.matching import marker_consistency
from bundleflow.plans.vm_ingest import REJECT_NOWHERE, STAGE_LOG, locate
from bundleflow.session import cut_lineage
from bundleflow.sources.files import deal_by_bytes, existing_paths, scan_paths
from bundleflow.sources.logs import format_log_rows
from bundleflow.sources.manifests import stream_manifests
from bundleflow.sources.routing import apply_moves
from bundleflow.sources.stages import STAGES, STATE_AFTER, read_stages, stages_done, write_stage, write_started

_OUTCOME = "tx string, status string, place string, detail string, n_files long, n_junk long"


class StageRun(NamedTuple):
    admission: DataFrame     # the requests with reject_reason (NULL: admitted) and their place
    stages: DataFrame        # rows of the stage table that this run wrote
    states: DataFrame        # (tx, state) of all requests after the run
    inconsistent: DataFrame  # (tx, marker): stages said to be done whose bundle is nowhere (JN-9)


def run_stages(requests: DataFrame, layout: Layout, *, stage_table: str, log_dir: str | None = None,
               verdicts: DataFrame | None = None, deny_digests: DataFrame | None = None,
               patterns: DataFrame | None = None, stop_after: str | None = None) -> StageRun:
    """Runs every request (tx, name, orig_src) from where it stands to the
    end, or up to and including the stage ``stop_after``.

    ``verdicts``: (tx, rel_path, infected, ok). Folders of ``layout`` must be
    seen by all executors. A transaction ends, and its state stays at the
    stage, where that stage fails: infected or undecodable bundles are moved
    to quarantine whole; a core file that cannot be read, a manifest of other
    content or a destination already there leave the bundle where it is. A
    bundle that is in none of its places is rejected and nothing is published
    for it. Ids are unique: of repeated requests of a tx the first by name and
    source counts.
    """
    spark = requests.sparkSession
    run = uuid.uuid4().hex[:12]
    known = cut_lineage(stages_done(spark, stage_table, layout.registry))
    first = F.min(F.struct("name", "orig_src"))
    asked = requests.groupBy("tx").agg(first.alias("r")).select("tx", "r.name", "r.orig_src")
    asked = asked.join(known, "tx", "left").withColumn("done", F.coalesce("done", F.lit(0))).withColumn(
        "state", F.coalesce("unknown", "state", F.lit("none")))
    placed = cut_lineage(locate(asked, layout))
    checked = validate_request(placed, layout, placed.where("at_source").select(F.col("orig_src").alias("path")))
    reason = (F.when(F.col("unknown").isNotNull(), F.concat(F.lit("unknown state: "), F.col("unknown")))
              .when(F.col("reject_reason").isNull() & (F.col("done") < len(STAGES)) & F.col("location").isNull(), REJECT_NOWHERE)
              .otherwise(F.col("reject_reason")))
    admission = cut_lineage(checked.withColumn("reject_reason", reason))
    said = read_stages(spark, stage_table).where("status = 'done'").select("tx", F.col("stage").alias("marker"))
    inconsistent = marker_consistency(said.join(admission.select("tx"), "tx", "left_semi").distinct(),
                                      admission.select("tx", "location"))

    work = _Work(spark, layout, stage_table, log_dir, run, admission.where("reject_reason IS NULL"))
    files = _files(work.live())
    steps = {"ingest": lambda: _ingest(work), "scan": lambda: _scan(work, files, verdicts, deny_digests, patterns),
             "validate": lambda: _validate(work, files, verdicts), "manifest": lambda: _manifest(work, files),
             "stage": lambda: _stage(work)}
    for stage in STAGES:
        if not work.due(stage).isEmpty():
            steps[stage]()
        if stage == stop_after:
            break
    mine = read_stages(spark, stage_table).where(F.col("run") == run)
    reached = read_stages(spark, stage_table).where("status = 'done'").groupBy("tx").agg(F.max("stage_no").alias("_n"))
    begun = read_stages(spark, stage_table).select("tx").distinct().withColumn("_begun", F.lit(True))
    n = F.greatest("done", F.coalesce("_n", F.lit(0)))
    after = (admission.select("tx", "done", "state", "unknown").join(reached, "tx", "left").join(begun, "tx", "left")
             .select("tx", F.coalesce("unknown", F.when(n > 0, F.element_at(F.array(*map(F.lit, STATE_AFTER)), n + 1)),
                                      F.when(F.col("_begun"), STAGES[0]), "state").alias("state")))
    return StageRun(admission, mine, after, inconsistent)


class _Work:
    """The transactions of a run and what has become of them so far."""

    def __init__(self, spark, layout: Layout, table: str, log_dir: str | None, run: str, admitted: DataFrame):
        self.spark, self.layout, self.table, self.log_dir, self.run = spark, layout, table, log_dir, run
        # done: stages before this run; place: where the bundle is
        self.txs = admitted.select("tx", "name", "orig_src", "proc_path", "stage_path", "quar_path", "location_kind",
                                   "done", F.regexp_replace("location", "/+\\z", "").alias("place"), F.lit(False).alias("ended"))

    def live(self) -> DataFrame:
        return self.txs.where(~F.col("ended") & (F.col("done") < len(STAGES)))

    def due(self, stage: str) -> DataFrame:
        """Those that run ``stage`` now: it is not done, and nothing before it
        failed. The table is one that was written, so its rows stay the same."""
        return self.live().where(F.col("done") <= STAGES.index(stage))

    def close(self, stage: str, due: DataFrame, outcome: DataFrame) -> DataFrame:
        """Writes a stage's rows and log; places and failures count from here on."""
        write_stage(outcome, self.table, self.run, stage)
        rows = self.spark.read.schema(_OUTCOME).parquet(
            f"{self.table.rstrip('/')}/run={self.run}/stage_no={STAGES.index(stage) + 1}")
        if self.log_dir is not None:
            self._log(stage, due, rows)
        new = rows.select("tx", F.col("place").alias("_place"), (F.col("status") != "done").alias("_ended"))
        self.txs = cut_lineage(self.txs.join(new, "tx", "left").withColumn("place", F.coalesce("_place", "place"))
                               .withColumn("ended", F.coalesce("_ended", "ended")).drop("_place", "_ended"))
        return rows

    def _log(self, stage: str, due: DataFrame, rows: DataFrame) -> None:
        """Two rows a transaction: 'running' and how the stage ended (IO-9)."""
        word, action = STAGE_LOG[STAGES.index(stage)]
        good = "passed" if stage in ("scan", "validate") else "success"
        ended = rows.join(due.select("tx", "name", F.col("place").alias("src")), "tx")
        status = F.when(F.col("status") == "done", good).otherwise("failed")
        lines = ended.select("tx", "name", "src", "place", "detail", F.explode(F.array(
            F.struct(F.lit("running").alias("status"), F.lit(f"{stage} started").alias("msg"), F.lit(0).alias("no")),
            F.struct(status.alias("status"), F.coalesce("detail", F.lit(f"{stage} complete")).alias("msg"), F.lit(1).alias("no")))).alias("e"))
        out = lines.select(F.current_timestamp().alias("ts"), "tx", "name", F.lit("vm").alias("machine"),
                           F.lit(action).alias("action"), F.col("e.status").alias("status"), F.lit(word).alias("stage"), "src",
                           F.when(F.col("e.no") == 1, F.col("place")).otherwise(F.lit("")).alias("dest"), F.col("e.msg").alias("msg"))
        (format_log_rows(out).write.mode("overwrite")
         .text(f"{self.log_dir.rstrip('/')}/run={self.run}/stage_no={STAGES.index(stage) + 1}"))


def _files(live: DataFrame) -> DataFrame:
    """Files of the bundles in their places, read once: (tx, rel_path, path,
    sha256, read_error). Those of transactions that only wait to be staged are not read."""
    todo = live.where(F.col("done") < STAGES.index("stage")).select("tx", "place")
    walked = scan_paths(todo.select(F.col("place").alias("path")).distinct())
    files = walked.join(todo.withColumnRenamed("place", "bundle"), "bundle").select("tx", "rel_path", "path", "length")
    return cut_lineage(fingerprint_paths(deal_by_bytes(files)).drop("length"))


def _moved(due: DataFrame, moves: DataFrame) -> DataFrame:
    """``due`` with the status of its move (NULL: none was needed)."""
    done = cut_lineage(apply_moves(moves))
    return due.join(moves.select("tx", "src", "dest").join(done, ["src", "dest"]).select(
        "tx", F.col("dest").alias("_dest"), F.col("status").alias("_move")), "tx", "left")


def _went(status: Column) -> Column:
    return status.isNull() | status.isin("moved", "already")


def _outcome(df: DataFrame, ok: Column, place: Column, detail: Column, n_files: Column | None = None,
             n_junk: Column | None = None) -> DataFrame:
    none = F.lit(None).cast("long")
    return df.select("tx", F.when(ok, "done").otherwise("failed").alias("status"), place.alias("place"), detail.alias("detail"),
                     (none if n_files is None else n_files).alias("n_files"), (none if n_junk is None else n_junk).alias("n_junk"))


def _ingest(work: _Work) -> None:
    """Source to processing; a single file into a folder of its own."""
    due = work.due("ingest")
    kinds = existing_paths(due.select(F.col("place").alias("path")).distinct()).withColumnRenamed("path", "place")
    due = cut_lineage(due.join(kinds, "place", "left"))
    folder = wrap_bundle_root("proc_path", "is_dir")
    inside = F.when(F.col("is_dir"), folder).otherwise(F.concat(folder, F.lit("/"), F.element_at(F.split("place", "/"), -1)))
    # a bundle found in processing was moved before; only a bare file there is still put in a folder
    write_started(due, work.table, work.run)
    moves = due.where((F.col("location_kind") == "src") | ~F.col("is_dir")).select("tx", F.col("place").alias("src"), inside.alias("dest"))
    at = _moved(due, moves)
    ok = _went(F.col("_move"))
    place = F.when(F.col("_move").isNull(), F.col("place")).when(ok, folder).otherwise(F.col("place"))
    work.close("ingest", due, _outcome(at, ok, place, F.when(~ok, F.concat(F.lit("cannot move to processing: "), F.col("_move")))))


def _quarantine(due: DataFrame, bad: DataFrame) -> DataFrame:
    """``due`` with ``witness`` of the bundles in ``bad`` (tx, witness), which are moved to quarantine whole."""
    due = cut_lineage(due.join(bad, "tx", "left"))
    moves = due.where("witness IS NOT NULL").select("tx", F.col("place").alias("src"), F.col("quar_path").alias("dest"))
    return _moved(due, moves)


def _judged(at: DataFrame, what: str) -> tuple[Column, Column, Column]:
    ok = F.col("witness").isNull()
    place = F.when(ok | ~_went(F.col("_move")), F.col("place")).otherwise(F.col("quar_path"))
    note = F.when(_went(F.col("_move")), F.lit("")).otherwise(F.concat(F.lit(" (quarantine move failed: "), F.col("_move"), F.lit(")")))
    return ok, place, F.when(~ok, F.concat(F.lit(f"{what}: "), F.col("witness"), note))


def _scan(work: _Work, files: DataFrame, verdicts: DataFrame | None, deny: DataFrame | None, patterns: DataFrame | None) -> None:
    """Digests, patterns and verdicts on all files; a bundle with an infected
    one goes to quarantine. The files are read where they are by now."""
    due = work.due("scan")
    rows = _here(files, due).withColumn("content", F.lit(None).cast("string"))
    flagged = flag_signatures(rows, deny, patterns, path="path")
    if verdicts is not None:
        v = verdicts.groupBy("tx", "rel_path").agg(F.bool_or("infected").alias("_v"))
        flagged = flagged.join(v, ["tx", "rel_path"], "left").withColumn("flagged", F.col("flagged") | F.coalesce("_v", F.lit(False)))
    bad = flagged.where("flagged").groupBy("tx").agg(F.min("rel_path").alias("witness"))
    at = _quarantine(due, bad)
    work.close("scan", due, _outcome(at, *_judged(at, "malware detected")))


def _here(files: DataFrame, due: DataFrame) -> DataFrame:
    """The files of ``due`` with the path they have now: below their bundle's place."""
    return files.drop("path").join(due.select("tx", "place"), "tx").withColumn(
        "path", F.concat("place", F.lit("/"), "rel_path")).drop("place")


def _validate(work: _Work, files: DataFrame, verdicts: DataFrame | None) -> None:
    """A core file that did not decode sends its bundle to quarantine; of the
    other bundles the junk files go there, one by one."""
    due = work.due("validate")
    rows = _here(files, due)
    bad = work.spark.createDataFrame([], "tx string, witness string")
    if verdicts is not None:
        failed = verdicts.groupBy("tx", "rel_path").agg(F.bool_and("ok").alias("ok")).where(~F.col("ok"))
        bad = (rows.where(classify_file("rel_path") == CORE).join(failed, ["tx", "rel_path"])
               .groupBy("tx").agg(F.min("rel_path").alias("witness")))
    at = cut_lineage(_quarantine(due, bad))
    quar = F.lit(work.layout.quarantine.rstrip("/") + "/")
    junk = (rows.where(classify_file("rel_path") == JUNK).join(at.where("witness IS NULL").select("tx"), "tx", "left_semi")
            .select("tx", F.col("path").alias("src"), F.concat(quar, "tx", F.lit(".junk/"), "rel_path").alias("dest")))
    went = cut_lineage(junk.join(apply_moves(junk), ["src", "dest"]))
    # what a run before took away is no longer listed; 'missing' would be a file lost since
    stuck = went.where(~_went(F.col("status"))).groupBy("tx").agg(F.min("src").alias("stuck"))
    n = went.groupBy("tx").agg(F.count(F.lit(1)).alias("n_junk"))
    at = at.join(stuck, "tx", "left").join(n, "tx", "left")
    ok, place, detail = _judged(at, "decode failed")
    detail = F.coalesce(detail, F.when(F.col("stuck").isNotNull(), F.concat(F.lit("quarantine move failed: "), F.col("stuck"))))
    work.close("validate", due, _outcome(at, ok & F.col("stuck").isNull(), place, detail, n_junk=F.coalesce("n_junk", F.lit(0))))


def _manifest(work: _Work, files: DataFrame) -> None:
    """``{tx}.json`` of the core files. One that is there already counts as
    this stage's work if it has the same bytes."""
    due = work.due("manifest")
    core = files.join(due.select("tx"), "tx", "left_semi").where(classify_file("rel_path") == CORE)
    broken = core.where("read_error IS NOT NULL").groupBy("tx").agg(F.min("rel_path").alias("broken"))
    sound = due.join(broken, "tx", "left_anti")
    entries = manifest_entries(core.join(sound.select("tx"), "tx", "left_semi"))
    status = cut_lineage(stream_manifests(entries, sound.select("tx", "name", "orig_src"), work.layout.registry))
    n = entries.groupBy("tx").agg(F.count(F.lit(1)).alias("n_files"))
    at = due.join(broken, "tx", "left").join(status.withColumnRenamed("status", "_s"), "tx", "left").join(n, "tx", "left")
    ok = F.coalesce(F.col("_s").isin("written", "same"), F.lit(False))
    detail = F.when(F.col("broken").isNotNull(), F.concat(F.lit("hash failed for "), F.col("broken"))).when(
        ~ok, F.concat(F.lit("manifest already exists: "), F.col("tx"), F.lit(".json")))
    work.close("manifest", due, _outcome(at, ok, F.col("place"), detail, n_files=F.when(ok, F.coalesce("n_files", F.lit(0)))))


def _stage(work: _Work) -> None:
    """Processing to staging."""
    due = work.due("stage")
    moves = due.where(~F.col("place").eqNullSafe(F.col("stage_path"))).select(
        "tx", F.col("place").alias("src"), F.col("stage_path").alias("dest"))
    at = _moved(due, moves)
    ok = _went(F.col("_move"))
    work.close("stage", due, _outcome(at, ok, F.when(ok, F.col("stage_path")).otherwise(F.col("place")),
                                      F.when(~ok, F.concat(F.lit("cannot move to staging: "), F.col("_move")))))
