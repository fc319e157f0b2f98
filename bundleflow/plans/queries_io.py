"""Registered queries: sources, sinks, filters, projections and scalar
functions (IO, PR, SC)."""

from __future__ import annotations

import math
import os

from pyspark.sql import functions as F

from bundleflow import schemas
from bundleflow.functions import paths as P
from bundleflow.functions import records as R
from bundleflow.operators import aggregates as AG
from bundleflow.operators import content as CT
from bundleflow.operators.filters import (Layout, derive_paths, directories_only, drop_filter, normalize_bundle,
                                          validate_request)
from bundleflow.plans import lenses as L
from bundleflow.plans.catalog import (BASENAME_SQL, CLASS_SQL, DOC_LENSES, DOC_SETS_SQL, VERDICT_SQL,
                                      register)
from bundleflow.plans.materialize import drop_folders, fresh_root, write_files
from bundleflow.session import cut_lineage, table
from bundleflow.sources import files as IOF
from bundleflow.sources import ledger as IOL
from bundleflow.sources import logs as IOG
from bundleflow.sources import manifests as IOM
from bundleflow.operators.hash_sets import contained_sets
from bundleflow.sources.named_files import read_named
from bundleflow.sources.routing import move_plan, route_output


LAYOUT = Layout()


# ------------------------------------------------------------------ sources
def materialized_files(spark, sf):
    """The files lens written out as a folder tree: {root}/{bundle}/{lang}/{doc}.{ext}."""
    root = fresh_root(spark, "files")
    write_files(L.files_lens(spark, sf), root)
    return root


@register("io1_scan_files", """SELECT bundle, rel_path, length FROM files_lens""", ("files_lens",))
def q_scan_files(spark, sf):
    root = materialized_files(spark, sf)
    return IOF.scan_files(spark, root).select("bundle", "rel_path", "length")


@register("io2_scan_contents", """SELECT bundle, rel_path, length, sha256 FROM files_lens""", ("files_lens",))
def q_scan_contents(spark, sf):
    root = materialized_files(spark, sf)
    df = IOF.scan_contents(spark, root)
    rel = P.relative_path(F.regexp_replace("path", "^file:", ""), F.lit(root))
    return df.select(F.substring_index(rel, "/", 1).alias("bundle"),
                     F.regexp_replace(rel, r"^[^/]*/", "").alias("rel_path"),
                     "length", F.sha2("content", 256).alias("sha256"))


MANIFESTS_BY_ID_SQL = """SELECT i.manifest_id AS tx, i.manifest_id AS job_id, coalesce(count(f.sha256), 0) AS n_files
FROM manifest_ids_lens i LEFT JOIN manifest_files_lens f USING (manifest_id) GROUP BY i.manifest_id"""


def manifests_by_id(spark, sf):
    """One manifest per (source, lang) id of the documents, files = its core files."""
    mf = L.manifest_files_lens(spark, sf).select(F.col("manifest_id").alias("tx"), "rel_path", "sha256")
    ids = L.manifest_ids_lens(spark, sf).select(F.col("manifest_id").alias("tx"),
                                                 F.col("manifest_id").alias("name"),
                                                 F.concat(F.lit("/srv/complete/"), "manifest_id").alias("orig_src"))
    return AG.build_manifest(mf, ids)


@register("io3_read_manifests", """SELECT concat(i.manifest_id, '.json') AS manifest_file, i.manifest_id AS job_id,
  CAST(count(f.sha256) AS INTEGER) AS n_files
FROM manifest_ids_lens i LEFT JOIN manifest_files_lens f USING (manifest_id) GROUP BY i.manifest_id""",
          ("manifest_files_lens", "manifest_ids_lens"))
def q_read_manifests(spark, sf):
    registry = fresh_root(spark, "registry")
    written = IOM.write_manifests(manifests_by_id(spark, sf), registry)
    written.agg(F.count(F.lit(1))).first()  # publish before reading back
    m = IOM.read_manifests(spark, registry)
    return m.select("manifest_file", "job_id", F.size("files").alias("n_files"))


@register("io4_read_stage_logs", """SELECT tx, machine, stage, status, msg,
  CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS ts_epoch FROM logs_lens""", ("logs_lens",))
def q_read_logs(spark, sf):
    folder = fresh_root(spark, "logs")
    IOG.append_log(L.logs_lens(spark, sf), folder)
    logs, _rejects = IOG.read_stage_logs(spark, folder)
    return logs.select("tx", "machine", "stage", "status", "msg", F.unix_seconds("ts").alias("ts_epoch"))


@register("io5_read_ledger", "SELECT DISTINCT job_id FROM ledger_lens", ("ledger_lens",))
def q_read_ledger(spark, sf):
    folder = fresh_root(spark, "ledger")
    L.ledger_lens(spark, sf).write.mode("overwrite").text(folder + "/done.log")
    return IOL.read_ledger(spark, folder + "/done.log", fmt="text")


REGISTRY_NAMES_SQL = """names AS (
  SELECT tx, concat(tx, '.state') AS file_name, coalesce(state, 'none') AS content FROM requests_lens
  UNION ALL SELECT tx, concat(tx, '.', m, '.done'), '' FROM requests_lens,
     unnest(CASE state WHEN 'done' THEN ['ingest', 'scan', 'validate', 'manifest', 'export']
                       WHEN 'validate' THEN ['ingest', 'scan'] ELSE []::VARCHAR[] END) AS t(m)
  UNION ALL SELECT tx, concat(tx, '.json'), '{}' FROM requests_lens WHERE state = 'done')"""


def registry_listing(spark, sf):
    from bundleflow.plans.queries_ops import lens_markers
    r = L.requests_lens(spark, sf)
    states = r.select(F.concat("tx", F.lit(".state")).alias("file_name"),
                      F.coalesce("state", F.lit("none")).alias("content"))
    marks = lens_markers(spark, sf).select(F.concat("tx", F.lit("."), "marker", F.lit(".done")).alias("file_name"),
                                           F.lit("").alias("content"))
    mans = r.where(F.col("state") == "done").select(F.concat("tx", F.lit(".json")).alias("file_name"),
                                                    F.lit("{}").alias("content"))
    return states.unionByName(marks).unionByName(mans)


#: Files of a registry folder, and folders that stand on the disk at once.
FOLDER_FILES, ROUND_FOLDERS = 50_000, 24


@register("io6_read_stage_markers", "WITH " + REGISTRY_NAMES_SQL + """
SELECT tx, CASE WHEN ends_with(file_name, '.done') THEN 'marker' WHEN ends_with(file_name, '.state') THEN 'state'
  ELSE 'manifest' END AS kind,
  CASE WHEN ends_with(file_name, '.done') THEN split_part(file_name, '.', 2) END AS marker,
  CASE WHEN ends_with(file_name, '.state') THEN content END AS state FROM names
WHERE NOT ends_with(file_name, '.json')""", ("requests_lens",))
def q_markers(spark, sf):
    """Registry folders with the markers, states and manifests as files. Every
    file takes a block of the disk, so they are written, read and taken away
    in rounds of a bounded number of files; all are read. Files of a folder
    that hold the same few bytes, as markers do, are names of one."""
    root = fresh_root(spark, "registry")
    listing = registry_listing(spark, sf)
    folders = max(1, math.ceil(listing.count() / FOLDER_FILES))
    at = F.pmod(F.xxhash64("file_name"), F.lit(folders)).cast("int")
    names = (listing.withColumn("no", at).withColumn("bundle", F.concat(F.lit("registry"), at))
             .withColumn("round", F.floor(at / ROUND_FOLDERS)))
    names.write.partitionBy("round").parquet(f"{root}/names")
    names = spark.read.schema(names.schema).parquet(f"{root}/names")
    for i in range(math.ceil(folders / ROUND_FOLDERS)):
        mine = [f"{root}/registry{k}" for k in range(i * ROUND_FOLDERS, min((i + 1) * ROUND_FOLDERS, folders))]
        dealt = names.where(F.col("round") == i).repartitionById(len(mine), F.col("no") - i * ROUND_FOLDERS)
        write_files(dealt, root, rel="file_name", link=True)
        there = [f for f in mine if os.path.isdir(f)]  # few names may leave one without files
        rows = IOF.read_stage_markers(spark, there)
        rows.write.parquet(f"{root}/rows/round={i}")
        drop_folders(spark, there)
    return spark.read.schema(rows.schema).parquet(f"{root}/rows").drop("round")


@register("io7_read_requests", "SELECT name, orig_src, tx FROM requests_lens", ("requests_lens",))
def q_read_requests(spark, sf):
    folder = fresh_root(spark, "requests")
    L.requests_lens(spark, sf).select("name", "orig_src", "tx").write.mode("overwrite").json(folder + "/in")
    return IOL.read_requests(spark, folder + "/in")


@register("io8_write_manifests", "SELECT tx, CASE WHEN length(tx) % 2 = 0 THEN 'exists' ELSE 'written' END AS status, "
          "CAST(n_files AS DOUBLE) AS n_files FROM (" + MANIFESTS_BY_ID_SQL + ")", DOC_LENSES)
def q_write_manifests(spark, sf):
    """Some manifests are published, then all; what stands in the folder is read back."""
    root = fresh_root(spark, "publish")
    mj = manifests_by_id(spark, sf).select("tx", "manifest_json")
    IOM.write_manifests(mj.where(F.length("tx") % 2 == 0), root).count()
    status = cut_lineage(IOM.write_manifests(mj, root))
    back = IOM.read_manifests(spark, root, include_empty=True).select(
        F.regexp_extract("manifest_file", r"([^/]*)\.json\z", 1).alias("tx"), F.size("files").cast("double").alias("n_files"))
    return status.join(back, "tx", "left").select("tx", "status", "n_files")


IO9_SQL = """SELECT to_json(struct_pack(ts := strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00'), tx := coalesce(nullif(tx, ''), 'none'),
  name := 'none', machine := machine, action := 'none', status := status, stage := stage, src := '', dest := '',
  msg := concat(coalesce(msg, ''), chr(10)))) AS value FROM logs_lens"""


@register("io9_append_log", IO9_SQL, ("logs_lens",))
def q_append_log(spark, sf):
    return IOG.format_log_rows(L.logs_lens(spark, sf).drop("event_id"))


@register("io10_append_ledger", """WITH led AS (SELECT job_id, 0 AS batch_id FROM ledger_lens),
new AS (SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS job_id, 1 AS batch_id FROM orders WHERE o_orderstatus IN ('P', 'F')),
allrows AS (SELECT * FROM led UNION ALL SELECT * FROM new WHERE job_id NOT IN (SELECT job_id FROM led))
SELECT job_id, CAST(min(batch_id) AS BIGINT) AS batch_id FROM allrows GROUP BY job_id""", ("ledger_lens",))
def q_append_ledger(spark, sf):
    """Two batches appended, the second one twice."""
    path = fresh_root(spark, "ledger-table") + "/ledger"
    new = (table(spark, sf, "orders").where(F.col("o_orderstatus").isin("P", "F"))
           .select(F.col("o_orderkey").cast("string").alias("job_id")))
    IOL.append_ledger(L.ledger_lens(spark, sf), path, 0)
    for _ in range(2):
        IOL.append_ledger(new, path, 1)
    return IOL.dedupe_ledger(spark.read.schema(schemas.LEDGER).parquet(path)).select("job_id", "batch_id")


@register("io11_export_manifests", "WITH " + DOC_SETS_SQL + """,
fm AS (SELECT DISTINCT manifest_id FROM (
  SELECT b.bundle, min(m.manifest_id) AS manifest_id FROM b, m WHERE list_has_all(b.hs, m.hs) GROUP BY b.bundle)),
mj AS (""" + MANIFESTS_BY_ID_SQL.replace("SELECT i.manifest_id AS tx, i.manifest_id AS job_id, coalesce(count(f.sha256), 0) AS n_files",
        """SELECT i.manifest_id AS tx, to_json(struct_pack(job_id := i.manifest_id, name := i.manifest_id,
  source := concat('/srv/complete/', i.manifest_id), type := NULL::VARCHAR,
  files := coalesce(list(struct_pack(name := f.rel_path, hash := f.sha256) ORDER BY f.rel_path) FILTER (WHERE f.sha256 IS NOT NULL),
                    []::STRUCT(name VARCHAR, hash VARCHAR)[]))) AS manifest_json""") + """)
SELECT mj.tx AS job_id, concat(mj.tx, '.json') AS export_name, concat(substr(mj.manifest_json, 1, length(mj.manifest_json) - 1),
  ',"extra":{"of":"', mj.tx, '"}}') AS manifest_json FROM mj JOIN fm ON fm.manifest_id = mj.tx""", DOC_LENSES)
def q_export(spark, sf):
    from bundleflow.plans.queries_ops import q_first_match
    fm = q_first_match(spark, sf).select(F.col("manifest_id").alias("tx")).distinct()
    mj = manifests_by_id(spark, sf).join(fm, "tx")
    # a field that no schema of ours has
    body = F.concat(F.expr("substring(manifest_json, 1, length(manifest_json) - 1)"), F.lit(',"extra":{"of":"'), "tx", F.lit('"}}'))
    exports = IOM.export_manifests(mj.withColumn("manifest_json", body).withColumn("type", F.lit(None).cast("string")), job="tx")
    root = fresh_root(spark, "exports")
    for _ in range(2):  # a repeated job adds nothing
        IOM.write_exports(exports, root)
    return read_named(spark, root, "*.json").select(
        F.regexp_replace("name", r"\.json\z", "").alias("job_id"), F.col("name").alias("export_name"),
        F.col("body").cast("string").alias("manifest_json"))


@register("io12_route_output", "WITH " + VERDICT_SQL + f"""
SELECT f.bundle, f.rel_path,
  CASE WHEN v.outcome <> 'passed' THEN 'quarantine' WHEN {CLASS_SQL} = 'junk' THEN 'quarantine_junk' ELSE 'staged' END AS route,
  CASE WHEN v.outcome <> 'passed' THEN concat('/srv/quarantine/', f.bundle, '/', f.rel_path)
       WHEN {CLASS_SQL} = 'junk' THEN concat('/srv/quarantine/', f.bundle, '.junk/', f.rel_path)
       ELSE concat('/srv/staging/', f.bundle, '.dir/', f.rel_path) END AS dest
FROM files_lens f JOIN verdict v USING (bundle)""", ("files_lens", "verdicts_lens"))
def q_route(spark, sf):
    from bundleflow.plans.queries_ops import doc_verdicts  # noqa: F811
    plan = move_plan(L.files_lens(spark, sf), doc_verdicts(spark, sf), staging=LAYOUT.staging, quarantine=LAYOUT.quarantine)
    base = fresh_root(spark, "routes") + "/plan"
    for batch in (1, 1):  # a repeated job adds nothing
        route_output(plan, base, batch)
    return spark.read.parquet(base).select("bundle", "rel_path", "route", "dest")


# ------------------------------------------------------------------ PR
@register("pr1_classify_file", f"SELECT doc_id, rel_path, {CLASS_SQL} AS class FROM files_lens", ("files_lens",))
def q_classify(spark, sf):
    return L.files_lens(spark, sf).select("doc_id", "rel_path", P.classify_file("rel_path").alias("class"))


@register("pr2_within_boundary", "SELECT tx, coalesce(starts_with(orig_src, '/srv/complete/'), false) AS within FROM requests_lens",
          ("requests_lens",))
def q_within(spark, sf):
    return L.requests_lens(spark, sf).select("tx", P.within_boundary("orig_src", LAYOUT.download).alias("within"))


@register("pr3_validate_request", """SELECT tx, CASE WHEN name IS NULL OR orig_src IS NULL OR tx IS NULL THEN 'usage: name, path and infohash required'
  WHEN orig_src = '' THEN 'missing source path'
  WHEN NOT starts_with(orig_src, '/srv/complete/') THEN 'must originate from download directory'
  WHEN coalesce(nullif(state, ''), 'none') = 'none' AND orig_src NOT IN
     (SELECT concat('/srv/complete/', l_orderkey, '.mkv') FROM lineitem) THEN 'input does not exist' END AS reject_reason
FROM requests_lens""", ("requests_lens",))
def q_validate(spark, sf):
    inv = table(spark, sf, "lineitem").select(
        F.concat(F.lit("/srv/complete/"), F.col("l_orderkey").cast("string"), F.lit(".mkv")).alias("path"))
    return validate_request(L.requests_lens(spark, sf), LAYOUT, inv).select("tx", "reject_reason")


@register("pr4_classify_type", """SELECT event_id, CASE WHEN starts_with(path, '/ready/movies/') THEN 'movies'
  WHEN starts_with(path, '/ready/shows/') THEN 'shows' END AS type FROM arrivals_lens""", ("arrivals_lens",))
def q_type(spark, sf):
    return L.arrivals_lens(spark, sf).select("event_id", P.classify_type("path", "/ready").alias("type"))


SPLIT_SQL = """SELECT event_id, split_part(substr(path, 8), '/', 1) AS folder,
  CASE WHEN contains(substr(path, 8), '/') THEN regexp_replace(substr(path, 8), '^[^/]*/', '') ELSE substr(path, 8) END AS name
FROM arrivals_lens"""


@register("pr5_drop_filter", "SELECT * FROM (" + SPLIT_SQL + """)
WHERE NOT (starts_with(name, '.') OR ends_with(name, '.part') OR ends_with(name, '.tmp'))""", ("arrivals_lens",))
def q_drop_filter(spark, sf):
    return drop_filter(L.arrivals_lens(spark, sf), "/ready").select("event_id", "folder", "name")


@register("pr6_directories_only", "SELECT event_id, path FROM arrivals_lens WHERE is_dir", ("arrivals_lens",))
def q_dirs(spark, sf):
    return directories_only(L.arrivals_lens(spark, sf)).select("event_id", "path")


@register("pr7_valid_job_id", """SELECT o_orderkey, job_id, coalesce(job_id IS NOT NULL AND job_id <> '' AND job_id <> 'null', false) AS valid
FROM (SELECT o_orderkey, CASE o_orderkey % 15 WHEN 0 THEN NULL WHEN 5 THEN '' WHEN 10 THEN 'null' ELSE tx END AS job_id
      FROM requests_lens)""", ("requests_lens",))
def q_valid_id(spark, sf):
    r = L.requests_lens(spark, sf)
    k = F.col("o_orderkey") % 15
    jid = F.when(k == 0, F.lit(None)).when(k == 5, F.lit("")).when(k == 10, F.lit("null")).otherwise(F.col("tx"))
    return r.select("o_orderkey", jid.alias("job_id")).withColumn("valid", P.valid_job_id("job_id"))


DERIVE_SQL = f"""SELECT tx, {BASENAME_SQL.format(c='orig_src')} AS basename,
  concat('/srv/processing/', {BASENAME_SQL.format(c='orig_src')}) AS proc_path,
  concat('/srv/staging/', {BASENAME_SQL.format(c='orig_src')}, '.dir') AS stage_path,
  concat('/srv/quarantine/', {BASENAME_SQL.format(c='orig_src')}) AS quar_path,
  concat('/srv/registry/', tx, '.json') AS manifest_path, concat('/srv/registry/', tx, '.state') AS state_path
FROM requests_lens"""


@register("pr8_derive_paths", DERIVE_SQL, ("requests_lens",))
def q_derive(spark, sf):
    return derive_paths(L.requests_lens(spark, sf), LAYOUT).select(
        "tx", "basename", "proc_path", "stage_path", "quar_path", "manifest_path", "state_path")


@register("pr9_normalize_bundle", "SELECT tx, CASE WHEN is_dir THEN proc_path ELSE concat(proc_path, '.dir') END AS bundle_root, "
          "CASE WHEN NOT is_dir THEN " + BASENAME_SQL.format(c="proc_path") + " END AS wrapped_rel_path FROM ("
          + DERIVE_SQL.replace("SELECT tx,", "SELECT tx, NOT ends_with(orig_src, '.mkv') AS is_dir,") + ")",
          ("requests_lens",))
def q_normalize(spark, sf):
    r = derive_paths(L.requests_lens(spark, sf), LAYOUT).withColumn("is_dir", ~F.col("orig_src").endswith(".mkv"))
    return normalize_bundle(r).select("tx", "bundle_root", "wrapped_rel_path")


@register("pr10_with_defaults", """SELECT event_id, coalesce(nullif(tx, ''), 'none') AS tx, 'none' AS name,
  coalesce(nullif(machine, ''), 'none') AS machine, 'none' AS action, coalesce(nullif(status, ''), 'none') AS status,
  coalesce(nullif(stage, ''), 'none') AS stage, '' AS src, '' AS dest FROM logs_lens""", ("logs_lens",))
def q_defaults(spark, sf):
    logs = L.logs_lens(spark, sf)
    cols = [F.col("event_id")]
    for f, d in IOG.LOG_DEFAULTS.items():
        c = F.col(f) if f in logs.columns else F.lit(None).cast("string")
        cols.append(P.with_default(c, d).alias(f))
    return logs.select(*cols)


@register("pr11_split_drop_path", SPLIT_SQL, ("arrivals_lens",))
def q_split(spark, sf):
    folder, name = P.split_drop_path("path", "/ready")
    return L.arrivals_lens(spark, sf).select("event_id", folder.alias("folder"), name.alias("name"))


# ------------------------------------------------------------------ SC
@register("sc1_basename", f"SELECT page_id, {BASENAME_SQL.format(c='path')} AS basename FROM pages_lens", ("pages_lens",))
def q_basename(spark, sf):
    return L.pages_lens(spark, sf).select("page_id", P.basename("path").alias("basename"))


@register("sc2_relative_path", """SELECT doc_id, rel_path AS relative FROM files_lens""", ("files_lens",))
def q_relative(spark, sf):
    f = L.files_lens(spark, sf)
    # A root holding glob characters is taken literally.
    root = F.concat(F.lit("/srv/processing/[1080p] "), F.col("bundle"))
    full = F.concat(root, F.lit("/"), F.col("rel_path"))
    return f.select("doc_id", P.relative_path(full, root).alias("relative"))


@register("sc3_manifest_fields", """SELECT i.manifest_id AS tx, i.manifest_id AS job_id, i.manifest_id AS bundle_name,
  'null' AS type, CAST(count(f.sha256) AS INTEGER) AS n_hashes
FROM manifest_ids_lens i LEFT JOIN manifest_files_lens f USING (manifest_id) GROUP BY i.manifest_id""",
          ("manifest_files_lens", "manifest_ids_lens"))
def q_fields(spark, sf):
    m = IOM.parse_manifest_text(manifests_by_id(spark, sf))
    return m.select("tx", "job_id", "bundle_name", "type", F.size("hashes").alias("n_hashes"))


@register("sc4_json_escape", "SELECT doc_id, CAST(to_json(text) AS VARCHAR) AS escaped FROM documents")
def q_escape(spark, sf):
    return table(spark, sf, "documents").select("doc_id", R.json_escape("text").alias("escaped"))


@register("sc5_iso_timestamp", """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS iso,
  CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS parsed_epoch FROM events""")
def q_iso(spark, sf):
    e = table(spark, sf, "events")
    iso = R.iso_timestamp("ts")
    return e.select("event_id", iso.alias("iso"), F.unix_seconds(R.parse_iso(iso)).alias("parsed_epoch"))


@register("sc6_hash_set_contains", """WITH b AS (SELECT bundle, list(DISTINCT sha256) AS hs FROM files_lens GROUP BY bundle),
m AS (SELECT i.manifest_id, split_part(i.manifest_id, '-', 1) AS bundle,
  coalesce(list(DISTINCT f.sha256) FILTER (WHERE f.sha256 IS NOT NULL), []::VARCHAR[]) AS hs
  FROM manifest_ids_lens i LEFT JOIN manifest_files_lens f USING (manifest_id) GROUP BY i.manifest_id)
SELECT m.manifest_id, m.bundle, list_has_all(b.hs, m.hs) AS contained FROM m JOIN b USING (bundle)""",
          ("files_lens", "manifest_files_lens", "manifest_ids_lens"))
def q_contains(spark, sf):
    files = L.files_lens(spark, sf).select("bundle", F.col("sha256").alias("hash"))
    listed = L.manifest_files_lens(spark, sf).select("manifest_id", F.col("sha256").alias("hash"))
    pairs = L.manifest_ids_lens(spark, sf).withColumn("bundle", F.split("manifest_id", "-").getItem(0))
    return contained_sets(pairs, listed, files, small_key="manifest_id", large_key="bundle").select("manifest_id", "bundle", "contained")


@register("ct5_verify_readable", "SELECT bundle AS job_id, count(*) AS n_files, 0::BIGINT AS n_unreadable FROM files_lens GROUP BY bundle",
          ("files_lens",))
def q_verify(spark, sf):
    root = materialized_files(spark, sf)
    listing = IOF.scan_files(spark, root).withColumnRenamed("bundle", "job_id")
    return CT.verify_readable(listing, content=None)

