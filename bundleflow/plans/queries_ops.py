"""Registered queries: content, matching, aggregation, ordering, set and
decision operators (CT, JN, AG, WN, ST, DC, UD)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from bundleflow.functions import paths as P
from bundleflow.functions.paths import classify_file, file_extension
from bundleflow.functions.records import STAGE_MARKERS
from bundleflow.operators import aggregates as AG
from bundleflow.operators import content as CT
from bundleflow.operators import decisions as DC
from bundleflow.operators import matching as JN
from bundleflow.operators import ordering as WN
from bundleflow.operators.filters import Layout, derive_paths
from bundleflow.operators.gram_index import count_patterns
from bundleflow.operators.validators import non_empty_no_nul
from bundleflow.plans import lenses as L
from bundleflow.plans.catalog import (AUX_RE, BASENAME_SQL, CLASS_SQL, CORE_RE, DOC_LENSES, DOC_SETS_SQL,
                                      STAGE_RANK_SQL, TS_TEXT, VERDICT_SQL, register, ts_text)
from bundleflow.session import cut_lineage, table

LAYOUT = Layout()


# ------------------------------------------------------------------ helpers
def doc_matches(spark, sf, empty_matches=True):
    files = L.files_lens(spark, sf)
    entries = L.manifest_files_lens(spark, sf).select("manifest_id", F.col("sha256").alias("hash"))
    ids = L.manifest_ids_lens(spark, sf)
    return JN.match_manifests(entries, AG.bundle_hash_set(files), ids, empty_matches=empty_matches), files


def order_matches(spark, sf, manifests=None):
    """Orders in customers; with ``manifests`` also those of them that have no items."""
    return JN.match_manifests(L.order_manifest_lens(spark, sf), L.customer_bundle_lens(spark, sf), manifests)


# ------------------------------------------------------------------ flagship
FLAGSHIP_SQL = f"""WITH {DOC_SETS_SQL}
SELECT b.bundle, min(m.manifest_id) AS manifest_id FROM b, m WHERE list_has_all(b.hs, m.hs) GROUP BY b.bundle"""


@register("jn2_first_match", FLAGSHIP_SQL, DOC_LENSES)
def q_first_match(spark, sf):
    """Which manifest each bundle answers to: classify -> fingerprint ->
    manifest entries -> containment -> first in registry order."""
    matches, files = doc_matches(spark, sf)
    return JN.first_match(matches, files.select("bundle"))


@register("jn1_match_manifests", f"""WITH {DOC_SETS_SQL}
SELECT m.manifest_id, b.bundle FROM b, m WHERE len(m.hs) > 0 AND list_has_all(b.hs, m.hs)""", DOC_LENSES)
def q_match_manifests(spark, sf):
    matches, _ = doc_matches(spark, sf)
    return matches.pairs


@register("jn1_match_vacuous", f"""WITH {DOC_SETS_SQL}
SELECT manifest_id FROM m WHERE len(hs) = 0""", DOC_LENSES)
def q_match_vacuous(spark, sf):
    matches, _ = doc_matches(spark, sf)
    return matches.vacuous


@register("jn1_match_orders", """WITH msize AS (SELECT manifest_id, count(*) AS n FROM order_manifest_lens GROUP BY 1)
SELECT o.manifest_id, c.bundle FROM order_manifest_lens o JOIN customer_bundle_lens c ON o.hash = c.hash
JOIN msize s ON s.manifest_id = o.manifest_id
GROUP BY o.manifest_id, c.bundle, s.n HAVING count(*) = s.n""", ("order_manifest_lens", "customer_bundle_lens"))
def q_match_orders(spark, sf):
    return order_matches(spark, sf).pairs


@register("jn2_first_match_orders", """WITH msize AS (SELECT manifest_id, count(*) AS n FROM order_manifest_lens GROUP BY 1),
pairs AS (SELECT o.manifest_id, c.bundle FROM order_manifest_lens o JOIN customer_bundle_lens c ON o.hash = c.hash
  JOIN msize s ON s.manifest_id = o.manifest_id GROUP BY o.manifest_id, c.bundle, s.n HAVING count(*) = s.n)
SELECT bundle, min(manifest_id) AS manifest_id FROM pairs GROUP BY bundle""",
          ("order_manifest_lens", "customer_bundle_lens"))
def q_first_match_orders(spark, sf):
    return JN.first_match(order_matches(spark, sf))


CLAIM_SQL = f"""WITH RECURSIVE {DOC_SETS_SQL},
cand AS (SELECT b.bundle, m.manifest_id FROM b, m WHERE list_has_all(b.hs, m.hs)),
ob AS (SELECT bundle, arrival, row_number() OVER (ORDER BY arrival, bundle) AS rn FROM b),
walk(rn, bundle, manifest_id, consumed) AS (
  SELECT 0::BIGINT, NULL::VARCHAR, NULL::VARCHAR, []::VARCHAR[]
  UNION ALL
  SELECT rn, bundle, pick, CASE WHEN pick IS NULL THEN consumed ELSE list_append(consumed, pick) END
  FROM (SELECT ob.rn, ob.bundle, w.consumed,
               (SELECT min(c.manifest_id) FROM cand c
                WHERE c.bundle = ob.bundle AND NOT list_contains(w.consumed, c.manifest_id)) AS pick
        FROM walk w JOIN ob ON ob.rn = w.rn + 1))
SELECT w.bundle, ob.arrival, w.manifest_id FROM walk w JOIN ob USING (rn) WHERE w.rn > 0"""


@register("jn3_claim_manifests", CLAIM_SQL, DOC_LENSES)
def q_claim(spark, sf):
    matches, files = doc_matches(spark, sf)
    arrivals = files.groupBy("bundle").agg(F.min("doc_id").alias("arrival"))
    return JN.claim_manifests(matches, arrivals).drop("round")


@register("jn3_claim_orders")
def q_claim_orders(spark, sf):
    """Claim-once over all orders (manifests, those without items too) and the
    customers that have items (bundles): rows-only."""
    arrivals = L.customer_bundle_lens(spark, sf).select("bundle").distinct().withColumn("arrival", F.col("bundle"))
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("manifest_id"))
    return JN.claim_manifests(order_matches(spark, sf, orders), arrivals)


DOC_META_SQL = """meta AS (SELECT DISTINCT concat(source, '-', lang) AS manifest_id, concat(source, '-', lang) AS job_id,
  CASE WHEN lang = 'en' THEN NULL ELSE source END AS name,
  CASE WHEN lang IN ('en', 'fr') THEN 'movies' ELSE 'shows' END AS type FROM documents)"""


def doc_meta(spark, sf):
    d = table(spark, sf, "documents")
    mid = F.concat("source", F.lit("-"), "lang")
    return d.select(mid.alias("manifest_id"), mid.alias("job_id"),
                    F.when(F.col("lang") == "en", F.lit(None)).otherwise(F.col("source")).alias("name"),
                    F.when(F.col("lang").isin("en", "fr"), "movies").otherwise("shows").alias("type")).distinct()


@register("jn4_resolve_identity", f"""WITH {DOC_SETS_SQL}, {DOC_META_SQL},
fm AS (SELECT b.bundle, min(m.manifest_id) AS manifest_id FROM b, m WHERE list_has_all(b.hs, m.hs) GROUP BY b.bundle)
SELECT fm.bundle, fm.manifest_id, meta.job_id, coalesce(meta.name, '') AS bundle_name, meta.type,
  concat(CASE meta.type WHEN 'movies' THEN '/export/movies' ELSE '/export/shows' END, '/', meta.job_id) AS dest
FROM fm LEFT JOIN meta USING (manifest_id)""", DOC_LENSES)
def q_resolve(spark, sf):
    fm = q_first_match(spark, sf)
    meta = doc_meta(spark, sf)
    out = JN.resolve_identity(fm.join(meta.select("manifest_id", "type"), "manifest_id", "left"), meta,
                              export_roots={"movies": LAYOUT.export_movies, "shows": LAYOUT.export_shows})
    return out.select("bundle", "manifest_id", "job_id", "bundle_name", "type", "dest")


@register("jn5_exclude_done", """SELECT CAST(o_orderkey AS VARCHAR) AS job_id, o_orderstatus FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM ledger_lens l WHERE l.job_id = CAST(o.o_orderkey AS VARCHAR))""", ("ledger_lens",))
def q_exclude_done(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("job_id"), "o_orderstatus")
    return JN.exclude_done(o, L.ledger_lens(spark, sf), "job_id")


@register("jn6_existing_destination", """SELECT tx, concat('/export/shows/', tx) AS dest,
  EXISTS (SELECT 1 FROM lineitem WHERE concat('/export/shows/', l_orderkey) = concat('/export/shows/', tx)) AS dest_exists
FROM requests_lens""", ("requests_lens",))
def q_existing_dest(spark, sf):
    r = L.requests_lens(spark, sf).select("tx", F.concat(F.lit("/export/shows/"), "tx").alias("dest"))
    inv = table(spark, sf, "lineitem").select(F.concat(F.lit("/export/shows/"), F.col("l_orderkey").cast("string")).alias("path"))
    return JN.existing_destination(r, inv)


@register("jn7_missing_local", """SELECT 'shows' AS type, tx AS job_id FROM requests_lens r
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE CAST(l_orderkey AS VARCHAR) = r.tx)""", ("requests_lens",))
def q_missing_local(spark, sf):
    jobs = L.requests_lens(spark, sf).select(F.lit("shows").alias("type"), F.col("tx").alias("job_id"))
    inv = table(spark, sf, "lineitem").select(F.lit("shows").alias("type"), F.col("l_orderkey").cast("string").alias("job_id"))
    return JN.missing_local(jobs, inv)


# Inventory of locations for JN-8/JN-9, derived from lineitem flags.
LOC_INV_SQL = """inv AS (
  SELECT concat('/srv/processing/', l_orderkey, '.mkv.dir') AS path FROM lineitem WHERE l_returnflag = 'R'
  UNION SELECT concat('/srv/processing/', l_orderkey) FROM lineitem WHERE l_returnflag = 'A'
  UNION SELECT concat('/srv/staging/', l_orderkey, '.mkv.dir') FROM lineitem WHERE l_linestatus = 'F'
  UNION SELECT concat('/srv/complete/', l_orderkey, '.mkv') FROM lineitem WHERE l_returnflag = 'N')"""


def location_inventory(spark, sf):
    li = table(spark, sf, "lineitem")
    k = F.col("l_orderkey").cast("string")
    parts = [
        li.where(F.col("l_returnflag") == "R").select(F.concat(F.lit("/srv/processing/"), k, F.lit(".mkv.dir")).alias("path")),
        li.where(F.col("l_returnflag") == "A").select(F.concat(F.lit("/srv/processing/"), k).alias("path")),
        li.where(F.col("l_linestatus") == "F").select(F.concat(F.lit("/srv/staging/"), k, F.lit(".mkv.dir")).alias("path")),
        li.where(F.col("l_returnflag") == "N").select(F.concat(F.lit("/srv/complete/"), k, F.lit(".mkv")).alias("path")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


HYDRATE_SQL = f"""WITH {LOC_INV_SQL},
r AS (SELECT tx, state, orig_src, concat('/srv/processing/', {BASENAME_SQL.format(c='orig_src')}) AS proc_path,
        concat('/srv/staging/', {BASENAME_SQL.format(c='orig_src')}, '.dir') AS stage_path FROM requests_lens),
h AS (SELECT tx, state,
  CASE WHEN proc_path IN (SELECT path FROM inv) THEN proc_path
       WHEN proc_path || '.dir' IN (SELECT path FROM inv) THEN proc_path || '.dir'
       WHEN stage_path IN (SELECT path FROM inv) THEN stage_path
       WHEN orig_src IN (SELECT path FROM inv) THEN orig_src END AS location,
  CASE WHEN proc_path IN (SELECT path FROM inv) THEN 'proc'
       WHEN proc_path || '.dir' IN (SELECT path FROM inv) THEN 'proc_dir'
       WHEN stage_path IN (SELECT path FROM inv) THEN 'stage'
       WHEN orig_src IN (SELECT path FROM inv) THEN 'src' END AS location_kind FROM r)"""


def hydrated(spark, sf):
    r = derive_paths(L.requests_lens(spark, sf), LAYOUT)
    return JN.hydrate_location(r, location_inventory(spark, sf))


@register("jn8_hydrate_location", HYDRATE_SQL + "\nSELECT tx, location, location_kind FROM h", ("requests_lens",))
def q_hydrate(spark, sf):
    return hydrated(spark, sf).select("tx", "location", "location_kind")


MARKERS_SQL = """mk AS (SELECT tx, unnest(CASE state WHEN 'done' THEN ['ingest', 'scan', 'validate', 'manifest', 'export']
  WHEN 'validate' THEN ['ingest', 'scan'] ELSE []::VARCHAR[] END) AS marker FROM requests_lens)"""


def lens_markers(spark, sf):
    """Markers a request in a given state has written: all stages before it."""
    r = L.requests_lens(spark, sf)
    done = F.array(*[F.lit(m) for _, m in STAGE_MARKERS])
    upto_validate = F.array(F.lit("ingest"), F.lit("scan"))
    arr = (F.when(F.col("state") == "done", done).when(F.col("state") == "validate", upto_validate)
           .otherwise(F.array().cast("array<string>")))
    return r.select("tx", F.explode(arr).alias("marker"))


@register("jn9_marker_consistency", HYDRATE_SQL + ",\n" + MARKERS_SQL + """
SELECT mk.tx, mk.marker FROM mk JOIN h USING (tx) WHERE h.location IS NULL""", ("requests_lens",))
def q_marker_consistency(spark, sf):
    return JN.marker_consistency(lens_markers(spark, sf), hydrated(spark, sf)).select("tx", "marker")


# ------------------------------------------------------------------ content
@register("ct1_fingerprint", f"""SELECT doc_id, rel_path,
  CASE WHEN regexp_matches(rel_path, {CORE_RE}) THEN sha256(content) END AS sha256 FROM files_lens""", ("files_lens",))
def q_fingerprint(spark, sf):
    f = L.files_lens(spark, sf).drop("sha256")
    return CT.fingerprint(f, only_core=True).select("doc_id", "rel_path", "sha256")


SIG_SQL = """deny AS (SELECT DISTINCT sha256(d.text) AS h FROM labels l JOIN documents d USING (doc_id) WHERE l.toxic = 1),
ph AS (SELECT f.doc_id, count(DISTINCT p.text) AS k FROM files_lens f JOIN (SELECT DISTINCT text FROM benchmark) p
       ON contains(f.content, p.text) GROUP BY f.doc_id),
flags AS (SELECT f.bundle, f.doc_id, f.sha256 IN (SELECT h FROM deny) AS dh, coalesce(ph.k, 0) > 0 AS phit
          FROM files_lens f LEFT JOIN ph USING (doc_id))"""


def signature_inputs(spark, sf):
    files = L.files_lens(spark, sf)
    toxic = table(spark, sf, "labels").where(F.col("toxic") == 1).select("doc_id")
    deny = files.join(toxic, "doc_id", "left_semi").select("sha256")
    return files, deny, table(spark, sf, "benchmark").select("text")


@register("ct2_signature_scan", "WITH " + SIG_SQL + """
SELECT bundle, bool_or(dh OR phit) AS infected, count(*) FILTER (WHERE dh) AS n_digest_hits,
  count(*) FILTER (WHERE phit) AS n_pattern_hits FROM flags GROUP BY bundle""", ("files_lens",))
def q_signature(spark, sf):
    files, deny, pats = signature_inputs(spark, sf)
    return CT.signature_scan(files, deny, pats)


#: Subtitles in French cannot be read: neither content nor digest is known.
BLIND_SQL = f"(starts_with(rel_path, 'fr/') AND regexp_matches(rel_path, {AUX_RE}))"


def partly_unreadable(files):
    blind = F.col("rel_path").startswith("fr/") & (classify_file("rel_path") == P.AUX)
    none = F.lit(None).cast("string")
    return files.withColumn("content", F.when(~blind, F.col("content")).otherwise(none)).withColumn(
        "sha256", F.when(~blind, F.col("sha256")).otherwise(none))


@register("ct2_signature_unreadable", f"""WITH deny AS (SELECT DISTINCT sha256(d.text) AS h FROM labels l JOIN documents d USING (doc_id) WHERE l.toxic = 1),
f AS (SELECT bundle, {BLIND_SQL} AS blind, sha256 IN (SELECT h FROM deny) AS dh FROM files_lens)
SELECT bundle, bool_or(blind OR dh) AS infected, count(*) FILTER (WHERE dh AND NOT blind) AS n_digest_hits,
  CAST(0 AS BIGINT) AS n_pattern_hits FROM f GROUP BY bundle""", ("files_lens",))
def q_signature_unreadable(spark, sf):
    """With a deny list alone, files that could not be read are flagged."""
    files, deny, _ = signature_inputs(spark, sf)
    return CT.signature_scan(partly_unreadable(files), deny)


@register("ct2_signature_index", """WITH pats AS (SELECT DISTINCT p FROM (SELECT text AS p FROM benchmark UNION ALL
  SELECT unnest(string_split(d.text, chr(10))) FROM labels l JOIN documents d USING (doc_id) WHERE l.toxic = 1) WHERE p <> '')
SELECT f.doc_id, count(p.p) AS pattern_hits FROM files_lens f LEFT JOIN pats p ON contains(f.content, p.p) GROUP BY f.doc_id""",
          ("files_lens",))
def q_signature_index(spark, sf):
    """Benchmark texts and the lines of toxic documents in every file, through the index of grams."""
    files, _, pats = signature_inputs(spark, sf)
    # Written first, so that Spark joins by the size of the ids themselves and not of
    # all labels: where those are too large for a broadcast, every text is shuffled.
    toxic = cut_lineage(table(spark, sf, "labels").where(F.col("toxic") == 1).select("doc_id").distinct())
    lines = files.join(toxic, "doc_id", "left_semi").select(F.explode(F.split("content", "\n")).alias("text"))
    found = count_patterns(files, pats.unionByName(lines), pattern_col="text", out="pattern_hits", content="content", path=None)
    return found.select("doc_id", "pattern_hits")


#: Every second document gets the header bytes of its extension in front.
PROBE_SQL = f"""SELECT doc_id, CAST(CASE WHEN regexp_matches(rel_path, {CORE_RE}) THEN doc_id % 2 = 0 OR coalesce(
  CASE regexp_extract(rel_path, '\\.([^./]*)$', 1)
    WHEN 'mkv' THEN substr(hx, 1, 8) = '1A45DFA3' WHEN 'webm' THEN substr(hx, 1, 8) = '1A45DFA3'
    WHEN 'mp4' THEN substr(hx, 9, 8) = '66747970' WHEN 'mov' THEN substr(hx, 9, 8) = '66747970'
    WHEN 'm4v' THEN substr(hx, 9, 8) = '66747970'
    WHEN 'avi' THEN substr(hx, 1, 8) = '52494646' AND substr(hx, 17, 8) = '41564920'
    WHEN 'ts' THEN substr(hx, 1, 2) = '47' END, false) END AS VARCHAR) AS probe_ok
FROM (SELECT doc_id, rel_path, hex(encode(left(content, 12))) AS hx FROM files_lens)"""


def headed_content(files):
    """Content as bytes, with a valid container header where doc_id is even."""
    ext = file_extension("rel_path")
    pad = bytes(4)
    head = (F.when(ext.isin("mkv", "webm"), F.lit(bytearray(CT.EBML)))
            .when(ext.isin("mp4", "mov", "m4v"), F.lit(bytearray(pad + CT.FTYP)))
            .when(ext == "avi", F.lit(bytearray(CT.RIFF + pad + CT.AVI)))
            .when(ext == "ts", F.lit(bytearray(CT.TS_SYNC))).otherwise(F.lit(bytearray())))
    data = F.col("content").cast("binary")
    return files.withColumn("content", F.when(F.col("doc_id") % 2 == 0, F.concat(head, data)).otherwise(data))


@register("ct3_container_probe", PROBE_SQL, ("files_lens",))
def q_probe(spark, sf):
    f = headed_content(L.files_lens(spark, sf))
    return f.select("doc_id", CT.container_probe("content", "rel_path").cast("string").alias("probe_ok"))


@register("ct4_apply_verdicts", f"""SELECT f.doc_id, CAST(CASE WHEN regexp_matches(f.rel_path, {CORE_RE})
  THEN coalesce(v.ok, true) END AS VARCHAR) AS ok FROM files_lens f LEFT JOIN verdicts_lens v USING (doc_id)""",
          ("files_lens", "verdicts_lens"))
def q_apply_verdicts(spark, sf):
    out = CT.apply_verdicts(L.files_lens(spark, sf), L.verdicts_lens(spark, sf))
    return out.select("doc_id", F.col("ok").cast("string").alias("ok"))


@register("ct6_reconcile_manifest", """WITH mf AS (SELECT DISTINCT manifest_id AS job_id, bundle, sha256 FROM manifest_files_lens),
jobs AS (SELECT DISTINCT job_id, bundle FROM mf),
have AS (SELECT DISTINCT j.job_id, f.sha256 FROM jobs j JOIN files_lens f USING (bundle))
SELECT coalesce(mf.job_id, have.job_id) AS job_id, coalesce(mf.sha256, have.sha256) AS sha256,
  CASE WHEN mf.job_id IS NOT NULL AND have.job_id IS NOT NULL THEN 'matched'
       WHEN mf.job_id IS NOT NULL THEN 'missing' ELSE 'extra' END AS status
FROM (SELECT DISTINCT job_id, sha256 FROM mf) mf FULL OUTER JOIN have ON mf.job_id = have.job_id AND mf.sha256 = have.sha256""",
          ("manifest_files_lens",))
def q_reconcile(spark, sf):
    mf = L.manifest_files_lens(spark, sf).withColumnRenamed("manifest_id", "job_id")
    return CT.reconcile_manifest(mf, L.files_lens(spark, sf))


CT.register_validator("non_empty_no_nul", non_empty_no_nul)


@register("ud1_validator", f"""SELECT bundle AS tx, rel_path, strlen(content) > 0 AND NOT contains(content, chr(0)) AS ok
FROM files_lens WHERE regexp_matches(rel_path, {CORE_RE})""", ("files_lens",))
def q_validator(spark, sf):
    return CT.run_validator("non_empty_no_nul", L.files_lens(spark, sf).select("bundle", "rel_path", "content"))


# ------------------------------------------------------------------ aggregates
BUILD_MANIFEST_SQL = f"""SELECT bundle AS tx, to_json(struct_pack(job_id := bundle, name := bundle,
  source := concat('/srv/complete/', bundle), type := NULL::VARCHAR,
  files := coalesce(list(struct_pack(name := rel_path, hash := sha256) ORDER BY rel_path)
                    FILTER (WHERE regexp_matches(rel_path, {CORE_RE})), []::STRUCT(name VARCHAR, hash VARCHAR)[]))) AS manifest_json,
  CAST(count(*) FILTER (WHERE regexp_matches(rel_path, {CORE_RE})) AS INTEGER) AS n_files
FROM files_lens GROUP BY bundle"""


def doc_requests(files):
    return files.select(F.col("bundle").alias("tx")).distinct().select(
        "tx", F.col("tx").alias("name"), F.concat(F.lit("/srv/complete/"), "tx").alias("orig_src"))


@register("ag1_build_manifest", BUILD_MANIFEST_SQL, ("files_lens",))
def q_build_manifest(spark, sf):
    files = L.files_lens(spark, sf)
    return AG.build_manifest(files.withColumnRenamed("bundle", "tx"), doc_requests(files))


@register("ag2_bundle_hash_set", "SELECT DISTINCT bundle, sha256 AS hash FROM files_lens", ("files_lens",))
def q_hash_set(spark, sf):
    return AG.bundle_hash_set(L.files_lens(spark, sf))


@register("ag3_empty_bundles", """SELECT o_orderkey AS bundle, 'hash' AS action, 'error' AS status FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def q_empty(spark, sf):
    bundles = table(spark, sf, "orders").select(F.col("o_orderkey").alias("bundle"))
    files = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("bundle"))
    return AG.empty_bundles(bundles, files)


def doc_verdicts(spark, sf):
    return AG.bundle_verdict(L.files_lens(spark, sf), L.verdicts_lens(spark, sf))


@register("ag4_bundle_verdict", "WITH " + VERDICT_SQL + "\nSELECT * FROM verdict", ("files_lens", "verdicts_lens"))
def q_verdict(spark, sf):
    return doc_verdicts(spark, sf)


@register("ag5_bundle_size", "SELECT bundle, CAST(sum(length) AS BIGINT) AS total_bytes FROM files_lens GROUP BY bundle",
          ("files_lens",))
def q_size(spark, sf):
    return AG.bundle_size(L.files_lens(spark, sf))


@register("ag6_class_counts", f"""SELECT bundle, count(*) FILTER (WHERE c = 'core') AS core,
  count(*) FILTER (WHERE c = 'aux') AS aux, count(*) FILTER (WHERE c = 'junk') AS junk
FROM (SELECT bundle, {CLASS_SQL} AS c FROM files_lens) GROUP BY bundle""", ("files_lens",))
def q_class_counts(spark, sf):
    return AG.class_counts(L.files_lens(spark, sf))


@register("ag7_stage_outcomes", """SELECT machine, stage, status, count(*) AS n FROM logs_lens
GROUP BY ROLLUP (machine, stage, status)""", ("logs_lens",))
def q_stage_outcomes(spark, sf):
    return AG.stage_outcomes(L.logs_lens(spark, sf))


# ------------------------------------------------------------------ ordering
STABLE_SQL = """r AS (SELECT target, ts, size, row_number() OVER (PARTITION BY target ORDER BY ts, event_id) AS reading
   FROM samples_lens),
r2 AS (SELECT *, lag(size) OVER (PARTITION BY target ORDER BY reading) AS prev FROM r WHERE reading <= 100),
r3 AS (SELECT *, reading - max(CASE WHEN prev IS NULL OR prev <> size THEN reading END)
        OVER (PARTITION BY target ORDER BY reading ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS streak FROM r2),
per AS (SELECT target, min(reading) FILTER (WHERE streak >= 3) AS st, max(reading) AS n_readings FROM r3 GROUP BY target),
stab AS (SELECT p.target, CASE WHEN p.st IS NOT NULL THEN 'stable' WHEN p.n_readings >= 100 THEN 'timeout' ELSE 'waiting' END AS outcome,
   CAST(CASE WHEN p.st IS NOT NULL THEN p.st WHEN p.n_readings >= 100 THEN 100 END AS DOUBLE) AS decided_at_reading,
   (SELECT r.ts FROM r WHERE r.target = p.target AND r.reading = CASE WHEN p.st IS NOT NULL THEN p.st
        WHEN p.n_readings >= 100 THEN p.n_readings END) AS decided_at, CAST(p.n_readings AS BIGINT) AS n_readings FROM per p)"""


@register("wn1_stable_targets", "WITH " + STABLE_SQL + "\nSELECT target, outcome, decided_at_reading, "
          + TS_TEXT.format(c="decided_at") + " AS decided_at, n_readings FROM stab", ("samples_lens",))
def q_stable(spark, sf):
    st = WN.stable_targets(L.samples_lens(spark, sf))
    # Nullable integers leave as double so both engines hand back one representation.
    return st.select("target", "outcome", F.col("decided_at_reading").cast("double").alias("decided_at_reading"),
                     ts_text("decided_at").alias("decided_at"), F.col("n_readings").cast("bigint").alias("n_readings"))


@register("wn2_registry_order", """SELECT manifest_id, row_number() OVER (ORDER BY manifest_id) AS visit_order
FROM manifest_ids_lens""", ("manifest_ids_lens",))
def q_registry_order(spark, sf):
    return WN.registry_order(L.manifest_ids_lens(spark, sf))


@register("wn3_destination_collisions", f"""WITH j AS (SELECT bundle, rel_path, concat('/srv/quarantine/', bundle) AS dest
  FROM files_lens WHERE {CLASS_SQL} = 'junk')
SELECT bundle, rel_path, dest, count(*) OVER (PARTITION BY dest) AS n_planned,
  count(*) OVER (PARTITION BY dest) > 1 AS collides,
  rel_path = min(rel_path) OVER (PARTITION BY dest) AS is_winner FROM j""", ("files_lens",))
def q_collisions(spark, sf):
    f = L.files_lens(spark, sf)
    # The producer's plan: every junk file of a bundle goes to one path named after the bundle.
    plan = (f.where(classify_file("rel_path") == "junk")
            .select("bundle", "rel_path", F.concat(F.lit("/srv/quarantine/"), "bundle").alias("dest")))
    return WN.destination_collisions(plan, order=["rel_path"])


def log_halves(spark, sf):
    logs = L.logs_lens(spark, sf)
    vm = logs.where(F.col("machine") == "vm")
    host = logs.where(F.col("machine") == "host").drop("msg")
    return vm, host


@register("wn4_tx_timeline", f"""SELECT event_id, tx, row_number() OVER (PARTITION BY tx ORDER BY ts, {STAGE_RANK_SQL}, event_id) AS seq
FROM logs_lens""", ("logs_lens",))
def q_timeline(spark, sf):
    vm, host = log_halves(spark, sf)
    return WN.tx_timeline(vm, host, tiebreak=["event_id"]).select("event_id", "tx", "seq")


@register("wn5_latest_status", f"""SELECT tx, last_stage, last_status, {TS_TEXT.format(c="last_ts")} AS last_ts FROM (
  SELECT tx, stage AS last_stage, status AS last_status, ts AS last_ts,
    row_number() OVER (PARTITION BY tx ORDER BY ts DESC, {STAGE_RANK_SQL} DESC, event_id DESC) AS rn FROM logs_lens) WHERE rn = 1""",
          ("logs_lens",))
def q_latest(spark, sf):
    st = WN.latest_status(L.logs_lens(spark, sf), tiebreak=["event_id"])
    return st.withColumn("last_ts", ts_text("last_ts"))


@register("wn6_stage_durations", """SELECT tx, stage, strftime(min(ts) FILTER (WHERE status = 'running'), '%Y-%m-%d %H:%M:%S.%f') AS started,
  strftime(max(ts) FILTER (WHERE status <> 'running'), '%Y-%m-%d %H:%M:%S.%f') AS finished, count(*) AS n_rows,
  CAST(epoch_us(max(ts) FILTER (WHERE status <> 'running')) - epoch_us(min(ts) FILTER (WHERE status = 'running')) AS DOUBLE) AS duration_us,
  max(ts) FILTER (WHERE status <> 'running') IS NULL AS stuck
FROM logs_lens GROUP BY tx, stage""", ("logs_lens",))
def q_durations(spark, sf):
    d = WN.stage_durations(L.logs_lens(spark, sf))
    return (d.withColumn("duration_us", F.col("duration_us").cast("double"))
            .withColumn("started", ts_text("started")).withColumn("finished", ts_text("finished")))


@register("st1_union_logs", """SELECT event_id, tx, machine, stage, status, CASE WHEN machine = 'vm' THEN msg END AS msg
FROM logs_lens""", ("logs_lens",))
def q_union(spark, sf):
    vm, host = log_halves(spark, sf)
    return WN.union_logs(vm, host).select("event_id", "tx", "machine", "stage", "status", "msg")


@register("st2_pending_work", """SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS job_id FROM lineitem
EXCEPT SELECT job_id FROM ledger_lens""", ("ledger_lens",))
def q_pending(spark, sf):
    ids = table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("job_id"))
    return WN.pending_work(ids, L.ledger_lens(spark, sf))


# ------------------------------------------------------------------ decisions
STATE_SQL = """SELECT tx, coalesce(nullif(st, ''), 'none') AS current_state,
  CASE coalesce(nullif(st, ''), 'none') WHEN 'none' THEN 'scan' WHEN 'ingest' THEN 'scan' WHEN 'scan' THEN 'validate'
    WHEN 'validate' THEN 'manifest' WHEN 'manifest' THEN 'stage' WHEN 'stage' THEN 'done' WHEN 'done' THEN 'done' END AS next_state,
  CASE WHEN coalesce(nullif(st, ''), 'none') NOT IN ('none', 'ingest', 'scan', 'validate', 'manifest', 'stage', 'done')
    THEN concat('unknown state: ', coalesce(nullif(st, ''), 'none')) END AS state_reject
FROM (SELECT tx, CASE WHEN o_orderkey % 13 = 0 THEN 'bogus' ELSE state END AS st FROM requests_lens)"""


@register("dc1_next_state", STATE_SQL, ("requests_lens",))
def q_next_state(spark, sf):
    r = L.requests_lens(spark, sf)
    r = r.withColumn("current_state", F.when(F.col("o_orderkey") % 13 == 0, "bogus").otherwise(F.col("state")))
    out = DC.with_next_state(r.withColumn("current_state", F.coalesce(F.nullif("current_state", F.lit("")), F.lit("none"))))
    return out.select("tx", "current_state", "next_state", "state_reject")


@register("dc2_current_state", """SELECT CAST(o.o_orderkey AS VARCHAR) AS tx, coalesce(nullif(r.state, ''), 'none') AS current_state
FROM orders o LEFT JOIN (SELECT tx, state FROM requests_lens WHERE state IS NOT NULL) r ON r.tx = CAST(o.o_orderkey AS VARCHAR)""",
          ("requests_lens",))
def q_current_state(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("tx"))
    states = L.requests_lens(spark, sf).where(F.col("state").isNotNull()).select("tx", "state")
    return DC.current_state(o, states)


SEGMENT_TYPE = {"AUTOMOBILE": "movies/", "MACHINERY": "movies/", "BUILDING": "shows/", "HOUSEHOLD": "shows/"}
#: The serial rule, manifest by manifest in registry order: of the bundles that
#: match and have nothing yet, those that do not consume it take it up to the
#: first that does. Which gives the same as serving bundle by bundle, as all
#: prefer the smaller id.
PROMOTE_SQL = """pairs AS MATERIALIZED (SELECT o.manifest_id, c.bundle FROM order_manifest_lens o JOIN customer_bundle_lens c ON o.hash = c.hash
   JOIN (SELECT manifest_id, count(*) AS n FROM order_manifest_lens GROUP BY 1) s ON s.manifest_id = o.manifest_id
   GROUP BY o.manifest_id, c.bundle, s.n HAVING count(*) = s.n),
bun AS MATERIALIZED (SELECT c_custkey AS bundle, concat('/ready/', CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'movies/'
     WHEN 'MACHINERY' THEN 'movies/' WHEN 'BUILDING' THEN 'shows/' WHEN 'HOUSEHOLD' THEN 'shows/' ELSE 'other/' END, c_custkey) AS path,
     CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'movies' WHEN 'MACHINERY' THEN 'movies' WHEN 'BUILDING' THEN 'shows'
     WHEN 'HOUSEHOLD' THEN 'shows' END AS type FROM customer),
meta AS MATERIALIZED (SELECT o_orderkey AS manifest_id, CASE WHEN o_orderpriority LIKE '5%' THEN 'null' ELSE CAST(o_orderkey AS VARCHAR) END AS job_id,
   concat('order ', o_orderkey) AS name FROM orders),
expinv AS MATERIALIZED (SELECT DISTINCT concat('/export/', t, '/', l_orderkey) AS path FROM lineitem, (VALUES ('movies'), ('shows')) v(t)
   WHERE l_returnflag = 'R' AND (t = 'movies' OR l_linenumber > 1)),
led AS MATERIALIZED (SELECT job_id FROM ledger_lens),
cands AS MATERIALIZED (SELECT manifest_id, list({'b': bundle, 'nc': nc} ORDER BY bundle) AS cs, row_number() OVER (ORDER BY manifest_id) AS step
   FROM (SELECT p.manifest_id, p.bundle, m.job_id = 'null' OR m.job_id IN (SELECT job_id FROM led)
           OR concat('/export/', b.type, '/', m.job_id) IN (SELECT path FROM expinv) AS nc
         FROM pairs p JOIN bun b USING (bundle) JOIN meta m USING (manifest_id) WHERE b.type IS NOT NULL) GROUP BY manifest_id),
walk(step, taken, got) AS (
   SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]), CAST([] AS BIGINT[])
   UNION ALL
   SELECT step, list_concat(taken, got), got FROM (
     SELECT step, taken, [x.b for x in free if first IS NULL OR x.b <= first] AS got FROM (
       SELECT step, taken, free, list_min([x.b for x in free if NOT x.nc]) AS first FROM (
         SELECT c.step, w.taken, [x for x in c.cs if NOT list_contains(w.taken, x.b)] AS free
         FROM walk w JOIN cands c ON c.step = w.step + 1)))),
fm AS (SELECT unnest(w.got) AS bundle, c.manifest_id FROM walk w JOIN cands c ON c.step = w.step),
d AS (SELECT b.bundle, b.path, b.type, fm.manifest_id, meta.job_id,
     CASE WHEN meta.manifest_id IS NOT NULL THEN coalesce(meta.name, '') END AS bundle_name,
     EXISTS (SELECT 1 FROM customer_bundle_lens h WHERE h.bundle = b.bundle) AS has_files
   FROM bun b LEFT JOIN fm USING (bundle) LEFT JOIN meta USING (manifest_id)),
d2 AS (SELECT *, CASE WHEN job_id IS NOT NULL AND job_id <> '' AND job_id <> 'null'
     THEN '/export/' || type || '/' || job_id END AS dest FROM d)"""


def promote_inputs(spark, sf):
    """Manifests, destinations present and the rest of a promotion's inputs:
    orders are manifests, customers bundles. Some destinations are present
    for movies only, so a manifest's standing depends on the bundle's type."""
    o = table(spark, sf, "orders")
    meta = o.select(F.col("o_orderkey").alias("manifest_id"),
                    F.when(F.col("o_orderpriority").startswith("5"), F.lit("null"))
                     .otherwise(F.col("o_orderkey").cast("string")).alias("job_id"),
                    F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("name"))
    li = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R")
    k = F.col("l_orderkey").cast("string")
    inv = (li.select(F.concat(F.lit("/export/movies/"), k).alias("path"))
           .unionByName(li.where("l_linenumber > 1").select(F.concat(F.lit("/export/shows/"), k).alias("path"))))
    return {"bundle_hashes": L.customer_bundle_lens(spark, sf), "entries": L.order_manifest_lens(spark, sf),
            "manifests": meta, "ledger": L.ledger_lens(spark, sf), "export_inventory": inv, "incoming": "/ready",
            "export_roots": {"movies": "/export/movies", "shows": "/export/shows"},
            # Orders without line items are manifests without files; in the
            # producer's mode each would be consumed by the next bundle whatever
            # it holds (see jn3_claim_manifests). Safe mode here.
            "empty_matches": False}


def promote_bundles(customers):
    seg = F.lit("other/")
    for k, v in reversed(list(SEGMENT_TYPE.items())):
        seg = F.when(F.col("c_mktsegment") == k, F.lit(v)).otherwise(seg)
    return customers.select(F.col("c_custkey").alias("bundle"),
                            F.concat(F.lit("/ready/"), seg, F.col("c_custkey").cast("string")).alias("path"))


PROMOTE_DECISION_SQL = "WITH RECURSIVE " + PROMOTE_SQL + """
SELECT bundle, path, type, CAST(manifest_id AS VARCHAR) AS manifest_id, job_id, bundle_name, dest,
  CASE WHEN type IS NULL THEN 'ignored' WHEN NOT has_files THEN 'empty' WHEN manifest_id IS NULL THEN 'unmatched'
       WHEN job_id IS NULL OR job_id = '' OR job_id = 'null' THEN 'invalid_job_id'
       WHEN job_id IN (SELECT job_id FROM led) THEN 'skipped'
       WHEN dest IN (SELECT path FROM expinv) THEN 'exists' ELSE 'export' END AS decision FROM d2"""


@register("dc4_promote_decision", PROMOTE_DECISION_SQL, ("order_manifest_lens", "customer_bundle_lens", "ledger_lens"))
def q_promote(spark, sf):
    from bundleflow.plans.host_promote import promote_batch
    x = promote_inputs(spark, sf)
    dec = promote_batch(promote_bundles(table(spark, sf, "customer")), x.pop("bundle_hashes"), x.pop("entries"),
                        x.pop("manifests"), x.pop("ledger"), x.pop("export_inventory"), **x).decisions
    # Manifest ids are registry names: returned as text (NULL when unmatched).
    return dec.withColumn("manifest_id", F.col("manifest_id").cast("string"))


@register("dc5_pull_decision", """WITH m AS (SELECT CASE WHEN o_orderpriority LIKE '5%' THEN 'null' ELSE CAST(o_orderkey AS VARCHAR) END AS job_id,
  CASE WHEN o_orderstatus = 'P' THEN 'movies' END AS type FROM orders),
inv AS (SELECT DISTINCT 'shows' AS t, CAST(l_orderkey AS VARCHAR) AS j FROM lineitem
        UNION SELECT DISTINCT 'movies', CAST(l_orderkey AS VARCHAR) FROM lineitem WHERE l_linestatus = 'O')
SELECT job_id, type, CASE WHEN type = 'movies' THEN 'movies' ELSE 'shows' END AS local_type,
  CASE WHEN job_id IS NULL OR job_id = '' OR job_id = 'null' THEN 'invalid_manifest'
       WHEN job_id IN (SELECT job_id FROM ledger_lens) THEN 'already_processed'
       WHEN NOT EXISTS (SELECT 1 FROM inv WHERE inv.t = (CASE WHEN type = 'movies' THEN 'movies' ELSE 'shows' END) AND inv.j = job_id)
         THEN 'missing_local' ELSE 'completed' END AS decision FROM m""", ("ledger_lens",))
def q_pull(spark, sf):
    o = table(spark, sf, "orders")
    m = o.select(F.when(F.col("o_orderpriority").startswith("5"), F.lit("null"))
                 .otherwise(F.col("o_orderkey").cast("string")).alias("job_id"),
                 F.when(F.col("o_orderstatus") == "P", F.lit("movies")).alias("type"))
    li = table(spark, sf, "lineitem")
    k = F.col("l_orderkey").cast("string")
    inv = (li.select(F.lit("shows").alias("type"), k.alias("job_id"))
           .unionByName(li.where(F.col("l_linestatus") == "O").select(F.lit("movies").alias("type"), k.alias("job_id"))))
    return DC.pull_decision(m, L.ledger_lens(spark, sf), inv).select("job_id", "type", "local_type", "decision")


#: Ledger: items of even users; removed while waiting: paths of users that 5
#: divides; destination present: names of users that 7 divides.
DROP_SQL = "WITH " + STABLE_SQL + """,
a AS (SELECT event_id, ts, path, split_part(substr(path, 8), '/', 1) AS folder,
        CASE WHEN contains(substr(path, 8), '/') THEN regexp_replace(substr(path, 8), '^[^/]*/', '') ELSE substr(path, 8) END AS name,
        CAST(regexp_extract(path, '([0-9]+)', 1) AS BIGINT) AS target FROM arrivals_lens),
a2 AS (SELECT *, starts_with(name, '.') OR ends_with(name, '.part') OR ends_with(name, '.tmp') AS filtered FROM a),
firsts AS (SELECT folder, name, min(struct_pack(ts := ts, event_id := event_id)) AS f FROM a2 WHERE NOT filtered GROUP BY folder, name),
led AS (SELECT DISTINCT folder, name FROM a2 WHERE target % 2 = 0),
there AS (SELECT DISTINCT path FROM a2 WHERE target % 5 <> 0),
dest AS (SELECT DISTINCT folder, name FROM a2 WHERE target % 7 = 0),
d AS (SELECT a2.event_id, a2.folder, a2.name, a2.target, CASE WHEN a2.filtered THEN 'filtered'
        WHEN (a2.folder, a2.name) IN (SELECT (folder, name) FROM led) THEN 'already_processed'
        WHEN a2.path NOT IN (SELECT path FROM there) THEN 'removed'
        WHEN firsts.f IS NULL OR firsts.f <> struct_pack(ts := a2.ts, event_id := a2.event_id) THEN 'already_processed'
        WHEN (a2.folder, a2.name) IN (SELECT (folder, name) FROM dest) THEN 'exists'
        ELSE 'move' END AS decision FROM a2 LEFT JOIN firsts USING (folder, name))
SELECT d.event_id, d.folder, d.name, d.decision, d.decision = 'move' AND coalesce(s.outcome, '') <> 'stable' AS unstable_warning
FROM d LEFT JOIN stab s ON s.target = d.target"""


@register("dc6_drop_decision", DROP_SQL, ("samples_lens", "arrivals_lens"))
def q_drop(spark, sf):
    a = L.arrivals_lens(spark, sf)
    user = F.regexp_extract("path", r"([0-9]+)", 1).cast("bigint")
    stab = WN.stable_targets(L.samples_lens(spark, sf))
    # readings are taken per user; an item's target is its path
    stab = a.select("path", user.alias("target")).distinct().join(stab, "target").select(
        F.col("path").alias("target"), "outcome")
    folder, name = P.split_drop_path("path", "/ready")
    led = a.where(user % 2 == 0).select(folder.alias("folder"), name.alias("name"))
    dest = a.where(user % 7 == 0).select(F.concat_ws("/", F.lit("/dest"), folder, name).alias("path"))
    d = DC.drop_decision(a, "/ready", ledger=led, existing=a.where(user % 5 != 0).select("path"), dest_inventory=dest,
                         stability=stab)
    return d.select("event_id", "folder", "name", "decision", "unstable_warning")


# Legal steps between a user's event types, taken as states.
EVENT_STEPS = (("signup", "view"), ("view", "click"), ("click", "purchase"), ("click", "view"), ("view", "view"))


@register("dc7_transition_audit", """WITH s AS (SELECT user_id AS tx, event_id AS seq, event_type AS state,
    lead(event_id) OVER w AS next_seq, lead(event_type) OVER w AS next_state
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
SELECT tx, seq, state, next_seq, next_state FROM s WHERE next_seq IS NOT NULL AND (state, next_state) NOT IN (
  ('signup', 'view'), ('view', 'click'), ('click', 'purchase'), ('click', 'view'), ('view', 'view'))""")
def q_audit(spark, sf):
    allowed = spark.createDataFrame(list(EVENT_STEPS), "from_state string, to_state string")
    history = table(spark, sf, "events").select(F.col("user_id").alias("tx"), F.col("event_id").alias("seq"),
                                                F.col("event_type").alias("state"))
    return DC.transition_audit(history, allowed)


#: The bundles' stored states, in turn by their first document; the last one is no state.
DC3_STATES = ("none", "ingest", "scan", "validate", "manifest", "stage", "done", "paused")
DC3_SQL = "WITH " + SIG_SQL + f""",
st AS (SELECT bundle, CAST(min(doc_id) % 8 AS INT) AS rank, {list(DC3_STATES)}[min(doc_id) % 8 + 1] AS state FROM files_lens GROUP BY bundle),
v AS (SELECT f.bundle, f.rel_path, st.rank, (coalesce(l.infected, false) OR fl.dh OR fl.phit OR {BLIND_SQL}) AND st.rank < 3 AS infected,
     regexp_matches(f.rel_path, {CORE_RE}) AND NOT coalesce(l.ok, true) AND st.rank < 4 AS bad_core, {CLASS_SQL} AS class
   FROM files_lens f LEFT JOIN verdicts_lens l USING (doc_id) JOIN flags fl USING (doc_id) JOIN st ON st.bundle = f.bundle),
agg AS (SELECT bundle, rank, min(rel_path) FILTER (WHERE infected) AS fi, min(rel_path) FILTER (WHERE bad_core) AS fc,
     count(*) FILTER (WHERE class = 'core') AS n_core, count(*) FILTER (WHERE class = 'junk') AS n_junk FROM v GROUP BY bundle, rank),
r AS (SELECT bundle, rank, n_core, n_junk, CASE WHEN fi IS NOT NULL THEN 'infected' WHEN fc IS NOT NULL THEN 'corrupt' ELSE 'passed' END AS outcome,
     CASE WHEN fi IS NOT NULL THEN 'security' WHEN fc IS NOT NULL THEN 'validation' END AS failed_stage, coalesce(fi, fc) AS first_bad FROM agg)
SELECT bundle AS tx, outcome, failed_stage, first_bad, CASE WHEN outcome = 'passed' THEN 'done' ELSE 'quarantined' END AS final_state,
  CASE WHEN outcome = 'passed' THEN concat('/srv/staging/', bundle, '.dir') ELSE concat('/srv/quarantine/', bundle) END AS dest,
  CAST(CASE WHEN outcome = 'passed' AND rank <= 4 THEN n_core END AS DOUBLE) AS n_manifest_files,
  CASE WHEN outcome = 'passed' AND rank < 4 THEN n_junk ELSE 0 END AS n_junk_isolated FROM r WHERE rank < 6
UNION ALL SELECT bundle, 'rejected', 'state', concat('unknown state: ', state), state, NULL, NULL, 0 FROM st WHERE rank = 7
UNION ALL SELECT DISTINCT concat('gone-', lang), 'rejected', 'ingest', 'context hydration failed: cannot resolve FILE_PATH', 'validate', NULL, NULL, 0
  FROM documents"""


@register("dc3_advance_batch", DC3_SQL, ("files_lens", "verdicts_lens"))
def q_advance(spark, sf):
    """All stored states, bundles with files that cannot be read, and
    transactions whose bundle is nowhere."""
    from bundleflow.plans.vm_ingest import advance_batch
    files, deny, pats = signature_inputs(spark, sf)
    first = files.groupBy(F.col("bundle").alias("tx")).agg(F.min("doc_id").alias("d"))
    states = first.select("tx", F.element_at(F.array(*map(F.lit, DC3_STATES)), (F.col("d") % 8 + 1).cast("int")).alias("state"))
    gone = table(spark, sf, "documents").select(F.concat(F.lit("gone-"), "lang").alias("tx")).distinct()
    requests = doc_requests(files).unionByName(gone.select("tx", F.col("tx").alias("name"), F.lit("/srv/complete/gone").alias("orig_src")))
    states = states.unionByName(gone.select("tx", F.lit("validate").alias("state")))
    res = advance_batch(partly_unreadable(files).withColumnRenamed("bundle", "tx"), requests, L.verdicts_lens(spark, sf),
                        deny_digests=deny, patterns=pats, layout=LAYOUT, states=states)
    return res.results.select("tx", "outcome", "failed_stage", "first_bad", "final_state", "dest",
                              F.col("n_manifest_files").cast("double").alias("n_manifest_files"), "n_junk_isolated")


#: Bundles of few files each, so that some pass: source, language and a digit of the id.
SMALL_SQL = "small AS (SELECT * REPLACE (concat(bundle, '-', string_split(rel_path, '/')[1], '-', doc_id % 10) AS bundle) FROM files_lens)"


@register("dc3_resume_stages", "WITH " + SMALL_SQL + ",\n" + VERDICT_SQL.replace("files_lens", "small") + """,
n AS (SELECT bundle, count(*) AS n_all FROM small GROUP BY bundle)
SELECT bundle AS tx, CASE outcome WHEN 'passed' THEN 'done' WHEN 'infected' THEN 'scan' ELSE 'validate' END AS state,
  CAST(CASE WHEN outcome = 'passed' THEN n_core END AS DOUBLE) AS n_manifest_files,
  CASE WHEN outcome = 'passed' THEN n_core + n_aux ELSE 0 END AS n_staged,
  CASE WHEN outcome = 'passed' THEN n_junk_isolated ELSE n_all END AS n_quarantined FROM verdict JOIN n USING (bundle)""",
          ("files_lens", "verdicts_lens"))
def q_resume(spark, sf):
    """Real files through all stages in two runs, the first of which ends after
    the scan. What stands in the folders is counted."""
    from bundleflow.plans.materialize import fresh_root, write_files
    from bundleflow.plans.stage_runner import run_stages
    from bundleflow.sources.files import scan_files
    from bundleflow.sources.manifests import read_manifests
    root = fresh_root(spark, "dc3")
    layout = Layout(**{n: f"{root}/{n}" for n in ("download", "processing", "staging", "quarantine", "registry")})
    for folder in (layout.staging, layout.quarantine, layout.registry):
        os.makedirs(folder)
    files = L.files_lens(spark, sf)
    files = files.withColumn("bundle", F.concat_ws("-", "bundle", F.substring_index("rel_path", "/", 1), F.col("doc_id") % 10))
    write_files(files, layout.download)
    requests = doc_requests(files).withColumn("orig_src", F.concat(F.lit(layout.download + "/"), "tx"))
    v = files.join(L.verdicts_lens(spark, sf), "doc_id").select(F.col("bundle").alias("tx"), "rel_path", "infected", "ok")
    for last in ("scan", None):
        run = run_stages(requests, layout, stage_table=f"{root}/stages", log_dir=f"{root}/logs", verdicts=v, stop_after=last)
    listed = read_manifests(spark, layout.registry).select(F.col("job_id").alias("tx"), F.size("files").cast("double").alias("n_manifest_files"))
    def count(folder, suffix, name):
        tx = F.regexp_replace("bundle", suffix, "")
        return scan_files(spark, folder).groupBy(tx.alias("tx")).agg(F.count(F.lit(1)).alias(name))
    staged = count(layout.staging, r"\.dir\z", "n_staged")
    quarantined = count(layout.quarantine, r"\.junk\z", "n_quarantined")
    return (run.states.join(listed, "tx", "left").join(staged, "tx", "left").join(quarantined, "tx", "left")
            .fillna(0, ["n_staged", "n_quarantined"]))
