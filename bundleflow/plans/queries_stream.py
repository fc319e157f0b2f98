"""Registered queries of the streaming operators (SR). Each runs its stream
over a driver table to completion (``availableNow``) into a sink below the
shared checkpoint folder and returns that sink as a batch DataFrame, so the
result can be held against the batch oracle."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from bundleflow.plans import lenses as L
from bundleflow.plans.catalog import register, ts_text
from bundleflow.plans.materialize import fresh_root, write_files
from bundleflow.plans.queries_io import SPLIT_SQL
from bundleflow.plans.queries_ops import PROMOTE_DECISION_SQL, STABLE_SQL, promote_bundles, promote_inputs
from bundleflow.session import table
from bundleflow.streaming import watchers as SR


def _sink_query(spark, stream_df, label, transform=None):
    out = fresh_root(spark, f"{label}-out")
    ck = fresh_root(spark, f"{label}-ck")

    def handle(batch, batch_id):
        SR.write_batch(transform(batch) if transform else batch, out, batch_id)

    SR.run_to_completion(stream_df, handle, ck)
    return spark.read.parquet(out).drop("batch_id")


@register("sr1_watch_ready", """SELECT event_id, path, CASE WHEN starts_with(path, '/ready/movies/') THEN 'movies'
  WHEN starts_with(path, '/ready/shows/') THEN 'shows' END AS type FROM arrivals_lens WHERE is_dir""", ("arrivals_lens",))
def q_watch_ready(spark, sf):
    arrivals = L.arrivals_lens(spark, sf, src=SR.stream_table(spark, sf, "events"))
    ready = SR.watch_ready(arrivals, "/ready").select("event_id", "path", "type")
    return _sink_query(spark, ready, "sr1")


@register("sr2_watch_drop", "SELECT s.event_id, CASE WHEN a.is_dir THEN 'moved_to' ELSE 'close_write' END AS event_kind, "
          "s.folder, s.name FROM (" + SPLIT_SQL + """) s JOIN arrivals_lens a USING (event_id)
WHERE NOT (starts_with(s.name, '.') OR ends_with(s.name, '.part') OR ends_with(s.name, '.tmp'))""", ("arrivals_lens",))
def q_watch_drop(spark, sf):
    a1 = L.arrivals_lens(spark, sf, src=SR.stream_table(spark, sf, "events"))
    a2 = L.arrivals_lens(spark, sf, src=SR.stream_table(spark, sf, "events"))
    closes = a1.where(~F.col("is_dir"))
    moves = a2.where(F.col("is_dir"))
    drop = SR.watch_drop(closes, moves, "/ready").select("event_id", "event_kind", "folder", "name")
    return _sink_query(spark, drop, "sr2")


@register("sr3_stability_stream", "WITH " + STABLE_SQL + """
SELECT target, outcome, CAST(decided_at_reading AS INTEGER) AS decided_at_reading,
  strftime(decided_at, '%Y-%m-%d %H:%M:%S.%f') AS decided_at FROM stab
WHERE outcome IN ('stable', 'timeout')""", ("samples_lens",))
def q_stability_stream(spark, sf):
    samples = L.samples_lens(spark, sf, src=SR.stream_table(spark, sf, "events"))
    out = _sink_query(spark, SR.stability_stream(samples), "sr3")
    return out.withColumn("decided_at", ts_text("decided_at"))


@register("sr4_dedupe_stream", """SELECT event_id, path FROM (SELECT event_id, path,
  row_number() OVER (PARTITION BY path ORDER BY ts, event_id) AS rn FROM arrivals_lens) WHERE rn = 1""", ("arrivals_lens",))
def q_dedupe_stream(spark, sf):
    arrivals = L.arrivals_lens(spark, sf, src=SR.stream_table(spark, sf, "events"))
    out, led, ck = fresh_root(spark, "sr4-out"), fresh_root(spark, "sr4-ledger"), fresh_root(spark, "sr4-ck")
    SR.dedupe_stream(spark, arrivals.select("event_id", "ts", "path"), ["path"], ["ts", "event_id"], out, led, ck)
    return spark.read.parquet(out).select("event_id", "path")


@register("sr5_promote_stream", PROMOTE_DECISION_SQL, ("order_manifest_lens", "customer_bundle_lens", "ledger_lens"))
def q_promote_stream(spark, sf):
    """The customers arrive in three micro-batches, in order of their key."""
    cust = table(spark, sf, "customer")
    third = cust.agg(F.ceil((F.max("c_custkey") + 1) / 3).alias("n")).first()["n"] or 1
    folder, base, ck = (fresh_root(spark, x) for x in ("sr5-in", "sr5", "sr5-ck"))
    for i in range(3):
        part = F.floor(F.col("c_custkey") / third)
        cust.where(part == i).coalesce(1).write.mode("append").parquet(folder)
    arriving = spark.readStream.schema(cust.schema).option("maxFilesPerTrigger", "1").parquet(folder)
    SR.promote_stream(spark, promote_bundles(arriving), promote_inputs(spark, sf), base, ck)
    dec = spark.read.parquet(f"{base}/decisions").drop("batch_id")
    return dec.withColumn("manifest_id", F.col("manifest_id").cast("string"))


@register("sr1_watch_folder", """SELECT concat(t, '/', c_custkey) AS name, t AS type, CAST(c_custkey % 2 AS BIGINT) AS wave FROM (
  SELECT c_custkey, CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'movies' ELSE 'shows' END AS t FROM customer)
WHERE c_custkey % 3 <> 0""")
def q_watch_folder(spark, sf):
    """Customers as entries of a ready folder, made in two waves, each followed
    by a run of the watching query; every third one is a file and no bundle."""
    root = fresh_root(spark, "ready")
    kind = F.when(F.col("c_mktsegment").isin("AUTOMOBILE", "MACHINERY"), "movies").otherwise("shows")
    c = table(spark, sf, "customer").select(
        kind.alias("bundle"), F.col("c_custkey").alias("k"), F.lit("x").alias("content"),
        F.concat(F.col("c_custkey"), F.when(F.col("c_custkey") % 3 == 0, "").otherwise("/media.mkv")).alias("rel_path"))

    def keep(batch, batch_id):
        SR.write_batch(batch.select("path", "type"), f"{root}/out", batch_id)

    for wave in (0, 1):
        write_files(c.where(F.col("k") % 2 == wave), f"{root}/in")
        SR.run_to_completion(SR.watch_ready_folder(spark, f"{root}/in", f"{root}/seen"), keep, f"{root}/ck")
    out = spark.read.parquet(f"{root}/out")
    waves = out.select("batch_id").distinct().withColumn("wave", F.dense_rank().over(Window.orderBy("batch_id")) - 1)
    return out.join(waves, "batch_id").select(
        F.substring_index("path", "/", -2).alias("name"), "type", F.col("wave").cast("long").alias("wave"))
