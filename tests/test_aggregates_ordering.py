"""Fail-closed verdicts, manifests, collisions, streaks and skew-safe sequences."""

import json

from pyspark.sql import Window
from pyspark.sql import functions as F

from bundleflow.operators import aggregates as AG
from bundleflow.operators import ordering as WN
from bundleflow.sources.routing import move_plan

FILES = "bundle string, rel_path string, doc_id long, infected boolean, ok boolean"


def test_manifest_with_aux_only_has_empty_files(spark):
    files = spark.createDataFrame([("t1", "s.srt", "h1"), ("t2", "a.mkv", "h2"), ("t2", "b.nfo", "h3")],
                                  "tx string, rel_path string, sha256 string")
    req = spark.createDataFrame([("t1", "", "/d/t1"), ("t2", "two", "/d/t2")],
                                "tx string, name string, orig_src string")
    got = {r.tx: json.loads(r.manifest_json) for r in AG.build_manifest(files, req).collect()}
    assert got["t1"] == {"job_id": "t1", "name": "unknown", "source": "/d/t1", "type": None, "files": []}
    assert got["t2"]["files"] == [{"name": "a.mkv", "hash": "h2"}]


def test_verdict_is_fail_closed(spark):
    rows = [
        ("inf", "a.mkv", 1, True, True), ("inf", "j1.txt", 2, False, None), ("inf", "j2.txt", 3, False, None),
        ("bad", "a.mkv", 4, False, False), ("bad", "j.txt", 5, False, None),
        ("ok", "a.mkv", 6, False, True), ("ok", "s.srt", 7, False, None), ("ok", "j1.txt", 8, False, None),
        ("ok", "j2.txt", 9, False, None),
    ]
    files = spark.createDataFrame(rows, FILES)
    v = {r.bundle: r for r in AG.bundle_verdict(files).collect()}
    assert (v["inf"].outcome, v["inf"].failed_stage, v["inf"].first_bad, v["inf"].n_junk_isolated) == \
        ("infected", "security", "a.mkv", 0)
    assert (v["bad"].outcome, v["bad"].first_bad, v["bad"].n_junk_isolated) == ("corrupt", "a.mkv", 0)
    assert (v["ok"].outcome, v["ok"].n_junk_isolated) == ("passed", 2)
    plan = move_plan(files, AG.bundle_verdict(files), staging="/st", quarantine="/q")
    routes = {(r.bundle, r.rel_path): (r.route, r.dest) for r in plan.collect()}
    assert routes[("inf", "j1.txt")][0] == "quarantine"  # whole bundle; no separate junk row
    assert routes[("ok", "j1.txt")] == ("quarantine_junk", "/q/ok.junk/j1.txt")
    assert routes[("ok", "a.mkv")] == ("staged", "/st/ok.dir/a.mkv")
    # The producer's plan sends both junk files to one path: WN-3 reports it.
    prod = files.where(F.col("bundle") == "ok").where(F.col("rel_path").startswith("j")) \
        .select("bundle", "rel_path", F.concat(F.lit("/q/"), "bundle").alias("dest"))
    col = WN.destination_collisions(prod, order=["rel_path"]).collect()
    assert all(r.collides for r in col) and sorted(r.is_winner for r in col) == [False, True]


def test_class_counts_and_size(spark):
    files = spark.createDataFrame([("b", "a.mkv", 10), ("b", "a.MKV", 5), ("b", "s.ass", 1)],
                                  "bundle string, rel_path string, length long")
    r = AG.class_counts(files).first()
    assert (r.core, r.aux, r.junk) == (1, 1, 1)
    assert AG.bundle_size(files).first().total_bytes == 16


def samples(spark, series):
    rows = []
    for target, sizes in series.items():
        for i, s in enumerate(sizes):
            rows.append((target, i, s))
    return (spark.createDataFrame(rows, "target string, event_id long, size long")
            .withColumn("ts", F.timestamp_seconds(F.col("event_id") * 3)))


def test_stability_rules(spark):
    s = samples(spark, {"a": [5, 5, 5, 5], "b": [5, 5, 5, 6, 6, 6, 6], "c": [i % 2 for i in range(120)],
                        "d": [1, 1, 2]})
    got = {r.target: (r.outcome, r.decided_at_reading) for r in WN.stable_targets(s).collect()}
    assert got == {"a": ("stable", 4), "b": ("stable", 7), "c": ("timeout", 100), "d": ("waiting", None)}


def test_sequence_within_matches_row_number_on_skew(spark):
    # One transaction holds most rows: it must be split over several partitions.
    hot = [("hot", i, i % 5) for i in range(3000)]
    cold = [(f"c{k}", i, i) for k in range(50) for i in range(7)]
    df = spark.createDataFrame(hot + cold, "tx string, n long, v long")
    got = WN.sequence_within(df, ["tx"], ["v", "n"], out="seq", num_partitions=8)
    ref = df.withColumn("seq", F.row_number().over(Window.partitionBy("tx").orderBy("v", "n")))
    assert got.select("tx", "n", "seq").exceptAll(ref.select("tx", "n", F.col("seq").cast("long"))).count() == 0
    assert got.count() == df.count()
    # and the hot key did not land in a single partition
    parts = (df.repartitionByRange(8, "tx", "v", "n").where(F.col("tx") == "hot")
             .select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts > 1


def test_registry_order_is_dense(spark):
    ids = spark.createDataFrame([(f"m{i:03d}",) for i in range(200)], "manifest_id string")
    got = [r.visit_order for r in WN.registry_order(ids).orderBy("manifest_id").collect()]
    assert got == list(range(1, 201))


def test_durations_and_latest(spark):
    logs = spark.createDataFrame([
        ("t", "ingest", "running", 0, 1), ("t", "ingest", "success", 5, 2),
        ("t", "security", "running", 5, 3),
    ], "tx string, stage string, status string, sec long, event_id long").withColumn(
        "ts", F.timestamp_seconds("sec"))
    d = {r.stage: r for r in WN.stage_durations(logs).collect()}
    assert d["ingest"].duration_us == 5_000_000 and not d["ingest"].stuck
    assert d["security"].stuck
    last = WN.latest_status(logs, tiebreak=["event_id"]).first()
    assert (last.last_stage, last.last_status) == ("security", "running")  # same second: stage rank decides


def test_sequence_within_null_groups(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), ("a", 2), ("a", 1)], "g string, n long")
    got = {(r.g, r.n, r.seq) for r in WN.sequence_within(df, ["g"], ["n"], num_partitions=3).collect()}
    assert got == {(None, 1, 1), (None, 3, 2), ("a", 1, 1), ("a", 2, 2)}
