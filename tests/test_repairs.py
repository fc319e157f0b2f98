"""Cases that once went wrong: rows lost by sequences, exports repeated,
checks that failed open, partial results."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from bundleflow.operators import content as CT
from bundleflow.operators import ordering as WN
from bundleflow.plans import host_promote as HP
from bundleflow.sources.routing import move_plan


def test_sequence_keeps_rows_with_payload(spark):
    n = 200_000
    df = spark.range(n).select((F.col("id") % 37).alias("g"), F.xxhash64("id").alias("o"), F.col("id").alias("payload"),
                               F.md5(F.col("id").cast("string")).alias("text"))
    out = WN.sequence_within(df, ["g"], ["o"])
    from pyspark.sql import Window
    want = F.row_number().over(Window.partitionBy("g").orderBy("o"))
    bad = out.withColumn("want", want).filter("seq <> want").count()
    assert out.count() == n and out.select("payload").distinct().count() == n and bad == 0


def test_stream_waits_for_a_slow_sink(spark, tmp_path):
    from bundleflow.streaming.watchers import run_to_completion
    src = str(tmp_path / "in")
    for i in range(3):
        spark.range(i * 10, i * 10 + 10).coalesce(1).write.mode("append").parquet(src)
    seen = []

    def slow(batch, batch_id):
        time.sleep(1)
        seen.extend(r.id for r in batch.collect())

    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", "1").parquet(src)
    q = run_to_completion(stream, slow, str(tmp_path / "ck"))
    assert sorted(seen) == list(range(30)) and not q.isActive


@pytest.mark.parametrize("n", [10, 100])
def test_empty_patterns_are_in_no_file(spark, n):
    files = spark.createDataFrame([("b", "f", "nothing here", "h")], "bundle string, rel_path string, content string, sha256 string")
    pats = spark.createDataFrame([("",), (None,)] + [(f"p{i}x",) for i in range(n)], "text string")
    out = CT.flag_signatures(files, None, pats)
    assert out.schema["pattern_hits"].dataType.simpleString() == "bigint"
    assert [(r.pattern_hits, r.flagged) for r in out.collect()] == [(0, False)]


def test_patterns_by_path(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(CT, "CHUNK", 8)  # a pattern lies across two reads
    (tmp_path / "a").write_bytes(b"xxxxxxbad wordxxxx")
    (tmp_path / "b").write_bytes(b"fine")
    rows = [("b", n, str(tmp_path / n), None, "h") for n in ("a", "b", "gone")]
    files = spark.createDataFrame(rows, "bundle string, rel_path string, path string, content string, sha256 string")
    pats = spark.createDataFrame([("bad word",)], "text string")
    got = {r.rel_path: r.flagged for r in CT.flag_signatures(files, None, pats, path="path").collect()}
    assert got == {"a": True, "b": False, "gone": True}


def test_no_verdict_is_not_staged(spark):
    files = spark.createDataFrame([("b1", "x.mkv"), ("b2", "y.mkv")], "bundle string, rel_path string")
    verdicts = spark.createDataFrame([("b1", "passed")], "bundle string, outcome string")
    got = {r.bundle: r.route for r in move_plan(files, verdicts, staging="/s", quarantine="/q").collect()}
    assert got == {"b1": "staged", "b2": "quarantine"}


def test_denied_subtitle_and_pattern_on_real_files(spark, tmp_path):
    import hashlib
    from bundleflow.operators.filters import Layout
    from bundleflow.plans.vm_ingest import ingest_requests
    for name, data in (("A/a.mkv", b"film"), ("A/a.srt", b"denied"), ("B/b.mkv", b"has EVIL in it"), ("C/c.mkv", b"good")):
        os.makedirs(tmp_path / name.split("/")[0], exist_ok=True)
        (tmp_path / name).write_bytes(data)
    req = spark.createDataFrame([(t, f"{tmp_path}/{t}", t) for t in "ABC"], "name string, orig_src string, tx string")
    deny = spark.createDataFrame([(hashlib.sha256(b"denied").hexdigest(),)], "sha256 string")
    pats = spark.createDataFrame([("EVIL",)], "text string")
    _, res, _ = ingest_requests(req, Layout(download=str(tmp_path)), deny_digests=deny, patterns=pats)
    assert {r.tx: r.outcome for r in res.results.collect()} == {"A": "infected", "B": "infected", "C": "passed"}


def test_unknown_state_is_rejected(spark):
    from bundleflow.plans.vm_ingest import advance_batch
    files = spark.createDataFrame([(t, "a.mkv", "x", "h" + t, i) for i, t in enumerate("ab")],
                                  "tx string, rel_path string, content string, sha256 string, doc_id long")
    req = spark.createDataFrame([(t, t, "/x/" + t) for t in "ab"], "tx string, name string, orig_src string")
    states = spark.createDataFrame([("a", "bogus"), ("b", "scan")], "tx string, state string")
    res = advance_batch(files, req, states=states)
    assert {r.tx: r.outcome for r in res.results.collect()} == {"a": "rejected", "b": "passed"}
    assert {r.bundle for r in res.routes.collect()} == {"b"}


def promote(spark, bundles, hashes, entries, manifests, ledger=(), present=(), unreadable=()):
    df = spark.createDataFrame
    return HP.promote_batch(
        df(bundles, "bundle string, path string, at long"), df(hashes, "bundle string, hash string"),
        df(entries, "manifest_id string, hash string"), df(manifests, "manifest_id string, job_id string, name string"),
        df([(x,) for x in ledger], "job_id string"), df([(x,) for x in present], "path string"), incoming="/in",
        export_roots={"movies": "/ex/movies", "shows": "/ex/shows"}, arrival="at",
        unreadable=df([(x,) for x in unreadable], "bundle string"))


def outcomes(res):
    return {r.bundle: r.decision for r in res.decisions.collect()}


def test_a_job_is_exported_once(spark):
    rnd = random.Random(1)
    bundles = [(f"b{i}", f"/in/{rnd.choice(['movies', 'shows'])}/b{i}", i) for i in range(12)]
    hashes = [(b, h) for b, _, _ in bundles for h in "xyz"]
    res = promote(spark, bundles, hashes, [("m1", "x"), ("m2", "y"), ("m3", "z")], [(f"m{i}", f"j{i}", None) for i in (1, 2, 3)])
    got = outcomes(res)
    assert [got[f"b{i}"] for i in range(4)] == ["export"] * 3 + ["unmatched"]
    assert res.exports.count() == 3 == res.exports.select("job_id").distinct().count()


def test_standing_is_per_type(spark):
    bundles = [("a", "/in/movies/a", 1), ("b", "/in/movies/b", 2), ("c", "/in/shows/c", 3), ("d", "/in/movies/d", 4)]
    got = outcomes(promote(spark, bundles, [(b, "x") for b, _, _ in bundles], [("m", "x")], [("m", "j", None)], present=["/ex/movies/j"]))
    assert got == {"a": "exists", "b": "exists", "c": "export", "d": "unmatched"}


def test_ignored_empty_and_unreadable_bundles_take_nothing(spark):
    bundles = [("a", "/in/other/a", 1), ("e", "/in/movies/e", 2), ("u", "/in/movies/u", 3), ("b", "/in/movies/b", 4)]
    got = outcomes(promote(spark, bundles, [(b, "x") for b in "aub"], [("m", "x")], [("m", "j", None)], unreadable=["u"]))
    assert got == {"a": "ignored", "e": "empty", "u": "hash_error", "b": "export"}


def test_unreadable_folder_is_reported(spark, tmp_path, monkeypatch):
    from bundleflow.sources import files as FS
    os.makedirs(tmp_path / "b" / "sub")
    (tmp_path / "b" / "sub" / "f").write_bytes(b"1")
    import pandas as pd

    def scandir(top):
        raise PermissionError(13, "no", top)
    monkeypatch.setattr(FS.os, "scandir", scandir)
    unit = pd.DataFrame({"root": [str(tmp_path)], "bundle": ["b"], "path": [str(tmp_path / "b" / "sub")], "kind": ["dir"]})
    rows = pd.concat(FS._walk_some(iter([unit])))
    assert rows.path.tolist() == [str(tmp_path / "b" / "sub")] and rows.length.isna().all()


def run_stability(spark, tmp_path, batches, **kw):
    from bundleflow.streaming import watchers as SR
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    for rows in batches:
        df = spark.createDataFrame(rows, "target string, event_id long, size long").withColumn(
            "ts", F.timestamp_seconds(F.col("event_id") * 3))
        df.coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(df.schema).parquet(src)
        SR.run_to_completion(SR.stability_stream(stream, **kw), lambda b, i: SR.write_batch(b, out, i), ck)
        time.sleep(1)
    return sorted((r.target, r.outcome, r.decided_at_reading) for r in spark.read.parquet(out).collect())


def test_a_target_is_decided_once(spark, tmp_path):
    batches = [[("a", i, 5) for i in range(5)], [("a", i, 5) for i in range(5, 10)]]
    assert run_stability(spark, tmp_path, batches) == [("a", "stable", 4)]


def test_a_silent_target_times_out(spark, tmp_path):
    """Timers need a query that goes on running."""
    from bundleflow.streaming import watchers as SR
    src, ck = str(tmp_path / "in"), str(tmp_path / "ck")
    df = spark.createDataFrame([("a", 0, 5)], "target string, event_id long, size long").withColumn(
        "ts", F.timestamp_seconds(F.col("event_id") * 3))
    df.coalesce(1).write.parquet(src)
    got = []
    stream = SR.stability_stream(spark.readStream.schema(df.schema).parquet(src), silence="0.5 seconds")
    q = (stream.writeStream.foreachBatch(lambda b, i: got.extend(b.collect())).option("checkpointLocation", ck)
         .trigger(processingTime="300 milliseconds").start())
    try:
        for _ in range(120):
            if got:
                break
            time.sleep(0.5)
    finally:
        q.stop()
    assert [(r.target, r.outcome, r.decided_at_reading) for r in got] == [("a", "timeout", 1)]


def test_contents_reach_python_in_batches_of_bounded_bytes(spark, tmp_path, monkeypatch):
    """No batch of whole contents is larger than the bound, however many rows
    a task has: in writing files and in the search for patterns."""
    import pandas as pd
    from bundleflow.operators import content as CT
    from bundleflow.plans.materialize import write_files
    from bundleflow.session import BATCH_BYTES
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    files = spark.range(3000, numPartitions=1).select(
        F.lit("b").alias("bundle"), F.col("id").cast("string").alias("rel_path"), F.repeat(F.lit("text "), 800).alias("content"))

    def sizes(batches):
        for pdf in batches:
            yield pd.DataFrame({"n": [int(pdf["content"].str.len().sum())]})

    def largest():
        return max(r.n for r in files.mapInPandas(sizes, "n long").collect())
    spark.conf.unset(key)
    try:
        assert largest() > BATCH_BYTES
        assert write_files(files, str(tmp_path)) == 3000
        assert largest() <= 1.1 * BATCH_BYTES
        spark.conf.unset(key)
        hits = CT.flag_signatures(files, None, spark.createDataFrame([("text text",)], "text string"))
        assert largest() <= 1.1 * BATCH_BYTES and hits.where("flagged").count() == 3000
    finally:
        spark.conf.unset(key)


def test_equal_short_files_are_names_of_one(spark, tmp_path):
    """A folder takes one file per short content and not one per row; names and
    contents are all there, and a name that stood there is replaced, not written through."""
    from bundleflow.plans.materialize import _linked, write_files
    rows = [("reg", f"{i}.{k}", c) for i in range(300) for k, c in (("ingest.done", ""), ("state", "done" if i % 2 else "none"), ("txt", "x" * 99))]
    files = spark.createDataFrame(rows, "bundle string, rel_path string, content string").coalesce(1)
    os.makedirs(tmp_path / "reg")
    (tmp_path / "other").write_text("kept")
    os.link(tmp_path / "other", tmp_path / "reg" / "7.state")
    for _ in range(2):  # as when a task is run again
        assert write_files(files, str(tmp_path), link=True) == len(rows)
        assert {e.name: (tmp_path / "reg" / e.name).read_text() for e in os.scandir(tmp_path / "reg")} == {r: c for _, r, c in rows}
        assert len({e.inode() for e in os.scandir(tmp_path / "reg") if not e.name.endswith(".txt")}) == 3
    assert (tmp_path / "other").read_text() == "kept"
    assert not _linked(str(tmp_path / "gone"), str(tmp_path / "new")) and not (tmp_path / "new").exists()


def test_markers_query_makes_few_files(spark, monkeypatch):
    """io6_read_stage_markers writes its registry with links, in several rounds."""
    from bundleflow.plans import queries_io as Q
    made, write = [], Q.write_files
    monkeypatch.setattr(Q, "FOLDER_FILES", 1000)
    monkeypatch.setattr(Q, "ROUND_FOLDERS", 2)

    def counted(files, root, **kw):
        n = write(files, root, **kw)
        made.append((n, len({e.inode() for d in os.scandir(root) if d.name.startswith("registry") for e in os.scandir(d.path)})))
        return n
    monkeypatch.setattr(Q, "write_files", counted)
    rows = Q.q_markers(spark, "/root/testdata/sf0.001")
    assert rows.where("kind = 'state'").count() == 1500 and len(made) > 1
    assert all(files <= 10 < n for n, files in made)
