"""File-system sources on real folders, sinks, and the decision cascades."""

import json
import os

import pytest

from pyspark.sql import functions as F

from bundleflow.operators import decisions as DC
from bundleflow.sources import files as IOF
from bundleflow.sources import ledger as IOL
from bundleflow.sources import logs as IOG
from bundleflow.sources import manifests as IOM


def write(path, data=b"x"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(data)


def test_scan_files_like_find(spark, tmpdir_fresh):
    root = tmpdir_fresh
    write(f"{root}/b1/a.mkv", b"abc")
    write(f"{root}/b1/.hidden.srt", b"s")
    write(f"{root}/b1/_under/x.nfo", b"n")
    write(f"{root}/b1/sub dir/name with space.mp4", b"zz")
    write(f"{root}/single.mkv", b"q")
    os.symlink(f"{root}/b1/a.mkv", f"{root}/b1/link.mkv")
    got = sorted((r.bundle, r.rel_path, r.length) for r in IOF.scan_files(spark, root).collect())
    assert got == [("b1", ".hidden.srt", 1), ("b1", "_under/x.nfo", 1), ("b1", "a.mkv", 3),
                   ("b1", "sub dir/name with space.mp4", 2), ("single.mkv", "single.mkv", 1)]


def test_read_manifests_edge_cases(spark, tmpdir_fresh):
    reg = tmpdir_fresh
    write(f"{reg}/a.json", json.dumps({"job_id": "a", "files": []}).encode())
    write(f"{reg}/b.json", json.dumps({"job_id": "b"}).encode())
    write(f"{reg}/c.json", b"{bad")
    write(f"{reg}/d.json.tmp", b"{}")
    write(f"{reg}/a.state", b"done\n")
    write(f"{reg}/processed/z.json", b"{}")
    m = {r.manifest_file: r for r in IOM.read_manifests(spark, reg).collect()}
    assert set(m) == {"a.json", "b.json"}
    assert m["a.json"].files == [] and m["b.json"].files is None


def test_write_manifests_publishes_once(spark, tmpdir_fresh):
    reg = tmpdir_fresh
    df = spark.createDataFrame([("t1", '{"job_id":"t1"}'), ("t2", '{"job_id":"t2"}')], "tx string, manifest_json string")
    first = {r.tx: r.status for r in IOM.write_manifests(df, reg).collect()}
    assert first == {"t1": "written", "t2": "written"}
    again = {r.tx: r.status for r in IOM.write_manifests(df, reg).collect()}
    assert again == {"t1": "exists", "t2": "exists"}
    assert sorted(n for n in os.listdir(reg) if n.endswith(".json")) == ["t1.json", "t2.json"]


def test_logs_round_trip_and_rejects(spark, tmpdir_fresh):
    rows = spark.createDataFrame([("t1", "vm", "ingest", "running", 'he said "hi"')],
                                 "tx string, machine string, stage string, status string, msg string")
    rows = rows.withColumn("ts", F.timestamp_seconds(F.lit(1704067207)))
    IOG.append_log(rows, f"{tmpdir_fresh}/logs")
    # A producer line with an unescaped quote in the name must be rejected, not crash the read.
    write(f"{tmpdir_fresh}/logs/vm-raw.log",
          b'{"ts":"2024-01-01T00:00:07+00:00","tx":"t2","name":"a"b","machine":"vm","action":"scan",'
          b'"status":"running","stage":"security","src":"","dest":"","msg":"x\\n"}\n')
    logs, rejects = IOG.read_stage_logs(spark, f"{tmpdir_fresh}/logs")
    got = logs.collect()
    assert len(got) == 1 and got[0].msg == 'he said "hi"' and got[0].name == "none"
    assert rejects.count() == 1


def test_ledger_text_equality_not_substring(spark, tmpdir_fresh):
    p = f"{tmpdir_fresh}/done.log"
    write(p, b"abc\nxyz\n")
    led = IOL.read_ledger(spark, p, fmt="text")
    jobs = spark.createDataFrame([("ab", None), ("abc", None)], "job_id string, type string")
    inv = spark.createDataFrame([("shows", "ab")], "type string, job_id string")
    d = {r.job_id: r.decision for r in DC.pull_decision(jobs, led, inv).collect()}
    assert d == {"ab": "completed", "abc": "already_processed"}


def test_append_ledger_is_idempotent(spark, tmpdir_fresh):
    p = f"{tmpdir_fresh}/ledger"
    ids = spark.createDataFrame([("j1",), ("j2",)], "job_id string")
    IOL.append_ledger(ids, p, batch_id=1)
    IOL.append_ledger(ids, p, batch_id=1)  # replay
    IOL.append_ledger(spark.createDataFrame([("j2",), ("j3",)], "job_id string"), p, batch_id=2)
    got = sorted(tuple(r) for r in IOL.dedupe_ledger(spark.read.parquet(p)).collect())
    assert got == [("j1", 1), ("j2", 1), ("j3", 2)]


def test_registry_names(spark):
    df = spark.createDataFrame([("t.ingest.done", ""), ("t.state", "validate\n"), ("t.json", "{}"),
                                ("a.b.export.done", ""), ("junk.txt", "")], "file_name string, content string")
    got = sorted((r.tx, r.kind, r.marker, r.state) for r in IOF.parse_registry_names(df).collect()
                 if r.kind is not None)
    assert got == [("a.b", "marker", "export", None), ("t", "manifest", None, None),
                   ("t", "marker", "ingest", None), ("t", "state", None, "validate")]


def test_promote_cascade(spark):
    bundles = spark.createDataFrame([("b0", "/ready/other/b0"), ("b1", "/ready/movies/b1"), ("b2", "/ready/shows/b2"),
                                     ("b3", "/ready/shows/b3"), ("b4", "/ready/movies/b4"), ("b5", "/ready/movies/b5"),
                                     ("b6", "/ready/movies/b6")], "bundle string, path string")
    hashes = spark.createDataFrame([(b, "h") for b in ["b0", "b2", "b3", "b4", "b5", "b6"]], "bundle string, hash string")
    matched = spark.createDataFrame([("b3", "m3"), ("b4", "m4"), ("b5", "m5"), ("b6", "m6")],
                                    "bundle string, manifest_id string")
    meta = spark.createDataFrame([("m3", "null", None), ("m4", "j4", "n"), ("m5", "j5", None), ("m6", "j6", None)],
                                 "manifest_id string, job_id string, name string")
    ledger = spark.createDataFrame([("j4",)], "job_id string")
    inv = spark.createDataFrame([("/exp/movies/j5",)], "path string")
    d = {r.bundle: r.decision for r in DC.promote_decision(
        bundles, hashes, matched, meta, ledger, inv, incoming="/ready",
        export_roots={"movies": "/exp/movies", "shows": "/exp/shows"}).collect()}
    assert d == {"b0": "ignored", "b1": "empty", "b2": "unmatched", "b3": "invalid_job_id", "b4": "skipped",
                 "b5": "exists", "b6": "export"}


def test_transition_audit(spark):
    hist = spark.createDataFrame([("t", 1, "none"), ("t", 2, "ingest"), ("t", 3, "validate"), ("t", 5, "manifest")],
                                 "tx string, seq long, state string")
    allowed = spark.createDataFrame(list(DC.ALLOWED_VM_STEPS), "from_state string, to_state string")
    bad = [(r.state, r.next_state) for r in DC.transition_audit(hist, allowed).collect()]
    assert bad == [("ingest", "validate")]


def test_read_stage_markers_from_folder(spark, tmpdir_fresh):
    reg = f"{tmpdir_fresh}/registry"
    write(f"{reg}/t1.state", b"validate\n")
    write(f"{reg}/t1.ingest.done", b"")
    write(f"{reg}/t1.scan.done", b"")
    write(f"{reg}/t1.json", b"{}")
    write(f"{reg}/t2.state", b"done\n")
    got = sorted((r.tx, r.kind, r.marker, r.state) for r in IOF.read_stage_markers(spark, reg).collect())
    assert got == [("t1", "marker", "ingest", None), ("t1", "marker", "scan", None), ("t1", "state", None, "validate"),
                   ("t2", "state", None, "done")]


def test_scan_files_parallel_lister_skips_hidden(spark, tmpdir_fresh):
    root = tmpdir_fresh
    write(f"{root}/b1/a.mkv", b"abc")
    write(f"{root}/b1/.hidden.srt", b"s")
    write(f"{root}/b2/x/y.srt", b"yy")
    got = sorted((r.bundle, r.rel_path, r.length) for r in IOF.scan_files(spark, root, include_hidden=False).collect())
    assert got == [("b1", "a.mkv", 3), ("b2", "x/y.srt", 2)]


def test_exports_are_verbatim(spark, tmpdir_fresh):
    body = '{ "job_id":"j1", "odd": [1, {"é": null}],  "files":[] }\n'
    ex = spark.createDataFrame([("j1", body), ("j2", "{}")], "job_id string, manifest_json string").withColumn(
        "type", F.lit(None).cast("string"))
    for _ in range(2):
        IOM.write_exports(IOM.export_manifests(ex), f"{tmpdir_fresh}/exp")
    assert sorted(os.listdir(f"{tmpdir_fresh}/exp")) == ["j1.json", "j2.json"]
    with open(f"{tmpdir_fresh}/exp/j1.json", encoding="utf-8") as fh:
        assert fh.read() == body


def test_a_failed_job_publishes_nothing(spark, tmpdir_fresh):
    from bundleflow.sources.named_files import read_named, write_named
    rows = spark.createDataFrame([(f"f{i}", f"x{i}") for i in range(20)], "name string, body string").repartition(4)
    bad = rows.withColumn("name", F.when(F.col("name") == "f7", "a/b").otherwise(F.col("name")))
    with pytest.raises(Exception, match="not a file name"):
        write_named(bad, tmpdir_fresh)
    assert os.listdir(tmpdir_fresh) == []
    write_named(rows, tmpdir_fresh)
    write_named(rows.withColumn("body", F.lit("later")).limit(3), tmpdir_fresh)
    assert {(r.name, bytes(r.body)) for r in read_named(spark, tmpdir_fresh).collect()} == {(f"f{i}", f"x{i}".encode()) for i in range(20)}
    write_named(rows.where("name = 'f1'").withColumn("body", F.lit("later")), tmpdir_fresh, existing="replace")
    assert {bytes(r.body) for r in read_named(spark, tmpdir_fresh, "f1").collect()} == {b"later"}


def test_routes_of_a_repeated_batch(spark, tmpdir_fresh):
    from bundleflow.sources.routing import route_output
    plan = spark.createDataFrame([("b", f"f{i}", r, "d") for i, r in enumerate(("staged", "quarantine", "staged"))],
                                 "bundle string, rel_path string, route string, dest string")
    for batch in (1, 1, 2):
        route_output(plan, f"{tmpdir_fresh}/plan", batch)
    got = sorted((r.batch_id, r.rel_path, r.route) for r in spark.read.parquet(f"{tmpdir_fresh}/plan").collect())
    assert got == [(b, f"f{i}", r) for b in (1, 2) for i, r in enumerate(("staged", "quarantine", "staged"))]


def test_advance_batch_resumes_from_state(spark):
    from bundleflow.plans.vm_ingest import advance_batch
    files = spark.createDataFrame([
        ("t1", "a.mkv", 1, "h1", "x"), ("t2", "a.mkv", 2, "h2", "x"), ("t3", "a.mkv", 3, "h3", "x"),
        ("t4", "a.mkv", 4, "h4", "x")], "tx string, rel_path string, doc_id long, sha256 string, content string")
    req = spark.createDataFrame([(t, t, f"/srv/complete/{t}") for t in ("t1", "t2", "t3", "t4")],
                                "tx string, name string, orig_src string")
    # every file infected and failing to decode
    verdicts = spark.createDataFrame([(i, True, False) for i in range(1, 5)], "doc_id long, infected boolean, ok boolean")
    states = spark.createDataFrame([("t1", None), ("t2", "validate"), ("t3", "manifest"), ("t4", "done")],
                                   "tx string, state string")
    res = {r.tx: (r.outcome, r.failed_stage) for r in advance_batch(files, req, verdicts, states=states).results.collect()}
    # t1 runs from the start: scan fails. t2 has scan done: validation fails.
    # t3 has both done: it passes on. t4 is finished and left out.
    assert res == {"t1": ("infected", "security"), "t2": ("corrupt", "validation"), "t3": ("passed", None)}


def test_ledger_from_empty_done_files(spark, tmpdir_fresh):
    write(f"{tmpdir_fresh}/state/movies-a.done", b"")
    write(f"{tmpdir_fresh}/state/shows-b.done", b"{}")
    got = sorted(r.job_id for r in IOL.read_ledger(spark, f"{tmpdir_fresh}/state", fmt="done_files").collect())
    assert got == ["movies-a", "shows-b"]


def test_scan_contents_keeps_empty_files(spark, tmpdir_fresh):
    write(f"{tmpdir_fresh}/b/a.mkv", b"abc")
    write(f"{tmpdir_fresh}/b/empty.mkv", b"")
    got = {os.path.basename(r.path): r.sha for r in IOF.scan_contents(spark, tmpdir_fresh)
           .select("path", F.sha2("content", 256).alias("sha")).collect()}
    assert got["empty.mkv"] == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert len(got) == 2


def test_read_manifests_includes_empty_files(spark, tmpdir_fresh):
    reg = tmpdir_fresh
    write(f"{reg}/a.json", json.dumps({"job_id": "a", "files": []}).encode())
    write(f"{reg}/e.json", b"")
    m = {r.manifest_file: r for r in IOM.read_manifests(spark, reg, include_empty=True).collect()}
    assert set(m) == {"a.json", "e.json"} and m["e.json"].job_id is None and m["e.json"].files is None


def test_resume_logs_skipped_stages_as_running(spark):
    from bundleflow.plans.vm_ingest import advance_batch
    files = spark.createDataFrame([("t1", "a.mkv", 1, "h1", "x")],
                                  "tx string, rel_path string, doc_id long, sha256 string, content string")
    req = spark.createDataFrame([("t1", "t1", "/srv/complete/t1")], "tx string, name string, orig_src string")
    states = spark.createDataFrame([("t1", "manifest")], "tx string, state string")
    logs = advance_batch(files, req, states=states).logs
    got = sorted((r.stage, r.status) for r in logs.collect())
    assert got == [("export", "running"), ("export", "success"), ("ingest", "running"), ("metadata", "running"),
                   ("metadata", "success"), ("security", "running"), ("validation", "running")]


def test_stream_manifests_same_bytes_as_built(spark, tmpdir_fresh):
    from bundleflow.operators import aggregates as AG
    files = spark.createDataFrame([("t1", "b/x.mkv", "h2"), ("t1", "a.mp4", "h1"), ("t1", "s.srt", "h3"),
                                   ("t2", "n.nfo", "h4"), ("t3", 'q"uote\\.mkv', "h5")],
                                  "tx string, rel_path string, sha256 string")
    req = spark.createDataFrame([("t1", "one", "/d/1"), ("t2", "", "/d/2"), ("t3", "thrée", "/d/3")],
                                "tx string, name string, orig_src string")
    st = {r.tx: r.status for r in IOM.stream_manifests(AG.manifest_entries(files), req, tmpdir_fresh).collect()}
    assert st == {"t1": "written", "t2": "written", "t3": "written"}
    built = {r.tx: r.manifest_json for r in AG.build_manifest(files, req).collect()}
    for tx, text in built.items():
        with open(f"{tmpdir_fresh}/{tx}.json", encoding="utf-8") as fh:
            assert fh.read() == text + "\n"


def test_probe_paths_reads_headers(spark, tmpdir_fresh):
    from bundleflow.operators.content import EBML, probe_paths
    write(f"{tmpdir_fresh}/b/good.mkv", EBML + b"rest")
    write(f"{tmpdir_fresh}/b/bad.mp4", b"not a movie")
    write(f"{tmpdir_fresh}/b/ok.mp4", b"\x00\x00\x00\x18ftypmp42")
    write(f"{tmpdir_fresh}/b/notes.txt", b"x")
    files = IOF.scan_files(spark, tmpdir_fresh)
    got = {r.rel_path: r.probe_ok for r in probe_paths(files).collect()}
    assert got == {"good.mkv": True, "bad.mp4": False, "ok.mp4": True}


def test_pull_type_from_promotion(spark):
    jobs = spark.createDataFrame([("j1", None), ("j2", None)], "job_id string, type string")
    promo = spark.createDataFrame([("j1", "movies")], "job_id string, type string")
    inv = spark.createDataFrame([("movies", "j1"), ("shows", "j2")], "type string, job_id string")
    led = spark.createDataFrame([], "job_id string")
    d = {r.job_id: (r.local_type, r.decision) for r in DC.pull_decision(jobs, led, inv, promotion=promo).collect()}
    assert d == {"j1": ("movies", "completed"), "j2": ("shows", "completed")}


def test_fingerprint_tree_streams_large_files(spark, tmpdir_fresh):
    import hashlib
    from bundleflow.operators.content import fingerprint_tree
    big = os.urandom(3 << 20)
    write(f"{tmpdir_fresh}/b/big.mkv", big)
    write(f"{tmpdir_fresh}/b/small.srt", b"sub")
    got = {os.path.basename(r.path): r.sha256 for r in fingerprint_tree(spark, tmpdir_fresh, max_bytes=1 << 20).collect()}
    assert got == {"big.mkv": hashlib.sha256(big).hexdigest(), "small.srt": hashlib.sha256(b"sub").hexdigest()}


@pytest.mark.parametrize("chunk_bytes", [None, 64])
def test_signature_scan_automaton_path(spark, monkeypatch, chunk_bytes):
    import random
    from bundleflow.operators import content as CT
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(4, 9))) for _ in range(120)]
    pats = sorted(set(words))
    texts = [" ".join(rng.choice(words + ["zzzz"] * 50) for _ in range(6)) for _ in range(40)]
    files = spark.createDataFrame([(f"b{i % 5}", f"f{i}", t, f"h{i}") for i, t in enumerate(texts)],
                                  "bundle string, rel_path string, content string, sha256 string")
    pdf = spark.createDataFrame([(p,) for p in pats], "text string")
    if chunk_bytes:
        monkeypatch.setattr(CT, "BROADCAST_PATTERN_BYTES", chunk_bytes)  # many chunks
    got = {r.rel_path: r.pattern_hits for r in CT.flag_signatures(files, None, pdf).collect()}
    expect = {f"f{i}": sum(1 for p in pats if p in t) for i, t in enumerate(texts)}
    assert got == expect


def test_vm_flow_on_real_folders(spark, tmpdir_fresh):
    import hashlib
    from bundleflow.operators.filters import Layout
    from bundleflow.plans.vm_ingest import ingest_requests
    dl = f"{tmpdir_fresh}/complete"
    write(f"{dl}/Film.mkv", b"film")                       # single-file source
    write(f"{dl}/Show S01/e1.mp4", b"ep1")                # directory source with aux and junk
    write(f"{dl}/Show S01/e1.srt", b"sub")
    write(f"{dl}/Show S01/readme.txt", b"junk")
    write(f"{dl}/Bad/b.mkv", b"bad")                      # fails its decode verdict
    lay = Layout(download=dl)
    req = spark.createDataFrame([
        ("Film", f"{dl}/Film.mkv", "t1"), ("Show", f"{dl}/Show S01", "t2"), ("Bad", f"{dl}/Bad", "t3"),
        ("Gone", f"{dl}/Gone.mkv", "t4"), ("Out", f"{tmpdir_fresh}/elsewhere/x.mkv", "t5")],
        "name string, orig_src string, tx string")
    verdicts = spark.createDataFrame([("t3", "b.mkv", False, False)],
                                     "tx string, rel_path string, infected boolean, ok boolean")
    reg = f"{tmpdir_fresh}/registry"
    adm, res, pub = ingest_requests(req, lay, registry=reg, verdicts=verdicts)
    rej = {r.tx: r.reject_reason for r in adm.collect()}
    assert rej["t4"] == "input does not exist" and rej["t5"] == "must originate from download directory"
    out = {r.tx: (r.outcome, r.n_manifest_files, r.n_junk_isolated) for r in res.results.collect()}
    assert out == {"t1": ("passed", 1, 0), "t2": ("passed", 1, 1), "t3": ("corrupt", None, 0)}
    assert {r.tx: r.status for r in pub.collect()} == {"t1": "written", "t2": "written"}
    with open(f"{reg}/t2.json") as fh:
        m = json.load(fh)
    assert m == {"job_id": "t2", "name": "Show", "source": f"{dl}/Show S01", "type": None,
                 "files": [{"name": "e1.mp4", "hash": hashlib.sha256(b"ep1").hexdigest()}]}
    routes = {(r.bundle, r.rel_path): r.route for r in res.routes.collect()}
    assert routes[("t2", "readme.txt")] == "quarantine_junk" and routes[("t1", "Film.mkv")] == "staged"


def test_pull_flow_on_real_folders(spark, tmpdir_fresh):
    from bundleflow.plans.nas_pull import pull_batch
    reg, led = f"{tmpdir_fresh}/registry", f"{tmpdir_fresh}/ledger"
    write(f"{reg}/j1.json", json.dumps({"job_id": "j1", "type": None, "files": []}).encode())
    write(f"{reg}/j2.json", json.dumps({"job_id": "j2", "type": None, "files": []}).encode())
    write(f"{reg}/bad.json", json.dumps({"name": "no id"}).encode())
    write(f"{tmpdir_fresh}/shows/j1/a.mkv", b"a")
    write(f"{tmpdir_fresh}/shows/j1/sub/b.srt", b"b")
    roots = {"movies": f"{tmpdir_fresh}/movies", "shows": f"{tmpdir_fresh}/shows"}
    res = pull_batch(spark, reg, led, roots, batch_id=1)
    got = {r.manifest_file: (r.decision, r.n_files) for r in res.decisions.collect()}
    assert got == {"j1.json": ("completed", 2), "j2.json": ("missing_local", None),
                   "bad.json": ("invalid_manifest", None)}
    again = {r.manifest_file: r.decision for r in pull_batch(spark, reg, led, roots, batch_id=2).decisions.collect()}
    assert again["j1.json"] == "already_processed" and again["j2.json"] == "missing_local"


def test_drop_flow_on_real_folders(spark, tmpdir_fresh):
    from bundleflow.operators.filters import drop_filter
    from bundleflow.plans.drop_watch import drop_batch, sample_sizes
    base = f"{tmpdir_fresh}/drop"
    write(f"{base}/movies/Film/a.mkv", b"12345")
    write(f"{base}/movies/Film/b.srt", b"67")
    write(f"{base}/shows/ep.mkv", b"x")
    write(f"{base}/shows/growing.mkv", b"a")
    write(f"{base}/shows/.hidden", b"h")
    arr = spark.createDataFrame([(f"{base}/movies/Film", 1), (f"{base}/shows/ep.mkv", 2),
                                 (f"{base}/shows/growing.mkv", 3), (f"{base}/shows/.hidden", 4),
                                 (f"{base}/movies/Film", 5)], "path string, event_id long") \
        .withColumn("ts", F.timestamp_seconds("event_id"))
    rounds = []
    for k in range(4):
        if k > 0:
            with open(f"{base}/shows/growing.mkv", "ab") as fh:
                fh.write(b"more")
        # Only arrivals that pass the drop filter are waited for.
        rounds.append(sample_sizes(drop_filter(arr, base).select("path"), reading=k + 1))
    samples = rounds[0]
    for r in rounds[1:]:
        samples = samples.unionByName(r)
    dec = {(r.name, r.decision, r.stability) for r in drop_batch(arr, samples, base, f"{tmpdir_fresh}/dest").collect()}
    assert ("Film", "move", "stable") in dec and ("Film", "already_processed", "stable") in dec
    assert ("ep.mkv", "move", "stable") in dec
    assert ("growing.mkv", "move", "waiting") in dec
    assert (".hidden", "filtered", None) in dec
    film = [r for r in samples.collect() if r.target.endswith("Film")]
    assert {r.size for r in film} == {7}


def test_drop_removed_item_is_not_marked_processed(spark):
    arr = spark.createDataFrame([("/w/movies/a", 1), ("/w/movies/a", 2), ("/w/movies/b", 3), ("/w/movies/b", 4)],
                                "path string, event_id long").withColumn("ts", F.timestamp_seconds("event_id"))
    existing = spark.createDataFrame([("/w/movies/b",)], "path string")
    led = spark.createDataFrame([("movies", "c")], "folder string, name string")
    d = {r.event_id: r.decision for r in DC.drop_decision(arr, "/w", existing=existing, ledger=led).collect()}
    assert d == {1: "removed", 2: "removed", 3: "move", 4: "already_processed"}


def test_unreadable_file_fails_bundle(spark, tmpdir_fresh):
    from bundleflow.operators.filters import Layout
    from bundleflow.plans.vm_ingest import ingest_requests
    dl = f"{tmpdir_fresh}/complete"
    write(f"{dl}/A/a.mkv", b"a")
    write(f"{dl}/B/b.mkv", b"b")
    os.symlink(f"{dl}/B/b.mkv", f"{dl}/B/link.mkv")  # links are not files: ignored, not an error
    req = spark.createDataFrame([("A", f"{dl}/A", "tA"), ("B", f"{dl}/B", "tB")], "name string, orig_src string, tx string")
    adm, res, pub = ingest_requests(req, Layout(download=dl), registry=f"{tmpdir_fresh}/reg")
    out = {r.tx: r.outcome for r in res.results.collect()}
    assert out == {"tA": "passed", "tB": "passed"}
    # a file that vanishes between listing and hashing is a read failure
    from bundleflow.operators.content import fingerprint_paths
    gone = spark.createDataFrame([("tX", "x.mkv", f"{dl}/nowhere/x.mkv", 1)], "tx string, rel_path string, path string, length long")
    r = fingerprint_paths(gone).first()
    assert r.sha256 is None and r.read_error.startswith("FileNotFoundError")


def test_promote_hash_error_before_empty(spark):
    bundles = spark.createDataFrame([("b1", "/ready/movies/b1"), ("b2", "/ready/movies/b2")], "bundle string, path string")
    hashes = spark.createDataFrame([("b2", "h")], "bundle string, hash string")
    matched = spark.createDataFrame([("b2", "m")], "bundle string, manifest_id string")
    meta = spark.createDataFrame([("m", "j", None)], "manifest_id string, job_id string, name string")
    none = spark.createDataFrame([], "job_id string")
    bad = spark.createDataFrame([("b1",), ("b2",)], "bundle string")
    d = {r.bundle: r.decision for r in DC.promote_decision(
        bundles, hashes, matched, meta, none, spark.createDataFrame([], "path string"), incoming="/ready",
        export_roots={"movies": "/e/m"}, unreadable=bad).collect()}
    assert d == {"b1": "hash_error", "b2": "hash_error"}


def test_contents_are_listed_by_executors(spark, tmpdir_fresh):
    """IO-2 lists no file in the driver, as binaryFile does, and returns what
    that reader returns, with the empty files beside."""
    big = bytes(range(256)) * 40_000
    for name, data in (("b/a.mkv", b"abc"), ("b/sub/big.mkv", big), ("b/sub/_x/c", b"1"), ("b/.hidden", b"2"), ("top", b"3"),
                       ("b/empty", b""), ("b/sub/.none", b"")):
        write(f"{tmpdir_fresh}/{name}", data)
    got = IOF.scan_contents(spark, tmpdir_fresh)
    assert "binaryFile" not in got._jdf.queryExecution().toString()
    plain = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(tmpdir_fresh).withColumn(
        "path", F.regexp_replace("path", "^file:", ""))
    rows = {(r.path, r.modificationTime, r.length, bytes(r.content)) for r in got.select(plain.columns).collect()}
    want = {(r.path, r.modificationTime, r.length, bytes(r.content)) for r in plain.collect()}
    assert len(want) == 3 and {r for r in rows if r[2]} == want
    assert sorted(os.path.relpath(r[0], tmpdir_fresh) for r in rows if not r[2]) == ["b/empty", "b/sub/.none"]
    cut = {os.path.basename(r.path): r.content for r in IOF.scan_contents(spark, tmpdir_fresh, max_bytes=1000, include_empty=False).collect()}
    assert cut["big.mkv"] is None and bytes(cut["a.mkv"]) == b"abc" and set(cut) == {"a.mkv", "big.mkv", "top"}
