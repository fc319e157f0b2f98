"""The VM flow in stages: ended anywhere and taken up again."""

import hashlib
import json
import os
import shutil

import pytest

from bundleflow.operators.filters import Layout
from bundleflow.plans import stage_runner as SR
from bundleflow.plans.vm_ingest import REJECT_NOWHERE, ingest_requests
from bundleflow.sources.logs import read_stage_logs
from bundleflow.sources.routing import apply_moves
from bundleflow.sources.stages import STAGES, stages_done

FILES = {"Film.mkv": b"film", "Show S01/e1.mp4": b"ep1", "Show S01/sub/e1.srt": b"sub", "Show S01/readme.txt": b"junk",
         "Show S01/sub/readme.txt": b"junk2", "Bad/b.mkv": b"bad", "Evil/e.mkv": b"xx EVIL xx", "Notes/n.nfo": b"only junk"}
REQUESTS = [("Film", "Film.mkv", "t1"), ("Show", "Show S01", "t2"), ("Bad", "Bad", "t3"), ("Evil", "Evil", "t4"),
            ("Gone", "Gone.mkv", "t5"), ("", "Notes", "t6"), ("Empty", "Nothing", "t7")]


def tree(root):
    for name, data in FILES.items():
        os.makedirs(os.path.dirname(f"{root}/download/{name}"), exist_ok=True)
        with open(f"{root}/download/{name}", "wb") as f:
            f.write(data)
    os.makedirs(f"{root}/download/Nothing")
    return Layout(**{n: f"{root}/{n}" for n in ("download", "processing", "staging", "quarantine", "registry")})


def run(spark, root, layout, **kw):
    req = spark.createDataFrame([(n, f"{root}/download/{s}", t) for n, s, t in REQUESTS], "name string, orig_src string, tx string")
    verdicts = spark.createDataFrame([("t3", "b.mkv", False, False)], "tx string, rel_path string, infected boolean, ok boolean")
    pats = spark.createDataFrame([("EVIL",)], "text string")
    return SR.run_stages(req, layout, stage_table=f"{root}/stages", log_dir=f"{root}/logs", verdicts=verdicts, patterns=pats, **kw)


def outcome(spark, root):
    """Files, manifests and logs of a tree, without its own path."""
    files = {}
    for part in ("download", "processing", "staging", "quarantine", "registry"):
        for d, dirs, names in os.walk(f"{root}/{part}"):
            dirs[:] = [x for x in dirs if not x.startswith(".")]
            for n in names:
                with open(f"{d}/{n}", "rb") as f:
                    files[os.path.relpath(f"{d}/{n}", root)] = f.read().replace(str(root).encode(), b"ROOT")
    logs, rejects = read_stage_logs(spark, f"{root}/logs")
    assert rejects.count() == 0
    lines = sorted(tuple((x or "").replace(str(root), "ROOT") for x in (r.tx, r.name, r.stage, r.action, r.status, r.src, r.dest, r.msg))
                   for r in logs.collect())
    return files, lines


@pytest.fixture(scope="module")
def straight(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("straight")
    got = run(spark, root, tree(root))
    states = {r.tx: r.state for r in got.states.collect()}
    rejects = {r.tx: r.reject_reason for r in got.admission.collect() if r.reject_reason}
    return outcome(spark, root), states, rejects


def test_from_start_to_end(straight):
    (files, logs), states, rejects = straight
    assert states == {"t1": "done", "t2": "done", "t3": "validate", "t4": "scan", "t5": "none", "t6": "done", "t7": "done"}
    assert rejects == {"t5": "input does not exist"}
    assert set(files) == {"staging/Film.mkv.dir/Film.mkv", "staging/Show S01.dir/e1.mp4", "staging/Show S01.dir/sub/e1.srt",
                          "quarantine/t2.junk/readme.txt", "quarantine/t2.junk/sub/readme.txt", "quarantine/Bad/b.mkv",
                          "quarantine/Evil/e.mkv", "quarantine/t6.junk/n.nfo", "registry/t1.json", "registry/t2.json",
                          "registry/t6.json", "registry/t7.json"}
    assert json.loads(files["registry/t1.json"]) == {
        "job_id": "t1", "name": "Film", "source": "ROOT/download/Film.mkv", "type": None,
        "files": [{"name": "Film.mkv", "hash": hashlib.sha256(b"film").hexdigest()}]}
    # folders that hold no core file have manifests without files
    assert json.loads(files["registry/t6.json"])["files"] == json.loads(files["registry/t7.json"])["files"] == []
    assert json.loads(files["registry/t6.json"])["name"] == "unknown"
    mine = [x[2:] for x in logs if x[0] == "t3"]
    assert sorted(x[0] + " " + x[2] for x in mine) == ["ingest running", "ingest success", "security passed", "security running",
                                                      "validation failed", "validation running"]
    assert ("validation", "validate", "failed", "ROOT/processing/Bad", "ROOT/quarantine/Bad", "decode failed: b.mkv") in mine


def test_ended_after_every_stage(spark, tmp_path, straight):
    layout = tree(tmp_path)
    for stage in STAGES[:-1]:
        run(spark, tmp_path, layout, stop_after=stage)
    got = run(spark, tmp_path, layout)
    assert outcome(spark, tmp_path) == straight[0]
    states = {r.tx: r.state for r in got.states.collect()}
    assert {t: s for t, s in straight[1].items() if s == "done"}.items() <= states.items()


def test_nothing_is_done_twice(spark, tmp_path, straight):
    layout = tree(tmp_path)
    run(spark, tmp_path, layout)
    assert run(spark, tmp_path, layout).stages.where("status = 'done'").count() == 0
    assert outcome(spark, tmp_path) == straight[0]


def test_work_that_was_not_written_down(spark, tmp_path, straight):
    """Bundles moved, wrapped or published by a run that ended before it wrote the stage's rows."""
    layout = tree(tmp_path)

    def forget(no):
        for name in os.listdir(f"{tmp_path}/stages"):
            if os.path.isdir(f"{tmp_path}/stages/{name}/stage_no={no}"):
                shutil.rmtree(f"{tmp_path}/stages/{name}/stage_no={no}")

    run(spark, tmp_path, layout, stop_after="ingest")
    forget(1)
    os.rename(f"{tmp_path}/processing/Film.mkv.dir/Film.mkv", f"{tmp_path}/processing/Film.mkv")
    os.rmdir(f"{tmp_path}/processing/Film.mkv.dir")
    run(spark, tmp_path, layout, stop_after="manifest")
    forget(4)
    os.makedirs(f"{tmp_path}/staging")
    os.rename(f"{tmp_path}/processing/Show S01", f"{tmp_path}/staging/Show S01.dir")
    with open(f"{tmp_path}/registry/t1.state", "w") as f:
        f.write("manifest\n")
    run(spark, tmp_path, layout)
    files = outcome(spark, tmp_path)[0]
    assert {n: d for n, d in files.items() if not n.endswith(".state")} == straight[0][0]


def test_nothing_is_published_for_a_bundle_that_is_nowhere(spark, tmp_path):
    layout = tree(tmp_path)
    os.makedirs(layout.registry)
    for tx, state in (("t5", "validate"), ("t1", "paused"), ("t2", "done")):
        with open(f"{layout.registry}/{tx}.state", "w") as f:
            f.write(state + "\n")
    open(f"{layout.registry}/t5.scan.done", "w").close()
    got = run(spark, tmp_path, layout)
    rejects = {r.tx: r.reject_reason for r in got.admission.collect() if r.reject_reason}
    assert rejects == {"t5": REJECT_NOWHERE, "t1": "unknown state: paused"}
    assert not os.path.exists(f"{layout.registry}/t5.json") and not os.path.exists(f"{layout.registry}/t1.json")
    assert os.path.exists(f"{layout.download}/Film.mkv") and os.path.exists(f"{layout.download}/Show S01")
    # the flow without a stage table rejects it too
    req = spark.createDataFrame([("Gone", f"{tmp_path}/download/Gone.mkv", "t5")], "name string, orig_src string, tx string")
    states = spark.createDataFrame([("t5", "validate")], "tx string, state string")
    _, res, pub = ingest_requests(req, layout, registry=layout.registry, states=states)
    assert [(r.outcome, r.final_state, r.first_bad) for r in res.results.collect()] == [("rejected", "validate", REJECT_NOWHERE)]
    assert pub.count() == 0 and not os.path.exists(f"{layout.registry}/t5.json")


def test_resumed_at_its_place(spark, tmp_path):
    layout = tree(tmp_path)
    os.makedirs(layout.processing)
    os.rename(f"{layout.download}/Show S01", f"{layout.processing}/Show S01")
    req = spark.createDataFrame([("Show", f"{layout.download}/Show S01", "t2")], "name string, orig_src string, tx string")
    states = spark.createDataFrame([("t2", "validate")], "tx string, state string")
    _, res, pub = ingest_requests(req, layout, registry=layout.registry, states=states)
    assert [(r.outcome, r.n_manifest_files) for r in res.results.collect()] == [("passed", 1)]
    assert [r.status for r in pub.collect()] == ["written"]


def test_a_manifest_of_other_content_stops_its_transaction(spark, tmp_path):
    layout = tree(tmp_path)
    os.makedirs(layout.registry)
    with open(f"{layout.registry}/t1.json", "w") as f:
        f.write("{}")
    got = run(spark, tmp_path, layout)
    assert {r.tx: r.state for r in got.states.collect()}["t1"] == "manifest"
    assert os.path.exists(f"{layout.processing}/Film.mkv.dir/Film.mkv")
    assert [r.detail for r in got.stages.where("status = 'failed' AND tx = 't1'").collect()] == ["manifest already exists: t1.json"]


def test_states_from_markers_and_table(spark, tmp_path):
    reg = tmp_path / "reg"
    reg.mkdir()
    (reg / "a.ingest.done").touch()
    (reg / "a.scan.done").touch()
    (reg / "a.state").write_text("scan\n")
    (reg / "b.state").write_text("none\n")
    (reg / "c.export.done").touch()
    (reg / "d.state").write_text("odd\n")
    got = {r.tx: (r.done, r.state, r.unknown) for r in stages_done(spark, str(tmp_path / "none"), str(reg)).collect()}
    assert got == {"a": (2, "validate", None), "c": (5, "done", None), "d": (0, "ingest", "odd")}


def test_moves_never_overwrite(spark, tmp_path):
    for n in ("a", "b", "c", "taken", "x", "y"):
        (tmp_path / n).write_text(n)
    (tmp_path / "was").write_text("moved before")
    plan = spark.createDataFrame([(f"{tmp_path}/{a}", f"{tmp_path}/{b}") for a, b in (
        ("a", "new/a"), ("b", "taken"), ("gone", "was"), ("lost", "nowhere"), ("x", "same"), ("y", "same"))], "src string, dest string")
    first = {os.path.basename(r.src): r.status for r in apply_moves(plan).collect()}
    assert first == {"a": "moved", "b": "exists", "gone": "already", "lost": "missing", "x": "collision", "y": "collision"}
    again = {os.path.basename(r.src): r.status for r in apply_moves(plan).collect()}
    assert again["a"] == "already" and (tmp_path / "taken").read_text() == "taken" and (tmp_path / "x").exists()
