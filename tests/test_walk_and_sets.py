"""Walks in rounds, files dealt by bytes, media read once, hash sets as bitmaps."""

import json
import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from bundleflow.operators import hash_sets as HS
from bundleflow.sources import files as FS


def test_rounds_hand_on_what_is_left(tmp_path, monkeypatch):
    """Units of three entries each, worked off until none is left."""
    import pandas as pd
    monkeypatch.setattr(FS, "LISTED", 3)
    want = set()
    for i in range(40):
        p = tmp_path / "b" / ("x/" * (i % 5)) / f"f{i}"
        os.makedirs(p.parent, exist_ok=True)
        p.write_bytes(b"1" * i)
        want.add((str(p), i))
    os.symlink(tmp_path / "b" / "f0", tmp_path / "b" / "link")
    units, got, rounds = [(str(tmp_path), "b", str(tmp_path / "b"), "dir")], [], 0
    while units:
        rounds += 1
        out = pd.concat(FS._walk_some(iter([pd.DataFrame(units, columns=["root", "bundle", "path", "kind"])])))
        got += [(r.path, r.length) for r in out.itertuples() if r.kind == "file"]
        units = [(r.root, r.bundle, r.path, r.kind) for r in out.itertuples() if r.kind != "file"]
    assert len(got) == 40 and set(got) == want and rounds > 2


def test_walk_of_a_tree(spark, tmp_path):
    for n in ("b/one", "b/sub/two", "b/_s/.three", "c"):
        p = tmp_path / n
        os.makedirs(p.parent, exist_ok=True)
        p.write_bytes(b"")
    every = sorted((r.bundle, r.rel_path, r.length) for r in FS.scan_files(spark, str(tmp_path)).collect())
    assert every == [("b", "_s/.three", 0), ("b", "one", 0), ("b", "sub/two", 0), ("c", "c", 0)]
    seen = sorted((r.bundle, r.rel_path) for r in FS.scan_files(spark, str(tmp_path), include_hidden=False).collect())
    assert seen == [("b", "one"), ("b", "sub/two"), ("c", "c")]


@pytest.mark.parametrize("shape", ["even", "skewed", "empty"])
def test_files_are_dealt_by_bytes(spark, shape):
    rnd = random.Random(1)
    n = {"even": 500, "skewed": 800, "empty": 0}[shape]
    size = (lambda i: 1 << 20) if shape == "even" else (lambda i: int(2 ** rnd.uniform(0, 26)))
    rows = [(f"/p/{i:05d}", size(i), i) for i in range(n)] + ([("/p/none", None, -1)] if n else [])
    df = spark.createDataFrame(rows, "path string, length long, extra int")
    dealt = FS.deal_by_bytes(df, parts=8)
    out = dealt.withColumn("p", F.spark_partition_id()).collect()
    assert sorted(tuple(r)[:3] for r in out) == sorted(rows) and dealt.columns == df.columns
    if n:
        load = {}
        for r in out:
            load[r.p] = load.get(r.p, 0) + (r.length or 0) + FS.PER_FILE
        share = sum(load.values()) / 8
        assert max(load.values()) <= share + max(r[1] or 0 for r in rows) + FS.PER_FILE


def test_media_are_read_once(spark, tmp_path):
    """Outputs stay the same when the media are gone after the flow has run."""
    import hashlib
    from bundleflow.plans.host_promote import promote_arrivals
    from bundleflow.plans.nas_pull import pull_batch
    for n in ("ready/movies/A/a.mkv", "ready/movies/E/.keep", "local/shows/j2/b.mkv"):
        os.makedirs(os.path.dirname(tmp_path / n), exist_ok=True)
        (tmp_path / n).write_bytes(n.encode())
    os.unlink(tmp_path / "ready/movies/E/.keep")
    reg = tmp_path / "reg"
    reg.mkdir()
    digest = hashlib.sha256(b"ready/movies/A/a.mkv").hexdigest()
    (reg / "j1.json").write_text(json.dumps({"job_id": "j1", "name": "n", "files": [{"name": "a", "hash": digest}]}))
    (reg / "j2.json").write_text(json.dumps({"job_id": "j2", "name": "n", "files": [{"name": "b", "hash": "x"}]}))
    arrived = spark.createDataFrame([(f"{tmp_path}/ready/movies/A",), (f"{tmp_path}/ready/movies/E",)], "path string")
    none = spark.createDataFrame([], "job_id string")
    res = promote_arrivals(arrived, str(reg), none, spark.createDataFrame([], "path string"), incoming=f"{tmp_path}/ready",
                           export_roots={"movies": "/ex/m", "shows": "/ex/s"})
    pulled = pull_batch(spark, str(reg), f"{tmp_path}/ledger", {"movies": f"{tmp_path}/local/movies", "shows": f"{tmp_path}/local/shows"},
                        batch_id=1)
    for folder in ("ready", "local"):
        shutil.rmtree(tmp_path / folder)
    assert {os.path.basename(r.path): r.decision for r in res.decisions.collect()} == {"A": "export", "E": "empty"}
    assert [r.job_id for r in res.exports.collect()] == ["j1"]
    assert {r.job_id: (r.decision, r.n_files) for r in pulled.decisions.collect()} == {"j1": ("missing_local", None), "j2": ("completed", 1)}


def test_containment_by_bitmaps(spark):
    rnd = random.Random(2)
    hashes = [f"h{i}" for i in range(300)]
    large = {f"b{i}": set(rnd.sample(hashes, rnd.randint(0, 120))) for i in range(6)}
    small = {}
    for i in range(40):
        b = large[f"b{i % 6}"]
        small[f"m{i}"] = set(rnd.sample(sorted(b), min(len(b), rnd.randint(0, 20)))) | set(rnd.sample(hashes, rnd.choice((0, 0, 1))))
    rows = [(m, h) for m, hs in small.items() for h in hs] + [("m5", "h1"), ("null", None), ("null", "h2")]
    small["m5"].add("h1")
    s = spark.createDataFrame(rows + rows[:5], "m string, hash string")
    b = spark.createDataFrame([(k, h) for k, hs in large.items() for h in hs] + [("b0", None)], "b string, hash string")
    pairs = [(m, k) for m in [*small, "null", "none"] for k in [*large, "nowhere"]]
    got = {(r.m, r.b): r.contained for r in HS.contained_sets(
        spark.createDataFrame(pairs, "m string, b string"), s, b, small_key="m", large_key="b").collect()}
    want = {(m, k): m != "null" and small.get(m, set()) <= large.get(k, set()) for m, k in pairs}
    assert got == want and sum(want.values()) > 20
    files = spark.createDataFrame([("x", None), ("x", "h"), ("y", "h")], "bundle string, sha256 string")
    assert [r.bundle for r in HS.incomplete_sets(files).collect()] == ["x"]


def test_many_buckets(spark):
    """More hashes than one bitmap has bits."""
    every = spark.range(100_000).select(F.lit("b").alias("b"), F.sha2(F.col("id").cast("string"), 256).alias("hash"))
    some = every.select(F.lit("m").alias("m"), "hash").where(F.crc32("hash") % 3 == 0)
    odd = some.unionByName(spark.createDataFrame([("m", "other")], "m string, hash string"))
    pair = spark.createDataFrame([("m", "b")], "m string, b string")
    assert HS.as_bitmaps(every, HS.number_hashes(every), key="b").count() == 4
    assert HS.contained_sets(pair, some, every, small_key="m", large_key="b").first().contained is True
    assert HS.contained_sets(pair, odd, every, small_key="m", large_key="b").first().contained is False


def test_registry_files_stand_on_the_disk_in_rounds(spark, monkeypatch):
    """More files than may be there at once: each round's are read and taken
    away before the next ones are written, and none is left out."""
    import glob
    from bundleflow.plans import queries_io as Q
    sf, seen, roots = "/root/testdata/sf0.001", [], []
    want = sorted(map(tuple, Q.q_markers(spark, sf).collect()), key=str)
    monkeypatch.setattr(Q, "FOLDER_FILES", 400, raising=False)
    monkeypatch.setattr(Q, "ROUND_FOLDERS", 3, raising=False)
    real, fresh = Q.IOF.read_stage_markers, Q.fresh_root

    def read(session, folders):
        seen.append(sum(len(glob.glob(f"{f}/*")) for f in ([folders] if isinstance(folders, str) else folders)))
        return real(session, folders)
    monkeypatch.setattr(Q.IOF, "read_stage_markers", read)
    monkeypatch.setattr(Q, "fresh_root", lambda *a: roots.append(fresh(*a)) or roots[-1])
    got = sorted(map(tuple, Q.q_markers(spark, sf).collect()), key=str)
    assert got == want and len(got) > 4000
    assert max(seen) < 2000 and sum(seen) > len(got)  # manifests are there too
    assert not [p for p in glob.glob(f"{roots[0]}/registry*/*") if p.endswith((".done", ".state", ".json"))]
