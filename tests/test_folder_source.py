"""Watched folders as a stream."""

import os

from bundleflow.streaming import watchers as SR
from bundleflow.streaming.folder_source import FolderReader, folder_arrivals


def test_offsets_are_snapshots(tmp_path):
    opts = {"path": str(tmp_path / "in"), "state": str(tmp_path / "state")}
    r = FolderReader(opts)
    assert r.latestOffset() == r.initialOffset() == {"snapshot": 0}
    for n in ("a", "b"):
        os.makedirs(tmp_path / "in" / n)
    (tmp_path / "in" / "f").touch()
    assert r.latestOffset() == {"snapshot": 1} == r.latestOffset()
    os.rmdir(tmp_path / "in" / "a")
    assert r.latestOffset() == {"snapshot": 2}
    os.makedirs(tmp_path / "in" / "a")
    again = FolderReader(opts)  # after a restart
    assert again.latestOffset() == {"snapshot": 3}

    def rows(a, b):
        return [(os.path.basename(p), d, k) for x in again.partitions({"snapshot": a}, {"snapshot": b}) for p, d, k, _ in again.read(x)]
    assert rows(0, 1) == [("a", True, "moved_to"), ("b", True, "moved_to"), ("f", False, "close_write")]
    assert rows(1, 2) == [] and rows(1, 3) == [("a", True, "moved_to")]


def test_every_bundle_arrives_once(spark, tmp_path):
    got = []

    def run():
        stream = SR.watch_ready_folder(spark, str(tmp_path / "in"), str(tmp_path / "seen"))
        SR.run_to_completion(stream, lambda b, i: got.append(sorted((os.path.basename(r.path), r.type) for r in b.collect())),
                             str(tmp_path / "ck"))
    os.makedirs(tmp_path / "in/movies/a")
    os.makedirs(tmp_path / "in/other/x")
    (tmp_path / "in/movies/file.mkv").touch()
    run()
    run()  # nothing new
    os.makedirs(tmp_path / "in/shows/b")
    run()
    assert [g for g in got if g] == [[("a", "movies")], [("b", "shows")]]


def test_drop_folder_leaves_partial_names(spark, tmp_path):
    for n in ("movies/a.mkv", "movies/b.part", "shows/.hidden", "shows/c d"):
        os.makedirs(os.path.dirname(tmp_path / n), exist_ok=True)
        (tmp_path / n).touch()
    got = []
    stream = SR.watch_drop_folder(spark, str(tmp_path), str(tmp_path / "state"), ("movies", "shows"))
    SR.run_to_completion(stream, lambda b, i: got.extend((r.folder, r.name) for r in b.collect()), str(tmp_path / "ck"))
    assert sorted(got) == [("movies", "a.mkv"), ("shows", "c d")]
    assert folder_arrivals(spark, str(tmp_path), str(tmp_path / "s2")).isStreaming
