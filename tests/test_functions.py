"""Column functions on the hand-made edge cases."""

from pyspark.sql import functions as F

from bundleflow.functions import paths as P
from bundleflow.functions import records as R
from bundleflow.operators.filters import Layout, derive_paths, drop_filter, normalize_bundle, validate_request


def one_col(spark, values, expr, name="x"):
    df = spark.createDataFrame([(v,) for v in values], f"{name} string")
    return [r[0] for r in df.select(expr).collect()]


def test_classify_edge_cases(spark):
    vals = ["a.MKV", "a.mkv\n", "mkv", ".mkv", "dir/x.mp4", "s.srt", "x.vtt.bak", "x.ts", "y.nfo"]
    got = one_col(spark, vals, P.classify_file("x"))
    assert got == ["junk", "junk", "junk", "core", "core", "aux", "junk", "core", "junk"]


def test_within_boundary_needs_slash(spark):
    vals = ["/srv/complete-old/x", "/srv/complete/x", "/srv/complete/", "/srv/complete", None]
    assert one_col(spark, vals, P.within_boundary("x", "/srv/complete")) == [False, True, True, False, False]


def test_drop_filter_first_char_only(spark):
    df = spark.createDataFrame([("/w/movies/.x",), ("/w/movies/a/.x",), ("/w/shows/x.part",), ("/w/shows/x.tmp",),
                                ("/w/shows/ok",)], "path string")
    kept = sorted(r["name"] for r in drop_filter(df, "/w").collect())
    assert kept == ["a/.x", "ok"]


def test_valid_job_id(spark):
    assert one_col(spark, [None, "", "null", "ab", "NULL"], P.valid_job_id("x")) == [False, False, False, True, True]


def test_basename_and_relative(spark):
    assert one_col(spark, ["/a/b/c/", "/a/b/c", "c", "/a//"], P.basename("x")) == ["c", "c", "c", "a"]
    df = spark.createDataFrame([("/r/[1080p] m/x/y.mkv", "/r/[1080p] m")], "p string, r string")
    assert df.select(P.relative_path("p", "r")).first()[0] == "x/y.mkv"


def test_split_drop_path(spark):
    folder, name = P.split_drop_path("x", "/w")
    df = spark.createDataFrame([("/w/movies/a/b.mkv",), ("/w/shows",)], "x string")
    assert [tuple(r) for r in df.select(folder, name).collect()] == [("movies", "a/b.mkv"), ("shows", "shows")]


def test_with_default_replaces_empty(spark):
    assert one_col(spark, [None, "", "v"], P.with_default("x", "none")) == ["none", "none", "v"]


def test_manifest_fields_absent_and_bad(spark):
    texts = ['{"job_id":"j","name":"n","type":null,"files":[]}', '{"job_id":"j"}', "", "{bad",
             '{"job_id":"k","files":[{"name":"a","hash":"h1"},{"name":"b","hash":null}]}']
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(R.manifest_fields("t").alias("f")).collect()
    assert (rows[0].f.job_id, rows[0].f.name, rows[0].f.type, rows[0].f.hashes) == ("j", "n", "null", [])
    assert (rows[1].f.name, rows[1].f.hashes) == ("", [])
    assert rows[2].f.job_id == "null" and rows[3].f.job_id == "null"
    assert rows[4].f.hashes == ["h1", None]


def test_hash_set_contains_empty_is_true(spark):
    df = spark.createDataFrame([(["a", "b"], []), (["a"], ["a", "b"]), (["a", "b"], ["b"])],
                               "b array<string>, m array<string>")
    assert [r[0] for r in df.select(R.hash_set_contains("b", "m")).collect()] == [True, False, True]


def test_next_state_and_bogus(spark):
    assert one_col(spark, [None, "", "ingest", "stage", "done", "bogus"], R.next_state("x")) == \
        ["scan", "scan", "scan", "done", "done", None]


def test_iso_round_trip(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:07.5' AS ts")
    iso = df.select(R.iso_timestamp("ts")).first()[0]
    assert iso == "2024-01-01T00:00:07+00:00"
    back = df.select(F.unix_seconds(R.parse_iso(F.lit(iso)))).first()[0]
    assert back == 1704067207


def test_json_escape(spark):
    assert one_col(spark, ['a"b\\c\nd'], R.json_escape("x")) == ['"a\\"b\\\\c\\nd"']


def test_validate_request_cascade(spark):
    lay = Layout(download="/srv/complete")
    req = spark.createDataFrame([
        ("n", "/srv/complete/a.mkv", "t1", None),      # exists
        ("n", "/srv/complete/b.mkv", "t2", None),      # missing, state none
        ("n", "/srv/complete/b.mkv", "t3", "scan"),    # missing but past none: admitted
        ("n", "/srv/complete-old/x", "t4", None),      # outside
        ("n", "", "t5", None),
        (None, "/srv/complete/a.mkv", "t6", None),
    ], "name string, orig_src string, tx string, state string")
    inv = spark.createDataFrame([("/srv/complete/a.mkv",)], "path string")
    got = {r.tx: r.reject_reason for r in validate_request(req, lay, inv).collect()}
    assert got["t1"] is None and got["t3"] is None
    assert got["t2"] == "input does not exist"
    assert got["t4"] == "must originate from download directory"
    assert got["t5"] == "missing source path"
    assert got["t6"].startswith("usage")


def test_derive_and_normalize(spark):
    req = spark.createDataFrame([("t", "/srv/complete/x.mkv", False), ("u", "/srv/complete/d/", True)],
                                "tx string, orig_src string, is_dir boolean")
    d = normalize_bundle(derive_paths(req, Layout())).orderBy("tx").collect()
    assert d[0].proc_path == "/srv/processing/x.mkv" and d[0].stage_path == "/srv/staging/x.mkv.dir"
    assert d[0].bundle_root == "/srv/processing/x.mkv.dir" and d[0].wrapped_rel_path == "x.mkv"
    assert d[1].basename == "d" and d[1].bundle_root == "/srv/processing/d"
