"""Signature search through the index of grams, and a scan that fails closed."""

import random

import pytest

from bundleflow.operators import content as CT
from bundleflow.operators import gram_index as G


def cases(seed=5):
    rnd = random.Random(seed)
    text = lambda n, a="abcd ": "".join(rnd.choices(a, k=n)).encode()
    files = [text(rnd.randint(0, 3000)) for _ in range(30)] + [b"", b"\x00\xff" * 50, b"x" * 1000]
    pats = [text(n) for n in (1, 2, 3, 5, 7, 8, 9, 20) for _ in range(6)] + [b"x" * 300, b"\xff\x00\xff", b"y" * 40]
    for n in (4, 12, 127, 128, 129, 255, 256, 257, 700):  # real parts, and parts with one wrong byte
        f = rnd.choice([f for f in files if len(f) > 1500])
        at = rnd.randint(0, len(f) - n)
        pats += [f[at:at + n], f[at:at + n - 1] + b"#", b"#" + f[at + 1:at + n]]
    return files, list(dict.fromkeys(p for p in pats if p))


@pytest.mark.parametrize("by_path", [False, True])
def test_counts_as_plain_search(spark, tmp_path, by_path):
    files, pats = cases()
    rows = []
    for i, data in enumerate(files):
        (tmp_path / str(i)).write_bytes(data)
        rows.append((f"f{i}", str(tmp_path / str(i)), None if by_path else bytearray(data)))
    rows.append(("gone", str(tmp_path / "gone"), None))
    df = spark.createDataFrame(rows, "rel_path string, path string, content binary")
    p = spark.createDataFrame([(bytearray(x),) for x in pats] + [(None,), (bytearray(b""),)], "p binary")
    got = {r.rel_path: r.n for r in G.count_patterns(df, p, pattern_col="p", out="n", content="content", path="path").collect()}
    want = {f"f{i}": sum(x in data for x in pats) for i, data in enumerate(files)}
    assert got == want | {"gone": None} and sum(want.values()) > 300


def _all_bits():
    import numpy as np
    return np.full(G.BITMAP_BITS // 32, 0xFFFFFFFF, np.uint32)


@pytest.mark.parametrize("size", [3, 8])
def test_windows_across_chunks(size):
    rnd = random.Random(1)
    data = bytes(rnd.choices(range(4), k=2500))
    bits = _all_bits()
    whole = list(G._windows(iter([data]), [size], bits))
    if size == G.GRAM:
        assert [w[4] for w in whole] == list(range(len(data) - size + 1))
    for n in (1, 50, 140, 999):
        parts = list(G._windows(iter([data[i:i + n] for i in range(0, len(data), n)]), [size], bits))
        assert [(w[0], w[1], w[4]) for w in parts] == [(w[0], w[1], w[4]) for w in whole]
        for _, _, around, at, place in parts:
            assert around[at:] == data[place:place + G.BLOCK] and around[:at] == data[place - at:place] and at >= min(place, G.BLOCK)


def test_equal_to_the_automaton(spark, monkeypatch):
    files, pats = cases(9)
    df = spark.createDataFrame([("b", f"f{i}", bytearray(d), f"h{i}") for i, d in enumerate(files)],
                               "bundle string, rel_path string, content binary, sha256 string")
    p = spark.createDataFrame([(bytearray(x),) for x in pats], "text binary")
    one = {tuple(r) for r in CT.flag_signatures(df, None, p).select("rel_path", "pattern_hits", "flagged").collect()}
    monkeypatch.setattr(CT, "BROADCAST_PATTERN_BYTES", 10)
    assert {tuple(r) for r in CT.flag_signatures(df, None, p).select("rel_path", "pattern_hits", "flagged").collect()} == one


def test_scan_fails_closed(spark):
    rows = [("b1", "seen", "fine", "h1"), ("b2", "blind", None, None), ("b3", "hashed", None, "h3")]
    df = spark.createDataFrame(rows, "bundle string, rel_path string, content string, sha256 string")
    deny, pats = spark.createDataFrame([("hx",)], "sha256 string"), spark.createDataFrame([("bad",)], "text string")

    def infected(*how):
        return {r.bundle for r in CT.signature_scan(df, *how).where("infected").collect()}
    assert infected(deny) == {"b2"}
    assert infected(None, pats) == {"b2", "b3"}
    assert infected(deny, pats) == {"b2", "b3"}
    assert infected() == set()


def test_unreadable_subtitle_goes_to_quarantine(spark, tmp_path, monkeypatch):
    from bundleflow.operators.filters import Layout
    from bundleflow.plans import vm_ingest as V
    (tmp_path / "A").mkdir()
    (tmp_path / "A/a.mkv").write_bytes(b"film")
    (tmp_path / "A/a.srt").write_bytes(b"sub")
    real = CT.fingerprint_paths

    def lost(files, **kw):  # the subtitle cannot be read
        from pyspark.sql import functions as F
        out, srt = real(files, **kw), F.col("rel_path").endswith(".srt")
        return out.withColumn("sha256", F.when(~srt, F.col("sha256"))).withColumn(
            "read_error", F.when(srt, F.lit("PermissionError")).otherwise(F.col("read_error")))
    monkeypatch.setattr(CT, "fingerprint_paths", lost)
    req = spark.createDataFrame([("A", f"{tmp_path}/A", "tA")], "name string, orig_src string, tx string")
    deny = spark.createDataFrame([("none",)], "sha256 string")
    for kw, outcome in (({"deny_digests": deny}, "infected"), ({}, "passed")):
        _, res, _ = V.ingest_requests(req, Layout(download=str(tmp_path)), **kw)
        assert [r.outcome for r in res.results.collect()] == [outcome]


def test_places_do_not_grow_with_patterns_times_text(spark):
    """Patterns and files are made of the same few words, so every word is in
    some block of a pattern; only real blocks of patterns are let through."""
    rnd = random.Random(3)
    words = ["".join(rnd.choices("abcdefg", k=7)) + " " for _ in range(12)]
    pats = ["".join(rnd.choices(words, k=n)) for n in (4, 8, 30, 50) for _ in range(100)]
    text = "".join(rnd.choices(words, k=20_000)) + pats[250]
    index = G.anchors(spark.createDataFrame([(p,) for p in pats], "p string"), "p").cache()
    sizes = sorted(r["size"] for r in index.select("size").distinct().collect())
    places = list(G._windows(iter([text.encode()]), sizes, G.bitmap(index)))
    real = sum(text.count(p) for p in pats)
    assert real >= 1 and len(places) <= 2 * real + 100  # 20,000 and more by grams of 8 bytes


def test_many_anchors_let_few_places_through(spark):
    """The bitmap grows with the anchors: a text that holds none of 1.5 million
    has as few places let through as beside a few anchors."""
    from pyspark.sql import functions as F
    rnd = random.Random(4)
    text = rnd.randbytes(300_000)
    for n in (1_000, 1_500_000):
        index = spark.range(n).select(F.xxhash64("id").alias("gram"))
        bits = G.bitmap(index)
        assert len(list(G._places(text, [8], bits, 0, len(text)))) <= 5  # some 600 with two bits of a fixed 2**26
        some = index.limit(500).toPandas()["gram"].to_numpy()
        assert len(G._through(some, bits)) == 500


def test_texts_stay_where_they_are_for_the_patterns(spark, monkeypatch):
    """ct2_signature_index shuffles no whole text to find the toxic ones, where
    labels are too large for a broadcast and the ids of the toxic are not."""
    from bundleflow.plans import queries_ops as Q
    plans = []
    monkeypatch.setattr(Q, "count_patterns", lambda files, patterns, **kw: plans.append(
        patterns._jdf.queryExecution().executedPlan().toString()) or files.selectExpr("doc_id", "0L AS pattern_hits"))
    key, sf = "spark.sql.autoBroadcastJoinThreshold", "/root/testdata/sf0.1"
    spark.conf.set(key, 8 * 1024)  # labels take 24 KB here
    try:
        Q.q_signature_index(spark, sf)
    finally:
        spark.conf.unset(key)
    assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" not in plans[0]
