import math
import re
from collections import Counter

import pyarrow as pa
import pytest

from bundleflow.llm import ranked_search as rs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=20):
    """(item_id, rank, doc_id, score), each row of ``items`` by itself."""
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in items:
        found = []
        for d, c in counts:
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // n_terms
            score = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                found.append((-score, d is None, d or 0))
        out += [(item_id, i, None if missing else d, -s) for i, (s, missing, d) in enumerate(sorted(found)[:top], 1)]
    return out


@pytest.fixture(scope="module")
def items(spark):
    rows = [(i, r.text) for i, r in enumerate(spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect())]
    rows += [(3, "the the of and"), (None, "the same words"), (4, None), (5, "?!"), (6, "zzzznothing"), (7, "É naïve 漢字"),
             (7, "É naïve 漢字"), (8, "x" * 60000)]
    return spark.createDataFrame([(i, t, "c", i) for i, t in rows], "item_id long, text string, doc_id string, rank long")


@pytest.mark.parametrize("which", ["documents", "edge_docs", "no_docs"])
def test_against_brute_force(which, request, items):
    docs = request.getfixturevalue(which)
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert Counter(map(tuple, rs.search(docs, items).collect())) == Counter(want)


def test_blocks_and_chunks_change_nothing(documents, items, monkeypatch):
    want = Counter(map(tuple, rs.search(documents, items, top=5).collect()))
    monkeypatch.setattr(rs, "BLOCK_ITEMS", 7)
    monkeypatch.setattr(rs, "CHUNK", 50)
    monkeypatch.setattr(rs, "EXACT", 1)
    assert Counter(map(tuple, rs.search(documents, items, top=5).collect())) == want


def test_no_items(documents, items):
    assert rs.search(documents, items.filter("false")).collect() == []


def test_ties_go_by_id(spark):
    docs = spark.createDataFrame([(i % 50 if i else None, "same words here") for i in range(120)], "doc_id long, text string")
    one = spark.createDataFrame([(1, "words"), (2, "other")], "item_id int, text string")
    got = sorted(rs.search(docs.repartition(7), one).collect(), key=lambda r: r.rank)
    ids = sorted(i % 50 for i in range(1, 120))[:20]
    assert [r.doc_id for r in got] == ids and [r.rank for r in got] == list(range(1, 21))
    few = rs.search(docs.limit(3), one).collect()
    assert [r.doc_id for r in sorted(few, key=lambda r: r.rank)] == [1, 2, None]


def test_terms_of_sliced_arrays():
    texts = ["A-b  c", None, "", "\x00\x7fÄ1ö_2", "漢字 Zz"]
    words, ends = rs.split_terms(pa.array(["xx yy", *(t or "" for t in texts)]).slice(1))
    assert words.to_pylist() == [w for t in texts for w in terms(t)]
    assert ends.tolist() == [3, 3, 3, 5, 7]
