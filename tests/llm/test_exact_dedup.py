import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from bundleflow.llm import exact_dedup

UPPER = {c: c + 32 for c in range(65, 91)}


def norm(text):
    return (text or "").translate(UPPER)


def brute(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[norm(t)].append(d)
    out = []
    for d, t in rows:
        ids = groups[norm(t)]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((d, keep, len(ids), d == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return Counter(out)


def tuples(df):
    return Counter(map(tuple, df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()))


@pytest.mark.parametrize("which", ["documents", "edge_docs", "no_docs"])
def test_against_brute_force(which, request):
    docs = request.getfixturevalue(which)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert tuples(exact_dedup.exact_duplicates(docs)) == brute(rows)


def test_shared_identifiers_are_told_apart(spark):
    """With the length as identifier nearly all chunks share one."""
    long = "one sentence here. " * 40
    texts = [long, long.replace("one", "two"), long, "abc", "abd", "ABC", long + "x", long + "y", ""]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert tuples(exact_dedup.exact_duplicates(docs, identify=F.length)) == brute(rows)


def test_chunks_are_the_text(spark):
    texts = ["", "x" * 5000, "a word, " * 900, "line\n" * 700, "漢字🙂" * 900]
    docs = spark.createDataFrame([(t,) for t in texts], "t string")
    got = docs.select("t", exact_dedup.chunks(F.col("t")).alias("c")).collect()
    assert all("".join(r.c) == r.t for r in got)
    assert any(len(r.c) > 3 for r in got)


@pytest.mark.parametrize("which", ["documents", "edge_docs", "no_docs"])
def test_one_row_of_each_text_stays(which, request):
    docs = request.getfixturevalue(which)
    kept = exact_dedup.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = Counter({(norm(t), k) for (d, t) in rows for k in [max((x for x, u in rows if x is not None and norm(u) == norm(t)), default=None)]})
    assert Counter((norm(r.text), r.doc_id) for r in kept.collect()) == want


def test_no_python_in_the_plan(documents):
    for df in (exact_dedup.exact_duplicates(documents), exact_dedup.drop_exact_duplicates(documents)):
        assert "Python" not in df._jdf.queryExecution().toString()
