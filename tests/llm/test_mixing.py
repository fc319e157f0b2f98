import hashlib
import math
import re
from collections import Counter, defaultdict

import corpus_pipeline
import pytest

from bundleflow.llm import mixing


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def key(doc_id, block):
    return hashlib.md5(f"{mixing.SEED}|{block}|{'null' if doc_id is None else doc_id}".encode()).hexdigest()


def exponent(tokens, part, limit):
    """Largest exponent that reaches the entropy, but none below the limit's."""
    t = sorted(x for x in tokens if x)
    if len(t) < 2:
        return 1.0
    p = [x / sum(t) for x in t]

    def entropy(x):
        w = [q ** x for q in p]
        return -sum(v / sum(w) * math.log(v / sum(w)) for v in w)

    def bisect(holds):
        lo, hi = 0.0, 1.0
        for _ in range(mixing.STEPS):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if holds(mid) else (lo, mid)
        return lo, hi
    flat = 1.0 if part is None else bisect(lambda x: entropy(x) >= entropy(1) + part * (math.log(len(p)) - entropy(1)))[0]
    least = 0.0 if limit is None or p[-1] / p[0] <= limit else bisect(lambda x: (p[-1] / p[0]) ** (1 - x) > limit)[1]
    return round(max(flat, least), 6)


def brute(rows, part, limit):
    by = defaultdict(list)
    for d, s, t in rows:
        by["null" if s is None else "=" + s].append((d, words(t)))
    total = {s: sum(n for _, n in x) for s, x in by.items()}
    x = exponent(total.values(), part, limit)
    top = max(total.values(), default=0)
    out = []
    for s, docs in by.items():
        budget = max(math.floor(top * (total[s] / top) ** x + 0.5), total[s]) if total[s] else 0
        blocks = budget // total[s] if total[s] else 1
        out += [(d, s, n, b, key(d, b)) for d, n in docs for b in range(blocks)]
        rest = budget - blocks * total[s]
        spent, per = 0, Counter()
        for d, n in docs:
            per[key(d, blocks)] += n
        for k in sorted(per):
            if spent >= rest:
                break
            out += [(d, s, n, blocks, k) for d, n in docs if key(d, blocks) == k]
            spent += per[k]
    return x, Counter(out)


@pytest.mark.parametrize("which,part,limit", [("documents", 0.5, 4.0), ("documents", None, 1.25), ("documents", 1.0, None),
                                              ("edge_docs", None, 2.5), ("no_docs", 0.5, 4.0)])
def test_against_brute_force(which, part, limit, request):
    docs = request.getfixturevalue(which)
    x, want = brute([(r.doc_id, r.source, r.text) for r in docs.select("doc_id", "source", "text").collect()], part, limit)
    mixed = mixing.mix(docs, part, limit)
    got = mixed.select("doc_id", "mix_source", "mix_tokens", "mix_block", "mix_key", "mix_exponent").collect()
    assert {r.mix_exponent for r in got} <= {x}
    assert Counter(tuple(r)[:5] for r in got) == want
    assert mixed.columns[:len(docs.columns)] == docs.columns
    if limit:
        assert all(r.mix_block < math.ceil(limit) for r in got)


def test_hot_bin_and_ties(spark, monkeypatch):
    """One bin holds a whole source, and repeated rows share a key."""
    monkeypatch.setattr(mixing, "BIN_DIGITS", 1)
    rows = [(i % 7, "big", "a b c") for i in range(60)] + [(i, "small", "x y") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    _, want = brute(rows_in_order(rows), None, 3.3)
    got = mixing.mix(docs, None, 3.3).select("doc_id", "mix_source", "mix_tokens", "mix_block", "mix_key").collect()
    assert Counter(map(tuple, got)) == want


def rows_in_order(rows):
    return [(d, s, t) for d, s, t in rows]


def test_clashing_names(spark):
    docs = spark.createDataFrame([(1, "s", "a b", "mine", 9)], "doc_id long, source string, text string, mix_block string, _mb int")
    row = mixing.mix(docs).first()
    assert row.mix_block == "mine" and row["_mb"] == 9 and row["_mix_block"] == 0


def test_no_python_in_the_plan(documents):
    assert "Python" not in mixing.mix(documents)._jdf.queryExecution().toString()


def test_pipeline_stage_repeats_small_sources(spark):
    """The stage's limit is 1.25 passes: of 10 documents of 10 tokens, 125
    tokens are the whole block and the next three documents."""
    rows = [(i, "a b c d e f g h i j", "big") for i in range(100)] + [(i, "a b c d e f g h i j", "small") for i in range(100, 110)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = Counter(r.doc_id for r in corpus_pipeline.mix_sources(spark, docs, "").collect())
    assert set(got) == set(range(110))
    assert all(got[i] == 1 for i in range(100))
    assert sorted(got[i] for i in range(100, 110)) == [1] * 7 + [2] * 3


def test_flattest_weights_within_the_limit(documents):
    """The exponent in closed form: (largest / smallest) ** (1 - exponent) is the limit."""
    totals = Counter()
    for r in documents.select("source", "text").collect():
        totals[r.source] += words(r.text)
    ratio = max(totals.values()) / min(totals.values())
    want = max(0.0, 1 - math.log(1.25) / math.log(ratio))
    mixed = mixing.mix(documents, corpus_pipeline.TARGET_ENTROPY, corpus_pipeline.MAX_REPETITION)
    assert abs(mixed.first().mix_exponent - want) < 2e-6
    assert want == 0 or mixed.filter("mix_block >= 1").count() > 0
