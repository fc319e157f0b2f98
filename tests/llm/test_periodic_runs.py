import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bundleflow.llm import periodic_runs as pr
from bundleflow.llm import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words, min_length=6, min_repeats=4):
    n, out = len(words), {}
    for q in range(1, n // min_repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i:
                length = j - i + q
                if length >= max(min_length, min_repeats * q):
                    out.setdefault((i, length), q)  # periods rise: the smallest stays
            i = j + 1
    return sorted((s, n, q) for (s, n), q in out.items())


def collapse(words, runs):
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in drop)


def brute_digests(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(collapse(words, runs).encode()).hexdigest())


def find(texts, **kw):
    runs, collapsed = pr.RunFinder(kw.get("min_length", 6), kw.get("min_repeats", 4))(pa.array(texts, pa.string()))
    return runs, collapsed.to_pylist()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab", max_size=40), max_size=4), st.integers(2, 7), st.integers(2, 4))
def test_small_alphabets(texts, min_length, min_repeats):
    runs, collapsed = find([" ".join(t) for t in texts], min_length=min_length, min_repeats=min_repeats)
    for text, found, kept in zip(texts, runs, collapsed):
        want = brute_runs(list(text), min_length, min_repeats)
        assert found == want
        assert kept == collapse(list(text), want)


def test_planted_runs(monkeypatch):
    rnd = random.Random(4)
    texts = []
    for _ in range(60):
        words = []
        for _ in range(rnd.randint(0, 6)):
            words += rnd.choices("abcdefgh", k=rnd.randint(0, 30))
            words += rnd.choices("abc", k=rnd.randint(1, 9)) * rnd.randint(1, 12)
        texts.append("\t".join(words) + " ")
    want = [brute_runs(t.split()) for t in texts]
    assert sum(map(len, want)) > 60
    assert find(texts)[0] == want
    monkeypatch.setattr(pr, "CHUNK_WORDS", 50)
    monkeypatch.setattr(pr, "BLOCK", 2)
    assert find(texts)[0] == want


def test_long_texts():
    fib = ["a", "ab"]
    while len(fib[-1]) < 3000:
        fib.append(fib[-1] + fib[-2])
    word = list(fib[-1][:3000])
    assert pr.runs_of(np.array([ord(c) for c in word])) == brute_runs(word)
    found, collapsed = find(["w " * 40000, "x y z " * 10000])
    assert found == [[(0, 40000, 1)], [(0, 30000, 3)]] and collapsed == ["w", "x y z"]


@pytest.mark.parametrize("which", ["documents", "edge_docs", "no_docs"])
def test_query_against_brute_force(which, request, tmp_path):
    docs = request.getfixturevalue(which)
    if which == "edge_docs":
        docs = docs.union(docs.selectExpr("doc_id + 100", "text", "lang", "source", "n_chars", "fp", "key", "score"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    # texts of 30,000 equal words are held to the values above: too slow by brute force
    rows = [r for r in rows if len(r[1] or "") < 100_000]
    small = {r[0] for r in rows}
    got = [tuple(r) for r in queries.op11_periodic_runs(docs.sparkSession, str(tmp_path)).collect()]
    assert len(got) == docs.count()
    assert Counter(r for r in got if r[0] in small) == Counter(brute_digests(*r) for r in rows)


def test_words_end_at_ascii_space_only(spark):
    docs = spark.createDataFrame([(1, "\x1ca\x1c " * 8 + "\x85\xa0 x\x0b\x0cy")], "doc_id int, text string")
    (row,) = pr.find_runs(docs).collect()
    assert [tuple(r) for r in row.runs] == [(0, 8, 1)] and row.collapsed == "\x1ca\x1c \x85\xa0 x y"
