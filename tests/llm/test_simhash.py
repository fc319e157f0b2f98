import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from bundleflow.llm import simhash
from bundleflow.llm.components import components

UPPER = {ord(c): ord(c) + 32 for c in map(chr, range(65, 91))}


def brute_fingerprint(text):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_groups(prints, radius=3):
    """Rows (doc_id, fp) to the smallest id that each row can reach."""
    fps = sorted({f for _, f in prints})
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[max(find(i), find(j))] = min(find(i), find(j))
    at = {f: i for i, f in enumerate(fps)}
    low = defaultdict(list)
    for d, f in prints:
        if d is not None:
            low[find(at[f])].append(d)
    return [(d, f, min(low[find(at[f])], default=None)) for d, f in prints]


def as_rows(df):
    return Counter((r.doc_id, r.fp % 2 ** 64, r.component_id) for r in df.collect())


@pytest.mark.parametrize("which", ["documents", "edge_docs", "no_docs"])
def test_against_brute_force(which, request):
    docs = request.getfixturevalue(which)
    want = brute_groups([(r.doc_id, brute_fingerprint(r.text)) for r in docs.select("doc_id", "text").collect()])
    assert as_rows(simhash.near_duplicates(docs)) == Counter(want)


def test_long_text_is_hashed_in_parts(monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 7)
    text = " ".join(random.Random(1).choices("abcdefg", k=200))
    assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


def test_links_of_close_fingerprints(spark):
    rnd = random.Random(3)
    prints = []
    for i in range(60):
        base = rnd.getrandbits(64)
        for _ in range(8):  # chains: each a few bits from the one before
            prints.append((len(prints), base))
            for b in rnd.sample(range(64), rnd.choice([1, 2, 3, 4])):
                base ^= 1 << b
    df = spark.createDataFrame([(d, f - 2 ** 64 if f >> 63 else f) for d, f in prints], "doc_id long, fp long")
    got = {(r.fp % 2 ** 64, r.component_id) for r in simhash.classes(df).collect()}
    assert got == {(f, c) for _, f, c in brute_groups(prints)}
    few = simhash.near_links(df.select("fp").distinct(), tile=3)  # many tiles in a cell
    assert few.count() > 0


def test_tile_links_do_not_grow_with_pairs():
    rnd = np.random.default_rng(0)
    a = np.uint64(12345) ^ (np.uint64(1) << rnd.integers(0, 64, 500).astype(np.uint64))
    u, v = simhash.tile_links(np.unique(a), np.unique(a), 3)
    assert 0 < len(u) <= 2 * len(np.unique(a))


def test_components_of_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, i) for i in range(501, 700)] + [(900, 900), (901, 902), (902, 901)]
    got = {r.u: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {i: 500 for i in range(501, 700)} | {902: 901}


@pytest.mark.parametrize("which", ["documents", "edge_docs", "no_docs"])
def test_one_row_of_each_group_stays(which, request):
    docs = request.getfixturevalue(which)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    rows = docs.select("doc_id", "text").collect()
    groups = brute_groups([(r.doc_id, brute_fingerprint(r.text)) for r in rows])
    assert Counter(r.doc_id for r in kept.collect()) == Counter(
        c for c, in {(g[2],) for g in groups if g[2] is not None})
