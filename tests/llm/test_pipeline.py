import hashlib
from collections import Counter

import public_tokenizers as P
import tiktoken
from test_exact_dedup import norm
from test_mixing import brute as mix_brute
from test_simhash import brute_fingerprint, brute_groups

import corpus_pipeline as cp
from bundleflow.llm import bpe

SF = "/root/testdata/sf0.001"


def exact(rows):
    best = {}
    for r in rows:
        k = norm(r.text)
        if k not in best or r.doc_id > best[k].doc_id:
            best[k] = r
    return list(best.values())


def near(rows):
    groups = brute_groups([(r.doc_id, brute_fingerprint(r.text)) for r in rows])
    return [r for r, (d, _, low) in zip(rows, groups) if d == low]


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = cp.drop_toxic(spark, docs, SF)
    assert kept.columns == docs.columns
    rows = near(exact(kept.collect()))
    deduped = cp.drop_near_copies(spark, cp.drop_exact_copies(spark, kept, SF), SF)
    assert deduped.columns == docs.columns
    assert Counter(deduped.collect()) == Counter(rows)
    _, mixed = mix_brute([(r.doc_id, r.source, r.text) for r in rows], cp.TARGET_ENTROPY, cp.MAX_REPETITION)
    texts = {r.doc_id: r.text for r in rows}
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={}, mergeable_ranks=bpe.parse_ranks(
        bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")))).encode_ordinary

    def digest(text):
        ids = lib(text)
        return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()
    want = Counter()
    for (d, *_), n in mixed.items():
        want[(d, *digest(texts[d]))] += n
    assert Counter(map(tuple, cp.run(spark, SF).collect())) == want
    assert len(cp.STAGES) == 5


def test_edge_rows_pass_every_stage(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        cur = docs
        for _, stage in cp.STAGES[:-1]:
            cur = stage(spark, cur, SF)
            assert cur.columns == docs.columns
        out = cp.encode(spark, cur, SF)
        assert out.count() == cur.count()
