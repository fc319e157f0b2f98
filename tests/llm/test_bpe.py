import random
from collections import Counter

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from bundleflow.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")
DATA = bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.parse_ranks(DATA), special_tokens={}).encode_ordinary


@pytest.fixture(scope="module")
def own():
    return bpe.Encoder(bpe.rank_table(DATA), P.PATTERN)


@pytest.mark.parametrize("which", ["documents", "edge_docs", "no_docs"])
def test_as_the_library(which, request, library):
    docs = request.getfixturevalue(which)
    rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    got = bpe.encode_documents(docs, PATH, P.PATTERN).collect()
    assert Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in got) == Counter(
        (d, tuple(library(t)), t.encode()) for d, t in rows)


def test_any_text(own, library):
    @settings(max_examples=300, deadline=None)
    @given(st.text(max_size=80))
    def same(text):
        assert own(text).tolist() == library(text)

    same()


def test_every_character_before_an_ending(own, library):
    """Each code point of the planes that have characters."""
    for start in (*range(0, 0x34000, 1 << 12), *range(0x3D000, 0x40000, 1 << 12), 0xE0000):
        text = "".join(f"{chr(c)}'ll a{chr(c)} {chr(c)}1 {chr(c)}" for c in range(start, start + (1 << 12))
                       if not 0xD800 <= c <= 0xDFFF)
        assert own(text).tolist() == library(text), hex(start)


def test_documents_are_encoded_once(spark, documents):
    plan = bpe.encode_documents(documents, PATH, P.PATTERN)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "ArrowEvalPython" not in plan


def test_columns(spark, library):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame([("a b",), (None,), ("",)], "text string")
    rows = docs.select(bpe.encode_column(spark, F.col("text"), PATH, P.PATTERN).alias("ids"), "text")
    rows = rows.withColumn("ids", F.when(F.col("text").isNotNull(), F.col("ids")))
    got = rows.select("ids", bpe.decode_column(spark, F.col("ids"), PATH).alias("back")).collect()
    assert [(r.ids, r.back and bytes(r.back)) for r in got] == [(library("a b"), b"a b"), (None, None), ([], b"")]


def test_odd_pretokens(own, library):
    rnd = random.Random(2)
    texts = ["ab" * 20000, "x" * 30000, " " * 5000, "é" * 2000, "\x1c\x1d a\x85　b", "<|endoftext|> it's IT'S"]
    texts += ["".join(rnd.choices("etaoin shr'dlu \n019é漢", k=rnd.randint(1, 60))) for _ in range(1500)]
    for t in texts:
        assert own(t).tolist() == library(t)


def test_small_memo_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(bpe, "MEMO", 3)
    enc = bpe.Encoder(bpe.RankTable(bpe.parse_ranks(DATA)), P.PATTERN)
    text = "the quick brown fox jumps over the lazy dog, again and again the quick fox"
    assert enc(text).tolist() == library(text)
