import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from bundleflow.llm import word_bpe as W

PATH = P.path("word_bpe_49k.json")
DATA = W.read_file(PATH)


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)

    def encode(texts):
        found = tokenizer.encode_batch(texts, add_special_tokens=False)
        return [(tuple(e.ids), tokenizer.decode(e.ids, skip_special_tokens=False)) for e in found]
    return encode


@pytest.fixture(scope="module")
def merges():
    return W.Merges(DATA)


@pytest.fixture(scope="module")
def own(merges):
    words = [b"the", b"and", b"hello", b"helloing", b"running", b"jogging", b"ing", "naïve".encode(), b"x"]
    encoder = W.WordEncoder(merges, W.Lexicon(W.compile_lexicon({w: merges.merge(w) for w in words})))

    def encode(texts):
        offsets, ids = encoder(texts)
        decoded = encoder.decode(offsets, ids).to_pylist()
        return [(tuple(ids[a:b].tolist()), d) for a, b, d in zip(offsets, offsets[1:], decoded)]
    return encode


@pytest.mark.parametrize("which", ["documents", "edge_docs", "no_docs"])
def test_as_the_library(which, request, library):
    docs = request.getfixturevalue(which)
    rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    want = [(d, ids, text) for (d, _), (ids, text) in zip(rows, library([t for _, t in rows]))]
    got = W.encode_documents(docs, PATH).collect()
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in got) == Counter(want)
    digests = Counter((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                       hashlib.sha256(text.encode()).hexdigest()) for d, ids, text in want)
    assert Counter(map(tuple, W.encoding_digests(docs, PATH, lexicon_words=50).collect())) == digests


def test_any_text(own, library):
    @settings(max_examples=200, deadline=None)
    @given(st.lists(st.text(max_size=60), max_size=5))
    def same(texts):
        assert own(texts) == library(texts)

    same()


def test_every_character(own, library):
    """Each code point of the planes that have characters, between letters, before an ending, with marks."""
    for start in (*range(0, 0x34000, 1 << 14), 0xE0000):
        chars = [chr(c) for c in range(start, start + (1 << 14)) if not 0xD800 <= c <= 0xDFFF]
        texts = ["".join(f"a{c}'s {c}1{c} é{c}̴ֿ {c}̣́ " for c in chars[i:i + 64])
                 for i in range(0, len(chars), 64)]
        for text, a, b in zip(texts, own(texts), library(texts)):
            assert a == b, ascii(text[:40])


def test_odd_texts(own, library):
    rnd = random.Random(2)
    texts = ["ab" * 20000, "x" * 3000, " " * 5000, "é" * 2000, "ΟΔΟΣ Σ", "İstanbul", "<|endoftext|>Hello<|startoftext|>THE",
             "<|endoftext", "it's IT'S 'll ''re", "\x00\x01 a\x85　b\x1c", "don't 12345 ½²"]
    texts += ["".join(rnd.choices("etaoin shr'dlu \n019é漢", k=rnd.randint(1, 60))) for _ in range(500)]
    assert own(texts) == library(texts)


def test_transducer_is_minimal_and_exact():
    rnd = random.Random(3)
    words = {bytes(rnd.choices(b"abc", k=rnd.randint(1, 7))) for _ in range(400)}
    entries = {w: tuple(rnd.choices(range(5), k=rnd.randint(1, 3))) for w in words}
    lexicon = W.Lexicon(W.compile_lexicon(entries))
    every = sorted(words | {w + b"a" for w in words} | {b"", b"zzz"})
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in every])]).astype(np.int32)
    found, counts, ids = lexicon.look_up(np.frombuffer(b"".join(every), np.uint8), offsets)
    assert [w for w, f in zip(every, found) if f] == sorted(words)
    at = 0
    for w, f, n in zip(every, found, counts):
        if f:
            assert tuple(ids[at:at + n]) == entries[w]
            at += n
    # no two states have the same arcs, targets and ids
    arcs = {}
    for key, *rest in zip(lexicon.keys, lexicon.targets, lexicon.starts, lexicon.sizes):
        arcs.setdefault(int(key) >> 8, []).append((int(key) & 255, *map(int, rest)))
    states = [(bool(lexicon.finals[s]), int(lexicon.tails[s]), int(lexicon.tail_sizes[s]), tuple(arcs.get(s, ())))
              for s in range(len(lexicon.finals))]
    assert len(set(states)) == len(states)


def test_suffixes_are_shared():
    same = {w + b"ing": (7,) for w in (b"runn", b"jogg", b"sitt")}
    lexicon = W.Lexicon(W.compile_lexicon(same))
    assert len(lexicon.finals) < sum(map(len, same))
    empty = W.Lexicon(W.compile_lexicon({}))
    assert not empty.look_up(np.frombuffer(b"ab", np.uint8), np.array([0, 2], np.int32))[0].any()


def test_frequent_words_cover_all_documents(spark):
    docs = spark.createDataFrame([("b a a",), ("A, c b",), (None,), ("word's",)], "text string").repartition(3)
    assert sorted(tuple(r) for r in W.frequent_words(docs).collect()) == [("a", 3), ("b", 2)]
    assert [tuple(r) for r in W.frequent_words(docs, limit=1).collect()] == [("a", 3)]


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        W.Merges(W.read_file(P.path("byte_bpe_50k.json")))
