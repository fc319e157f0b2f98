import random
from collections import Counter
from itertools import product

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from bundleflow.llm import token_counts as tc

PATH = P.path("piece_bpe_32k.model")
PIECES = tc.model_pieces(tc.read_model(PATH))


def library(pieces, byte_fallback=True):
    t = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=byte_fallback))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement=tc.SPACE, prepend_scheme="always", split=True)
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("which", ["documents", "edge_docs", "no_docs"])
def test_as_the_library(which, request):
    docs = request.getfixturevalue(which)
    count = library(PIECES)
    want = Counter((r.doc_id, count(r.text or "")) for r in docs.select("doc_id", "text").collect())
    assert Counter((r.doc_id, r.n_tokens) for r in tc.count_tokens(docs, PATH).collect()) == want


def test_ties_and_unknown_characters():
    """Few pieces of equal scores make many ties."""
    rnd = random.Random(4)
    for fallback in (False, True):
        pieces = [("<unk>", 0.0), (tc.SPACE, -1.0)] + [("".join(p), float(-rnd.randint(1, 3)))
                                                       for n in (1, 2, 3) for p in product("ab", repeat=n) if rnd.random() < 0.8]
        if fallback:
            pieces += [(f"<0x{b:02X}>", -9.0) for b in range(256)]
        vocab, count = tc.Vocabulary(pieces), library(pieces, fallback)
        for _ in range(1500):
            text = "".join(rnd.choices("aaabbb cé漢", k=rnd.randint(0, 12)))
            assert vocab.count(text)[0] == count(text), (text, pieces)


def test_best_score_against_all_segmentations():
    pieces = [("<unk>", 0.0), ("a", -2.0), ("b", -2.5), ("ab", -4.0), ("ba", -3.0), ("aba", -6.9), (tc.SPACE, -1.0)]
    scores, vocab = dict(pieces), tc.Vocabulary(pieces)

    def best(word):
        if not word:
            return 0.0
        return max(scores[word[:i]] + best(word[i:]) for i in range(1, len(word) + 1) if word[:i] in scores)
    for n in range(1, 8):
        for p in product("ab", repeat=n):
            word = "".join(p)
            assert abs(vocab.best(word)[1] - best(word)) < 1e-9


def test_small_memo_changes_nothing(monkeypatch):
    text = "one two three one two three four five one " * 5
    want = tc.Vocabulary(PIECES).count(text)
    monkeypatch.setattr(tc, "MEMO", 2)
    assert tc.Vocabulary(PIECES).count(text) == want
