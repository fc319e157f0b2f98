import math
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from bundleflow.llm import toxicity as tx

CORPUS = ("the idiot was there and the others went to the old house by the river with a stupid plan "
          "nobody liked the pathetic idea but people are people and this is what they said about it").split()


@pytest.fixture(scope="module")
def model():
    counts = Counter()
    for w in CORPUS:
        tx.grams_of(w, 3, counts)
    return tx.CharModel(dict(counts))


@pytest.mark.parametrize("seen,meant", [("1d1ot", "idiot"), ("i.d.i.o.t", "idiot"), ("iiidiot", "idiot"), ("5tupid", "stupid"),
                                        ("$tupid", "stupid"), ("path3t1c", "pathetic"), ("idiooot", "idiot"), ("st*pid", "stupid")])
def test_restores_words(model, seen, meant):
    assert meant in tx.readings(seen, model)


def test_spaced_words(model):
    text = "what an i d i o t he is"
    assert "idiot" in set(tx.words_of(text, model))
    assert "idiot" in set(tx.words_of("S T U P I D  1 d 1 o t", model)) or "stupid" in set(tx.words_of("S T U P I D", model))


def test_plain_words_have_one_path(model):
    assert tx.readings("house,", model) == ["house"] and tx.readings("...", model) == []
    assert tx.readings("x" * 500, model) == ["x", "x" * 500]  # a stretched letter, and the run as written


def test_decode_is_the_best_path(model):
    """Against all paths of the lattice."""
    from itertools import product
    for token in ("1d10t", "st0pp", "h3e", "a.b1", "ooo1"):
        paths = []
        for path in product(*tx.lattice(token)):
            text = "".join(c for c, _ in path)
            letters = "  " + "".join(map(tx._letter, text)) + " "
            cost = sum(e for _, e in path) + sum(model.cost(letters[i:i + 3]) for i in range(len(letters) - 2))
            paths.append((round(cost, 9), text))
        assert tx.decode(token, model) == min(paths)[1]


@pytest.fixture(scope="module")
def labelled(spark):
    sf = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")


def test_held_out_labels(labelled):
    docs, labels = labelled
    scored = tx.score_documents(docs, labels).cache()
    assert scored.count() == docs.count() and scored.filter("score < 0 or score > 1 or score is null").count() == 0
    seen = {(r.toxic, r.predicted): r["count"] for r in scored.filter("held_out").join(labels, "doc_id")
            .groupBy("toxic", "predicted").count().collect()}
    assert seen.get((0, 1), 0) == 0 and seen[1, 1] >= 0.7 * (seen[1, 1] + seen.get((1, 0), 0))


def test_disguised_words_are_found(spark, labelled):
    docs, labels = labelled
    scorer = tx.fit(docs, labels, tx.held_out_by_id(F.col("doc_id")))
    clean = "the house by the river was there and they went to it"
    # the labels of so small a table do not teach every word
    learnt = [w for w in ("idiot", "moron", "stupid", "trash", "clown") if w in scorer.lexicon]
    assert len(learnt) >= 3
    for word in learnt:
        leet = word.replace("i", "1").replace("o", "0").replace("t", "7")
        for form in (word, leet, " ".join(word), ".".join(word), word[0] + word[1] * 4 + word[2:]):
            assert scorer(f"{clean} {form} {clean}") >= tx.THRESHOLD, form
    assert scorer(clean) < tx.THRESHOLD and scorer("") < tx.THRESHOLD


def test_edge_rows(edge_docs, no_docs, labelled):
    labels = labelled[1]
    got = tx.score_documents(edge_docs, labels).collect()
    assert len(got) == edge_docs.count() and all(r.predicted == 0 for r in got)
    assert tx.score_documents(no_docs, labels).count() == 0
    assert tx.score_documents(edge_docs, labels.filter("false")).filter("predicted = 1").count() == 0
    kept = tx.drop_toxic(edge_docs, labels)
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count()


SYMBOLS = ("$$$", "@@@", "--$", "€€€", "(((@", "!!$", "...", "$", "@")


def test_tokens_of_symbols_only(model):
    scorer = tx.Scorer(model, {"idiot": 3.0}, (-1.0, 1.0, 1.0))
    for token in SYMBOLS:
        tx.readings(token, model)
        assert scorer(f"the {token} house") < tx.THRESHOLD <= scorer(f"the {token} idiot")


def test_long_tokens_are_decoded(model):
    words = ("people", "said", "what", "they", "liked", "about", "the", "old", "house", "and", "others", "went", "there")
    dotted = ".".join("".join(words) + "idiot")
    assert len(dotted) > 64 and "idiot" in tx.readings(dotted, model)
    assert "stupid" in tx.readings("st" + "u" * 200 + "pid", model)
    assert "idiot" in tx.readings("/".join(words * 3 + ("1d1ot",)), model)
    spaced = " ".join("house" * 12 + "is" + "idiot" + "is" + "house" * 12)  # the 64th letter is one of idiot
    assert "idiot" in set(tx.words_of(spaced, model))


def test_decoding_is_linear(model):
    start = time.process_time()
    tx.decode("1d1ot" * 2000, model, borders=True)
    small = time.process_time() - start
    start = time.process_time()
    tx.decode("1d1ot" * 20000, model, borders=True)
    assert time.process_time() - start < 30 * small + 1


def test_whole_words_make_the_character_model(spark):
    docs = spark.createDataFrame([("a" * 64 + "qzj",)], "text string")
    assert tx.char_model(docs).counts.get("qzj") == 1


@pytest.mark.parametrize("seen,meant", [("stuupid", "stupid"), ("$tup!d", "stupid"), ("(1d!0+", "idiot"), ("1d!0+", "idiot"),
                                        ("!d10+!", "idiot"), ("@$$hole", "asshole"), ("$#it", "shit"), ("shi+", "shit"),
                                        ("5#17", "shit"), ("(shi+", "shit")])
def test_disguises_at_borders_and_of_symbols(spoken, seen, meant):
    assert meant in tx.readings(seen, spoken)


@pytest.mark.parametrize("text,meant", [("he is an a s s here", "ass"), ("go d i e.", "die"), ("k i l l, them", "kill"),
                                        ("b o o b", "boob")])
def test_short_spaced_words(spoken, text, meant):
    assert meant in set(tx.words_of(text, spoken))


def test_doubled_letters_stay_readable(model):
    assert "hello" in tx.readings("hello", model) and "wall" in tx.readings("wall", model)


@pytest.fixture(scope="module")
def spoken():
    counts = Counter()
    for w in [*CORPUS, "asshole", "ass", "shit", "die", "kill", "boob", "hello"]:
        tx.grams_of(w, 3, counts)
    return tx.CharModel(dict(counts))


@pytest.mark.parametrize("seen,meant", [("you/die", "die"), ("go/die/now", "die"), ("so,die", "die"), ("k1ll/you", "you"),
                                        ("k1ll/you", "kill"), ("a:b", "b")])
def test_short_parts_are_words(spoken, seen, meant):
    assert meant in tx.readings(seen, spoken)
    assert tx.Scorer(spoken, {meant: 3.0}, (-1.0, 1.0, 1.0))(f"the {seen} house") >= tx.THRESHOLD


def brute_score(text, model, lexicon, weights):
    """Every reading of every token, without memo or sieve."""
    tokens = set(text.lower().split())
    best = [max((lexicon.get(f, 0.0) for w in tx.readings(t, model) for f in tx.features(w)), default=0.0) for t in tokens]
    best += [max((lexicon.get(f, 0.0) for f in tx.features(w)), default=0.0) for w in tx.spaced_words(text, tokens, model)]
    found = [b for b in best if b]
    z = weights[0] + weights[1] * max(found, default=0.0) + weights[2] * math.log1p(math.fsum(found))
    return 1 / (1 + math.exp(-z))


def test_sieve_changes_no_score(labelled, spoken):
    docs, _ = labelled
    rnd = random.Random(6)
    words = CORPUS + ["asshole", "kill", "moron", "stupid"]
    disguise = {"i": "1!|", "o": "0", "a": "4@", "s": "5$", "t": "7+", "e": "3*", "l": "1|"}

    def odd():
        out = []
        for c in rnd.choice(words):
            c = rnd.choice(disguise.get(c, c)) if rnd.random() < 0.4 else c
            out.append(c * rnd.choice((1, 1, 1, 2, 4)) + rnd.choice(("", "", "", ".", "-")))
        return rnd.choice(("", "", "(", "$", "!!")) + "".join(out) + rnd.choice(("", "", "!", "!$", "/you"))
    texts = [" ".join(odd() for _ in range(12)) for _ in range(400)] + [r.text for r in docs.limit(150).collect()]
    lexicon = {"idiot": 2.0, "stup~": 1.5, "kill": 1.0, "asshol~": 2.5, "$tupid": 0.5, "moron": 2.0, "people~": 0.7}
    scorer = tx.Scorer(spoken, lexicon, (-2.0, 0.5, 0.5))
    for text in texts:
        assert scorer(text) == pytest.approx(brute_score(text, spoken, lexicon, scorer.weights), abs=1e-12)
    hits = sum(scorer(t) > 0.2 for t in texts)
    assert 100 < hits < 500


def test_lexicon_is_what_the_counts_say(spark, labelled):
    """Lexicon of Spark against plain counting over the same sample."""
    docs, labels = labelled
    model = tx.char_model(docs)
    train = tx.training_rows(docs, labels, tx.held_out_by_id(F.col("doc_id")), 400, "doc_id", "text")
    rows = [(r.toxic, r.text) for r in train.collect()]
    once = {}
    for toxic, text in rows:
        words = frozenset(f for w in tx.words_of(text, model) for f in tx.features(w))
        key = tx._digest(text)
        if key not in once or toxic < once[key][0]:
            once[key] = (toxic, words)
    toxic, total = sum(t for t, _ in once.values()), len(once)
    seen, bad = Counter(), Counter()
    for t, words in once.values():
        seen.update(words)
        bad.update(words if t else ())
    want = {}
    for f, n in seen.items():
        a = bad[f]
        if a >= tx.MIN_TOXIC and a * total > n * toxic:
            g = 2 * sum(x * math.log(x / e) for x, e in (
                (a, n * toxic / total), (n - a, n * (total - toxic) / total), (toxic - a, (total - n) * toxic / total),
                (total - toxic - n + a, (total - n) * (total - toxic) / total)) if x)
            if g >= tx.MIN_RATIO:
                want[f] = math.log((a + 0.5) / (toxic + 1)) - math.log((n - a + 0.5) / (total - toxic + 1))
    got = tx._lexicon(train, model)
    assert want and set(got) == set(want) and all(got[f] == pytest.approx(want[f]) for f in want)


def test_a_score_on_the_threshold_is_toxic(labelled):
    docs, labels = labelled
    some = docs.limit(40)
    scores = {r.doc_id: r.score for r in tx.score_documents(some, labels).collect()}
    edge = sorted(scores.values())[20]
    got = {r.doc_id: r.predicted for r in tx.score_documents(some, labels, threshold=edge).collect()}
    assert got == {d: int(s >= edge) for d, s in scores.items()}
