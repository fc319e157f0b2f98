"""Toxicity of texts whose words may be disguised: a noisy channel.

Words written with look-alike characters, stretched or spaced out are seen as
the output of a noisy channel. A character lattice holds what each character
may stand for; Viterbi decoding under a character trigram model of the corpus
picks the likeliest reading. The restored words are scored by a lexicon of
words and word beginnings that labelled toxic texts have and others have not.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bundleflow.llm.common import small_batches, whole_text

# What a character may stand for besides itself.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¥": "y",
    "*": "aeiou", "#": "h", "%": "x", "&": "a",
}
#: Put between letters to break a word up.
FILLERS = ".-_~'^"
#: Letters that the trigram model tells apart; all others are one class.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xDF, 0x100)))
OTHER, EDGE = "\0", " "
#: Channel costs in nats: a look-alike, a filler or a repeat taken away, a border put in.
SUBSTITUTE, REMOVE, BREAK = 1.0, 0.5, 2.0
#: A letter that is doubled once is mostly meant.
DOUBLED = 1.0
#: Word beginnings of these lengths are features besides the word.
STEMS = (4, 5, 6)
#: Labelled rows that the classifier is fitted on, at most.
MAX_TRAIN_ROWS = 20_000
#: The likelihood ratio that a feature of the lexicon must reach, and the toxic texts it must be in.
MIN_RATIO, MIN_TOXIC = 30.0, 5
#: Tokens whose features a worker remembers, and their length at most; the
#: results do not depend on either.
MEMO, MEMO_CHARS = 1 << 18, 64
THRESHOLD = 0.7

_DOUBLED = re.compile(r"(.)\1")
_RUN = re.compile(r"(.)\1+", re.DOTALL)
_NO_LETTER = re.compile(r"[\W\d_]+")
_SPACED = re.compile(r"(?<!\S)[\"'(\[]*(\S(?:\s+\S){2,})[.,;:!?\"')\]]*(?!\S)")


def _letter(c: str) -> str:
    return c if c in _KNOWN else OTHER


_KNOWN = frozenset(LETTERS + EDGE)


class CharModel:
    """Trigram model over LETTERS, OTHER and EDGE, with add-one smoothing of
    trigrams towards bigrams."""

    def __init__(self, counts: dict[str, int]):
        self.counts = counts
        self.pairs: dict[str, int] = defaultdict(int)
        self.ones: dict[str, int] = defaultdict(int)
        for gram, n in counts.items():
            self.pairs[gram[:2]] += n
            self.ones[gram[2]] += n
        self.total = sum(self.ones.values())
        self.size = len(LETTERS) + 2
        self.memo: dict[str, float] = {}

    def cost(self, gram: str) -> float:
        """Minus the logarithm of the last character's probability."""
        known = self.memo.get(gram)
        if known is None:
            one = (self.ones.get(gram[2], 0) + 1) / (self.total + self.size)
            known = self.memo[gram] = -math.log(
                (self.counts.get(gram, 0) + 2 * one) / (self.pairs.get(gram[:2], 0) + 2))
        return known


def grams_of(word: str, n: int, counts: Counter) -> None:
    letters = EDGE * 2 + "".join(map(_letter, word)) + EDGE
    for i in range(len(letters) - 2):
        counts[letters[i:i + 3]] += n


def lattice(token: str, at: int = 0, end: int | None = None) -> list[list[tuple[str, float]]]:
    """For each position the readings (characters, cost); an empty string takes
    the position away. Of equal letters in a row, one or two stay. Look-alikes
    before ``at`` and from ``end`` on may be punctuation."""
    out: list[list[tuple[str, float]]] = []
    for i, c in enumerate(token):
        if c.isalpha():
            ways = [(c, 0.0)]
            if i > 1 and token[i - 1] == c and token[i - 2] == c:
                ways = [("", REMOVE / 4)]  # the third and later ones always go
            elif i > 0 and token[i - 1] == c and i + 1 < len(token) and token[i + 1] == c:
                ways.append(("", REMOVE))  # the second may stay
            elif i > 0 and token[i - 1] == c:
                ways.append(("", DOUBLED))
        elif c in FILLERS:
            ways = [("", REMOVE)]
        else:
            ways = [(x, SUBSTITUTE) for x in LOOKALIKES.get(c, "")] or [(c, 0.0)]
            if i < at or end is not None and i >= end:
                ways.append(("", REMOVE))
        out.append(ways)
    return out


def _unwind(read: tuple | None) -> str:
    """The text of a chain of (chain before, characters, number of links)."""
    out = []
    while read:
        out.append(read[1])
        read = read[0]
    return "".join(reversed(out))


def _first(a: tuple | None, b: tuple | None) -> bool:
    """Whether chain a's text sorts before b's; what they share is not looked at."""
    x, y = [], []
    while a is not b:
        n, m = a[2] if a else 0, b[2] if b else 0
        if n >= m:
            x.append(a[1])
            a = a[0]
        if m >= n:
            y.append(b[1])
            b = b[0]
    return "".join(reversed(x)) < "".join(reversed(y))


def decode(token: str, model: CharModel, borders: bool = False, at: int = 0, end: int | None = None) -> str:
    """Likeliest reading of a token, the first in order of equally likely ones;
    with ``borders`` it may have several words. Readings are chains that share
    what they have in common, so time and memory are linear in the token."""
    states: dict[str, tuple[float, tuple | None]] = {EDGE * 2: (0.0, None)}
    memo = model.memo
    for ways in lattice(token, at, end):
        if len(states) == 1 and len(ways) == 1 and not borders:
            # one path: what it costs is the same for all readings
            ((tail, (cost, read)),) = states.items()
            if chars := ways[0][0]:
                states = {tail[1] + _letter(chars): (cost, (read, chars, read[2] + 1 if read else 1))}
            continue
        after: dict[str, tuple[float, tuple | None]] = {}
        ways = [(chars, chars and _letter(chars), extra) for chars, extra in ways]
        for tail, (cost, read) in states.items():
            links, last = read[2] + 1 if read else 1, tail[1]
            for chars, c, extra in ways:
                if not c:
                    key, total, added = tail, cost + extra, ""
                else:
                    step = memo.get(tail + c)
                    key, total, added = last + c, cost + extra + (model.cost(tail + c) if step is None else step), chars
                known = after.get(key)
                if known is None or total < known[0]:
                    after[key] = (total, (read, added, links) if added else read)
                elif total == known[0] and _first(link := (read, added, links) if added else read, known[1]):
                    after[key] = (total, link)
                if not borders or not c or last == EDGE:
                    continue
                key, added = EDGE + c, EDGE + chars
                total = cost + extra + BREAK + model.cost(tail + EDGE) + model.cost(last + EDGE + c)
                known, link = after.get(key), (read, added, links)
                if known is None or total < known[0] or total == known[0] and _first(link, known[1]):
                    after[key] = (total, link)
        states = after
    best: tuple[float, tuple | None] | None = None
    for tail, (cost, read) in states.items():
        total = cost + model.cost(tail + EDGE)
        if best is None or total < best[0] or total == best[0] and _first(read, best[1]):
            best = (total, read)
    return _unwind(best[1])


def _bare(token: str) -> str:
    """The token without punctuation around it; a look-alike next to a letter
    is left in front, as in ``$tupid``."""
    at, end = _bare_span(token)
    return token[at:end]


def _bare_span(token: str) -> tuple[int, int]:
    end = len(token)
    while end and not token[end - 1].isalnum() and (token[end - 1] not in "@$€" or end < 3):
        end -= 1
    at = 0
    while at < end and not token[at].isalnum() and (
            token[at] not in "@$€(|!" or at + 1 == end or not token[at + 1].isalnum()):
        at += 1
    return at, end


def _full_span(token: str) -> tuple[int, int]:
    """The token without characters around it that can be no letter."""
    at, end = 0, len(token)
    while at < end and not token[at].isalnum() and token[at] not in LOOKALIKES:
        at += 1
    while end > at and not token[end - 1].isalnum() and token[end - 1] not in LOOKALIKES:
        end -= 1
    return at, end


def readings(token: str, model: CharModel | None) -> list[str]:
    """The words that a lower-case token may stand for. Letters alone, none of
    them twice in a row, have one path through the lattice: themselves. Letters
    alone with runs give two words, the likeliest reading and what is written;
    so a run of one letter is that letter stretched, and the run. Symbols at
    the token's borders may be letters, punctuation, or some of both. Parts
    between other characters are words of any length."""
    at, end = _bare_span(token)
    word = token[at:end]
    if model is None:
        return [word] if word else []
    start, stop = _full_span(token)
    full = token[start:stop]
    if word == full and (not word or word.isalpha() and not _DOUBLED.search(word)):
        return [word] if word else []
    out = [decode(word, model)] if word else []
    if word == full and word.isalpha():
        return out if out[0] == word else [*out, word]
    if full != word:
        out += [decode(full, model), decode(full, model, False, at - start, end - start)]
    inner = [i for i, c in enumerate(full) if c.isalnum()]
    if inner and (inner[0] + start, inner[-1] + 1 + start) not in ((at, end), (start, stop)):
        out.append(decode(full, model, False, inner[0], inner[-1] + 1))
    if any(c in FILLERS for c in word):  # words may be put together by them
        out += decode(word, model, borders=True).split()
    if not any(map(str.isalpha, word)):
        out.append(word)
    # what it says as it is written, and between characters that stand for no letter
    out += [w for x in (word, *out) for w in _NO_LETTER.split(x)]
    return [w for w in dict.fromkeys(out) if w]


def words_of(text: str, model: CharModel | None) -> Iterator[str]:
    """The distinct restored words of a text, not in order."""
    tokens = set(text.lower().split())
    for token in tokens:
        yield from readings(token, model)
    yield from spaced_words(text, tokens, model)


def spaced_words(text: str, tokens: set[str], model: CharModel | None) -> Iterator[str]:
    """Words spelt with spaces: runs of three and more single characters, with
    punctuation around them, read as one word and as several."""
    if model is not None and any(len(t) == 1 for t in tokens):
        for run in _SPACED.finditer(text.lower()):
            joined = "".join(run[1].split())
            if any(c.isalpha() or c in LOOKALIKES for c in joined):
                yield decode(joined, model)
                yield from decode(joined, model, borders=True).split()


def features(word: str) -> list[str]:
    """A word and its beginnings; beginnings carry a mark."""
    return [word, *(word[:n] + "~" for n in STEMS if len(word) >= n)]


# --- the corpus' character model -------------------------------------------

def char_model(docs: DataFrame, text_col: str = "text") -> CharModel:
    """Trigrams of all words of all documents. Words are counted with map-side
    aggregation, then the trigrams of the distinct ones; there are at most
    len(LETTERS) + 2 to the third power of them, so the sums fit the driver
    whatever the input."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Counter()
        for batch in batches:
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                grams_of(word, n, grams)
        yield pa.RecordBatch.from_arrays([pa.array(list(grams), pa.string()), pa.array(list(grams.values()), pa.int64())],
                                         ["gram", "n"])

    words = docs.select(F.explode(F.split(F.lower(whole_text(text_col)), r"(?U)\s+")).alias("word"))
    words = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    words = words.select(F.btrim("word", F.lit(".,;:!?\"'()[]")).alias("word"), "n").filter(F.col("word").rlike(r"^\p{L}+$"))
    rows = words.mapInArrow(count, "gram string, n long")
    return CharModel({r.gram: r.n for r in rows.groupBy("gram").agg(F.sum("n").alias("n")).collect()})


# --- fitting ---------------------------------------------------------------

def training_rows(docs: DataFrame, labels: DataFrame, held_out: Column, max_rows: int,
                  id_col: str, text_col: str) -> DataFrame:
    """(toxic, text) of at most ``max_rows`` labelled rows that are not held
    out: those with the smallest digest of their id. Contradicting labels of
    an id leave it out."""
    ids = (labels.select(F.col("doc_id").alias("doc_id"), F.col("toxic").alias("toxic"))
           .filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out)
           .groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other"))
           .filter("toxic = other").select("doc_id", "toxic"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    texts = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    return texts.join(F.broadcast(ids), F.col("id") == F.col("doc_id")).select("toxic", "text")


def _digest(text: str) -> int:
    """Smallest digest of the text's three-word shingles: near copies mostly
    share it, other texts hardly ever."""
    words = text.lower().split()
    grams = map(" ".join, zip(words, words[1:], words[2:])) if len(words) > 2 else [" ".join(words)]
    return min(xxhash.xxh64_intdigest(g) for g in grams) >> 1


def _likelihood_ratio(a: Column, n: Column, toxic: int, total: int) -> Column:
    """G-squared of a feature in n of all texts, a of them toxic."""
    def term(x: Column, expected: Column) -> Column:
        return F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)
    share = F.lit(toxic / total)
    rest, b = total - n, n - a
    return 2 * (term(a, n * share) + term(b, n * (1 - share)) + term(toxic - a, rest * share)
                + term(total - toxic - b, rest * (1 - share)))


def _lexicon(train: DataFrame, model: CharModel) -> dict[str, float]:
    """Features that say toxic, with their log odds. Near copies of a text
    would make any of its words say so: texts with the same smallest digest
    over their three-word shingles count once."""
    shared = train.sparkSession.sparkContext.broadcast(model)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            words = [list({f for w in words_of(t, shared.value) for f in features(w)}) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int32()), pa.array(map(_digest, texts), pa.int64()),
                 pa.array(words, pa.list_(pa.string()))], ["toxic", "digest", "words"])

    rows = train.mapInArrow(expand, "toxic int, digest long, words array<string>")
    once = rows.groupBy("digest").agg(
        F.min_by(F.struct("toxic", "words"), F.col("toxic")).alias("x")).select("x.toxic", "x.words")
    once = once.cache()  # a bounded sample
    try:
        toxic, total = once.agg(F.sum("toxic"), F.count(F.lit(1))).first()
        if not toxic or toxic == total:
            return {}
        found = (once.select("toxic", F.explode("words").alias("f")).groupBy("f")
                 .agg(F.sum("toxic").alias("a"), F.count(F.lit(1)).alias("n"))
                 .filter(F.col("a") * total > F.col("n") * toxic).filter(F.col("a") >= MIN_TOXIC)
                 .filter(_likelihood_ratio(F.col("a"), F.col("n"), toxic, total) >= MIN_RATIO).collect())
    finally:
        once.unpersist()
    clean = total - toxic
    out = {}
    for r in found:  # features of a bounded sample
        out[r.f] = math.log((r.a + 0.5) / (toxic + 1)) - math.log((r.n - r.a + 0.5) / (clean + 1))
    return out


class Sieve:
    """Tells which tokens need no decoding, as no reading of them can have a
    feature of the lexicon.

    Readings take letters out of runs, fillers and symbols at the borders, and
    put look-alikes' letters in. So a feature that a reading of letters alone
    begins with begins, with its runs cut to one letter, the token with its
    runs cut. For other tokens, letters that share a look-alike are one class:
    the feature's classes must stand in the token's, fillers left out and runs
    cut in both. Where they do, the feature's own letters, each with its
    look-alikes, must stand there too; very long tokens are spared that test.
    """

    def __init__(self, lexicon: Iterable[str]):
        self.words = {_cut_runs(f) for f in lexicon if not f.endswith("~")}
        self.stems = {_cut_runs(f[:-1]) for f in lexicon if f.endswith("~")}
        self.sizes = sorted({len(s) for s in self.stems})
        patterns: dict[str, list[str]] = defaultdict(list)
        for f in {f.removesuffix("~") for f in lexicon}:
            patterns[_classes(f)].append(_spellings(f))
        self.always = "" in patterns
        self.automaton = ahocorasick.Automaton()
        for c, found in patterns.items():
            if c:
                self.automaton.add_word(c, re.compile("|".join(sorted(found))).search)
        self.automaton.make_automaton()

    def passes(self, token: str) -> bool:
        """Whether a reading of the token may have a feature."""
        core = token.strip(_PUNCTUATION)
        if core.isalpha():
            cut = _RUN.sub(r"\1", core)
            return cut in self.words or any(cut[:n] in self.stems for n in self.sizes)
        at, end = _bare_span(token)
        start, stop = _full_span(token)
        # of several kinds of symbols at a border any may be taken out: no short way there
        if self.always or len(_classes(token[start:at])) > 1 or len(_classes(token[end:stop])) > 1:
            return True
        if not len(self.automaton):
            return False
        if len(token) > MEMO_CHARS:
            return next(self.automaton.iter(_classes(token)), None) is not None
        return any(search(token) for _, search in self.automaton.iter(_classes(token)))


def _spellings(feature: str) -> str:
    """A pattern that every spelling of the feature matches: of each letter
    itself and its look-alikes, any number, with fillers after each."""
    fillers = f"[{re.escape(FILLERS)}]*"
    return "".join(f"(?:[{''.join(map(re.escape, _SPELT.get(c, c)))}]{fillers})+" for c in _cut_runs(feature))


#: What may be read as a letter: itself and its look-alikes.
_SPELT = {c: c + "".join(sign for sign, letters in LOOKALIKES.items() if c in letters) for c in LETTERS}
#: Around a token these are neither letters nor look-alikes.
_PUNCTUATION = ".,;:?\"')]}[{-_/"


def _look_alike_classes() -> dict[int, str | None]:
    """For each letter and look-alike the first letter of its class; fillers have none."""
    group: dict[str, str] = {}

    def root(c: str) -> str:
        while group.get(c, c) != c:
            c = group[c]
        return c

    for sign, letters in LOOKALIKES.items():
        for c in letters:
            a, b = sorted((root(c), root(letters[0])))
            group[b] = a
        group[sign] = root(letters[0])
    out: dict[int, str | None] = {ord(c): root(c) for c in group}
    out.update({ord(c): None for c in FILLERS})
    return out


_CLASSES = _look_alike_classes()


def _cut_runs(word: str) -> str:
    return _RUN.sub(r"\1", word)


def _classes(word: str) -> str:
    return _cut_runs(word.translate(_CLASSES))


class Scorer:
    """Character model, lexicon and the weights of a text's evidence."""

    def __init__(self, model: CharModel, lexicon: dict[str, float], weights: tuple[float, ...]):
        self.model, self.lexicon, self.weights = model, lexicon, weights
        self.memo: dict[str, float] = {}
        self.sieve: Sieve | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"memo": {}, "sieve": None}

    def _best(self, words: Iterable[str]) -> float:
        get = self.lexicon.get
        return max((get(f, 0.0) for w in words for f in features(w)), default=0.0)

    def evidence(self, text: str) -> tuple[float, float]:
        """The strongest word's log odds, and the logarithm of the sum of all."""
        memo, found = self.memo, []
        if self.sieve is None:  # built where it is used
            self.sieve = Sieve(self.lexicon)
        passes = self.sieve.passes
        tokens = set(text.lower().split())
        for token in tokens:
            best = memo.get(token)
            if best is None:
                best = self._best(readings(token, self.model)) if passes(token) else 0.0
                if len(token) <= MEMO_CHARS:
                    if len(memo) >= MEMO:
                        memo.clear()
                    memo[token] = best
            if best:
                found.append(best)
        found += filter(None, (self._best([w]) for w in spaced_words(text, tokens, self.model)))
        return max(found, default=0.0), math.log1p(math.fsum(found))

    def __call__(self, text: str) -> float:
        bias, strongest, together = self.weights
        x, y = self.evidence(text)
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, bias + strongest * x + together * y))))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 100) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the first column is the bias."""
    w = np.zeros(x.shape[1])
    hold = np.diag([1e-6, *[ridge] * (x.shape[1] - 1)])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * np.maximum(p * (1 - p), 1e-9)) @ x + hold, x.T @ (y - p) - hold @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, held_out: Column, max_train_rows: int = MAX_TRAIN_ROWS,
        id_col: str = "doc_id", text_col: str = "text") -> Scorer:
    """Fits on labelled documents. ``held_out`` is a condition on ``doc_id``
    that keeps labels out. Without labels of both kinds all texts get 0.5 less
    a little, so none is called toxic."""
    model = char_model(docs, text_col)
    small_batches(docs.sparkSession)
    train = training_rows(docs, labels, held_out, max_train_rows, id_col, text_col).cache()  # bounded
    try:
        lexicon = _lexicon(train, model)
        scorer = Scorer(model, lexicon, (-1.0, 0.0, 0.0))
        if not lexicon:
            return scorer
        shared = docs.sparkSession.sparkContext.broadcast(scorer)

        def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [shared.value.evidence(t) for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).cast(pa.float64()), pa.array([x for x, _ in found], pa.float64()),
                     pa.array([y for _, y in found], pa.float64())], ["toxic", "x", "y"])

        rows = np.array([tuple(r) for r in train.mapInArrow(evidence, "toxic double, x double, y double").collect()])
    finally:
        train.unpersist()
    w = _logistic(np.column_stack([np.ones(len(rows)), rows[:, 1:]]), rows[:, 0])
    return Scorer(model, lexicon, tuple(map(float, w)))


def score_column(docs: DataFrame, scorer: Scorer, text: Column) -> Column:
    """Score from 0 to 1 of a text column; NULL counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([shared.value(t.as_py() or "") for t in texts], pa.float64())

    return F.arrow_udf(run, T.DoubleType())(whole_text(text))


def held_out_by_id(doc_id: Column, parts: int = 3, part: int = 1) -> Column:
    """Rows whose labels are held out; a row without an id is not one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame, max_train_rows: int = MAX_TRAIN_ROWS,
                    threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (1 from
    ``threshold`` on).

    NULL and empty texts are scored as texts without evidence. Repeated rows
    and NULL ids each get their row; NULL labels are left out; other columns
    are not read; an empty table gives no rows.
    """
    scorer = fit(docs, labels, held_out_by_id(F.col("doc_id")), max_train_rows, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out_by_id(F.col(id_col)).alias("held_out"),
                       score_column(docs, scorer, F.col(text_col)).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, max_train_rows: int = MAX_TRAIN_ROWS,
               threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows scored ``threshold`` or more; all columns as
    they were."""
    scorer = fit(docs, labels, held_out_by_id(F.col("doc_id")), max_train_rows, id_col, text_col)
    return docs.filter(score_column(docs, scorer, F.col(text_col)) < threshold)
