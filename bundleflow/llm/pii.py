"""Personal data in texts: patterns propose spans, checksums confirm them, and
words nearby adjust their score. DataFrame functions only.

Kinds are the base ones (email, ip, card, phone) and two that the method adds:
accounts (iban), and keys and passwords (secret). Base spans stay whatever
their score; added ones need a certain form or a context word.

Spans are (kind, start, end, value, score); start and end count code points
from 0, end exclusive. Matches of a kind are leftmost and do not overlap; a
match that fails its check is dropped and not tried again in part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bundleflow.llm.common import fresh, whole_text

#: Characters before and after a span in which context words count, up to the
#: next match of the same kind.
CONTEXT = 40
#: Kinds that are kept by score; the others are kept whenever their check holds.
THRESHOLD = {"iban": 0.6, "secret": 0.6}
KINDS = ("email", "ip", "card", "phone", "iban", "secret")

#: Length of an account number by country (IBAN registry).
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
_COUNTRIES = "|".join(IBAN_LENGTHS.values()).replace(" ", "|")


def _other_letters() -> str:
    """Pairs of letters that are no country of the registry."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    known = set(_COUNTRIES.split("|"))
    return "|".join(f"{a}[{''.join(b for b in letters if a + b not in known)}]" for a in letters)


def iban_pattern(front: str = r"(?<![A-Za-z0-9_])", back: str = r"(?![A-Za-z0-9_])") -> str:
    """Accounts of the registry's countries end at their length. For other
    letters the groups go on as long as they can, but not into a group that
    starts as an account of the registry does. ``front`` and ``back`` are the
    borders, for engines that write them otherwise."""
    known = "|".join(
        f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "")
        for n, c in IBAN_LENGTHS.items())
    none = _other_letters()
    group = f"(?:[0-9][A-Z0-9]{{3}}|[A-Z][0-9][A-Z0-9]{{2}}|(?:{none})[A-Z0-9]{{2}}|[A-Z]{{3}}[A-Z0-9]|[A-Z]{{2}}[0-9][A-Z])"
    other = f"(?:{none})[0-9]{{2}}(?: ?{group}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?"
    return f"{front}(?:{known}|{other}){back}"


# The patterns below match what the plain ones in the comments do. Possessive
# quantifiers and the border in front keep the work linear in the text: a run
# of letters without an @ is looked at once, not once per letter. \G lets a
# match start where the last one ended.
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+ of 13 to 19 digits: those runs are as long as they
    # can be, so a run of another length is no match in part either
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # two letters, two digits, then groups of four and a shorter last one, as long as the country's are
    "iban": iban_pattern(),
    # [A-Za-z0-9_/+-]{16,}
    "secret": r"(?<![A-Za-z0-9_/+-])[A-Za-z0-9_/+-]{16,}+",
}
#: Cheap conditions without which a pattern cannot match.
NEEDS = {"email": r"@[A-Za-z0-9-]+\.", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
         "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]", "iban": r"[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}", "secret": r"(?<![A-Za-z0-9_/+-])[A-Za-z0-9_/+-]{16}"}
# Score without context, and words that raise it.
BASE_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.5, "iban": 0.7, "secret": 0.7}
CONTEXT_SCORE = 0.2
#: Score of an account whose first letters are no country of the registry, and
#: of a key of no known format: context decides.
DOUBTFUL_SCORE = 0.5
#: Values of these kinds that match are not doubtful. the
#: registry's countries; public formats of access keys and tokens.
CERTAIN = {"iban": f"^(?:{_COUNTRIES})",
           "secret": r"^(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|glpat-[A-Za-z0-9_-]{20}|xox[abp]-[A-Za-z0-9-]+|sk_live_[A-Za-z0-9]+)$"}
#: Different characters that a key of no known format has at least, a letter and a digit among them.
KEY_CHARS = 8
CONTEXT_WORDS = {
    "email": r"e-?mail|contact|write to|courriel|correo",
    "ip": r"(?:^|[^a-z0-9])ip(?:[^a-z0-9]|$)|address|server|host|login",
    "card": r"card|visa|master|amex|credit|payment|karte|carte|tarjeta",
    "phone": r"phone|call|tel(?:[^a-z0-9]|$)|mobile|fax|telefon|t[eé]l[eé]phone",
    "iban": r"iban|account|bank|konto|compte|cuenta|bic(?:[^a-z0-9]|$)",
    "secret": r"password|passwd|pwd|passphrase|secret|token|credential|(?:api|access|private)[ _-]?key|passwort|contrase",
}
#: Spans of a text in one block of the running sum of their places.
BLOCK = 256


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """The card checksum: from the right every second digit doubled, its
    digits added; the sum is a multiple of ten."""
    def add(total: Column, digit: Column, i: Column) -> Column:
        d = digit.cast("int")
        twice = F.when(d < 5, d * 2).otherwise(d * 2 - 9)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    digits = F.filter(F.split(F.reverse(_digits(value)), ""), lambda x: x != "")
    summed = F.aggregate(F.transform(digits, lambda x, i: F.struct(x.alias("d"), i.alias("i"))), F.lit(0),
                         lambda total, x: add(total, x["d"], x["i"]))
    return summed % 10 == 0


def mod97(value: Column) -> Column:
    """The account checksum: the first four characters behind the rest, letters
    as 10 to 35, and the number leaves 1 when divided by 97."""
    bare = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.filter(F.split(F.concat(F.substring(bare, 5, 64), F.substring(bare, 1, 4)), ""), lambda x: x != "")

    def add(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code < 65, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(turned, F.lit(0), add) == 1


def holds(kind: str, value: Column) -> Column:
    """The check of a kind's matches."""
    digits = F.length(_digits(value))
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        # no part over 255, leading zeros allowed; no number that a cast could overflow
        return F.forall(F.split(value, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3) & F.forall(
            F.split(value, r"\."), lambda p: F.coalesce(F.substring(F.regexp_replace(p, "^0+(?=.)", ""), 1, 4).cast("int"),
                                                        F.lit(0)) <= 255)
    if kind == "card":
        return digits.between(13, 19) & luhn(value)
    if kind == "phone":
        return digits.between(9, 15)
    if kind == "secret":
        chars = F.array_distinct(F.filter(F.split(value, ""), lambda x: x != ""))
        mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.size(chars) >= KEY_CHARS)
        return value.rlike(CERTAIN[kind]) | mixed
    return F.length(F.replace(value, F.lit(" "), F.lit(""))).between(15, 34) & mod97(value)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), lambda v: body(v)), 1)


def _steps(text: Column, pattern: str) -> Column:
    """Structs (gap, len, value, before, after) of the matches: characters
    since the last match and of this one, its text, and what stands around it."""
    def pair(pieces: Column) -> Column:
        ahead = F.zip_with(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), pieces,
                           lambda m, p: F.struct(m.alias("value"), p.alias("piece")))
        both = F.zip_with(ahead, F.slice(pieces, 2, F.size(pieces)), lambda x, after: F.struct(
            F.length(x["piece"]).alias("gap"), F.length(x["value"]).alias("len"), x["value"].alias("value"),
            F.right(x["piece"], F.lit(CONTEXT)).alias("before"), F.left(after, F.lit(CONTEXT)).alias("after")))
        return F.filter(both, lambda x: x["value"].isNotNull())  # the last piece has no match behind it

    return _let(F.split(text, pattern, -1), pair)


PLACE = "struct<start:int,end:int,value:string,before:string,after:string>"


def _places(steps: Column) -> Column:
    """PLACE structs of the steps. A running sum appends to its list, which
    copies it; blocks keep the lists short, so a text with very many matches
    does not cost their square."""
    def walk(items: Column, start: Column) -> Column:
        """Places of items, the text before them being ``start`` long."""
        first = F.struct(start.alias("at"), F.array().cast(f"array<{PLACE}>").alias("out"))
        return F.aggregate(items, first, lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["len"]).alias("at"),
            F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + x["gap"]).alias("start"), (acc["at"] + x["gap"] + x["len"]).alias("end"),
                x["value"].alias("value"), x["before"].alias("before"), x["after"].alias("after")))).alias("out")),
            lambda acc: acc["out"])

    def blocks(items: Column) -> Column:
        last = F.floor((F.greatest(F.size(items), F.lit(1)) - 1) / BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: _let(F.slice(items, b * BLOCK + 1, F.lit(BLOCK)), lambda part: F.struct(
            part.alias("items"), F.aggregate(part, F.lit(0), lambda a, x: a + x["gap"] + x["len"]).alias("size"))))

    def together(sized: Column) -> Column:
        starts = F.aggregate(sized, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
                             lambda acc, b: F.struct((acc["at"] + b["size"]).alias("at"),
                                                     F.concat(acc["out"], F.array(acc["at"])).alias("out")),
                             lambda acc: acc["out"])
        return F.flatten(F.zip_with(sized, starts, lambda b, s: walk(b["items"], s)))

    return _let(steps, lambda items: _let(blocks(items), together))


SPAN = "struct<kind:string,start:int,end:int,value:string,score:double>"


def kind_spans(kind: str, text: Column) -> Column:
    """Spans of one kind with their scores, checked."""
    none = F.array().cast(f"array<{SPAN}>")
    found = _places(_steps(text, PATTERNS[kind]))

    def scored(s: Column) -> Column:
        around = F.lower(F.concat_ws(" ", s["before"], s["after"]))
        hint = F.when(around.rlike(CONTEXT_WORDS[kind]), F.lit(CONTEXT_SCORE)).otherwise(F.lit(0.0))
        base = F.lit(BASE_SCORE[kind])
        if kind in CERTAIN:
            base = F.when(s["value"].rlike(CERTAIN[kind]), base).otherwise(DOUBTFUL_SCORE)
        return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                        s["value"].alias("value"), (base + hint).alias("score"))

    checked = F.transform(F.filter(found, lambda s: holds(kind, s["value"])), scored)
    if kind in THRESHOLD:
        checked = F.filter(checked, lambda s: s["score"] >= THRESHOLD[kind])
    return F.when(text.rlike(NEEDS[kind]), checked).otherwise(none)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id and an array of spans per kind.

    NULL texts count as empty and have no spans. Repeated rows and NULL ids
    each get their row; other columns are not read; an empty table gives no
    rows. No row is shuffled.
    """
    text = F.col("t")
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("t"))
    return rows.select("doc_id", *(kind_spans(k, text).alias(k) for k in KINDS))


def mask(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with what every confirmed span holds replaced by its kind in
    brackets, longer values first; NULL texts stay NULL."""
    (found,) = fresh(docs, "spans")
    text = whole_text(text_col)
    spans = F.concat(*(kind_spans(k, text) for k in KINDS))
    values = F.array_distinct(F.transform(spans, lambda s: F.struct(
        (-F.length(s["value"])).alias("n"), s["value"].alias("v"), s["kind"].alias("k"))))
    masked = F.aggregate(F.array_sort(F.col(found)), text, lambda t, x: F.replace(
        t, x["v"], F.concat(F.lit("["), x["k"], F.lit("]"))))
    out = docs.withColumn(found, values)
    return out.withColumn(text_col, F.when(F.col(text_col).isNotNull(), masked)).select(*docs.columns)


def span_list(kinds: tuple[str, ...]) -> Column:
    """kind:start:end of the kinds' spans, by kind, then start, comma-joined."""
    return F.array_join(F.transform(F.concat(*(F.col(k) for k in kinds)),
                                    lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def score_list(kinds: tuple[str, ...]) -> Column:
    """Scores of the spans in hundredths, in the order of ``span_list``."""
    return F.array_join(F.transform(F.concat(*(F.col(k) for k in kinds)),
                                    lambda s: F.round(s["score"] * 100).cast("int").cast("string")), ",")
