"""DuckDB SQL for the queries whose result SQL can express."""

from __future__ import annotations

from bundleflow.llm import pii

_WORD = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

EXACT_DEDUP = f"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}') AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256
FROM t JOIN g USING (norm)"""


def _bisection(name: str, holds: str) -> str:
    """A CTE with the bracket after each step; ``holds`` speaks of ``mid``."""
    return f"""{name}(step, lo, hi) AS (
  SELECT 0, 0e0, 1e0
  UNION ALL
  SELECT step + 1, CASE WHEN ok THEN mid ELSE lo END, CASE WHEN ok THEN hi ELSE mid END
  FROM (SELECT *, {holds} AS ok FROM (SELECT step, lo, hi, (lo + hi) / 2 AS mid, ps FROM {name}, p WHERE step < 50)))"""


def mixing(target_entropy: float, max_repetition: float, seed: str) -> str:
    entropy = ("(ln(list_sum([pow(x, {e}) for x in ps])) - list_sum([pow(x, {e}) * {e} * ln(x) for x in ps])"
               " / list_sum([pow(x, {e}) for x in ps]))")
    natural = entropy.format(e="1e0")
    reach = f"{entropy.format(e='mid')} >= {natural} + {target_entropy} * (ln(len(ps)) - {natural})"
    over = f"pow(ps[len(ps)] / ps[1], 1 - mid) > {max_repetition}"

    def key(block: str) -> str:
        return f"md5(concat_ws('|', '{seed}', {block}, coalesce(CAST(doc_id AS VARCHAR), 'null')))"

    return f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, coalesce('=' || source, 'null') AS source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS n_tokens FROM documents),
tot AS MATERIALIZED (SELECT source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM d GROUP BY source),
p AS MATERIALIZED (SELECT [x / list_sum(ts) for x in ts] AS ps, ts[len(ts)] AS top FROM (
    SELECT list(CAST(tokens AS DOUBLE) ORDER BY tokens) AS ts FROM tot WHERE tokens > 0)),
{_bisection('flat', reach)},
{_bisection('least', over)},
e AS MATERIALIZED (SELECT top, round(CASE WHEN len(ps) < 2 THEN 1e0 ELSE greatest(
    (SELECT lo FROM flat WHERE step = 50),
    CASE WHEN ps[len(ps)] / ps[1] <= {max_repetition} THEN 0e0 ELSE (SELECT hi FROM least WHERE step = 50) END) END, 6) AS exponent
  FROM p),
b AS (SELECT source, tokens, exponent, CASE WHEN tokens > 0 THEN greatest(tokens,
    CAST(floor(top * pow(tokens / top, exponent) + 0.5) AS BIGINT)) ELSE 0 END AS budget FROM tot, e),
plan AS MATERIALIZED (SELECT source, exponent, budget / nullif(sum(budget) OVER (), 0) AS weight,
    CASE WHEN tokens > 0 THEN budget // tokens ELSE 1 END AS blocks,
    CASE WHEN tokens > 0 THEN budget - (budget // tokens) * tokens ELSE 0 END AS rest FROM b),
lastblock AS (SELECT doc_id, source, n_tokens, blocks AS block, k,
    coalesce(sum(n_tokens) OVER (PARTITION BY source ORDER BY k RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)
    - sum(n_tokens) OVER (PARTITION BY source, k) AS before, rest
  FROM (SELECT *, {key('blocks')} AS k FROM d JOIN plan USING (source) WHERE rest > 0)),
rows_ AS (SELECT doc_id, source, n_tokens, block, {key('block')} AS block_key FROM (
    SELECT doc_id, source, n_tokens, unnest(range(0, blocks)) AS block FROM d JOIN plan USING (source))
  UNION ALL SELECT doc_id, source, n_tokens, block, k FROM lastblock WHERE before < rest)
SELECT doc_id, source, n_tokens, CAST(block AS BIGINT) AS block, block_key, exponent, round(weight, 9) AS weight
FROM rows_ JOIN plan USING (source)"""


_KINDS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
           "len([x for x in string_split(v, '.') if len(ltrim(x, '0')) > 3 OR TRY_CAST(x AS HUGEINT) > 255]) = 0"),
    "card": (r"[0-9]([\x20-]?[0-9])+", "len(digits) BETWEEN 13 AND 19 AND list_sum([CASE WHEN i % 2 = 0 THEN CAST(digits[len(digits) - i] AS INT)"
             " WHEN CAST(digits[len(digits) - i] AS INT) < 5 THEN 2 * CAST(digits[len(digits) - i] AS INT)"
             " ELSE 2 * CAST(digits[len(digits) - i] AS INT) - 9 END for i in range(0, len(digits))]) % 10 = 0"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "len(digits) BETWEEN 9 AND 15"),
    "iban": (pii.iban_pattern(r"\b", r"\b"),
             "len(bare) BETWEEN 15 AND 34 AND list_reduce(list_concat([CAST(0 AS BIGINT)], "
             "[CAST(ascii(x) AS BIGINT) for x in string_split(concat(bare[5:], bare[1:4]), '')]), "
             "lambda a, c: CASE WHEN c < 65 THEN (a * 10 + c - 48) % 97 ELSE (a * 100 + c - 55) % 97 END) = 1"),
    "secret": (r"[A-Za-z0-9_/+-]{16,}", f"regexp_matches(v, '{pii.CERTAIN['secret']}') OR (regexp_matches(v, '[0-9]')"
               " AND regexp_matches(v, '[A-Za-z]') AND len(list_distinct(string_split(v, ''))) >= 8)"),
}
# score in hundredths without context, and the least that is kept
_SCORES = {"email": ("90", 0), "ip": ("60", 0), "card": ("70", 0), "phone": ("50", 0),
           "iban": (f"CASE WHEN regexp_matches(v, '{pii.CERTAIN['iban']}') THEN 70 ELSE 50 END", 60),
           "secret": (f"CASE WHEN regexp_matches(v, '{pii.CERTAIN['secret']}') THEN 70 ELSE 50 END", 60)}


def personal_data() -> str:
    ctes = []
    for no, (kind, (pattern, valid)) in enumerate(_KINDS.items()):
        base, least = _SCORES[kind]
        # runs of digits too short or too long for a card do not end the context
        proposed = "WHERE len(regexp_replace(v, '[^0-9]', '', 'g')) BETWEEN 13 AND 19" if kind == "card" else ""
        ctes.append(f"""{kind}_m AS (SELECT doc_id, n, t, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS g FROM t),
{kind}_p AS (SELECT doc_id, n, t, v, pos, pos + len(v) AS fin, regexp_replace(v, '[^0-9]', '', 'g') AS digits, replace(v, ' ', '') AS bare FROM (
  SELECT doc_id, n, t, m[i] AS v, CAST(coalesce(list_sum([len(x) for x in g[1:i]]), 0) + coalesce(list_sum([len(x) for x in m[1:i - 1]]), 0) AS BIGINT) AS pos
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM {kind}_m)) {proposed}),
{kind}_w AS (SELECT *, coalesce(lag(fin) OVER w, 0) AS since, coalesce(lead(pos) OVER w, len(t)) AS until FROM {kind}_p
  WINDOW w AS (PARTITION BY n ORDER BY pos)),
{kind}_s AS (SELECT *, {base} + CASE WHEN regexp_matches(lower(concat(right(substr(t, since + 1, pos - since), 40), ' ',
    left(substr(t, fin + 1, until - fin), 40))), '{pii.CONTEXT_WORDS[kind]}') THEN 20 ELSE 0 END AS score FROM {kind}_w),
{kind}_v AS (SELECT doc_id, n, {no} AS ord, '{kind}' AS kind, pos, fin, score FROM {kind}_s WHERE ({valid}) AND score >= {least})""")
    union = " UNION ALL ".join(f"SELECT * FROM {k}_v" for k in _KINDS)
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in _KINDS)
    text = "concat_ws(':', kind, CAST(pos AS BIGINT), CAST(fin AS BIGINT))"
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS n FROM documents),
{', '.join(ctes)},
f AS (SELECT n, {counts}, string_agg({text}, ',' ORDER BY ord, pos) AS spans,
    string_agg({text}, ',' ORDER BY ord, pos) FILTER (WHERE ord < 4) AS base,
    string_agg(CAST(score AS VARCHAR), ',' ORDER BY ord, pos) AS scores FROM ({union}) GROUP BY n)
SELECT doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in _KINDS)}, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(scores, '') AS scores FROM t LEFT JOIN f USING (n)"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

RANKED_SEARCH = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_TERM}') AS terms FROM documents),
i AS MATERIALIZED (SELECT row_number() OVER () AS item, item_id,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_TERM}') AS terms FROM benchmark),
s AS (SELECT CAST(count(*) FILTER (WHERE len(terms) > 0) AS BIGINT) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d),
q AS MATERIALIZED (SELECT item, term, CAST(count(*) AS BIGINT) AS repeats FROM (SELECT item, unnest(terms) AS term FROM i) GROUP BY ALL),
tf AS MATERIALIZED (SELECT row, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT row, unnest(terms) AS term FROM d)
    WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM tf, s GROUP BY term, n_docs),
m AS (SELECT row, doc_id, 100 - 25 + ((25 * CAST(len(terms) AS BIGINT) * n_docs) // n_terms) AS m FROM d, s WHERE len(terms) > 0),
v AS (SELECT row, term, w * ((1000000000 * tf) // (1000 * tf + 12 * m)) AS value FROM tf JOIN w USING (term) JOIN m USING (row)),
r AS (SELECT item, row, CAST(sum(repeats * value) AS BIGINT) AS score FROM q JOIN v USING (term) GROUP BY ALL HAVING sum(repeats * value) > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM r JOIN i USING (item) JOIN (SELECT row, doc_id FROM d) USING (row)) WHERE rank <= 20"""
