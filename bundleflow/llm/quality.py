"""Quality classifier: a sparse ensemble of rules.

Statistics of the whole text are Spark columns. A random forest over them
gives the candidates: every path from a root is a conjunction of comparisons.
A lasso logistic regression weighs the rules, most of them with zero, and the
rest are compiled into one Spark column expression.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bundleflow.llm.common import materialise, whole_text

THRESHOLD = 0.7
TREES, DEPTH, LASSO, SEED = 20, 3, 2e-3, 7
#: A condition of a rule: statistic, whether it must be above, and the border.
Condition = tuple[str, bool, float]
Rule = frozenset[Condition]

_BLANK = r"\x20\x09-\x0D"


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a text, all zero for an empty one. Rates are per word or
    per character, so they do not depend on how long the text is."""
    def count(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)).cast("double")

    chars = F.length(text).cast("double")
    n_words = count(rf"[^{_BLANK}]+")

    def per(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    return {
        "chars": chars,
        "words": n_words,
        "word_chars": per(chars, n_words),
        "upper_words": per(count(r"(?<!\p{L})\p{Lu}{2,}(?!\p{Ll})"), n_words),
        "symbol_runs": per(count(r"[#$%&*!|~^=<>@+_\\]{2,}"), n_words),
        "bars": per(count(r"\|"), n_words),
        "exclaims": per(count(r"!+"), n_words),
        "sentences": per(count(rf"[.!?](?=[{_BLANK}]|$)"), n_words),
        "commas": per(count(r"[,;:]"), n_words),
        "numbers": per(count(r"[0-9]+"), n_words),
        "lines": per(count(r"\n+"), n_words),
        "links": per(count(r"https?://"), n_words),
        "long_words": per(count(rf"[^{_BLANK}]{{20,}}"), n_words),
        "twice": per(count(rf"(?<![^{_BLANK}])([^{_BLANK}]++)[{_BLANK}]++\1(?![^{_BLANK}])"), n_words),
        "distinct": per(F.size(F.array_distinct(F.split(text, rf"[{_BLANK}]+"))).cast("double"), n_words),
    }


STATISTICS = ("chars words word_chars upper_words symbol_runs bars exclaims sentences commas numbers lines links "
              "long_words twice distinct").split()


def tree_rules(description: str, names: list[str]) -> set[Rule]:
    """All paths of the trees in a model's ``toDebugString``, inner nodes too,
    as sets of conditions; of several borders of a statistic the tightest."""
    rules: set[Rule] = set()
    path: list[tuple[int, Condition]] = []
    for line in description.splitlines():
        m = re.match(r"(\s*)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if not m:
            if re.match(r"\s*Tree ", line):
                path = []
            continue
        depth = len(m[1])
        path = [x for x in path if x[0] < depth] + [(depth, (names[int(m[2])], m[3] == ">", float(m[4])))]
        tight: dict[tuple[str, bool], float] = {}
        for _, (name, above, border) in path:
            pick = max if above else min
            tight[name, above] = pick(tight.get((name, above), border), border)
        rules.add(frozenset((n, a, b) for (n, a), b in tight.items()))
    return rules


def rule_column(rule: Rule) -> Column:
    """1 where all conditions hold, else 0."""
    parts = [(F.col(n) > F.lit(b)) if above else (F.col(n) <= F.lit(b)) for n, above, b in sorted(rule)]
    return reduce(Column.__and__, parts).cast("double")


class RuleEnsemble:
    """Weighted rules over the statistics."""

    def __init__(self, bias: float, weights: dict[Rule, float]):
        self.bias, self.weights = bias, weights

    def column(self) -> Column:
        """The score as an expression over the statistics' columns."""
        ordered = sorted(self.weights.items(), key=lambda x: (sorted(x[0]), x[1]))
        total = reduce(Column.__add__, (rule_column(r) * F.lit(w) for r, w in ordered), F.lit(self.bias))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(rows: DataFrame, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO) -> RuleEnsemble:
    """Fits on rows of STATISTICS and ``label`` (0.0 or 1.0), all of them, on
    the executors. Rows of one label only give that label's share as score,
    none at all 0.5."""
    counts = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        return RuleEnsemble({0.0: -4.0, 1.0: 4.0}.get(next(iter(counts), None), 0.0), {})
    data = VectorAssembler(inputCols=STATISTICS, outputCol="x").transform(rows).select("label", "x")
    forest = RandomForestClassifier(featuresCol="x", numTrees=trees, maxDepth=depth, maxBins=64, seed=SEED,
                                    featureSubsetStrategy="0.5").fit(data)
    rules = sorted(tree_rules(forest.toDebugString, STATISTICS), key=lambda r: sorted(r))
    if not rules:
        return RuleEnsemble(0.0, {})
    columns = [rule_column(r).alias(f"r{i}") for i, r in enumerate(rules)]
    data = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="x").transform(
        rows.select("label", *columns)).select("label", "x")
    lasso_fit = LogisticRegression(featuresCol="x", elasticNetParam=1.0, regParam=lasso, maxIter=100).fit(data)
    weights = {r: float(w) for r, w in zip(rules, lasso_fit.coefficients.toArray()) if w}
    return RuleEnsemble(float(lasso_fit.intercept), weights)


def held_out_by_id(doc_id: Column, parts: int = 4, part: int = 2) -> Column:
    """Rows whose labels are held out; a row without an id is not one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (1 from
    ``threshold`` on).

    NULL texts count as empty; empty ones have zero in all statistics.
    Repeated rows and NULL ids each get their row. Labels other than 0 and 1
    and ids with contradicting labels teach nothing; other columns are not read; an empty
    table gives no rows.
    """
    stats = statistics(F.col("t"))
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("t"))
    rows = materialise(rows.select("doc_id", *(stats[n].alias(n) for n in STATISTICS)), "statistics")
    known = (labels.select(F.col("doc_id").alias("id"), F.col("quality").alias("q"))
             .filter(F.col("q").isin(0, 1) & F.col("id").isNotNull() & ~held_out_by_id(F.col("id")))
             .groupBy("id").agg(F.min("q").cast("double").alias("label"), F.max("q").cast("double").alias("other"))
             .filter("label = other").select("id", "label"))
    train = materialise(rows.join(known, F.col("doc_id") == F.col("id")).select("label", *STATISTICS), "train")
    score = fit(train).column()
    return (rows.select("doc_id", held_out_by_id(F.col("doc_id")).alias("held_out"), score.alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
