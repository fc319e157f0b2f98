import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from bundleflow.llm import quality


@pytest.fixture(scope="module")
def labelled(spark):
    sf = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")


def test_held_out_labels(labelled):
    docs, labels = labelled
    scored = quality.score_documents(docs, labels).cache()
    assert scored.count() == docs.count() and scored.filter("score < 0 or score > 1 or score is null").count() == 0
    seen = {(r.quality, r.predicted): r["count"] for r in scored.filter("held_out").join(labels, "doc_id")
            .groupBy("quality", "predicted").count().collect()}
    right = sum(n for (q, p), n in seen.items() if q == p)
    assert right >= 0.95 * sum(seen.values())


def test_rules_of_a_tree():
    text = """RandomForestClassificationModel: uid=x, numTrees=2
  Tree 0 (weight 1.0):
    If (feature 0 <= 1.5)
     If (feature 1 <= 2.0)
      Predict: 0.0
     Else (feature 1 > 2.0)
      Predict: 1.0
    Else (feature 0 > 1.5)
     Predict: 1.0
  Tree 1 (weight 1.0):
    Predict: 1.0"""
    a, b = ("a", False, 1.5), ("b", False, 2.0)
    assert quality.tree_rules(text, ["a", "b"]) == {
        frozenset([a]), frozenset([a, b]), frozenset([a, ("b", True, 2.0)]), frozenset([("a", True, 1.5)])}


def test_column_is_the_sum_of_rules(spark):
    rnd = random.Random(1)
    rules = {frozenset([("x", True, 0.5)]): 1.5, frozenset([("x", False, 0.2), ("y", True, 0.7)]): -2.0}
    rows = [(rnd.random(), rnd.random()) for _ in range(100)]
    df = spark.createDataFrame(rows, "x double, y double").withColumn("s", quality.RuleEnsemble(0.3, rules).column())
    for r in df.collect():
        z = 0.3 + 1.5 * (r.x > 0.5) - 2.0 * (r.x <= 0.2 and r.y > 0.7)
        assert abs(r.s - 1 / (1 + math.exp(-z))) < 1e-12


def test_statistics(spark):
    row = spark.createDataFrame([("One TWO two two, | 12 !!\n",), ("",)], "t string").select(
        *(c.alias(n) for n, c in quality.statistics(F.col("t")).items())).collect()
    assert row[0].words == 7 and row[0].upper_words == 1 / 7 and row[0].numbers == 1 / 7 and row[0].bars == 1 / 7
    assert all(v == 0 for n, v in row[1].asDict().items() if n not in ("distinct",))


def test_edge_rows(edge_docs, no_docs, labelled):
    labels = labelled[1]
    assert quality.score_documents(edge_docs, labels.filter("doc_id < 0")).count() == edge_docs.count()
    assert quality.score_documents(no_docs, labels).count() == 0
    got = quality.score_documents(edge_docs, labels).collect()
    assert len(got) == edge_docs.count() and all(0 <= r.score <= 1 for r in got)


def test_other_label_values_teach_nothing(labelled):
    docs, labels = labelled
    docs = docs.filter("doc_id < 400")
    other = labels.withColumn("quality", F.when(F.col("doc_id") % 7 == 0, 2).otherwise(F.col("quality")))
    want = quality.score_documents(docs, labels.filter("doc_id % 7 <> 0"))
    got = quality.score_documents(docs, other)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_score_at_the_threshold(spark, edge_docs, labelled):
    score = {r.doc_id: r.score for r in quality.score_documents(edge_docs.filter("doc_id < 8"), labelled[1]).collect()}
    border = max(score.values())
    rows = quality.score_documents(edge_docs.filter("doc_id < 8"), labelled[1], threshold=border).collect()
    assert {r.doc_id for r in rows if r.predicted} == {i for i, s in score.items() if s == border}


def by_hand(text):
    """The statistics by plain Python, for texts of ASCII letters and signs."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {"chars": len(text), "words": len(words)}


def test_scores_against_plain_python(labelled, spark):
    """Scores of all documents from the fitted rules, row by row in Python;
    the weights are the optimum of the lasso's loss, checked by its conditions."""
    docs, labels = labelled
    stats = quality.statistics(F.col("text"))
    rows = docs.select("doc_id", "text", *(stats[n].alias(n) for n in quality.STATISTICS)).collect()
    for r in rows:
        hand = by_hand(r.text)
        assert r.words == hand["words"] and (r.chars == hand["chars"] or abs(r.chars - math.log1p(hand["chars"])) < 1e-9)
    known = {r.doc_id: r.quality for r in labels.collect() if r.quality in (0, 1) and zlib.crc32(str(r.doc_id).encode()) % 4 != 2}
    train = spark.createDataFrame([(float(known[r.doc_id]), *(float(r[n]) for n in quality.STATISTICS)) for r in rows if r.doc_id in known],
                                  "label double, " + ", ".join(f"{n} double" for n in quality.STATISTICS))
    model = quality.fit(train)
    assert model.weights
    ordered = list(model.weights)

    def holds(rule, row):
        return float(all((row[n] > b) if above else (row[n] <= b) for n, above, b in rule))

    def score(row):
        return 1 / (1 + math.exp(-model.bias - sum(model.weights[r] * holds(r, row) for r in ordered)))

    got = {r.doc_id: r.s for r in docs.select("doc_id", *(stats[n].alias(n) for n in quality.STATISTICS))
           .select("doc_id", model.column().alias("s")).collect()}
    assert all(abs(got[r.doc_id] - score(r)) < 1e-9 for r in rows)
    # at the optimum the loss has no slope in the bias, and for each rule with a
    # weight a slope of the penalty's size against it (the rules by their spread)
    taught = [r for r in rows if r.doc_id in known]
    y = np.array([known[r.doc_id] for r in taught])
    p = np.array([score(r) for r in taught])
    assert abs((p - y).mean()) < 1e-3
    for rule in ordered:
        x = np.array([holds(rule, r) for r in taught])
        slope = ((p - y) * x).mean() / x.std(ddof=1)
        assert slope == pytest.approx(-quality.LASSO * np.sign(model.weights[rule]), abs=0.2 * quality.LASSO + 1e-4)
