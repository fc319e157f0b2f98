"""Mixing sources to target weights.

The token shares of the sources are raised to an exponent between 0 (all
alike) and 1 (as they are) and normalised. The exponent is bisected: the
largest one whose weights reach a target entropy, but none so small that a
source would be repeated more often than a limit. The weights are realised as
blocks: a block is a permutation of a source's documents by a keyed digest;
each source gets as many whole blocks as its token budget pays for, and of one
more block the documents that come first until the budget is spent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bundleflow.llm.common import fresh, materialise, same, whole_text

SEED = "mix-1"
STEPS = 50
#: Sources are configuration, not data: their totals form one row. More of them raise.
MAX_SOURCES = 100_000
#: Leading hex digits of a document's key that make the bins of a budget.
BIN_DIGITS = 3


def token_count(text: Column) -> Column:
    """Words: maximal runs of characters other than ASCII white space."""
    return F.regexp_count(whole_text(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def order_key(doc_id: Column, block: Column, seed: str = SEED) -> Column:
    """Place of a document in its source's block: MD5 of seed, block and id."""
    return F.md5(F.concat_ws("|", F.lit(seed), block.cast("string"),
                             F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))


def _bisect(shares: str, test: str) -> str:
    """SQL for the bisection's last bracket: ``test`` holds at ``lo`` and may
    fail at ``hi``; it is an expression over the exponent ``{x}``."""
    mid = "((b.lo + b.hi) / 2)"
    holds = test.format(x=mid, p=shares)
    return (f"aggregate(sequence(1, {STEPS}), named_struct('lo', 0D, 'hi', 1D), (b, i) -> "
            f"named_struct('lo', if({holds}, {mid}, b.lo), 'hi', if({holds}, b.hi, {mid})))")


def source_plan(totals: DataFrame, target_entropy: float | None, max_repetition: float | None) -> DataFrame:
    """Totals (src, tokens, docs) to one row per source: src, tokens, docs,
    exponent, weight, budget, blocks (whole ones), rest (tokens of the last).

    ``target_entropy`` is a part of the way from the natural weights' entropy
    to that of equal weights (0 to 1), and without it the weights are the
    natural ones, so nothing is repeated; ``max_repetition`` is the most passes
    over a source, which bounds how flat the weights get. All weights are realised at the smallest size at which no source
    gets less than one pass, so no document is left out. The exponent is
    rounded to six digits. Sources without a token get one pass.
    """
    one = totals.agg(F.sort_array(F.collect_list(F.when(F.col("tokens") > 0, F.col("tokens")))).alias("t"),
                     F.count(F.lit(1)).alias("n"))
    one = one.withColumn("t", F.when(F.col("n") > MAX_SOURCES, F.raise_error(
        F.lit(f"more than {MAX_SOURCES} sources"))).otherwise(F.col("t")))
    one = one.withColumn("p", F.expr("transform(t, x -> x / aggregate(t, 0D, (a, y) -> a + y))"))
    entropy = ("(ln(aggregate({p}, 0D, (a, y) -> a + power(y, {x}))) - aggregate({p}, 0D, (a, y) -> "
               "a + power(y, {x}) * {x} * ln(y)) / aggregate({p}, 0D, (a, y) -> a + power(y, {x})))")
    one = one.withColumn("h1", F.expr(f"if(size(p) < 2, 0D, {entropy.format(p='p', x='1D')})"))
    reach = f"({entropy} >= h1 + {target_entropy or 0}D * (ln(cast(size(p) as double)) - h1))"
    one = one.withColumn("flat", F.lit(1.0) if target_entropy is None else F.expr(
        f"if(size(p) < 2, 1D, {_bisect('p', reach)}.lo)"))
    # passes of the smallest source while the largest gets one: (largest / smallest) ** (1 - exponent)
    over = f"(power(p[size(p) - 1] / p[0], 1 - {{x}}) > {max_repetition or 1}D)"
    one = one.withColumn("least", F.lit(0.0) if max_repetition is None else F.expr(
        f"if(size(p) < 2, 0D, if(p[size(p) - 1] / p[0] <= {max_repetition}D, 0D, {_bisect('p', over)}.hi))"))
    one = one.select(F.round(F.greatest("flat", "least"), 6).alias("exponent"), F.get("t", F.size("t") - 1).alias("top"))
    # the single row reaches every source through a key they share
    plan = totals.withColumn("one", F.lit(1)).join(F.broadcast(one.withColumn("one", F.lit(1))), "one").drop("one")
    # budgets are as the weights tokens ** exponent, and the largest source's is one pass
    budget = F.floor(F.col("top") * F.pow(F.try_divide(F.col("tokens"), F.col("top")), F.col("exponent")) + 0.5)
    plan = plan.withColumn("budget", F.when(F.col("tokens") > 0, budget).otherwise(F.lit(0)).cast("long"))
    plan = plan.withColumn("budget", F.greatest("budget", "tokens"))
    plan = plan.withColumn("blocks", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens")))
                           .otherwise(F.lit(1)).cast("long"))
    plan = plan.withColumn("rest", F.col("budget") - F.col("blocks") * F.col("tokens"))
    everything = Window.partitionBy(F.lit(1))
    return plan.withColumn("weight", F.try_divide(F.col("budget"), F.sum("budget").over(everything))).select(
        "src", "tokens", "docs", "exponent", "weight", "budget", "blocks", "rest")


def _last_keys(slim: DataFrame, plan: DataFrame, seed: str) -> DataFrame:
    """(src, last): the key at which a source's rest is spent. Tokens are
    summed by bin of the key, then within the one bin where the rest ends, so
    no window sees more than a bin of a source."""
    part = plan.filter("rest > 0").select("src", "blocks", "rest")
    keyed = slim.join(F.broadcast(part), "src").withColumn("k", order_key(F.col("doc_id"), F.col("blocks"), seed))
    keyed = keyed.select("src", "rest", "n_tokens", "k", F.substring("k", 1, BIN_DIGITS).alias("bin"))
    bins = keyed.groupBy("src", "rest", "bin").agg(F.sum("n_tokens").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("src").orderBy("bin"))
    ends = (bins.withColumn("upto", upto).filter("upto >= rest and upto - n < rest")
            .select(F.col("src").alias("s"), F.col("bin").alias("b"), (F.col("rest") - F.col("upto") + F.col("n")).alias("left")))
    inside = keyed.join(F.broadcast(ends), (F.col("src") == F.col("s")) & (F.col("bin") == F.col("b")))
    sums = inside.groupBy("src", "left", "k").agg(F.sum("n_tokens").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("src").orderBy("k"))
    return (sums.withColumn("upto", upto).filter("upto >= left and upto - n < left")
            .select("src", F.col("k").alias("last")))


def mix(docs: DataFrame, target_entropy: float | None = 0.5, max_repetition: float | None = 4.0,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED) -> DataFrame:
    """``docs`` with each row once per block it stands in, and the columns
    mix_block (from 0), mix_key (its place in that block), mix_tokens,
    mix_source, mix_exponent and mix_weight (underscores are put before a name
    that ``docs`` has).

    Blocks of a source are read in order, each by key. NULL sources are one
    source of their own, NULL and empty texts have no tokens and come once per
    whole block and in the last one if they stand before its end. Rows that
    repeat an id have the same key and go together. An empty table gives no
    rows. The documents' texts are not shuffled.
    """
    block, key, tokens, src, exponent, weight = fresh(
        docs, "mix_block", "mix_key", "mix_tokens", "mix_source", "mix_exponent", "mix_weight")
    named = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("null"))
    slim = materialise(docs.select(F.col(id_col).alias("doc_id"), named.alias("src"),
                                   token_count(F.col(text_col)).alias("n_tokens")), "tokens")
    totals = slim.groupBy("src").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    plan = materialise(source_plan(materialise(totals, "totals"), target_entropy, max_repetition), "plan")
    ends = _last_keys(slim, plan, seed)
    plan = materialise(plan.join(ends, "src", "left"), "blocks")
    steps = plan.select(F.col("src").alias(src), F.col("blocks").alias("_mb"), F.col("last").alias("_ml"),
                        F.col("exponent").alias(exponent), F.col("weight").alias(weight))
    blocks, last = fresh(docs, "_mb", "_ml")
    steps = steps.withColumnsRenamed({"_mb": blocks, "_ml": last})
    out = docs.withColumn(src, named).join(F.broadcast(steps), src)
    # the whole blocks, and the part of one more
    part = F.when(order_key(F.col(id_col), F.col(blocks), seed) <= F.col(last), F.col(blocks)).otherwise(F.col(blocks) - 1)
    out = out.withColumn(tokens, token_count(F.col(text_col)))
    out = out.select("*", F.explode(F.sequence(F.lit(0).cast("long"), part)).alias(block))
    out = out.withColumn(key, order_key(F.col(id_col), F.col(block), seed))
    return out.select(*docs.columns, block, key, tokens, src, exponent, weight)
