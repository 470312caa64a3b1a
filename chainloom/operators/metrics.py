"""Diversity and quality metrics over calls and conversations, and run comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import walk as W


def entropy(counts: DataFrame, n: str = "n") -> DataFrame:
    """One row: bits (Shannon entropy of the counts), kinds, total. One aggregate: H = log2 N - sum(n log2 n) / N."""
    plogp = F.sum(F.col(n) * F.log2(F.col(n).cast("double")))
    total = F.sum(n)
    bits = F.when(F.count(F.lit(1)) <= 1, 0.0).otherwise(F.log2(total.cast("double")) - F.try_divide(plogp, total))
    return counts.agg(F.coalesce(bits, F.lit(0.0)).alias("bits"), F.count(F.lit(1)).alias("kinds"), F.coalesce(total, F.lit(0)).alias("total"))


def normalised(bits: Column, kinds: Column) -> Column:
    return F.when(kinds <= 1, 0.0).otherwise(bits / F.log2(F.greatest(kinds, F.lit(2)).cast("double")))


def usage_entropy(calls: DataFrame) -> DataFrame:
    return entropy(calls.groupBy("endpoint").agg(F.count(F.lit(1)).alias("n"))).select(F.round(normalised(F.col("bits"), F.col("kinds")), 9).alias("usage_entropy"))


def unique_tools(calls: DataFrame) -> DataFrame:
    return calls.agg(F.count_distinct("tool", "api").alias("unique_tools_used"))


def coverage(calls: DataFrame, registry_size: DataFrame) -> DataFrame:
    """``registry_size``: one row, n."""
    both = unique_tools(calls).join(F.broadcast(registry_size))
    return both.select(F.round(F.when(F.col("n") > 0, F.col("unique_tools_used") / F.col("n")).otherwise(0.0), 9).alias("coverage_ratio"))


def concentration(calls: DataFrame, top: int = 5) -> DataFrame:
    counts = calls.groupBy("endpoint").agg(F.count(F.lit(1)).alias("n"))
    best = counts.orderBy(F.desc("n"), "endpoint").limit(top).agg(F.sum("n").alias("best"))
    both = counts.agg(F.sum("n").alias("total")).join(F.broadcast(best))
    return both.select(F.round(F.coalesce(F.try_divide("best", "total"), F.lit(0.0)), 9).alias(f"top{top}_concentration"))


def signatures(conversations: DataFrame, calls: DataFrame) -> DataFrame:
    """Each conversation with its sorted distinct endpoints; no calls: the empty signature."""
    sets = calls.groupBy("conv_id").agg(F.array_sort(F.collect_set("endpoint")).alias("signature"))
    return conversations.join(sets, "conv_id", "left").withColumn("signature", F.coalesce("signature", F.array().cast("array<string>")))


def combo_entropy(conversations: DataFrame, calls: DataFrame) -> DataFrame:
    counts = signatures(conversations, calls).groupBy("signature").agg(F.count(F.lit(1)).alias("n"))
    return entropy(counts).select(F.round("bits", 9).alias("combo_entropy"))


def chain_ratio(conversations: DataFrame, calls: DataFrame) -> DataFrame:
    s = signatures(conversations, calls).agg(F.count_distinct("signature").alias("unique_chains"), F.count(F.lit(1)).alias("n"))
    return s.select("unique_chains", F.round(F.coalesce(F.try_divide("unique_chains", "n"), F.lit(0.0)), 9).alias("chain_ratio"))


def domain_uniformity(categories: DataFrame, known: int | None = None) -> DataFrame:
    """Entropy over categories, one count a conversation and category, over that of ``known`` categories (default: those seen)."""
    e = entropy(categories.groupBy("category").agg(F.count(F.lit(1)).alias("n")))
    return e.select(F.round(normalised(F.col("bits"), F.lit(known) if known else F.col("kinds")), 9).alias("domain_uniformity"))


def used_domains(conversations: DataFrame, categories: DataFrame, calls: DataFrame) -> DataFrame:
    """conv_id, category: a conversation's categories; if it has none, the tools that it used."""
    without = conversations.select("conv_id").join(categories, "conv_id", "left_anti")
    tools = calls.select("conv_id", F.col("tool").alias("category")).distinct().join(without, "conv_id", "left_semi")
    return categories.select("conv_id", "category").unionByName(tools)


def mean_scores(scores: DataFrame) -> DataFrame:
    names = ("naturalness", "tool_correctness", "task_completion")
    mean = lambda c: F.coalesce(F.avg(c), F.lit(0.0))
    scored = F.col("naturalness").isNotNull()
    overall = (mean(names[0]) + mean(names[1]) + mean(names[2])) / 3
    return scores.agg(*[F.round(mean(c), 9).alias(c) for c in names], F.round(overall, 9).alias("overall_mean"), F.count(F.when(scored, 1)).alias("scored_count"))


def per_conversation(conversations: DataFrame, calls: DataFrame) -> DataFrame:
    """conv_id, ..., n_calls, n_tools, n_endpoints; conversations without calls have zeros."""
    counts = calls.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_calls"), F.count_distinct("tool").alias("n_tools"), F.count_distinct("endpoint").alias("n_endpoints"))
    return conversations.join(counts, "conv_id", "left").fillna(0, ["n_calls", "n_tools", "n_endpoints"])


def _share(hit: Column) -> Column:
    return F.round(F.coalesce(F.avg(hit.cast("double")), F.lit(0.0)), 9)


def ms_mt_rate(conversations: DataFrame, calls: DataFrame, by: str = "n_endpoints") -> DataFrame:
    """Share with three calls or more, of two different endpoints or more (``n_tools``: tools)."""
    return per_conversation(conversations, calls).agg(_share((F.col("n_calls") >= 3) & (F.col(by) >= 2)).alias("ms_mt_rate"))


def chained(json_calls: DataFrame) -> DataFrame:
    """conv_id, chained: whether a call's argument equals a value of a strictly earlier response, at any depth of it.

    Of arguments the first level counts; strings of three characters or more, numbers and booleans. Values
    are compared as text. The first place of a value is enough, so each conversation and value has one row on either side."""

    def values(found: Column, keep: Column) -> DataFrame:
        return json_calls.select("conv_id", "call_idx", F.explode(found).alias("x")).select("conv_id", "call_idx", "x.*").where(keep)

    first = values(W.leaf_values(F.col("response")), F.lit(True)).groupBy("conv_id", "value").agg(F.min("call_idx").alias("seen"))
    last = values(W.entries(F.col("arguments")), (F.col("kind") != "string") | (F.length("value") >= 3)).groupBy("conv_id", "value").agg(F.max("call_idx").alias("used"))
    hits = first.join(last, ["conv_id", "value"]).where("seen < used").select("conv_id").distinct().withColumn("hit", F.lit(True))
    return json_calls.select("conv_id").distinct().join(hits, "conv_id", "left").select("conv_id", F.coalesce("hit", F.lit(False)).alias("chained"))


def real_chaining_rate(json_calls: DataFrame) -> DataFrame:
    return chained(json_calls).agg(_share(F.col("chained")).alias("real_chaining_rate"), F.count(F.when(F.col("chained"), 1)).alias("chained"), F.count(F.lit(1)).alias("conversations"))


def per_type(conversations: DataFrame, calls: DataFrame) -> DataFrame:
    """type with totals and hits of both runs, zero where a run lacks the type."""
    hit = (F.col("n_calls") >= 3) & (F.col("n_endpoints") >= 2)
    of = lambda run, c: F.count(F.when((F.col("run") == run) & c, 1)).alias
    counts = per_conversation(conversations, calls).withColumn("type", F.coalesce("type", F.lit("?"))).groupBy("type")
    return counts.agg(of("A", F.lit(True))("total_a"), of("A", hit)("hits_a"), of("B", F.lit(True))("total_b"), of("B", hit)("hits_b"))


def overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    """Sizes of A and B, only A, only B, A or B: one pass over tagged distinct rows instead of four set operations."""
    tagged = a.distinct().withColumns({"a": F.lit(1), "b": F.lit(0)}).unionByName(b.distinct().withColumns({"a": F.lit(0), "b": F.lit(1)}))
    each = tagged.groupBy(*a.columns).agg(F.max("a").alias("a"), F.max("b").alias("b"))
    n = lambda c: F.count(F.when(c, 1)).alias
    x, y = F.col("a") == 1, F.col("b") == 1
    return each.agg(n(x & y)("both"), n(x & ~y)("only_a"), n(~x & y)("only_b"), F.count(F.lit(1)).alias("either"))


def diversity_summary(conversations: DataFrame, calls: DataFrame, categories: DataFrame, registry_size: DataFrame) -> DataFrame:
    parts = [usage_entropy(calls), unique_tools(calls), coverage(calls, registry_size), concentration(calls), combo_entropy(conversations, calls), chain_ratio(conversations, calls), domain_uniformity(categories)]
    parts.append(calls.agg(F.count(F.lit(1)).alias("total_tool_calls")))
    out = parts[0]
    for p in parts[1:]:
        out = out.join(F.broadcast(p))  # one row each
    return out


def threshold_checks(metrics: DataFrame, gates=K.GATES) -> DataFrame:
    """``metrics``: one row. Returns name, threshold, value, passed."""
    checks = F.array(*[F.struct(F.lit(k).alias("name"), F.lit(t).alias("threshold"), F.col(k).cast("double").alias("value")) for k, t in gates])
    return metrics.select(F.explode(checks).alias("c")).select("c.*").withColumn("passed", F.col("value") >= F.col("threshold"))


def steering_counts(calls: DataFrame, categories: DataFrame, patterns: DataFrame) -> DataFrame:
    """kind (tool, category, pattern), key, n."""
    of = lambda df, key, kind: df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), F.coalesce("key", F.lit("unknown")).alias("key"), "n")
    return of(calls, "endpoint", "tool").unionByName(of(categories, "category", "category")).unionByName(of(patterns, "pattern", "pattern"))


def exclude_tools(calls: DataFrame, conversations: DataFrame, factor: float = 3.0, top: int = 10, least: int = 10) -> DataFrame:
    """Of the ``top`` most used endpoints those used more than ``factor`` times the mean; none in a small corpus."""
    counts = calls.groupBy("endpoint").agg(F.count(F.lit(1)).alias("n"))
    mean = counts.agg(F.avg("n").alias("mean")).join(F.broadcast(conversations.agg(F.count(F.lit(1)).alias("convs"))))
    return counts.orderBy(F.desc("n"), "endpoint").limit(top).join(F.broadcast(mean)).where((F.col("n") > factor * F.col("mean")) & (F.col("convs") >= least)).select("endpoint", "n")


def against_mean(counts: DataFrame, factor: float, above: bool) -> DataFrame:
    """Rows of counts (key, n) above or below ``factor`` times their mean."""
    mean = counts.agg((F.avg("n") * factor).alias("bound"))
    test = F.col("n") > F.col("bound") if above else F.col("n") < F.col("bound")
    return counts.join(F.broadcast(mean)).where(test).drop("bound")


def pattern(n_calls: Column, n_tools: Column) -> Column:
    return F.when(n_calls == 1, "single_call").when(n_tools == 1, "single_tool_multi_step").when(n_calls <= 3, "short_multi_tool").otherwise("long_multi_tool")


def best_attempt(attempts: DataFrame, threshold: float) -> DataFrame:
    """``attempts``: slot, attempt (from 0), score. The best up to the first that reaches the threshold; first wins ties."""
    before = Window.partitionBy("slot").orderBy("attempt").rowsBetween(Window.unboundedPreceding, -1)
    tried = attempts.withColumn("done", F.coalesce(F.max(F.col("score") >= threshold).over(before), F.lit(False))).where("not done")
    best = Window.partitionBy("slot").orderBy(F.desc("score"), "attempt")
    last = F.max("attempt").over(Window.partitionBy("slot"))
    return tried.withColumns({"r": F.row_number().over(best), "retries": last}).where("r = 1").select("slot", "attempt", "score", "retries")


def deltas(report: DataFrame) -> DataFrame:
    """``report``: run (A or B) and numbers, a row a run. metric, a, b, delta (b - a; null if a run lacks it)."""
    numbers = [c for c in report.columns if c != "run"]
    each = report.select("run", *[F.col(c).cast("double").alias(c) for c in numbers]).unpivot("run", numbers, "metric", "value")
    of = lambda run: F.max(F.when(F.col("run") == run, F.col("value")))
    sides = each.groupBy("metric").agg(of("A").alias("a"), of("B").alias("b"))
    return sides.select("metric", "a", "b", F.round(F.col("b") - F.col("a"), 9).alias("delta"))


def fill_scores(conversations: DataFrame, scored: DataFrame, names: tuple[str, ...] = ("naturalness", "tool_correctness", "task_completion")) -> DataFrame:
    """``conversations`` (conv_id and ``names``) with the scores of ``scored`` where they have none; those that have any keep them."""
    without = F.coalesce(*names).isNull()
    fresh = scored.select("conv_id", *[F.col(n).alias(f"_{n}") for n in names])
    rows = conversations.where(without).join(fresh, "conv_id", "left").select("conv_id", *[F.col(f"_{n}").alias(n) for n in names], F.lit(True).alias("fresh"))
    return conversations.where(~without).select("conv_id", *names, F.lit(False).alias("fresh")).unionByName(rows)
