"""Summaries over data sets: error rates, score tables, token statistics, judged checklists, cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONG_TOKENS, MANY_TURNS = 131_072, 100


def tool_error_rate(counts: DataFrame) -> DataFrame:
    """Rates by scaffold and over all (null scaffold), from error_counts(); records without calls don't count."""
    used = counts.filter("calls > 0")
    sums = used.rollup("scaffold").agg(F.grouping("scaffold").alias("g"), F.sum("calls").alias("calls"), F.sum("errors").alias("errors"), F.count("*").alias("trajectories"), F.count_if(F.col("errors") > 0).alias("with_error"))
    return sums.filter("trajectories > 0").select(
        F.when(F.col("g") == 0, F.col("scaffold")).alias("scaffold"), "calls", "errors", "trajectories", "with_error",
        F.round(F.col("errors") / F.col("calls"), 6).alias("error_rate"), F.round(F.col("with_error") / F.col("trajectories"), 6).alias("trajectory_error_rate"),
    )


def score_summary(scores: DataFrame, metrics: list[str], group: str = "scaffold") -> DataFrame:
    """n, mean, population deviation, least and greatest of each metric by group and over all (null group)."""
    pairs = ", ".join(f"'{m}', CAST({m} AS DOUBLE)" for m in metrics)
    long = scores.selectExpr(group, f"stack({len(metrics)}, {pairs}) AS (metric, value)").filter("value IS NOT NULL")
    every = F.grouping(group)
    out = long.cube("metric", group).agg(F.grouping("metric").alias("gm"), every.alias("g"), F.count("*").alias("n"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.min("value").alias("low"), F.max("value").alias("high"))
    return out.filter("gm = 0").select("metric", F.when(F.col("g") == 0, F.col(group)).alias(group), "n", "mean", "std", "low", "high")


def token_stats(rows: DataFrame, tokens: str = "tokens", turns: str = "turns") -> DataFrame:
    """One row: greatest, least and truncated mean lengths, how many are long, and the totals."""
    whole = lambda c: F.floor(F.avg(c)).cast("bigint")
    return rows.agg(
        F.max(tokens).alias("max_tokens"), F.min(tokens).alias("min_tokens"), whole(tokens).alias("mean_tokens"), F.count_if(F.col(tokens) > LONG_TOKENS).alias("gt_128k"),
        F.max(turns).alias("max_turns"), F.min(turns).alias("min_turns"), whole(turns).alias("mean_turns"), F.count_if(F.col(turns) >= MANY_TURNS).alias("gte_100"),
        F.sum(tokens).alias("total_tokens"), F.count("*").alias("n"),
    )


def checklist_rewards(checks: DataFrame) -> DataFrame:
    """Of binary checks (rec_id, category_id, score 0/1): isr (all passed), csr (share passed) and csr of each category."""
    passed = F.col("score").cast("double")
    by_category = checks.groupBy("rec_id", "category_id").agg(F.avg(passed).alias("share"), F.sum(passed).alias("hits"), F.count("*").alias("n"))
    category = F.map_from_entries(F.array_sort(F.collect_list(F.struct("category_id", "share"))))
    return by_category.groupBy("rec_id").agg(F.when(F.sum("hits") == F.sum("n"), 1.0).otherwise(0.0).alias("isr"), (F.sum("hits") / F.sum("n")).alias("csr"), F.sum("n").alias("total_checks"), F.sum("hits").cast("bigint").alias("total_passed"), category.alias("category_scores"))


def rated_rewards(items: DataFrame) -> DataFrame:
    """Of items rated 1 to 5 (rec_id, category, score): (sum - n) / (4 n) of each category, and the mean of these."""
    clamped = F.greatest(F.lit(1), F.least(F.lit(5), F.coalesce("score", F.lit(1))))
    by = items.groupBy("rec_id", "category").agg(((F.sum(clamped) - F.count("*")) / (4 * F.count("*"))).alias("reward"))
    return by.groupBy("rec_id").agg(F.avg("reward").alias("composite"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "reward")))).alias("categories"))


def cost_estimate(prompts: DataFrame, prompt: str, rate_in: float, rate_out: float, tokens_out: int = 2000) -> DataFrame:
    """Records, estimated input and output tokens (a token for four characters) and cost at rates for a million tokens."""
    tokens = F.sum(F.floor(F.length(prompt) / 4).cast("bigint"))
    return prompts.agg(F.count("*").alias("records"), tokens.alias("input_tokens"), (F.count("*") * tokens_out).alias("output_tokens")).withColumn("cost", (F.col("input_tokens") * rate_in + F.col("output_tokens") * rate_out) / 1e6)


def capped_checks(checks: DataFrame, cap: int = 40) -> DataFrame:
    """The first ``cap`` checks of each record (rec_id, cat_pos, check_pos, check_id), repeated ids numbered _2, _3, ..."""
    from pyspark.sql import Window

    order = Window.partitionBy("rec_id").orderBy("cat_pos", "check_pos")
    kept = checks.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= cap)
    again = F.row_number().over(Window.partitionBy("rec_id", "check_id").orderBy("cat_pos", "check_pos"))
    named: Column = F.when(F.col("again") > 1, F.concat_ws("_", "check_id", "again")).otherwise(F.col("check_id"))
    return kept.withColumn("again", again).withColumn("check_id", named).drop("n", "again")
