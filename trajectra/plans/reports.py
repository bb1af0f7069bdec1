"""Reports over scored data sets: judge details and summaries, text of error rates, statistics beside rendered lists."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajectra.functions import text
from trajectra.operators import judge, stats

#: Fixed value: the greatest rating of a check.
MOST = 5


def judge_details(answers: DataFrame, answer: str = "llm_raw_response") -> DataFrame:
    """rec_id, total_checks, total_score, total_max and by_category (map to score, max, count) of rated answers.

    Ratings are clamped to 1 to 5, what is no number counts 1; only the known categories count.  Records whose answer is no JSON have no row.
    """
    rated = answers.select("rec_id", judge.ratings(F.col(answer)).alias("r")).filter("r IS NOT NULL")
    known = F.map_filter("r", lambda k, v: k.isin(*judge.CATEGORY_COLUMNS) & v.isNotNull())
    scores = F.transform_values(known, lambda k, v: F.transform(F.map_values(v), lambda x: text.clamp_score(x, 1, MOST)))
    one = lambda v: F.aggregate(v, F.lit(0).cast("bigint"), lambda a, x: a + x)
    by = F.transform_values("s", lambda k, v: F.struct(one(v).alias("score"), (MOST * F.size(v)).cast("bigint").alias("max"), F.size(v).cast("bigint").alias("count")))
    total = lambda field: F.aggregate(F.map_values("by_category"), F.lit(0).cast("bigint"), lambda a, x: a + x[field])
    rows = rated.withColumn("s", scores).withColumn("by_category", by)
    return rows.select("rec_id", total("count").alias("total_checks"), total("score").alias("total_score"), total("max").alias("total_max"), "by_category")


def llm_summary(records: DataFrame, scores: dict[str, str], main_score: str, error: str) -> DataFrame:
    """Row by row (name, scored, failed, not_scored, mean, low, high) of main records' scores: the main score, then the others.

    ``scores`` maps names to columns.  A record with an error has failed, one without score and error isn't scored.
    """
    main = records.filter(F.coalesce("_agent_type", F.lit("main")) != "subagent")
    failed, scored = F.count_if(F.coalesce(error, F.lit("")) != ""), F.count(main_score)
    rows = []
    for k, (name, column) in enumerate({"composite": main_score, **scores}.items()):
        counts = (scored, failed, F.count("*") - scored - failed) if not k else (F.count(column), *[F.lit(None).cast("bigint")] * 2)
        value = F.col(column).cast("double")
        rows.append(F.struct(F.lit(k).alias("k"), F.lit(name).alias("name"), *(c.alias(n) for n, c in zip(("scored", "failed", "not_scored"), counts)), F.avg(value).alias("mean"), F.min(value).alias("low"), F.max(value).alias("high")))
    return main.agg(F.array(*rows).alias("rows")).select(F.inline("rows")).orderBy("k").drop("k")


def category_summary(records: DataFrame, categories: str = "category_scores") -> DataFrame:
    """category and mean share of passed checks over main records, by name."""
    main = records.filter(F.coalesce("_agent_type", F.lit("main")) != "subagent")
    return main.select(F.explode(categories).alias("category", "share")).groupBy("category").agg(F.avg("share").alias("csr")).orderBy("category")


def tool_error_text(rates: DataFrame) -> str:
    """The result of stats.tool_error_rate() as a few lines of text: over all, and by scaffold where there are several."""
    found = {r["scaffold"]: r for r in rates.collect()}  # one row a scaffold
    every = found.pop(None, None)
    if every is None or not every["calls"]:
        return "Tool-call error rate: none (no tool calls)"
    line = lambda r: f"calls {r['errors']} of {r['calls']} = {r['error_rate']:.4f}, trajectories {r['with_error']} of {r['trajectories']} = {r['trajectory_error_rate']:.4f}"
    parts = [f"Tool-call errors: {line(every)}"]
    if len(found) > 1:
        parts += [f"  {name}: {line(found[name])}" for name in sorted(found)]
    return "\n".join(parts)


def side_statistics(rendered: DataFrame, trajectories: DataFrame, tokens=None) -> str:
    """JSON of token, turn and score statistics of rendered records and of their trajectories' tool errors."""
    from trajectra.plans import flows

    lengths = flows.token_statistics(rendered, tokens).first()
    out: dict = {}
    if lengths["n"]:
        part = lambda name, last: {k: lengths[f"{k}_{name}"] for k in ("max", "min", "mean")} | {last: lengths[last]}
        out = {"token_lens": part("tokens", "gt_128k"), "n_turns": part("turns", "gte_100"), "total_tokens": lengths["total_tokens"], "count": lengths["n"]}
    rates = {r["scaffold"]: r.asDict() for r in flows.error_rates(trajectories).collect()}
    out["tool_call_errors"] = {"all": rates.pop(None, None), "by_scaffold": dict(sorted(rates.items()))}
    return json.dumps(out, ensure_ascii=False, indent=2)


def dry_run(trajectories: DataFrame, checklist: dict[str, list[str]], rate_in: float = 2.5, rate_out: float = 10.0) -> DataFrame:
    """What rating the main records would cost, at rates for a million tokens; nothing is asked."""
    main = trajectories.filter(F.coalesce("_agent_type", F.lit("main")) != "subagent") if "_agent_type" in trajectories.columns else trajectories
    return stats.cost_estimate(main.select(judge.rating_prompt(F.col("tools"), F.col("messages"), checklist).alias("prompt")), "prompt", rate_in, rate_out)
