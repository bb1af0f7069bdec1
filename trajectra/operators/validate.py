"""Checks and filters: role order, tool calls, reasoning, whole instances, repositories, limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Which role may follow which.
FOLLOWS = ("assistant>tool", "assistant>user", "tool>tool", "tool>assistant", "user>assistant")


def roles_valid(messages: Column) -> Column:
    """First message after an optional system one from the user, last from the assistant, and only allowed transitions."""
    roles = F.transform(messages, lambda m: m["role"])
    body = F.when(F.get(roles, F.lit(0)) == "system", F.slice(roles, F.lit(2), F.size(roles))).otherwise(roles)
    pairs = F.transform(F.slice(body, F.lit(1), F.greatest(F.size(body) - 1, F.lit(0))), lambda r, i: F.concat_ws(">", r, F.get(body, i + 1)))
    ok = (F.get(body, F.lit(0)) == "user") & (F.element_at(body, -1) == "assistant") & F.forall(pairs, lambda p: p.isin(*FOLLOWS))
    return F.coalesce((F.size(body) > 0) & F.when(F.size(body) > 0, ok), F.lit(False))


def roles_valid_rows(messages: DataFrame) -> DataFrame:
    """rec_id and valid, for exploded messages (rec_id, msg_idx, role)."""
    w = Window.partitionBy("rec_id").orderBy("msg_idx")
    body = messages.withColumn("n", F.row_number().over(w)).filter("NOT (n = 1 AND role = 'system')").withColumn("previous", F.lag("role").over(w))
    fits = F.col("previous").isNull() | F.concat_ws(">", "previous", "role").isin(*FOLLOWS)
    ends = (F.min_by("role", "msg_idx") == "user") & (F.max_by("role", "msg_idx") == "assistant")
    checked = body.groupBy("rec_id").agg((F.bool_and(fits) & ends).alias("valid"))
    return messages.select("rec_id").distinct().join(checked, "rec_id", "left").select("rec_id", F.coalesce("valid", F.lit(False)).alias("valid"))


def tool_calls_valid(messages: Column) -> Column:
    """Every assistant message but the last has tool calls."""
    sizes = F.transform(F.filter(messages, lambda m: m["role"] == "assistant"), lambda m: F.coalesce(F.size(m["tool_calls"]), F.lit(0)))
    return F.forall(F.slice(sizes, F.lit(1), F.greatest(F.size(sizes) - 1, F.lit(0))), lambda n: n > 0)


def reasoning_valid(messages: Column, think_mode: Column, mode: str = "adaptive", threshold: float = 0.2, from_message: Column | int = 0) -> Column:
    """Fast records pass; else the share of assistant messages with reasoning, blank or not, reaches the threshold (strict: all)."""
    start = from_message if isinstance(from_message, Column) else F.lit(from_message)
    later = F.filter(messages, lambda m, i: (m["role"] == "assistant") & (i >= start))
    with_it = F.size(F.filter(later, lambda m: F.coalesce(m["reasoning_content"], F.lit("")) != ""))
    enough = with_it == F.size(later) if mode == "strict" else (F.size(later) == 0) | (with_it / F.size(later) >= threshold)
    return (think_mode == "fast") | enough


def keep_instances(rows: DataFrame, failed: Column, instance: str = "_instance_id") -> DataFrame:
    """Rows of the instances in which no row failed: all of an instance or nothing."""
    bad = rows.withColumn("__bad", failed.cast("int")).groupBy(instance).agg(F.max("__bad").alias("__bad")).filter("__bad = 1").select(instance)
    return rows.join(bad, instance, "left_anti")


def filter_score_bundles(rows: DataFrame, least: float, score: str = "score", is_main: str = "is_main", instance: str = "_instance_id") -> DataFrame:
    """Whole instances whose best main row reaches the score; rows without an instance are judged alone, no score counts 0."""
    best = rows.filter(F.col(instance).isNotNull()).groupBy(instance).agg(F.max(F.when(F.col(is_main), F.coalesce(score, F.lit(0.0)))).alias("__best")).filter(F.col("__best") >= least).select(instance)
    alone = rows.filter(F.col(instance).isNull() & (F.coalesce(score, F.lit(0.0)) >= least))
    return rows.join(best, instance, "left_semi").select(*rows.columns).unionByName(alone)


def repo_key(instance_id: Column) -> Column:
    """`owner__repo` of an instance id `owner__repo-number`, with or without a `__suffix`, lower-cased; else empty."""
    return F.lower(F.regexp_extract(instance_id, r"(?dU)^(.+)-\d+(?:__\w+)?$", 1))


def without_repos(rows: DataFrame, repos: DataFrame, instance: str = "_instance_id", repo: str = "repo") -> DataFrame:
    """Rows whose instance is of none of the repositories (`owner/name`; malformed entries are left out)."""
    keys = repos.select(F.lower(F.replace(F.trim(repo), F.lit("/"), F.lit("__"))).alias("__key")).filter(F.col("__key").rlike(r"^[^/\s]+__[^/\s]+$")).distinct()
    return rows.withColumn("__key", repo_key(F.col(instance))).join(keys, "__key", "left_anti").drop("__key")


def repo_of_path(path: Column) -> Column:
    """`owner__repo` of a file path: of the first folder that is named like an instance, else empty."""
    parts = F.filter(F.transform(F.split(path, "/"), repo_key), lambda k: k != "")
    return F.coalesce(F.get(parts, F.lit(0)), F.lit(""))


def first_kept(rows: DataFrame, n: int, order: str, kept: Column) -> DataFrame:
    """The first n kept rows in an order, which should be total; n of 0 or less means all."""
    kept_rows = rows.filter(kept)
    return kept_rows if n <= 0 else kept_rows.orderBy(order).limit(n)
