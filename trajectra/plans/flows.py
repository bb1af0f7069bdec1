"""Whole flows composed of the operators; each is one lazy plan until something is written."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajectra import schema
from trajectra.functions import text
from trajectra.operators import dedup, metrics, normalize, relations, stats, turns, validate
from trajectra.sources import convert, files


def score(trajectories: DataFrame, canonical: bool = True) -> DataFrame:
    """Trajectories with _score; subagents stay, without one.  An earlier score is replaced; a column scaffold is believed."""
    rows = trajectories.drop("_score")
    kinds = rows.withColumn("__kind", F.coalesce("_agent_type", normalize.agent_type(F.col("tools")))) if "_agent_type" in rows.columns else rows.withColumn("__kind", normalize.agent_type(F.col("tools")))
    main = kinds.filter("__kind <> 'subagent'").select("rec_id", "tools", "messages", *(["scaffold"] if "scaffold" in rows.columns else []))
    scored = metrics.score_trajectories(normalize.canonicalize(main) if canonical else main)
    fields = [c for c in scored.columns if c != "rec_id"]
    return rows.join(scored.select("rec_id", F.struct(*fields).alias("_score")), "rec_id", "left")


def error_rates(trajectories: DataFrame) -> DataFrame:
    """Tool error rates over all records, subagents included, names as they are."""
    return stats.tool_error_rate(metrics.error_counts(relations.profiles(relations.steps(trajectories))))


def clean(messages: DataFrame) -> DataFrame:
    """Exploded messages without failed turns and trailing tools, and with empty placeholders blanked."""
    kept = turns.trim_trailing_tools(turns.drop_error_turns(messages))
    return kept.withColumn("content", turns.empty_placeholder(F.col("role"), F.col("content")))


def _cleaned(records: DataFrame) -> DataFrame:
    exploded = records.select("rec_id", F.posexplode("messages").alias("msg_idx", "m")).select("rec_id", "msg_idx", "m.role", "m.content", "m")
    again = F.transform(F.array_sort(F.collect_list(F.struct("msg_idx", F.col("m").withField("content", F.col("content")).alias("m")))), lambda x: x["m"])
    return records.drop("messages").join(clean(exploded).groupBy("rec_id").agg(again.alias("messages")), "rec_id")


#: Statuses for which a record's instance goes as a whole.
LOST = ("failed", "roles", "calls", "reasoning")
_RAW_TOOLS = "array<struct<type:string,name:string,description:string,input_schema:string,function:struct<name:string,description:string,parameters:string>>>"


def declared_tools(raw: Column) -> Column:
    """Tools of raw JSON text, with parameters or an input schema."""
    pick = lambda t, name: F.coalesce(t["function"][name], t[name])
    return F.transform(F.from_json(raw, _RAW_TOOLS), lambda t: F.struct(F.lit("function").alias("type"), F.struct(pick(t, "name").alias("name"), pick(t, "description").alias("description"), F.coalesce(t["function"]["parameters"], t["input_schema"], F.lit("{}")).alias("parameters")).alias("function")))


def with_status(records: DataFrame, mode: str = "adaptive", threshold: float = 0.2, calls: bool = True) -> DataFrame:
    """Records with think_mode, _agent_type and status: the first check that fails (roles, calls, reasoning), or kept."""
    rows = records.withColumn("think_mode", normalize.think_mode(F.col("messages"))).withColumn("_agent_type", normalize.agent_type(F.col("tools")))
    status = F.when(~validate.roles_valid(F.col("messages")), "roles")
    if calls:
        status = status.when(~validate.tool_calls_valid(F.col("messages")), "calls")
    return rows.withColumn("status", status.when(~validate.reasoning_valid(F.col("messages"), F.col("think_mode"), mode, threshold), "reasoning").otherwise("kept"))


def logged_records(logged: DataFrame, mode: str = "adaptive", threshold: float = 0.2, skip_titles: bool = False, rename: tuple[str, str] | None = None) -> DataFrame:
    """Logged requests (instance_id, line_no, raw) deduplicated, converted and cleaned, with a status each.

    ``skip_titles`` leaves out calls that only make a title; ``rename`` replaces the model's name in system messages.
    """
    rows = dedup.dedup_requests(logged).withColumn("c", convert.convert(F.col("raw"), "logged"))
    named = rows.select(F.concat_ws("#", "instance_id", "line_no").alias("rec_id"), F.col("instance_id").alias("_instance_id"), "pos", declared_tools(F.get_json_object("raw", "$.request_body.tools")).alias("tools"), F.col("c.messages").alias("messages"), F.col("c.error").alias("error"))
    good = _cleaned(named.filter("error IS NULL").drop("error"))
    if skip_titles:
        first = F.get("messages", F.lit(0))
        good = good.filter(~F.coalesce((first["role"] == "system") & F.lower(first["content"]).contains("title generator"), F.lit(False)))
    if rename:
        good = good.withColumn("messages", normalize.replace_model_name(F.col("messages"), *rename))
    judged = with_status(good, mode, threshold)
    failed = named.filter("error IS NOT NULL").drop("error")
    return judged.unionByName(failed.withColumn("status", F.lit("failed")), allowMissingColumns=True)


def whole_instances(judged: DataFrame) -> DataFrame:
    """Kept records of the instances of which no record failed a check."""
    return validate.keep_instances(judged, F.col("status").isin(*LOST)).filter("status = 'kept'").drop("status")


def convert_logged(logged: DataFrame, mode: str = "adaptive", threshold: float = 0.2, skip_titles: bool = False, rename: tuple[str, str] | None = None) -> DataFrame:
    """Logged requests to trajectories of whole, valid instances; of an instance all records are kept or none."""
    return whole_instances(logged_records(logged, mode, threshold, skip_titles, rename)).drop("pos", "think_mode")


def skip_counts(judged: DataFrame, instance: str = "_instance_id") -> DataFrame:
    """One row: records filtered for roles or calls, records filtered for reasoning, instances that failed."""
    failed = F.count_distinct(F.when(F.col("status") == "failed", F.col(instance)))
    return judged.agg(F.count_if(F.col("status").isin("roles", "calls")).alias("role_filtered"), F.count_if(F.col("status") == "reasoning").alias("reasoning_filtered"), failed.alias("failed_instances"))


def first_instances(judged: DataFrame, instances: DataFrame, n: int, with_records: bool = False) -> DataFrame:
    """Of whole_instances() those of the first n kept instances, in the order of ``instances`` (_instance_id, position).

    An instance without any record counts as kept, unless ``with_records``.
    """
    each = judged.groupBy("_instance_id").agg(F.max(F.col("status").isin(*LOST)).alias("bad"), F.count_if(F.col("status") == "kept").alias("n"))
    kept = instances.join(each, "_instance_id", "left").filter(~F.coalesce("bad", F.lit(False)) & (F.coalesce("n", F.lit(0)) >= int(with_records)))
    return whole_instances(judged).join(kept.orderBy("position").limit(n).select("_instance_id"), "_instance_id", "left_semi")


def convert_sessions(events: DataFrame, system: str, reminders: list[str], tools: list[dict], root: str, mode: str = "adaptive", threshold: float = 0.2) -> DataFrame:
    """Session lines (file_path, line_no, raw) to records with a status each; a session is an instance, named by its path below root."""
    found = convert.convert_sessions(events, system, reminders, convert.declared_order(tools))
    rows = found.select(F.col("file_path").alias("rec_id"), files.session_instance(F.col("file_path"), root).alias("_instance_id"), declared_tools(F.lit(json.dumps(tools))).alias("tools"), "converted.*")
    judged = with_status(rows.filter("error IS NULL").drop("error"), mode, threshold, calls=False)
    return judged.unionByName(rows.filter("error IS NOT NULL").drop("error").withColumn("status", F.lit("failed")), allowMissingColumns=True)


def convert_recorded(rows: DataFrame, system: str, tools: list[dict], first: int | None = None) -> DataFrame:
    """Recorded conversations (file_path, line_no, raw) to records with a status each.

    The first rows, in order of file and line, are taken before the model is looked at.  A conversation without user
    or assistant counts as one of wrong roles.
    """
    taken = rows if not first else rows.orderBy("file_path", "line_no").limit(first)
    own = taken.filter(convert.keep_claude_model(F.coalesce(F.get_json_object("raw", "$.model"), F.lit(""))))
    named = own.select(F.concat_ws("#", "file_path", "line_no").alias("rec_id"), F.coalesce(F.get_json_object("raw", "$.session_id"), F.lit("unknown")).alias("_instance_id"), declared_tools(F.lit(json.dumps(tools))).alias("tools"), convert.convert(F.col("raw"), "recorded").alias("c"))
    head = F.from_json(F.lit(json.dumps([{"role": "system", "content": system}])), f"array<{schema.MESSAGE}>")
    good = named.filter("c.error IS NULL").withColumn("messages", F.concat(head, F.col("c.messages"))).drop("c")
    status = F.when(F.col("c.error").contains(convert.NO_TURNS), "roles").otherwise("failed")
    bad = named.filter("c.error IS NOT NULL").withColumn("status", status).drop("c")
    return with_status(good, "adaptive", 0.0, calls=False).unionByName(bad, allowMissingColumns=True)


def convert_last_records(last: DataFrame, instances: DataFrame, mode: str = "adaptive", threshold: float = 0.2) -> DataFrame:
    """One record with status for each instance (_instance_id), from the last successful line of its file (_instance_id, raw).

    Statuses: no_file (no row), all_failed (a null line), no_choices, invalid, kept.  Kept records carry the request's
    generation parameters and usage as JSON.
    """
    rows = instances.select("_instance_id").join(last.withColumn("there", F.lit(True)), "_instance_id", "left").withColumn("c", convert.convert(F.col("raw"), "sdk"))
    body = F.get_json_object("raw", "$.request_body")
    rows = rows.select("_instance_id", "there", "raw", "c", declared_tools(F.get_json_object(body, "$.tools")).alias("tools"), generation_params(body).alias("_gen_params"), F.get_json_object("raw", "$.usage").alias("_usage"), F.col("c.messages").alias("messages"))
    judged = with_status(rows, mode, threshold)
    status = F.when(F.col("there").isNull(), "no_file").when(F.col("raw").isNull(), "all_failed").when(F.col("c.error").contains(convert.NO_CHOICES), "no_choices").when(F.col("c.error").isNotNull() | (F.col("status") != "kept"), "invalid").otherwise("kept")
    return judged.withColumn("status", status).select("_instance_id", "status", "tools", "messages", "think_mode", "_gen_params", "_usage")


#: The request's settings that are kept.
GENERATION = ("model", "max_tokens", "top_p", "temperature")


def generation_params(body: Column) -> Column:
    """JSON of those of GENERATION that a request body (JSON) has, as they are; a null that is there stays."""
    keys = F.json_object_keys(body)
    value = lambda k: F.variant_get(F.try_parse_json(body), f"$.{k}", "variant")
    items = [F.when(F.array_contains(keys, k), F.concat(F.lit(f'"{k}":'), F.coalesce(F.to_json(value(k)), F.lit("null")))) for k in GENERATION]
    return F.when(keys.isNotNull(), F.concat(F.lit("{"), F.concat_ws(",", *items), F.lit("}")))


def convert_records(rows: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """Converted records (rec_id, messages) of (rec_id, raw), and counts of the outcomes."""
    done = rows.withColumn("c", convert.convert(F.col("raw"), kind))
    status = F.when(F.col("c.error").isNotNull(), "failed").when(~validate.roles_valid(F.col("c.messages")), "roles").otherwise("kept")
    done = done.withColumn("status", status)
    return done.filter("status = 'kept'").select("rec_id", F.col("c.messages").alias("messages")), done.groupBy("status").count()


def token_statistics(lf: DataFrame, tokens=None) -> DataFrame:
    """Statistics of rendered records; ``tokens`` counts a text column's tokens, by default its words."""
    count = tokens or (lambda c: F.size(F.filter(F.split(c, r"\s+"), lambda x: x != "")))
    turns_ = F.size(F.filter("messages", lambda m: m["role"] == "assistant"))
    return stats.token_stats(lf.select(count(F.col("rendered")).alias("tokens"), turns_.alias("turns")))


def language(trajectories: DataFrame) -> DataFrame:
    return trajectories.select("rec_id", text.infer_language(normalize.first_user_text(F.col("messages"))).alias("language"))
