"""Normalisation of records: messages, tools, ids, meta information, tool names, kinds of record."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajectra import schema
from trajectra.functions import patterns as P
from trajectra.functions import text

#: Defaults of the meta information.
META_DEFAULTS = {"teacher": "glm-5-thinking", "query_source": "synthesized", "owner": "00000000", "category": "code"}


def json_udf(rule: Callable[[str | None], str | None]) -> Callable[[Column], Column]:
    """A column function from a rule on JSON text; used where key order must survive, which SQL functions don't keep."""

    def apply(column: Column) -> Column:
        @F.arrow_udf("string")
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for values in batches:
                yield pa.array([rule(v.as_py()) for v in values], pa.string())

        return run(column)

    return apply


def compact(value) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def canonical_arguments(raw: str | None) -> str:
    """Arguments as compact JSON: text that doesn't parse becomes a JSON string, null an empty object."""
    if raw is None:
        return "{}"
    try:
        return compact(json.loads(raw))
    except ValueError:
        return compact(raw)


def ordered_arguments(raw: str | None, order: list[str]) -> str:
    """Compact JSON arguments with the declared properties first, in their order, others after in theirs."""
    try:
        value = json.loads(raw) if raw else {}
    except ValueError:
        return canonical_arguments(raw)
    if not isinstance(value, dict):
        return compact(value)
    return compact({k: value[k] for k in order if k in value} | {k: v for k, v in value.items() if k not in order})


args_canon = json_udf(canonical_arguments)


def args_reorder(raw: Column, order: Column) -> Column:
    @F.arrow_udf("string")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for values, orders in batches:
            yield pa.array([ordered_arguments(v.as_py(), o.as_py() or []) for v, o in zip(values, orders)], pa.string())

    return run(raw, order)


def property_order(tools: Column) -> Column:
    """map of tool name to its declared properties in order; of equal names the last counts."""
    entries = F.transform(F.coalesce(tools, F.array()), lambda t: F.struct(t["function"]["name"].alias("key"), F.coalesce(F.json_object_keys(F.get_json_object(t["function"]["parameters"], "$.properties")), F.expr("CAST(array() AS array<string>)")).alias("value")))
    named = F.filter(entries, lambda e: e["key"].isNotNull() & (e["key"] != ""))
    last = F.filter(named, lambda e, i: ~F.exists(F.slice(named, i + 2, F.size(named)), lambda later: later["key"] == e["key"]))
    return F.map_from_entries(last)


def _message(role, content, reasoning, calls, like: Column) -> Column:
    return F.struct(role.alias("role"), like["name"].alias("name"), content.alias("content"), reasoning.alias("reasoning_content"), calls.alias("tool_calls"), like["weight"].alias("weight"), F.when(role == "tool", like["tool_call_id"]).alias("tool_call_id"))


def messages(column: Column) -> Column:
    """Messages with a role; a leading think block becomes reasoning unless there is some; a system message comes first."""
    kept = F.filter(F.coalesce(column, F.expr(f"CAST(array() AS array<{schema.MESSAGE}>)")), lambda m: F.coalesce(m["role"], F.lit("")) != "")

    def clean(m: Column) -> Column:
        content = F.coalesce(m["content"], F.lit(""))
        thought, rest = text.think_parts(content)
        acting = m["role"] == "assistant"
        given = F.coalesce(text.strip(m["reasoning_content"]), F.lit(""))
        reasoning = F.when(acting, F.nullif(F.when(given != "", m["reasoning_content"]).otherwise(thought), F.lit("")))
        calls = F.when(acting & (F.size(m["tool_calls"]) > 0), F.transform(m["tool_calls"], lambda c: F.struct(F.nullif(c["id"], F.lit("")).alias("id"), F.lit("function").alias("type"), F.struct(F.coalesce(c["function"]["name"], F.lit("")).alias("name"), F.coalesce(c["function"]["arguments"], F.lit("{}")).alias("arguments")).alias("function"))))
        return _message(m["role"], F.when(acting, rest).otherwise(content), reasoning, calls, m)

    done = F.transform(kept, clean).cast(f"array<{schema.MESSAGE}>")
    system = F.expr(f"CAST(array(named_struct('role', 'system', 'name', CAST(NULL AS string), 'content', '', 'reasoning_content', CAST(NULL AS string), 'tool_calls', CAST(NULL AS array<{schema.CALL}>), 'weight', CAST(NULL AS double), 'tool_call_id', CAST(NULL AS string))) AS array<{schema.MESSAGE}>)")
    return F.when(F.get(done, F.lit(0))["role"] == "system", done).otherwise(F.concat(system, done))


def tools(column: Column) -> Column:
    """Tools as functions; missing parameters are an empty object."""
    return F.transform(F.coalesce(column, F.array()), lambda t: F.struct(F.lit("function").alias("type"), F.struct(F.coalesce(t["function"]["name"], F.lit("")).alias("name"), F.coalesce(t["function"]["description"], F.lit("")).alias("description"), F.coalesce(F.nullif(t["function"]["parameters"], F.lit("")), F.lit("{}")).alias("parameters")).alias("function")))


def first_user_text(column: Column) -> Column:
    return F.get(F.filter(F.transform(F.filter(column, lambda m: m["role"] == "user"), lambda m: m["content"]), lambda c: text.strip(F.coalesce(c, F.lit(""))) != ""), F.lit(0))


def think_mode(column: Column, stated: Column | None = None) -> Column:
    """fast or slow as stated, else slow if any assistant message has reasoning."""
    found = F.when(F.exists(column, lambda m: (m["role"] == "assistant") & (F.coalesce(m["reasoning_content"], F.lit("")) != "")), "slow").otherwise("fast")
    return found if stated is None else F.when(stated.isin("fast", "slow"), stated).otherwise(found)


def rounds(column: Column) -> Column:
    return F.size(F.filter(column, lambda m: m["role"] == "assistant")).cast("bigint")


def meta(messages_column: Column, day: str, given: dict[str, Column] | None = None) -> Column:
    """Meta information: given values that aren't empty, else the defaults; ``day`` stands for both dates."""
    given = given or {}
    value = lambda key, default: F.coalesce(F.nullif(given[key], F.lit("")), F.lit(default)) if key in given else F.lit(default)
    language = F.coalesce(F.nullif(given["language"], F.lit("")), text.infer_language(first_user_text(messages_column))) if "language" in given else text.infer_language(first_user_text(messages_column))
    return F.struct(
        value("teacher", META_DEFAULTS["teacher"]).alias("teacher"), value("query_source", META_DEFAULTS["query_source"]).alias("query_source"),
        value("response_generate_time", day).alias("response_generate_time"), value("response_update_time", day).alias("response_update_time"),
        value("owner", META_DEFAULTS["owner"]).alias("owner"), language.alias("language"), value("category", META_DEFAULTS["category"]).alias("category"),
        F.coalesce(given.get("rounds", F.lit(None).cast("bigint")), rounds(messages_column)).alias("rounds"),
    )


def to_im(records: DataFrame, day: str, unique: tuple[str, ...] = ("_instance_id", "_agent_type")) -> DataFrame:
    """version, meta_info (with the named columns in unique_info), tools and messages; rec_id stays for order."""
    m = messages(F.col("messages"))
    info = F.struct(*(F.col(c).alias(c) for c in unique if c in records.columns)) if any(c in records.columns for c in unique) else F.lit(None)
    out = records.withColumn("messages", m).withColumn("tools", tools(F.col("tools")))
    return out.select("rec_id", F.lit(schema.VERSION).alias("version"), meta(F.col("messages"), day).withField("unique_info", info).alias("meta_info"), "tools", "messages")


def is_im(column: Column) -> Column:
    """Whether messages are a non-empty list whose members all have a role."""
    return F.coalesce((F.size(column) > 0) & F.forall(column, lambda m: m["role"].isNotNull()), F.lit(False))


def agent_type(tools_column: Column) -> Column:
    """subagent if there are tools and none edits or writes, else main."""
    lower = F.transform(F.coalesce(tools_column, F.array()), lambda t: F.lower(t["function"]["name"]))
    return F.when((F.size(lower) > 0) & ~F.arrays_overlap(lower, F.array(F.lit("edit"), F.lit("write"))), "subagent").otherwise("main")


def canonical_name(name: Column, params: Column) -> Column:
    """The usual name of a tool with these parameters; null where it has one, or none fits."""
    has = lambda *keys: F.arrays_overlap(params, F.array(*map(F.lit, keys)))
    known = F.lower(name).isin(*P.SHELL_TOOLS, *P.EDITORS, *P.EDIT_TOOLS, "finish", "think", "task_tracker")
    return (
        F.when(known, F.lit(None).cast("string"))
        .when(has("task_completed"), "finish")
        .when(has("thought") & ~has("command", "path"), "think")
        .when(has("task_list"), "task_tracker")
        .when(has("old_str", "new_str", "file_text", "view_range"), "str_replace_editor")
        .when(has("command") & has("is_input", "timeout"), "execute_bash")
        .when(has("command") & has("path"), "str_replace_editor")
    )


def canonicalize(records: DataFrame) -> DataFrame:
    """Renamed tools take their usual names, in definitions and in calls."""
    props = F.coalesce(property_order(F.col("tools")), F.expr("CAST(map() AS map<string,array<string>>)"))
    rows = records.withColumn("__props", props)
    renames = F.map_filter(F.transform_values("__props", lambda k, v: canonical_name(k, v)), lambda k, v: v.isNotNull())
    rows = rows.withColumn("__names", renames)
    new = lambda name: F.coalesce(F.try_element_at("__names", name), name)
    tool = lambda t: t.withField("function", t["function"].withField("name", new(t["function"]["name"])))
    message = lambda m: F.when((m["role"] == "assistant") & m["tool_calls"].isNotNull(), m.withField("tool_calls", F.transform(m["tool_calls"], tool))).otherwise(m)
    return rows.withColumn("tools", F.transform("tools", tool)).withColumn("messages", F.transform("messages", message)).drop("__props", "__names")


def replace_model_name(column: Column, old: str, new: str) -> Column:
    """The model's name replaced in a leading system message."""
    return F.transform(column, lambda m, i: F.when((i == 0) & (m["role"] == "system"), m.withField("content", F.replace(m["content"], F.lit(old), F.lit(new)))).otherwise(m))


def truncate_messages(column: Column, tool: int = 5_000, assistant: int = 50_000, reasoning: int = 50_000) -> Column:
    """Long contents cut in the middle; assistant messages get their 0-based index."""

    def cut(m: Column, i: Column) -> Column:
        acting = m["role"] == "assistant"
        content = F.when(acting, text.truncate_middle(m["content"], assistant)).when(m["role"] == "tool", text.truncate_middle(m["content"], tool)).otherwise(m["content"])
        turn = F.when(acting, F.size(F.filter(F.slice(column, F.lit(1), i + 1), lambda x: x["role"] == "assistant")) - 1)
        return F.struct(m["role"].alias("role"), content.alias("content"), text.truncate_middle(m["reasoning_content"], reasoning).alias("reasoning_content"), m["tool_calls"].alias("tool_calls"), turn.alias("assistant_turn_index"))

    return F.transform(column, cut)


def attach_reasoning(column: Column, by_turn: Column) -> Column:
    """Reasoning from a map of 0-based assistant index to text; indexes beyond the record are left out."""

    def attach(m: Column, i: Column) -> Column:
        turn = F.size(F.filter(F.slice(column, F.lit(1), i + 1), lambda x: x["role"] == "assistant")) - 1
        return F.when(m["role"] == "assistant", m.withField("reasoning_content", F.coalesce(F.try_element_at(by_turn, turn), m["reasoning_content"]))).otherwise(m)

    return F.transform(column, attach)
