"""Writers: normalised JSON lines, chat-template records with their statistics, resumable parts."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def write_jsonl(records: DataFrame, path: str, order: str | None = None, single: bool = False) -> None:
    """One JSON object a line, null fields left out.  Spark's commit protocol makes the folder appear whole.

    ``single`` writes one file, in the order; only for results that fit one task.
    """
    columns = [c for c in records.columns if c != order]
    rows = records.select(*([order] if order else []), F.to_json(F.struct(*columns)).alias("value"))
    rows = rows.orderBy(order) if order else rows
    (rows.select("value").coalesce(1) if single else rows.select("value")).write.mode("overwrite").text(path)


def write_list(records: DataFrame, path: str, order: str, statistics: str | None = None) -> None:
    """One JSON list in a folder's single file, in an order, and beside it ``<path>.stats.json`` with the statistics.

    Only for results that fit one task; larger ones are better written by write_jsonl().
    """
    rows = records.select(order, F.to_json(F.struct(*(c for c in records.columns if c != order))).alias("value")).orderBy(order).select("value").coalesce(1)

    def bracketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = "["
        for batch in batches:
            out = []
            for v in batch.column(0).to_pylist():
                out.append(before + "\n" + json.dumps(json.loads(v), ensure_ascii=False, indent=4))
                before = ","
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if before == "[" else "]"])], ["value"])

    # the comma that separates two records begins the second one's line
    rows.mapInArrow(bracketed, "value string").write.mode("overwrite").text(path)
    if statistics is not None:
        records.sparkSession.createDataFrame([(statistics,)], "value string").coalesce(1).write.mode("overwrite").text(path.rstrip("/") + ".stats.json")


def write_pending(scored: DataFrame, path: str) -> None:
    """Append scored rows to a Parquet folder; with pending(), a stopped run goes on where it ended."""
    scored.write.mode("append").parquet(path)


def pending(rows: DataFrame, done: DataFrame, key: str = "rec_id") -> DataFrame:
    return rows.join(done.select(key), key, "left_anti")


def restore(rows: DataFrame, previous: DataFrame, prefix: str, key: str = "rec_pos") -> DataFrame:
    """Columns of an earlier output whose names begin with the prefix, joined by row position (or another key)."""
    kept = [c for c in previous.columns if c.startswith(prefix)]
    return rows.drop(*kept).join(previous.select(key, *kept), key, "left")


def chatml(messages: list[dict], tools: list[dict]) -> str:
    """The default chat template: each message between marks, with reasoning and calls in tags."""
    parts = [f"{START}system\n# Tools\n{json.dumps(tools, ensure_ascii=False)}{END}\n"] if tools else []
    for m in messages:
        body = f"<think>\n{m['reasoning_content']}\n</think>\n\n" if m.get("reasoning_content") else ""
        body += m.get("content") or ""
        for c in m.get("tool_calls") or []:
            f = c["function"]
            try:
                value = json.loads(f["arguments"])
            except (ValueError, TypeError):
                value = f["arguments"]
            body += f"\n<tool_call>\n{json.dumps({'name': f['name'], 'arguments': value}, ensure_ascii=False)}\n</tool_call>"
        parts.append(f"{START}{m['role']}\n{body}{END}\n")
    return "".join(parts)


def render(messages: Column, tools: Column, template: Callable[[list, list], str] = chatml) -> Column:
    """Rendered text of nested messages by a template (messages, tools) -> text."""

    @F.arrow_udf("string")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for ms, ts in batches:
            yield pa.array([template(m.as_py() or [], t.as_py() or []) for m, t in zip(ms, ts)], pa.string())

    return run(messages, tools)


def parse_rendered(rendered: Column, think_mode: Column) -> Column:
    """array<struct<role, content>> of rendered text; of fast records only what follows a think block."""
    turns = F.filter(F.transform(F.split(rendered, r"<\|im_end\|>"), lambda t: F.trim(F.regexp_replace(t, r"^\s+", ""))), lambda t: t.startswith(START))

    def one(t: Column) -> Column:
        content = F.regexp_extract(t, r"(?s)^[^\n]*\n?(.*)$", 1)
        later = F.regexp_replace(F.regexp_extract(content, r"(?s)^.*?</think>(.*)$", 1), r"^\s+|\s+$", "")
        role = F.regexp_extract(t, r"^<\|im_start\|>([^\n]*)", 1)
        return F.struct(role.alias("role"), F.when((think_mode == "fast") & content.contains("</think>"), later).otherwise(content).alias("content"))

    return F.filter(F.transform(turns, one), lambda m: m["role"] != "")


def to_lf(records: DataFrame, think_mode: Column, template: Callable[[list, list], str] = chatml, carry: tuple[str, ...] = ("_score", "_instance_id", "_agent_type", "_gen_params", "_usage", "_instance_metadata")) -> DataFrame:
    """rec_id, rendered, messages and the carried columns that exist."""
    rows = records.withColumn("__mode", think_mode).withColumn("rendered", render(F.col("messages"), F.col("tools"), template))
    return rows.select("rec_id", "rendered", parse_rendered(F.col("rendered"), F.col("__mode")).alias("messages"), *(c for c in carry if c in records.columns))


def step_lf(records: DataFrame) -> DataFrame:
    """Records of typed commands keep their messages as they are, and three columns."""
    return records.select("messages", *(c for c in ("_score", "_instance_id", "_instance_metadata") if c in records.columns))
