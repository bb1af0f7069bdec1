"""Files of agent runs as DataFrames: JSON lines in order, job folders, sessions, step files, lists."""

from __future__ import annotations

import json
import os
import tomllib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trajectra import schema
from trajectra.functions import text


def lines(spark: SparkSession, *paths: str, **options) -> DataFrame:
    """file_path, line_no (from 1, blank lines left out) and raw of text files, in the files' order.

    Files are split between tasks as usual; only the order within one file is ranked.
    """
    raw = spark.read.options(**options).text([*paths]).select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("raw"))
    order = Window.partitionBy("file_path").orderBy("block", "at")
    return raw.filter(text.strip(F.col("raw")) != "").withColumn("line_no", F.row_number().over(order).cast("bigint")).select("file_path", "line_no", "raw")


def json_lines(spark: SparkSession, *paths: str, strict: bool = False) -> DataFrame:
    """lines() that hold JSON; others are left out, or with ``strict`` fail the query."""
    rows = lines(spark, *paths)
    return _strict(rows) if strict else rows.filter(F.try_parse_json("raw").isNotNull())


def _strict(rows: DataFrame) -> DataFrame:
    return rows.withColumn("raw", F.when(F.try_parse_json("raw").isNotNull(), F.col("raw")).otherwise(F.raise_error(F.concat(F.lit("malformed JSON in "), "file_path"))))


def json_documents(spark: SparkSession, *paths: str) -> DataFrame:
    """file_path and raw of files that are one JSON document each."""
    return spark.read.text([*paths], wholetext=True).select(F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("raw"))


#: Fields of a record that may stand at its top or in meta_info.unique_info; the top one counts.
LIFTED = ("_instance_id", "_agent_type", "_score", "_gen_params", "_usage", "_instance_metadata")


def trajectories(rows: DataFrame) -> DataFrame:
    """Trajectories from JSON records (file_path, line_no, raw) in the normalised form.

    A nested field is lifted only where the record has no such key at its top; a null there counts.
    """
    has = lambda k: F.array_contains("top", k)
    lift = {k: F.when(has(k), F.get_json_object("raw", f"$.{k}")).otherwise(F.get_json_object("raw", f"$.meta_info.unique_info.{k}")) for k in LIFTED}
    rows = rows.withColumn("top", F.coalesce(F.json_object_keys("raw"), F.expr("CAST(array() AS array<string>)")))
    parsed = F.from_json("raw", f"struct<tools:array<{schema.TOOL}>,messages:array<{schema.MESSAGE}>>")
    return rows.withColumn("p", parsed).select(F.concat_ws("#", "file_path", "line_no").alias("rec_id"), F.col("line_no").alias("rec_pos"), *(c.alias(k) for k, c in lift.items()), F.col("p.tools").alias("tools"), F.col("p.messages").alias("messages"))


def read_trajectories(spark: SparkSession, *paths: str) -> DataFrame:
    return trajectories(json_lines(spark, *paths))


def first_records(rows: DataFrame, n: int, position: str = "rec_pos") -> DataFrame:
    """The first n input rows, by position."""
    return rows.filter(F.col(position) <= n) if n > 0 else rows


# ---- job folders ----

_RESULTS = "struct<stats:struct<evals:map<string,struct<reward_stats:struct<reward:map<string,array<string>>>>>>>"
#: Reward keys are compared as they are written.
STATUS_KEYS = {"resolved": ("1.0",), "unresolved": ("0.0",)}


def job_folders(results: DataFrame, status: str = "resolved") -> DataFrame:
    """folder and place of the trials of a job's result.json (column raw) with a status; `all` takes every reward."""
    evals = results.select(F.posexplode(F.map_entries(F.from_json("raw", _RESULTS)["stats"]["evals"])).alias("eval_pos", "e"))
    rewards = evals.select("eval_pos", F.posexplode(F.map_entries(F.col("e.value.reward_stats.reward"))).alias("reward_pos", "r"))
    if status != "all":
        rewards = rewards.filter(F.col("r.key").isin(*STATUS_KEYS[status]))
    return rewards.select("eval_pos", "reward_pos", F.posexplode("r.value").alias("pos", "folder"))


def trial_tasks(configs: DataFrame) -> DataFrame:
    """folder, task_dir and instance_id from trial configs (file_path, raw): the task path's last part names the instance."""
    folder = F.element_at(F.split("file_path", "/"), -2)
    base = F.regexp_replace("file_path", "/[^/]*$", "")
    path = F.get_json_object("raw", "$.task.path")
    home = F.lit(os.path.expanduser("~"))
    full = F.when(path.rlike("^~(/|$)"), F.concat(home, F.substring(path, F.lit(2), F.length(path)))).when(path.startswith("/"), path).otherwise(F.concat_ws("/", base, path))
    ok = text.strip(F.coalesce(path, F.lit(""))) != ""
    return configs.select(folder.alias("folder"), F.when(ok, full).alias("task_dir"), F.when(ok, F.element_at(F.split(F.regexp_replace(full, "/+$", ""), "/"), -1)).alias("instance_id"))


def instance_of_folder(folder: Column) -> Column:
    """A trial folder's name without its last `__` part."""
    return F.regexp_replace(folder, r"(?s)^(.*)__.*$", "$1")


def toml_table(content: Column, name: str = "metadata") -> Column:
    """A table of TOML text as JSON; null without it or for malformed text."""

    @F.arrow_udf("string")
    def parse(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for values in batches:
            out = []
            for v in values:
                try:
                    found = tomllib.loads(v.as_py() or "").get(name)
                except tomllib.TOMLDecodeError:
                    found = None
                out.append(json.dumps(found, ensure_ascii=False, default=str) if isinstance(found, dict) else None)
            yield pa.array(out, pa.string())

    return parse(content)


def with_metadata(rows: DataFrame, metadata: DataFrame, key: str = "_instance_id") -> DataFrame:
    """Rows with the instance's metadata (key, _instance_metadata), null where there is none."""
    return rows.join(metadata, key, "left")


# ---- sessions, step files, last records ----


def session_files(spark: SparkSession, root: str) -> list[str]:
    """Session files below a root, sorted: those in job folders' session projects, or without any those in the root itself."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    for pattern in ("*/agent/sessions/projects/-testbed/*.jsonl", "*.jsonl"):
        at = path(f"{root.rstrip('/')}/{pattern}")
        found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
        if found:
            return sorted(f.getPath().toString() for f in found)
    return []


def conversation_files(spark: SparkSession, root: str) -> DataFrame:
    """Lines (file_path, line_no, raw) of every conversations.jsonl below a root, at any depth; a malformed one fails the query."""
    return _strict(lines(spark, root, recursiveFileLookup=True, pathGlobFilter="conversations.jsonl"))


def tool_definitions(spark: SparkSession, path: str) -> list[dict]:
    """A file's JSON list of tools, as functions with parameters (its small content comes to the driver)."""
    raw = json.loads(json_documents(spark, path).first()["raw"])
    out = []
    for t in raw:
        f = t.get("function") or t
        out.append({"type": "function", "function": {"name": f.get("name", ""), "description": f.get("description", ""), "parameters": f.get("parameters") or f.get("input_schema") or {}}})
    return out


def session_instance(file_path: Column, root: str) -> Column:
    """First folder below the root, or the file's stem if it lies in the root itself."""
    inner = F.regexp_replace(F.replace(file_path, F.lit(root.rstrip("/") + "/"), F.lit("")), "^/+", "")
    return F.when(inner.contains("/"), F.substring_index(inner, "/", 1)).otherwise(F.regexp_replace(inner, r"\.[^.]*$", ""))


def session_events(rows: DataFrame) -> DataFrame:
    """Lines of type user or assistant."""
    return rows.filter(F.get_json_object("raw", "$.type").isin("user", "assistant"))


def last_records(rows: DataFrame, only_success: bool = False) -> DataFrame:
    """The last line of each file, or the last whose success isn't literally false."""
    from trajectra.operators.dedup import not_failed

    kept = rows.filter(not_failed(F.col("raw"))) if only_success else rows
    return kept.groupBy("file_path").agg(F.max_by("raw", "line_no").alias("raw"), F.max("line_no").alias("line_no"))


def ordered_files(rows: DataFrame) -> DataFrame:
    """Files with their rank by the time in their names (`digits.digits`; none sorts first), then by name."""
    name = F.element_at(F.split("file_path", "/"), -1)
    stamp = F.coalesce(F.nullif(F.regexp_extract(name, r"\d+\.\d+", 0), F.lit("")).cast("double"), F.lit(float("-inf")))
    folder = F.regexp_replace("file_path", "/[^/]*$", "")
    return rows.withColumn("folder", folder).withColumn("rank", F.row_number().over(Window.partitionBy("folder").orderBy(stamp, name)))


def repo_list(spark: SparkSession, path: str) -> DataFrame:
    """repo: one `owner/name` a line; blank lines and those after # are left out."""
    value = F.trim("value")
    return spark.read.text(path).select(value.alias("repo")).filter((F.col("repo") != "") & ~F.col("repo").startswith("#")).distinct()


def prompt_blocks(raw: Column, strip_each: bool = True) -> Column:
    """Text of a prompt file's blocks, joined by blank lines."""
    texts = F.transform(F.from_json(raw, "struct<blocks:array<struct<text:string>>>")["blocks"], lambda b: text.strip(b["text"]) if strip_each else b["text"])
    return F.array_join(F.filter(texts, lambda t: t.isNotNull() & (t != "")), "\n\n")
