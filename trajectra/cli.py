"""Command line: ``python -m trajectra.cli COMMAND ...`` converts, deduplicates, scores and judges files of agent runs.

Outputs are folders of JSON lines; ``--single`` writes one file in input order, for small results.
"""

from __future__ import annotations

import argparse
import importlib
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajectra.operators import dedup, judge, metrics, normalize, relations, stats, validate
from trajectra.plans import flows, reports
from trajectra.sources import files, sinks


def _common(p: argparse.ArgumentParser, source: str, reasoning: bool = True) -> None:
    p.add_argument(f"--{source}", required=True)
    p.add_argument("--im-output", required=True, help="folder of normalised JSON lines")
    p.add_argument("--lf-output", help="folder of a rendered JSON list, with a statistics file beside it")
    p.add_argument("--max-instances", type=int)
    p.add_argument("--exclude-repos-file")
    p.add_argument("--single", action="store_true")
    p.add_argument("--day", default="", help="date of the records' meta information")
    if reasoning:
        p.add_argument("--reasoning-check-mode", choices=("strict", "adaptive"), default="adaptive")
        p.add_argument("--reasoning-content-ratio-threshold", type=float, default=0.2)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="trajectra", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)
    for name in ("convert-logged", "convert-last", "convert-steps"):
        p = commands.add_parser(name)
        _common(p, "job-dir", reasoning=name != "convert-steps")
        p.add_argument("--instance-status", choices=("resolved", "unresolved", "all"), default="resolved")
        if name == "convert-logged":
            p.add_argument("--skip-titles", action="store_true", help="leave out calls that make a title; an instance needs a record")
            p.add_argument("--rename-model", nargs=2, metavar=("OLD", "NEW"))
    for name in ("convert-sessions", "convert-recorded"):
        p = commands.add_parser(name)
        _common(p, "source-dir", reasoning=name == "convert-sessions")
        p.add_argument("--system-prompt-json", required=True)
        p.add_argument("--tools-json", required=True)
        if name == "convert-sessions":
            p.add_argument("--reminders-json")
    p = commands.add_parser("dedup")
    p.add_argument("-i", "--input", required=True)
    p.add_argument("-o", "--output", required=True)
    p = commands.add_parser("score")
    p.add_argument("-i", "--input", required=True)
    p.add_argument("-o", "--output", required=True)
    p.add_argument("--max-instances", type=int, default=0)
    p.add_argument("--scaffold", choices=("claudecode", "opencode", "openhands", "openhands_sdk", "terminus2"))
    p.add_argument("--quiet", action="store_true")
    for name in ("judge", "judge-checklist"):
        p = commands.add_parser(name)
        p.add_argument("-i", "--input", required=True)
        p.add_argument("-o", "--output", required=True)
        p.add_argument("--client", help="module:function from a prompt to a text")
        p.add_argument("--max-instances", type=int, default=0)
        if name == "judge":
            p.add_argument("--checklist", required=True, help="JSON file: category to list of checks")
            p.add_argument("--dry-run", action="store_true")
            p.add_argument("--rates", type=float, nargs=2, default=(2.5, 10.0), help="price of a million tokens in and out")
    return top


def _client(name: str | None):
    if not name:
        raise SystemExit("--client is needed")
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def _save(a: argparse.Namespace, records: DataFrame) -> None:
    """Records as normalised lines and, where asked for, rendered."""
    im = normalize.to_im(records, a.day)
    sinks.write_jsonl(im, a.im_output, order="rec_id", single=a.single)
    if a.lf_output:
        lf = sinks.to_lf(records, normalize.think_mode(F.col("messages")))
        sinks.write_list(lf.drop("rendered"), a.lf_output, "rec_id", reports.side_statistics(lf, records))


def _trials(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """_instance_id, position and folder of a job's trials with the asked status, without excluded repositories."""
    job = a.job_dir.rstrip("/")
    folders = files.job_folders(files.json_documents(spark, f"{job}/result.json"), a.instance_status)
    tasks = files.trial_tasks(files.json_documents(spark, f"{job}/*/config.json")).select("folder", "instance_id")
    named = folders.join(tasks, "folder", "left").withColumn("_instance_id", F.coalesce("instance_id", files.instance_of_folder(F.col("folder"))))
    kept = named.select("folder", "_instance_id", F.struct("eval_pos", "reward_pos", "pos").alias("position"))
    return validate.without_repos(kept, files.repo_list(spark, a.exclude_repos_file)) if a.exclude_repos_file else kept


def _logs(spark: SparkSession, a: argparse.Namespace, trials: DataFrame) -> DataFrame:
    rows = files.lines(spark, f"{a.job_dir.rstrip('/')}/*/agent/litellm-trajectory.jsonl")
    return rows.withColumn("folder", F.element_at(F.split("file_path", "/"), -3)).join(F.broadcast(trials.select("folder", "_instance_id")), "folder")


def _limited(a: argparse.Namespace, judged: DataFrame, instances: DataFrame, with_records: bool) -> DataFrame:
    kept = flows.first_instances(judged, instances, a.max_instances, with_records) if a.max_instances is not None else flows.whole_instances(judged)
    print("skipped:", flows.skip_counts(judged).first().asDict())
    return kept


def convert_logged(spark: SparkSession, a: argparse.Namespace) -> None:
    trials = _trials(spark, a)
    logged = _logs(spark, a, trials).select(F.col("_instance_id").alias("instance_id"), "line_no", "raw")
    judged = flows.logged_records(logged, a.reasoning_check_mode, a.reasoning_content_ratio_threshold, a.skip_titles, tuple(a.rename_model) if a.rename_model else None).cache()
    _save(a, _limited(a, judged, trials, a.skip_titles))


def convert_last(spark: SparkSession, a: argparse.Namespace) -> None:
    trials = _trials(spark, a)
    rows = _logs(spark, a, trials)
    last = files.last_records(rows, only_success=True).select("file_path", "raw")
    seen = rows.select("file_path", "_instance_id").distinct().join(last, "file_path", "left").select("_instance_id", "raw")
    judged = flows.convert_last_records(seen, trials.select("_instance_id"), a.reasoning_check_mode, a.reasoning_content_ratio_threshold).cache()
    print({r["status"]: r["count"] for r in judged.groupBy("status").count().collect()})
    kept = judged.filter("status = 'kept'").join(trials.select("_instance_id", "position"), "_instance_id")
    kept = kept if a.max_instances is None else kept.orderBy("position").limit(a.max_instances)
    _save(a, kept.select(F.col("_instance_id").alias("rec_id"), "_instance_id", "tools", "messages", "_gen_params", "_usage"))


def convert_steps(spark: SparkSession, a: argparse.Namespace) -> None:
    trials = _trials(spark, a)
    docs = files.json_documents(spark, f"{a.job_dir.rstrip('/')}/*/agent/trajectory.json").withColumn("folder", F.element_at(F.split("file_path", "/"), -3))
    rows = docs.join(F.broadcast(trials), "folder").select(F.col("folder").alias("rec_id"), "raw")
    kept, counts = flows.convert_records(rows, "steps")
    print({r["status"]: r["count"] for r in counts.collect()})
    named = kept.join(trials.select(F.col("folder").alias("rec_id"), "_instance_id", "position"), "rec_id").withColumn("tools", F.lit(None).cast("array<struct<type:string,function:struct<name:string,description:string,parameters:string>>>"))
    _save(a, (named if a.max_instances is None else named.orderBy("position").limit(a.max_instances)).drop("position"))


def convert_sessions(spark: SparkSession, a: argparse.Namespace) -> None:
    prompt = lambda path, strip=True: files.json_documents(spark, path).select(files.prompt_blocks(F.col("raw"), strip)).first()[0]
    found = files.session_files(spark, a.source_dir)
    if not found:
        raise SystemExit(f"no sessions below {a.source_dir}")
    reminders = [b["text"] for b in json.loads(files.json_documents(spark, a.reminders_json).first()["raw"])["blocks"]] if a.reminders_json else []
    root = found[0][: found[0].index(a.source_dir.rstrip("/").split("://")[-1])] + a.source_dir.rstrip("/").split("://")[-1]
    events = files.session_events(files.json_lines(spark, *found))
    judged = flows.convert_sessions(events, prompt(a.system_prompt_json), reminders, files.tool_definitions(spark, a.tools_json), root, a.reasoning_check_mode, a.reasoning_content_ratio_threshold).cache()
    instances = judged.groupBy("_instance_id").agg(F.min("rec_id").alias("position"))
    if a.exclude_repos_file:
        instances = validate.without_repos(instances, files.repo_list(spark, a.exclude_repos_file))
        judged = judged.join(instances.select("_instance_id"), "_instance_id", "left_semi")
    _save(a, _limited(a, judged, instances, True))


def convert_recorded(spark: SparkSession, a: argparse.Namespace) -> None:
    system = files.json_documents(spark, a.system_prompt_json).select(files.prompt_blocks(F.col("raw"))).first()[0]
    rows = files.conversation_files(spark, a.source_dir)
    if a.exclude_repos_file:
        rows = validate.without_repos(rows.withColumn("__repo", validate.repo_of_path(F.col("file_path"))), files.repo_list(spark, a.exclude_repos_file), "__repo").drop("__repo")
    judged = flows.convert_recorded(rows, system, files.tool_definitions(spark, a.tools_json), a.max_instances).cache()
    print("skipped:", flows.skip_counts(judged).first().asDict())
    _save(a, judged.filter("status = 'kept'").drop("status"))


def dedup_file(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = files.lines(spark, a.input).withColumn("instance_id", F.lit("all"))
    kept = dedup.dedup_requests(rows.select("instance_id", "line_no", "raw"))
    kept.orderBy("pos").select(F.col("raw").alias("value")).write.mode("overwrite").text(a.output)


def score(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = files.first_records(files.read_trajectories(spark, a.input), a.max_instances)
    scored = flows.score(rows.withColumn("scaffold", F.lit(a.scaffold)) if a.scaffold else rows).drop("scaffold").cache()
    sinks.write_jsonl(scored.drop("rec_id"), a.output, order="rec_pos")
    if not a.quiet:
        flat = scored.filter("_score IS NOT NULL").select("_score.*")
        stats.score_summary(flat, [c for c in flat.columns if c.endswith("_score")]).orderBy("metric", "scaffold").show(200, False)
        print(reports.tool_error_text(stats.tool_error_rate(metrics.error_counts(relations.profiles(relations.steps(rows))))))


def judge_records(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = files.first_records(files.read_trajectories(spark, a.input), a.max_instances)
    checklist = json.loads(files.json_documents(spark, a.checklist).first()["raw"])
    if a.dry_run:
        print(reports.dry_run(rows, checklist, *a.rates).first().asDict())
        return
    got = judge.fixed_scores(rows, _client(a.client), checklist)
    got.write.mode("overwrite").json(a.output)
    done = spark.read.schema(got.schema).json(a.output)
    reports.llm_summary(rows.select("rec_id", "_agent_type").join(done, "rec_id", "left"), judge.CATEGORY_COLUMNS, "llm_composite_score", "llm_error").show(20, False)


def judge_checklist(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = files.first_records(files.read_trajectories(spark, a.input), a.max_instances).filter("coalesce(_agent_type, 'main') <> 'subagent'")
    got = judge.checklist_scores(rows, _client(a.client))
    got.write.mode("overwrite").json(a.output)
    done = spark.read.schema(got.schema).json(a.output).withColumn("_agent_type", F.lit("main"))
    reports.llm_summary(done, {"isr": "isr"}, "csr", "error").show(20, False)
    reports.category_summary(done).show(200, False)


COMMANDS = {"convert-logged": convert_logged, "convert-last": convert_last, "convert-steps": convert_steps, "convert-sessions": convert_sessions, "convert-recorded": convert_recorded, "dedup": dedup_file, "score": score, "judge": judge_records, "judge-checklist": judge_checklist}


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(arguments)
    COMMANDS[a.command](spark or SparkSession.builder.appName("trajectra").getOrCreate(), a)


if __name__ == "__main__":
    main(sys.argv[1:])
