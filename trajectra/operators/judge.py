"""Scores by a language model behind an interface: prompts, calls, answers, rewards.

A client is a function from a prompt to a text.  It is called inside tasks with a few
threads each; a task that runs again calls it again, so a client should answer from a
store keyed by the prompt's hash.  Each distinct checklist request is made once.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajectra.functions import text
from trajectra.operators import normalize, stats

Client = Callable[[str], str]
#: Names of result columns, limits, attempts.
CATEGORY_COLUMNS = {"F": "llm_f_problem_understanding", "G": "llm_g_solution_quality", "H": "llm_h_reasoning_quality", "I": "llm_i_verification_rigor", "J": "llm_j_efficiency"}
CHECKS_PER_CATEGORY = 3
QUESTION_CHARS, SYSTEM_CHARS, TOOLS_CHARS = 12_000, 8_000, 10_000
ATTEMPTS, FIRST_PAUSE = 3, 2.0
QUESTION_FIELDS = ("question", "problem_statement", "query", "prompt", "task", "instruction")


def ask(client: Client, prompt: str, attempts: int = ATTEMPTS, pause: float = FIRST_PAUSE) -> tuple[str | None, str | None]:
    """Answer or error; failed calls are repeated after doubling pauses."""
    for k in range(attempts):
        try:
            return client(prompt), None
        except Exception as e:  # a client may raise anything; the row keeps the error
            error = f"{type(e).__name__}: {e}"[:300]
            if k + 1 < attempts:
                time.sleep(pause * 2**k)
    return None, error


def answers(prompt: Column, client: Client, threads: int = 8, pause: float = FIRST_PAUSE) -> Column:
    """struct<answer, error> of each prompt."""

    @F.arrow_udf("struct<answer:string,error:string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        with ThreadPoolExecutor(threads) as pool:
            for prompts in batches:
                got = [*pool.map(lambda p: ask(client, p.as_py() or "", pause=pause), prompts)]
                yield pa.StructArray.from_arrays([pa.array([a for a, _ in got], pa.string()), pa.array([e for _, e in got], pa.string())], ["answer", "error"])

    return run(prompt)


def system_text(messages: Column) -> Column:
    first = F.get(F.filter(messages, lambda m: m["role"] == "system"), F.lit(0))["content"]
    return text.truncate_middle(F.coalesce(first, F.lit("")), SYSTEM_CHARS)


def question(messages: Column, stated: dict[str, Column] | None = None) -> tuple[Column, Column]:
    """The user's question and where it comes from: the first stated field that isn't blank, else the first user message."""
    stated = stated or {}
    picks = [(k, stated[k]) for k in QUESTION_FIELDS if k in stated]
    value, source = normalize.first_user_text(messages), F.lit("first_user_message")
    for k, c in reversed(picks):
        filled = text.strip(F.coalesce(c, F.lit(""))) != ""
        value, source = F.when(filled, c).otherwise(value), F.when(filled, k).otherwise(source)
    return text.truncate_middle(F.coalesce(value, F.lit("")), QUESTION_CHARS), source


def tools_summary(tools: Column) -> Column:
    """A line for each tool: name, the start of its description, sorted parameter names."""
    keys = lambda t: F.array_join(F.array_sort(F.coalesce(F.json_object_keys(F.get_json_object(t["function"]["parameters"], "$.properties")), F.expr("CAST(array() AS array<string>)"))), ", ")
    line = lambda t: F.concat(F.lit("- "), F.coalesce(t["function"]["name"], F.lit("")), F.lit(": "), F.substring(F.coalesce(t["function"]["description"], F.lit("")), 1, 200), F.lit(" (params: "), keys(t), F.lit(")"))
    return text.truncate_middle(F.array_join(F.transform(F.coalesce(tools, F.array()), line), "\n"), TOOLS_CHARS)


def trajectory_text(tools: Column, messages: Column) -> Column:
    return F.concat(F.lit("Tools:\n"), F.coalesce(F.to_json(tools), F.lit("[]")), F.lit("\n\nMessages:\n"), F.to_json(normalize.truncate_messages(messages)))


def rating_prompt(tools: Column, messages: Column, checklist: dict[str, list[str]]) -> Column:
    """Asks for ratings of 1 to 5, as {"ratings": {category: {check: score}}}."""
    asked = "Rate this software-engineering agent's work. Give every check a whole number from 1 (poor) to 5 (excellent).\nAnswer with JSON only: {\"ratings\": {category: {check: score}}}.\nChecks:\n" + json.dumps(checklist, ensure_ascii=False)
    return F.concat(F.lit(asked + "\n\n"), trajectory_text(tools, messages))


def ratings(answer: Column) -> Column:
    """map<category, map<check, score text>> of an answer, fenced or not."""
    return F.from_json(text.fenced_json(answer), "struct<ratings:map<string,map<string,string>>>")["ratings"]


def fixed_scores(rows: DataFrame, client: Client, checklist: dict[str, list[str]], pause: float = FIRST_PAUSE) -> DataFrame:
    """Rating columns of each main record: category rewards, their mean, the raw answer, the error if it failed.

    Records that have an llm_composite_score already aren't asked about again, and have no row in the result.
    """
    main = rows.filter(F.coalesce("_agent_type", F.lit("main")) != "subagent")
    if "llm_composite_score" in rows.columns:
        main = main.filter(~already_scored(F.col("llm_composite_score")))
    asked = main.select("rec_id", answers(rating_prompt(F.col("tools"), F.col("messages"), checklist), client, pause=pause).alias("a"))
    rated = asked.withColumn("r", ratings(F.col("a.answer")))
    items = rated.filter("r IS NOT NULL").select("rec_id", F.explode("r").alias("category", "checks")).select("rec_id", "category", F.explode("checks").alias("check", "value"))
    scored = stats.rated_rewards(items.select("rec_id", "category", text.clamp_score(F.col("value"), 1, 5).alias("score")))
    columns = [F.try_element_at("categories", F.lit(k)).alias(v) for k, v in CATEGORY_COLUMNS.items()]
    error = F.coalesce("a.error", F.when(F.col("r").isNull(), "answer is no JSON object"))
    return rated.select("rec_id", F.col("a.answer").alias("llm_raw_response"), error.alias("llm_error")).join(scored, "rec_id", "left").select("rec_id", *columns, F.col("composite").alias("llm_composite_score"), "llm_raw_response", "llm_error")


def already_scored(score: Column) -> Column:
    """A stored score counts only if it isn't null, so failed records are tried again."""
    return score.isNotNull()


# ---- checklists made for each question ----

_CHECK = "struct<check_id:string,description:string,requirement:string,check:string,check_type:string,required_evidence:string,evidence_hint:string>"
_CATEGORY = f"struct<category_id:string,name:string,description:string,title:string,checks:array<{_CHECK}>>"
#: Keys of a checklist that are no categories.
NO_CATEGORIES = ("question_summary", "summary", "metadata", "meta")


def checklist_rows(rows: DataFrame, answer: str = "answer", cap: int = 40) -> DataFrame:
    """rec_id, cat_pos, category_id, check_pos, check_id, description of generated checklists.

    Accepts {"categories": [...]} and {"categories": {id: {...}}}, a bare list, and {id: {"checks": [...]}}.  Blank
    descriptions go, missing names are made from the position, and the caps and numbering are those of stats.capped_checks().
    """
    # each text is parsed and trimmed once: what is read twice is a column, or the argument of a lambda, and blank checks go within their array
    trimmed = lambda *cs: F.coalesce(*(text.once(text.strip(c), lambda s: F.when(s != "", s)) for c in cs), F.lit(""))
    bare = rows.select("rec_id", text.fenced_json(F.col(answer)).alias("bare"))
    listed = bare.select("rec_id", "bare", F.get_json_object("bare", "$.categories").alias("listed"))
    found = listed.select("rec_id", F.col("listed").isNotNull().alias("given"), F.when(F.col("bare").startswith("["), F.col("bare")).otherwise(F.coalesce("listed", "bare")).alias("source"))
    by_name = F.map_entries(F.from_json("source", "map<string,string>"))
    named = F.filter(by_name, lambda e: F.col("given") | (~e["key"].isin(*NO_CATEGORIES) & F.get_json_object(e["value"], "$.checks").startswith("[")))
    keyed = F.transform(named, lambda e: F.from_json(e["value"], _CATEGORY).withField("category_id", e["key"]))
    parsed = F.when(F.col("source").startswith("["), F.from_json("source", f"array<{_CATEGORY}>")).otherwise(keyed)
    cats = found.select("rec_id", F.posexplode(parsed).alias("cat_pos", "c")).filter("c IS NOT NULL")
    category = text.make_id(trimmed(F.col("c.category_id"), F.col("c.name")), F.concat(F.lit("category_"), F.col("cat_pos") + 1))
    cats = cats.select("rec_id", "cat_pos", category.alias("category_id"), F.col("c.checks").alias("checks"))

    def check(k: Column, i: Column) -> Column:
        given = text.make_id(F.coalesce(k["check_id"], F.lit("")), F.concat_ws("_", "category_id", i + 1))
        return F.struct(i.alias("check_pos"), given.alias("check_id"), trimmed(k["description"], k["requirement"], k["check"]).alias("description"))

    checks = cats.select("rec_id", "cat_pos", "category_id", F.inline(F.filter(F.transform("checks", check), lambda k: k["description"] != "")))
    return stats.capped_checks(checks.select("rec_id", "cat_pos", "category_id", "check_pos", "check_id", "description"), cap)


def once_for_each(rows: DataFrame, prompt: Column, client: Client, pause: float = FIRST_PAUSE) -> DataFrame:
    """Rows with answer and error, one call for each distinct prompt."""
    keyed = rows.withColumn("__prompt", prompt).withColumn("__key", F.sha2("__prompt", 256))
    made = keyed.groupBy("__key").agg(F.min("__prompt").alias("__prompt")).select("__key", answers(F.col("__prompt"), client, pause=pause).alias("__a"))
    return keyed.drop("__prompt").join(made, "__key").select(*rows.columns, F.col("__a.answer").alias("answer"), F.col("__a.error").alias("error"))


def project_judgement(checks: DataFrame, judged: DataFrame, tasks: int | None = None) -> DataFrame:
    """Every check with its judged score (0 or 1), status, reasoning and up to three evidence texts; checks that weren't judged fail.

    Both are dealt out to so many tasks, if given, else to as many as the session says.
    """
    if tasks is not None:
        checks, judged = (d.repartition(tasks, "rec_id", "category_id", "check_id") for d in (checks, judged))
    j = judged.groupBy("rec_id", "category_id", "check_id").agg(F.max(F.struct("status", "score", "reasoning", "evidence")).alias("j"))
    score = text.clamp_score(F.col("j.score"), 0, 1)
    evidence = F.slice(F.filter(F.coalesce("j.evidence", F.array()), lambda e: text.strip(F.coalesce(e, F.lit(""))) != ""), 1, 3)
    joined = checks.join(j, ["rec_id", "category_id", "check_id"], "left")
    return joined.select(*checks.columns, score.alias("score"), text.status_of(F.col("j.status"), score).alias("status"), F.coalesce("j.reasoning", F.lit("not judged")).alias("reasoning"), evidence.alias("evidence"))


def checklist_scores(rows: DataFrame, client: Client, judge: Client | None = None, pause: float = FIRST_PAUSE) -> DataFrame:
    """rec_id, isr, csr, counts and error of every record: a checklist for its question, judged against the trajectory.

    A record whose list or judgement failed has nulls and the error.
    """
    q, _ = question(F.col("messages"))
    ask_list = F.concat(F.lit("Write a checklist of yes/no checks for judging how well an agent solves this task. Answer with JSON only: {\"categories\": [{\"category_id\", \"description\", \"checks\": [{\"check_id\", \"description\", \"check_type\", \"required_evidence\"}]}]}.\nTask:\n"), q, F.lit("\nSystem prompt:\n"), system_text(F.col("messages")), F.lit("\nTools:\n"), tools_summary(F.col("tools")))
    listed = once_for_each(rows.select("rec_id", "tools", "messages"), ask_list, client, pause)
    checks = checklist_rows(listed)
    lists = checks.groupBy("rec_id").agg(F.to_json(F.array_sort(F.collect_list(F.struct("cat_pos", "check_pos", "category_id", "check_id", "description")))).alias("checks"))
    prompt = F.concat(F.lit("Judge each check against the trajectory. Answer with JSON only: {\"judgements\": [{\"category_id\", \"check_id\", \"status\", \"score\", \"reasoning\", \"evidence\": []}]}.\nChecks:\n"), F.col("checks"), F.lit("\n\n"), trajectory_text(F.col("tools"), F.col("messages")))
    judged = listed.select("rec_id", "tools", "messages").join(lists, "rec_id").select("rec_id", answers(prompt, judge or client, pause=pause).alias("a"))
    items = "struct<judgements:array<struct<category_id:string,check_id:string,status:string,score:string,reasoning:string,evidence:array<string>>>>"
    judged = judged.withColumn("j", F.from_json(text.fenced_json(F.col("a.answer")), items)["judgements"])
    scored = stats.checklist_rewards(project_judgement(checks, judged.select("rec_id", F.explode("j").alias("j")).select("rec_id", "j.*")).select("rec_id", "category_id", "score"))
    good = judged.filter("j IS NOT NULL").select("rec_id")
    told = judged.select("rec_id", F.coalesce("a.error", F.when(F.col("j").isNull(), "judgement is no JSON object")).alias("judge_error"), F.lit(True).alias("asked"))
    error = F.coalesce("error", F.when(F.col("asked").isNull(), "no checks in the answer"), "judge_error")
    return listed.select("rec_id", "error").join(told, "rec_id", "left").select("rec_id", error.alias("error")).join(scored.join(good, "rec_id", "left_semi"), "rec_id", "left").select("rec_id", *(c for c in scored.columns if c != "rec_id"), "error")
