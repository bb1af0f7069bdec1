"""Scores and checks of hand-written trajectories."""

import json

import pytest
from pyspark.sql import functions as F

from trajectra import schema
from trajectra.operators import dedup, judge, metrics, normalize, relations, stats, validate
from trajectra.plans import flows
from trajectra.sources import convert, files, sinks
from trajectra.streaming import score as streaming


def tool(name, **props):
    return {"type": "function", "function": {"name": name, "description": "", "parameters": json.dumps({"properties": {k: {} for k in props}})}}


def say(role, content="", calls=(), reasoning=None):
    return {"role": role, "name": None, "content": content, "reasoning_content": reasoning, "tool_calls": [{"id": None, "type": "function", "function": {"name": n, "arguments": json.dumps(a)}} for n, a in calls] or None, "weight": None, "tool_call_id": None}


def frame(spark, records):
    rows = [(f"r{i}", i, None, None, t, m) for i, (t, m) in enumerate(records)]
    return spark.createDataFrame(rows, schema.TRAJECTORY)


CC = [tool(n) for n in ("Bash", "Read", "Edit", "Write", "Grep")]
FIXED = [say("system", "You are Claude Code"), say("user", "fix"), say("assistant", "read", [("Read", {"file_path": "/testbed/a.py"})]), say("tool", "code"), say("assistant", "edit", [("Edit", {"file_path": "tests/test_a.py"})]), say("tool", "ok"), say("assistant", "run", [("Bash", {"command": "pytest -q"})]), say("tool", "1 passed"), say("assistant", "All tests pass.")]


def scored(spark, *records):
    return [r.asDict() for r in metrics.score_trajectories(frame(spark, records)).orderBy("rec_id").collect()]


def test_score_of_a_good_record(spark):
    (s,) = scored(spark, (CC, FIXED))
    assert (s["scaffold"], s["assistant_turns"], s["total_tool_calls"], s["tvr_score"], s["sub_score"], s["stp_score"], s["fec_score"]) == ("claudecode", 4, 3, 1.0, 1.0, 0.8, 1.0)


def test_many_edits_of_one_file(spark):
    edits = [m for _ in range(6) for m in (say("assistant", "e", [("Edit", {"file_path": "a.py"})]), say("tool", "ok"))]
    (s,) = scored(spark, (CC, [say("user", "x"), *edits, say("assistant", "done")]))
    assert s["fec_score"] == 0.0 and s["reproduce_first"] == 0.0


def test_last_test_run_counts_only_its_own_output(spark):
    runs = [say("assistant", "t", [("Bash", {"command": "pytest"})]), say("tool", "3 passed"), say("assistant", "t", [("Bash", {"command": "pytest | tail -1"})])]
    (s,) = scored(spark, (CC, [say("user", "x"), *runs]))
    assert s["tvr_score"] == 0.54


def test_typed_commands(spark):
    body = json.dumps({"commands": [{"keystrokes": "ls\n"}, {"keystrokes": "cat > a.py\n"}, {"keystrokes": "pytest\n"}], "task_complete": True})
    p = relations.profiles(relations.steps(frame(spark, [([], [say("user", "x"), say("assistant", body), say("user", "fine")])])))
    assert [tuple(r) for r in metrics.error_counts(p).select("calls", "errors").collect()] == [(3, 0)]
    assert metrics.scores(p).first()["scaffold"] == "terminus2"


def test_renamed_tools_score_alike(spark):
    usual = [tool("execute_bash", command=1, is_input=1), tool("str_replace_editor", command=1, path=1, old_str=1), tool("finish", task_completed=1), tool("helper", x=1)]
    names = {"execute_bash": "sh", "str_replace_editor": "ed", "finish": "end"}
    rename = lambda n: names.get(n, n)

    def record(f):
        calls = [("execute_bash", {"command": "pytest"}), ("str_replace_editor", {"command": "str_replace", "path": "a.py"}), ("finish", {"task_completed": "true"})]
        body = [say("user", "x")]
        for n, a in calls:
            body += [say("assistant", "go", [(f(n), a)]), say("tool", "1 passed")]
        return body

    renamed = [{**t, "function": {**t["function"], "name": rename(t["function"]["name"])}} for t in usual]
    rows = normalize.canonicalize(frame(spark, [(usual, record(lambda n: n)), (renamed, record(rename))]))
    a, b = (r.asDict() for r in metrics.score_trajectories(rows).orderBy("rec_id").collect())
    assert {k: v for k, v in a.items() if k != "rec_id"} == {k: v for k, v in b.items() if k != "rec_id"}


@pytest.mark.parametrize(("tools", "kind"), [(None, "terminus2"), ([], "terminus2"), ([tool("terminal"), tool("think")], "openhands_sdk"), ([tool("Bash")], "opencode"), ([tool("own")], "openhands")])
def test_scaffolds(spark, tools, kind):
    rows = frame(spark, [(tools, [say("user", "x")])])
    assert rows.select(relations.scaffold_of(F.col("tools"), F.col("messages"))).first()[0] == kind


@pytest.mark.parametrize(
    ("roles", "valid"),
    [("user assistant", True), ("system user assistant", True), ("user", False), ("assistant", False), ("user assistant tool user assistant", False), ("user assistant tool tool assistant", True), ("user system assistant", False), ("", False), ("system", False), ("user user assistant", False)],
)
def test_roles(spark, roles, valid):
    rows = frame(spark, [([], [say(r) for r in roles.split()])])
    assert rows.select(validate.roles_valid(F.col("messages"))).first()[0] is valid


def test_reasoning_and_calls(spark):
    rows = frame(spark, [([], [say("user"), say("assistant", "a", [("x", {})], "why"), say("tool"), say("assistant", "b")])])
    check = lambda **k: rows.select(validate.reasoning_valid(F.col("messages"), F.lit("slow"), **k)).first()[0]
    assert check() and check(threshold=0.5) and not check(threshold=0.6) and not check(mode="strict")
    assert rows.select(validate.tool_calls_valid(F.col("messages"))).first()[0]


def test_bundles(spark):
    rows = spark.createDataFrame([("a", True, 0.8), ("a", False, None), ("b", True, 0.3), (None, True, 0.6), (None, True, None)], "_instance_id string, is_main boolean, score double")
    kept = validate.filter_score_bundles(rows, 0.5).collect()
    assert sorted((r._instance_id or "", r.score or 0) for r in kept) == [("", 0.6), ("a", 0), ("a", 0.8)]


def test_logged_requests_dedup(spark):
    line = lambda ok, t, n: json.dumps({"success": ok, "request_time": t, "request_body": {"messages": [{"role": "user", "content": f"m{i}"} for i in range(n)]}})
    rows = spark.createDataFrame([("i", 1, line(False, 0, 4)), ("i", 2, line(True, 1, 3)), ("i", 3, line(True, 2, 5)), ("i", 4, "not json"), ("j", 1, line("false", 1, 3)), ("j", 2, line(None, 2, 2))], "instance_id string, line_no long, raw string")
    assert sorted((r.instance_id, r.line_no) for r in dedup.dedup_requests(rows).collect()) == [("i", 3), ("j", 1)]


def test_prefix_dedup_is_exact(spark):
    import random

    rnd = random.Random(1)
    texts = ["".join(rnd.choice("ab") for _ in range(rnd.choice([0, 1, 2, 3, 70]))) for _ in range(60)] + ["x" * 64, "x" * 65, "x" * 64, "x" * 200]
    rows = spark.createDataFrame([("g", i, t) for i, t in enumerate(texts)], "g string, i int, t string")
    want = [i for i, t in enumerate(texts) if not any(u.startswith(t) for u in texts[i + 1 :])]
    assert sorted(r.i for r in dedup.dedup_prefix(rows, "g", "i", "t").collect()) == want


def test_converters(spark):
    blocks = {"request_body": {"system": [{"type": "text", "text": "S"}], "tools": [{"name": "Edit", "input_schema": {"properties": {"a": {}, "b": {}}}}], "messages": [{"role": "user", "content": [{"type": "text", "text": "hi"}, {"type": "tool_result", "content": [{"type": "text", "text": "out"}], "tool_use_id": "t1"}]}, {"role": "assistant", "content": [{"type": "thinking", "thinking": " "}, {"type": "text", "text": ""}]}]}, "response_body": {"content": [{"type": "thinking", "thinking": "why"}, {"type": "tool_use", "name": "Edit", "id": "t2", "input": {"b": 1, "a": 2, "c": 3}}]}}
    m = convert.logged(blocks)
    assert [x["role"] for x in m] == ["system", "user", "tool", "assistant"] and m[2]["content"] == "out"
    assert m[3]["tool_calls"][0]["function"]["arguments"] == '{"a":2,"b":1,"c":3}' and m[3]["reasoning_content"] == "why"
    steps = {"trajectory": {"steps": [{"source": "user", "message": "do"}, {"message": "Analysis: a\nPlan: p", "tool_calls": [{"function_name": "x", "arguments": {"command": "ls"}}, {"function_name": "mark_task_complete", "arguments": {}}], "observation": {"results": [{"content": "seen"}]}}]}, "steps": []}
    t = convert.typed_steps(steps)
    assert [x["role"] for x in t] == ["user", "assistant"] and json.loads(t[1]["content"]) == {"analysis": "a", "plan": "p", "commands": [{"keystrokes": "ls\n"}], "task_complete": True}
    r = convert.recorded({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a", "tool_uses": [{"tool": "Grep", "input": "pattern=x y path=src"}]}, {"role": "assistant", "content": "b", "thinking": "t"}, {"role": "user", "content": "<command-name>x"}, {"role": "user", "content": "z"}]})
    assert len(r) == 2 and r[1]["content"] == "a\n\nb" and json.loads(r[1]["tool_calls"][0]["function"]["arguments"]) == {"pattern": "x y", "path": "src"}
    rows = spark.createDataFrame([(1, json.dumps({"steps": []})), (2, "[]x"), (3, json.dumps(steps))], "rec_id int, raw string")
    kept, counts = flows.convert_records(rows, "steps")
    assert [x.rec_id for x in kept.collect()] == [3] and {x.status: x["count"] for x in counts.collect()} == {"failed": 2, "kept": 1}


@pytest.mark.parametrize(("raw", "out"), [("not json", '"not json"'), (None, "{}"), ('{"b": 1, "a": 2}', '{"b":1,"a":2}')])
def test_argument_text(raw, out):
    assert normalize.canonical_arguments(raw) == out


def test_logged_flow(spark):
    def line(t, error=False):
        middle = [{"role": "user", "content": "go"}, {"role": "assistant", "content": "", "reasoning_content": "r", "tool_calls": [{"id": "1", "function": {"name": "Edit", "arguments": "{}"}}]}, {"role": "tool", "content": "<tool_use_error>" if error else "ok"}]
        return json.dumps({"request_time": t, "request_body": {"system": "s", "tools": [{"type": "function", "function": {"name": "Edit"}}], "messages": middle}, "response_body": {"choices": [{"message": {"role": "assistant", "content": "done", "reasoning_content": "r"}}]}})

    rows = spark.createDataFrame([("i", 1, line(1)), ("k", 1, line(1, True))], "instance_id string, line_no long, raw string")
    kept = {r._instance_id: [m.role for m in r.messages] for r in flows.convert_logged(rows).collect()}
    assert kept == {"i": ["system", "user", "assistant", "tool", "assistant"], "k": ["system", "user", "assistant"]}


def test_im_round_trip_and_rendering(spark, tmp_path):
    rows = frame(spark, [(CC, [say("user", "hi"), say("assistant", "<think>why</think> yes", [("Read", {"path": "a"})])]), (None, [say("user", "你好"), say("assistant", "x")])])
    im = normalize.to_im(rows, "2024-01-01")
    first, second = im.orderBy("rec_id").collect()
    assert [m.role for m in first.messages] == ["system", "user", "assistant"] and first.messages[2].reasoning_content == "why" and first.messages[2].content == "yes"
    assert (first.meta_info.language, second.meta_info.language, first.meta_info.rounds) == ("en", "zh", 1)
    sinks.write_jsonl(im, str(tmp_path / "im"), order="rec_id", single=True)
    back = files.read_trajectories(spark, str(tmp_path / "im"))
    assert sorted(len(r.messages) for r in back.collect()) == [3, 3]
    lf = sinks.to_lf(rows, normalize.think_mode(F.col("messages"))).orderBy("rec_id").collect()
    assert [m.role for m in lf[0].messages] == ["system", "user", "assistant"] and "why" not in lf[0].messages[2].content
    scored_rows = flows.score(back)
    assert scored_rows.count() == 2 and "_score" in scored_rows.columns
    query = streaming.score_stream(streaming.watch_trajectories(spark, str(tmp_path / "im")), str(tmp_path / "out"), str(tmp_path / "ck"))
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_job_folders_and_tasks(spark, tmp_path):
    job = {"stats": {"evals": {"a": {"reward_stats": {"reward": {"1.0": ["x__1"], "0.0": ["y__2"]}}}, "b": {"reward_stats": {"reward": {"1.0": ["z"], "1": ["w"]}}}}}}
    rows = spark.createDataFrame([(json.dumps(job),)], "raw string")
    names = lambda s: [r.folder for r in files.job_folders(rows, s).orderBy("eval_pos", "reward_pos", "pos").collect()]
    assert names("resolved") == ["x__1", "z"] and names("unresolved") == ["y__2"] and names("all") == ["x__1", "y__2", "z", "w"]
    cfg = spark.createDataFrame([("f:/job/t1/config.json", json.dumps({"task": {"path": "tasks/a-1/"}})), ("f:/job/t2/config.json", "{}")], "file_path string, raw string")
    assert [(r.folder, r.instance_id) for r in files.trial_tasks(cfg).orderBy("folder").collect()] == [("t1", "a-1"), ("t2", None)]
    toml = spark.createDataFrame([("[metadata]\nd = 1",), ("x",), (None,)], "c string")
    assert [r[0] for r in toml.select(files.toml_table(F.col("c"))).collect()] == ['{"d": 1}', None, None]


def test_judges(spark):
    rows = frame(spark, [(CC, FIXED), (CC, [say("user", "other")])])
    client = lambda prompt: "```json\n" + json.dumps({"ratings": {"F": {"a": 5, "b": 3}, "G": {"a": 1}}}) + "\n```"
    got = judge.fixed_scores(rows, client, {"F": ["a", "b"], "G": ["a"]}).collect()
    assert {r.llm_f_problem_understanding for r in got} == {0.75} and {r.llm_composite_score for r in got} == {0.375}

    def failing(prompt):
        raise RuntimeError("down")

    bad = judge.fixed_scores(rows, failing, {}, pause=0.0).collect()
    assert all(r.llm_composite_score is None and "down" in r.llm_error for r in bad)

    def dynamic(prompt):
        if prompt.startswith("Write"):
            return json.dumps({"categories": [{"category_id": "c", "description": "", "checks": [{"check_id": "x", "description": "d"}, {"check_id": "x", "description": "e"}, {"description": " "}]}]})
        return json.dumps({"judgements": [{"category_id": "c", "check_id": "x", "status": "passed", "score": "1", "reasoning": "r", "evidence": ["1", " ", "2", "3", "4"]}]})

    got = judge.checklist_scores(rows, dynamic).collect()
    assert {(r.isr, r.csr, r.total_checks, r.total_passed) for r in got} == {(0.0, 0.5, 2, 1)}


def test_summary_tables(spark):
    counts = spark.createDataFrame([("a", 4, 1), ("a", 4, 1), ("b", 2, 0), ("b", 0, 0)], "scaffold string, calls long, errors long")
    got = {r.scaffold: (r.error_rate, r.trajectory_error_rate) for r in stats.tool_error_rate(counts).collect()}
    assert got == {"a": (0.25, 1.0), "b": (0.0, 0.0), None: (0.2, 0.666667)}
    assert stats.cost_estimate(spark.createDataFrame([("abcdefgh",)], "p string"), "p", 1.0, 1.0).first()["input_tokens"] == 2
