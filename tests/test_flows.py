"""Whole flows, reports and the command line on small files."""

import json

import pytest
from pyspark.sql import functions as F

from test_trajectories import CC, FIXED, frame, say
from trajectra import cli
from trajectra.operators import dedup, judge, metrics, relations, stats, validate
from trajectra.plans import flows, reports
from trajectra.sources import files, sinks
from trajectra.streaming import score as streaming

CALL = {"id": "1", "function": {"name": "Edit", "arguments": "{}"}}


def logged_line(t, calls=True, reasoning="r", title=False, answer=True):
    middle = [{"role": "user", "content": "go"}, {"role": "assistant", "content": "", "reasoning_content": reasoning, "tool_calls": [CALL] if calls else None}, {"role": "tool" if calls else "user", "content": "ok"}]
    body = {"model": "m", "top_p": None, "system": "You are a title generator" if title else "powered by m", "tools": [{"type": "function", "function": {"name": "Edit"}}], "messages": middle}
    return json.dumps({"request_time": t, "request_body": body, "response_body": {"choices": [{"message": {"role": "assistant", "content": "done", "reasoning_content": reasoning}}] if answer else []}, "usage": {"n": t}})


def test_instances_are_kept_whole_and_counted(spark):
    rows = [("a", 1, logged_line(1)), ("b", 1, logged_line(1, calls=False)), ("b", 2, logged_line(2)), ("c", 1, json.dumps({"request_body": {"messages": [{"role": "user", "content": 1}] * 3, "tools": 5}, "response_body": "x"})), ("d", 1, logged_line(1, calls=False, answer=False)), ("e", 1, logged_line(1))]
    logged = spark.createDataFrame(rows, "instance_id string, line_no long, raw string")
    judged = flows.logged_records(logged, rename=("by m", "by z")).cache()
    assert {(r._instance_id, r.status) for r in judged.select("_instance_id", "status").collect()} == {("a", "kept"), ("b", "calls"), ("b", "kept"), ("c", "failed"), ("d", "roles"), ("e", "kept")}
    assert [r._instance_id for r in flows.convert_logged(logged).orderBy("_instance_id").collect()] == ["a", "e"]
    assert tuple(flows.skip_counts(judged).first()) == (2, 0, 1)
    assert judged.filter("_instance_id = 'a'").first().messages[0].content == "powered by z"
    listing = spark.createDataFrame([(x, k) for k, x in enumerate("zabcde")], "_instance_id string, position int")
    names = lambda n, need: sorted(r._instance_id for r in flows.first_instances(judged, listing, n, need).collect())
    assert names(2, False) == ["a"] and names(2, True) == ["a", "e"] and names(9, False) == ["a", "e"]


def test_last_records_have_one_status_each(spark):
    raws = [("ok", logged_line(3)), ("none", None), ("empty", logged_line(1, answer=False)), ("odd", "{"), ("fast", logged_line(1, calls=False))]
    last = spark.createDataFrame(raws, "_instance_id string, raw string")
    every = spark.createDataFrame([(x,) for x, _ in raws] + [("gone",)], "_instance_id string")
    got = {r._instance_id: r for r in flows.convert_last_records(last, every).collect()}
    assert {k: r.status for k, r in got.items()} == {"ok": "kept", "none": "all_failed", "empty": "no_choices", "odd": "invalid", "fast": "invalid", "gone": "no_file"}
    assert json.loads(got["ok"]._gen_params) == {"model": "m", "top_p": None} and json.loads(got["ok"]._usage) == {"n": 3}


def test_recorded_conversations_are_sliced_before_the_model_filter(spark):
    line = lambda model, turns: json.dumps({"model": model, "session_id": model + "1", "messages": turns})
    talk = [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a", "thinking": "t"}]
    rows = spark.createDataFrame([("f", 1, line("other", talk)), ("f", 2, line("claude-x", talk)), ("f", 3, line("claude-y", talk[:1])), ("g", 1, line("claude-z", talk))], "file_path string, line_no long, raw string")
    tools = [{"name": "Edit", "input_schema": {"properties": {"a": {}}}}]
    got = {r._instance_id: r for r in flows.convert_recorded(rows, "S", tools, 3).collect()}
    assert {k: r.status for k, r in got.items()} == {"claude-x1": "kept", "claude-y1": "roles"}
    r = got["claude-x1"]
    assert [m.role for m in r.messages] == ["system", "user", "assistant"] and r.messages[0].content == "S" and r.think_mode == "slow" and r.tools[0].function.name == "Edit"


def test_session_flow_in_both_layouts(spark, tmp_path):
    event = lambda role, content: json.dumps({"type": role, "message": {"role": role, "content": content}})
    good = "\n".join([event("user", "hi"), event("assistant", [{"type": "thinking", "thinking": "why"}, {"type": "text", "text": "yes"}])])
    nested = tmp_path / "job" / "inst-1" / "agent" / "sessions" / "projects" / "-testbed"
    nested.mkdir(parents=True)
    (nested / "s.jsonl").write_text(good)
    (tmp_path / "flat").mkdir()
    (tmp_path / "flat" / "one.jsonl").write_text(good)
    (tmp_path / "flat" / "two.jsonl").write_text(event("user", "alone"))
    tools = tmp_path / "tools.json"
    tools.write_text(json.dumps([{"name": "Edit", "input_schema": {"properties": {"b": {}}}}]))
    (tmp_path / "system.json").write_text(json.dumps({"blocks": [{"text": "A "}, {"text": "B"}]}))
    for folder, names in (("job", {"inst-1": "kept"}), ("flat", {"one": "kept", "two": "roles"})):
        found = files.session_files(spark, str(tmp_path / folder))
        events = files.session_events(files.json_lines(spark, *found))
        root = found[0].split(f"/{folder}/")[0] + f"/{folder}"
        judged = flows.convert_sessions(events, "S", ["R"], files.tool_definitions(spark, str(tools)), root)
        assert {r._instance_id: r.status for r in judged.collect()} == names
    out = tmp_path / "im"
    cli.main(["convert-sessions", "--source-dir", str(tmp_path / "flat"), "--im-output", str(out), "--system-prompt-json", str(tmp_path / "system.json"), "--tools-json", str(tools), "--lf-output", str(tmp_path / "lf")], spark)
    (r,) = files.read_trajectories(spark, str(out)).collect()
    assert [m.role for m in r.messages] == ["system", "user", "assistant"] and r.messages[0].content == "A\n\nB" and r._instance_id == "one"
    (part,) = (tmp_path / "lf").glob("part-*")
    (lf,) = json.loads(part.read_text())
    assert [m["role"] for m in lf["messages"]][-1] == "assistant"
    (side,) = (tmp_path / "lf.stats.json").glob("part-*")
    assert json.loads(side.read_text())["count"] == 1


def test_command_line_on_a_job(spark, tmp_path, capsys):
    job = tmp_path / "job"
    for name in ("x__1", "y__2", "z__3"):
        (job / name / "agent").mkdir(parents=True)
        (job / name / "config.json").write_text(json.dumps({"task": {"path": f"tasks/o__{name[0]}-1"}}))
        (job / name / "agent" / "litellm-trajectory.jsonl").write_text(logged_line(1, calls=name != "y__2") + "\n")
    (job / "result.json").write_text(json.dumps({"stats": {"evals": {"a": {"reward_stats": {"reward": {"1.0": ["x__1", "y__2"], "0.0": ["z__3"]}}}}}}))
    cli.main(["convert-logged", "--job-dir", str(job), "--im-output", str(tmp_path / "im"), "--instance-status", "all"], spark)
    assert "'role_filtered': 1" in capsys.readouterr().out
    assert sorted(r._instance_id for r in files.read_trajectories(spark, str(tmp_path / "im")).collect()) == ["o__x-1", "o__z-1"]
    (tmp_path / "repos").write_text("o/x\n")
    cli.main(["convert-last", "--job-dir", str(job), "--im-output", str(tmp_path / "im2"), "--instance-status", "all", "--exclude-repos-file", str(tmp_path / "repos")], spark)
    assert [r._instance_id for r in files.read_trajectories(spark, str(tmp_path / "im2")).collect()] == ["o__z-1"]
    cli.main(["score", "-i", str(tmp_path / "im"), "-o", str(tmp_path / "scored")], spark)
    assert "Tool-call errors: calls" in capsys.readouterr().out
    assert all(json.loads(r._score)["composite_score"] > 0 for r in files.read_trajectories(spark, str(tmp_path / "scored")).collect())
    cli.main(["dedup", "-i", str(job / "x__1" / "agent" / "litellm-trajectory.jsonl"), "-o", str(tmp_path / "dedup")], spark)
    assert spark.read.text(str(tmp_path / "dedup")).count() == 1
    (tmp_path / "checks.json").write_text(json.dumps({"F": ["a"]}))
    cli.main(["judge", "-i", str(tmp_path / "im"), "-o", str(tmp_path / "j"), "--checklist", str(tmp_path / "checks.json"), "--dry-run"], spark)
    assert "'records': 2" in capsys.readouterr().out


def test_reports(spark):
    rates = stats.tool_error_rate(spark.createDataFrame([("a", 4, 1), ("b", 2, 0)], "scaffold string, calls long, errors long"))
    assert reports.tool_error_text(rates).splitlines() == ["Tool-call errors: calls 1 of 6 = 0.1667, trajectories 1 of 2 = 0.5000", "  a: calls 1 of 4 = 0.2500, trajectories 1 of 1 = 1.0000", "  b: calls 0 of 2 = 0.0000, trajectories 0 of 1 = 0.0000"]
    assert "no tool calls" in reports.tool_error_text(rates.filter("calls < 0"))
    answer = json.dumps({"ratings": {"F": {"a": 9, "b": "x"}, "G": {"a": 3}, "Z": {"a": 5}}})
    (d,) = reports.judge_details(spark.createDataFrame([("r", answer), ("s", "no")], "rec_id string, llm_raw_response string")).collect()
    assert (d.total_checks, d.total_score, d.total_max) == (3, 9, 15) and {k: tuple(v) for k, v in d.by_category.items()} == {"F": (6, 10, 2), "G": (3, 5, 1)}
    rows = spark.createDataFrame([("main", 0.5, 0.25, None), (None, None, None, "down"), ("main", None, None, None), ("subagent", 1.0, None, None)], "_agent_type string, s double, f double, e string")
    first, second = reports.llm_summary(rows, {"F": "f"}, "s", "e").collect()
    assert tuple(first) == ("composite", 1, 1, 1, 0.5, 0.5, 0.5) and (second.name, second.scored, second.mean) == ("F", 1, 0.25)
    assert reports.dry_run(frame(spark, [(CC, FIXED)]), {"F": ["a"]}).first()["records"] == 1


def test_judges_keep_failed_records_and_skip_scored_ones(spark):
    rows = frame(spark, [(CC, FIXED), (CC, [say("user", "other")]), (CC, [say("user", "third")])])

    def client(prompt):
        if "third" in prompt:
            raise RuntimeError("down")
        if prompt.startswith("Write"):
            return json.dumps({"c": {"checks": [{"requirement": "d"}]}, "meta": {"checks": []}}) if "other" not in prompt else "[]"
        return json.dumps({"judgements": [{"category_id": "c", "check_id": "c_1", "score": "1"}]})

    got = {r.rec_id: r for r in judge.checklist_scores(rows, client, pause=0.0).collect()}
    assert (got["r0"].isr, got["r0"].error) == (1.0, None)
    assert got["r1"].csr is None and got["r1"].error == "no checks in the answer"
    assert got["r2"].csr is None and "down" in got["r2"].error
    scored = rows.withColumn("llm_composite_score", F.when(F.col("rec_id") == "r0", 0.5))
    assert sorted(r.rec_id for r in judge.fixed_scores(scored, lambda p: "{}", {}).collect()) == ["r1", "r2"]


@pytest.mark.parametrize(("answer", "want"), [
    ({"categories": [{"name": "A b", "checks": [{"check_id": "x", "description": "d"}, {"check_id": "x", "description": "e"}, {"description": " "}]}]}, [("a_b", "x", "d"), ("a_b", "x_2", "e")]),
    ({"categories": {"q": {"checks": [{"check": "d"}]}}}, [("q", "q_1", "d")]),
    ({"meta": {"checks": [{"check": "no"}]}, "other": 1, "z": {"checks": [{"check": "d"}]}}, [("z", "z_1", "d")]),
    ([{"checks": [{"description": "d"}]}], [("category_1", "category_1_1", "d")]),
    ("words", []),
])
def test_checklist_layouts(spark, answer, want):
    rows = spark.createDataFrame([("r", json.dumps(answer) if answer != "words" else answer)], "rec_id string, answer string")
    assert [(r.category_id, r.check_id, r.description) for r in judge.checklist_rows(rows).orderBy("cat_pos", "check_pos").collect()] == want


def test_equal_lines_of_a_stream_are_records_of_their_own(spark, tmp_path):
    line = json.dumps({"tools": [], "messages": [{"role": "user", "content": "x"}, {"role": "assistant", "content": "y"}]})
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text(f"{line}\n{line}\n")
    streaming.score_stream(streaming.watch_trajectories(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len({r.rec_id for r in got}) == len(got) == 2 and {r._score.assistant_turns for r in got} == {1}


def test_lifted_fields(spark):
    raw = [{"_score": None, "meta_info": {"unique_info": {"_score": 1, "_usage": {"a": 1}}}}, {"meta_info": {"unique_info": {"_score": 2}}}]
    rows = spark.createDataFrame([("f", k, json.dumps(r)) for k, r in enumerate(raw)], "file_path string, line_no long, raw string")
    assert [(r._score, r._usage) for r in files.trajectories(rows).orderBy("rec_pos").collect()] == [(None, '{"a":1}'), ("2", None)]


def test_blank_reasoning_counts(spark):
    rows = frame(spark, [([], [say("user"), say("assistant", "a", reasoning=" ")])])
    assert rows.select(validate.reasoning_valid(F.col("messages"), F.lit("slow"), "strict")).first()[0]


def test_prefix_dedup_of_texts_that_begin_alike(spark):
    """5,000 texts with a long beginning in common, chains of prefixes among them."""
    import random

    rnd = random.Random(3)
    head, texts = "s" * 64, []
    for _ in range(5_000):
        texts.append((rnd.choice(texts)[: rnd.choice([70, 200, 10**6])] if texts and rnd.random() < 0.5 else head) + "".join(rnd.choice("ab") for _ in range(rnd.choice([0, 1, 30]))))
    rows = spark.createDataFrame([("g", i, t) for i, t in enumerate(texts)] + [("g", -1, None), (None, 0, "s")], "g string, i int, t string")
    last = {}
    for i, t in enumerate(texts):
        for n in range(64, len(t) + 1):
            last[t[:n]] = i
    want = sorted([-1, 0] + [i for i, t in enumerate(texts) if last[t] == i])
    assert sorted(r.i for r in dedup.dedup_prefix(rows, "g", "i", "t").collect()) == want


def test_score_of_a_long_record_takes_linear_time(spark):
    """4,000 turns: what follows a message, and pairs of turns, are not looked up row by row."""
    import time

    body = [m for k in range(4_000) for m in (say("assistant", "e", [("Edit", {"file_path": f"f{k % 9}.py"})]), say("tool", "ok"))]
    rows = frame(spark, [(CC, [say("user", "x"), *body])])
    began = time.monotonic()
    assert metrics.scores(relations.profiles(relations.steps(rows))).first()["assistant_turns"] == 4_000
    assert time.monotonic() - began < 60


def test_falling_scope_against_all_pairs(spark):
    import random

    rnd = random.Random(2)
    for n in (12, 40):
        names = [f"f{rnd.randrange(6)}.py" for _ in range(n)]
        body = [m for f in names for m in (say("assistant", "e", [("Edit", {"file_path": f})]), say("tool", "ok"))]
        got = relations.profiles(relations.steps(frame(spark, [(CC, [say("user", "x"), *body])]))).select(metrics.psn()).first()[0]
        scope = [len(set(names[max(0, k - 4) : k + 1])) for k in range(n)][n // 2 :]
        signs = [(b > a) - (b < a) for i, a in enumerate(scope) for b in scope[i + 1 :]]
        used = sum(map(abs, signs))
        assert got == pytest.approx((1 - sum(signs) / used) / 2 if used else 0.5)


def test_list_of_records(spark, tmp_path):
    for n in (0, 3):
        sinks.write_list(spark.range(n).select("id", F.concat(F.lit("é"), "id").alias("a")), str(tmp_path / f"l{n}"), "id", "{}")
        (part,) = (tmp_path / f"l{n}").glob("part-*")
        assert json.loads(part.read_text()) == [{"a": f"é{k}"} for k in range(n)]
