"""Registered queries over raw records: JSON that is built from the test tables, converted, checked, judged; answers are computed in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trajectra import schema
from trajectra.functions import shell, text
from trajectra.operators import dedup, judge, metrics, normalize, relations, stats, validate
from trajectra.plans import flows, reports
from trajectra.queries import _METRICS_SQL, query
from trajectra.sources import convert, files, sinks
from trajectra.views import STEPS_SQL, conversation_messages, event_steps, event_trajectories, table, tasks_for

_STEPS = f"WITH {STEPS_SQL}"
_s = lambda c: F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
_cat = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def _per_record(spark: SparkSession, sf_dir: str, step_json: Column, before: str, after: str) -> DataFrame:
    """rec_id and raw: a user's steps as JSON, joined by commas between two literals."""
    rows = event_steps(spark, sf_dir).withColumn("j", step_json)
    return rows.groupBy("rec_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("step", "j"))), lambda x: x["j"]), ",").alias("body")).select("rec_id", _cat(before, F.col("body"), after).alias("raw"))


def _exploded(rows: DataFrame, *more: str) -> DataFrame:
    return rows.select(*more, F.posexplode("messages").alias("msg_idx", "m")).select(*more, F.col("msg_idx").cast("bigint").alias("msg_idx"), "m.*")


def _quoted(c: Column) -> Column:
    """A text as JSON."""
    return F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r'^\{"v":(.*)\}$', 1)


# ---- converters ----

_W = "'w' || left(regexp_replace(text, '[^a-zA-Z]+', '', 'g'), 20)"


@query(f"SELECT conv_id, turn, ' ' || w || ' ' || chr(10) || chr(10) || 'b' || turn AS im, ' ' || w || ' ' || chr(10) || 'b' || turn AS obs, ' ' || w || ' ' || chr(10) || 'b' || turn AS assistant, w || chr(10) || chr(10) || 'b' || turn AS tool, ' ' || w || ' ' AS first, ' ' || w || ' ' || chr(10) || '{{\"type\": \"image\"}}' || chr(10) || 'b' || turn AS coerce FROM (SELECT *, {_W} AS w FROM conversations)")
def content_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = _cat(" w", F.substring(F.regexp_replace("text", "[^a-zA-Z]+", ""), 1, 20), " ")
    block = lambda kind, value: F.struct(F.lit(kind).alias("type"), value.cast("string").alias("text"))
    rows = table(spark, sf_dir, "conversations").withColumn("raw", F.to_json(F.array(block("text", word), block("image", F.lit(None)), block("text", _cat("b", F.col("turn"))))))
    return rows.select("conv_id", "turn", *(convert.content_text(F.col("raw"), rule).alias(rule) for rule in ("im", "obs", "assistant", "tool", "first", "coerce")))


_NUMBERED = "CAST(row_number() OVER (PARTITION BY rec_id ORDER BY place) - 1 AS BIGINT) AS msg_idx"


@query(_STEPS + f""", p AS (SELECT DISTINCT rec_id, 0 AS place, 'system' AS role, 'S' AS content, NULL AS reasoning, NULL AS call, NULL AS tool_call_id FROM steps UNION ALL SELECT DISTINCT rec_id, 1, 'user', 'fix it', NULL, NULL, NULL FROM steps
UNION ALL SELECT rec_id, 2 + 3 * step, 'assistant', 'go ' || k, 't' || k, tool || '{{"a":"y","x":"' || k || '"}}c' || step, NULL FROM steps
UNION ALL SELECT rec_id, 3 + 3 * step, 'tool', output, NULL, NULL, 'c' || step FROM steps UNION ALL SELECT rec_id, 4 + 3 * step, 'user', 'and ' || k, NULL, NULL, NULL FROM steps WHERE k % 2 = 0
UNION ALL SELECT DISTINCT rec_id, 1000000, 'assistant', 'done', NULL, NULL, NULL FROM steps) SELECT rec_id, {_NUMBERED}, role, content, reasoning, call, tool_call_id FROM p""")
def convert_logged_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    said = _cat('{"role":"assistant","content":[{"type":"thinking","thinking":"t', k, '"},{"type":"text","text":" go ', k, ' "},{"type":"tool_use","id":"c', F.col("step"), '","name":"', F.col("tool"), '","input":{"x":"', k, '","a":"y"}}]}')
    seen = _cat(',{"role":"user","content":[{"type":"tool_result","tool_use_id":"c', F.col("step"), '","content":[{"type":"text","text":', _quoted(F.col("output")), "}]}", F.when(k % 2 == 0, _cat(',{"type":"text","text":"and ', k, '"}')).otherwise(""), "]}")
    tools = ",".join(f'{{"name":"{t}","input_schema":{{"properties":{{"a":{{}},"x":{{}}}}}}}}' for t in ("Read", "Edit", "Grep", "Bash"))
    raw = _per_record(spark, sf_dir, F.concat(said, seen), '{"request_body":{"system":[{"type":"text","text":"S"}],"tools":[' + tools + '],"messages":[{"role":"user","content":[{"type":"text","text":"fix it"}]},', ']},"response_body":{"choices":[{"message":{"role":"assistant","content":"done"}}]}}')
    rows = _exploded(raw.select("rec_id", convert.convert(F.col("raw"), "logged")["messages"].alias("messages")), "rec_id")
    call = F.get("tool_calls", F.lit(0))
    return rows.select("rec_id", "msg_idx", "role", "content", F.col("reasoning_content").alias("reasoning"), F.when(call.isNotNull(), F.concat(call["function"]["name"], call["function"]["arguments"], call["id"])).alias("call"), "tool_call_id")


@query(_STEPS + """ SELECT rec_id, step, CASE WHEN k % 3 = 0 THEN '' ELSE 'a' || k END AS analysis, CASE WHEN k % 3 = 1 THEN '' ELSE 'p' || k END AS plan, output || CASE WHEN k % 2 = 0 THEN chr(10) ELSE '' END AS keystrokes, CASE WHEN k % 2 = 1 THEN k::DOUBLE END AS duration, step = n - 1 AS complete, CASE WHEN step < n - 1 THEN output END AS seen FROM steps""")
def convert_typed_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    said = F.when(k % 3 == 0, _cat("Plan: p", k)).when(k % 3 == 1, _cat("Analysis: a", k)).otherwise(_cat("Analysis: a", k, "\nPlan: p", k))
    keys = F.when(k % 2 == 0, _cat('"command":', _quoted(F.col("output")))).otherwise(_cat('"keystrokes":', _quoted(F.col("output")), ',"duration":', k))
    step = _cat('{"message":', _quoted(said), ',"tool_calls":[{"function_name":"run","arguments":{', keys, "}}", F.when(F.col("last"), ',{"function_name":"mark_task_complete","arguments":{}}').otherwise(""), '],"observation":{"results":[{"content":', _quoted(F.col("output")), "}]}}")
    last = F.col("step") == F.max("step").over(_by_record())
    rows = event_steps(spark, sf_dir).withColumn("last", last).withColumn("j", step)
    raw = rows.groupBy("rec_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("step", "j"))), lambda x: x["j"]), ",").alias("body")).select("rec_id", _cat('{"trajectory":{"steps":[{"source":"user","message":"do"},', F.col("body"), "]}}").alias("raw"))
    m = _exploded(raw.select("rec_id", convert.convert(F.col("raw"), "steps")["messages"].alias("messages")), "rec_id").withColumn("step", F.floor((F.col("msg_idx") - 1) / 2)).filter("msg_idx > 0")
    acts = m.filter("role = 'assistant'").select("rec_id", "step", F.get_json_object("content", "$.analysis").alias("analysis"), F.get_json_object("content", "$.plan").alias("plan"), F.get_json_object("content", "$.commands[0].keystrokes").alias("keystrokes"), F.get_json_object("content", "$.commands[0].duration").cast("double").alias("duration"), F.coalesce(F.get_json_object("content", "$.task_complete") == "true", F.lit(False)).alias("complete"))
    return acts.join(m.filter("role = 'user'").select("rec_id", "step", F.col("content").alias("seen")), ["rec_id", "step"], "left")


def _by_record():
    from pyspark.sql import Window

    return Window.partitionBy("rec_id")


@query("""WITH c AS (SELECT DISTINCT conv_id FROM conversations) SELECT CASE WHEN conv_id % 4 = 3 THEN 'unknown' ELSE 's' || conv_id END AS instance, conv_id, CASE WHEN conv_id % 5 = 0 THEN 'roles' ELSE 'kept' END AS status, CASE WHEN conv_id % 5 <> 0 THEN 'q' || conv_id || chr(10) || chr(10) || 'r' END AS question,
CASE WHEN conv_id % 5 <> 0 THEN '{"pattern":"x y","path":"src/' || conv_id || '"}' END AS args, CASE WHEN conv_id % 5 <> 0 AND conv_id % 2 = 0 THEN 't' END AS thought, CASE WHEN conv_id % 5 <> 0 THEN 3 END AS n FROM c WHERE conv_id % 3 <> 1""")
def convert_recorded_talk(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("conv_id")
    head = F.when(c % 3 == 0, "claude-x").when(c % 3 == 1, "other").otherwise("anthropic/claude-y")
    answer = F.when(c % 5 == 0, "").otherwise(_cat(',{"role":"assistant","content":"a"', F.when(c % 2 == 0, ',"thinking":"t"').otherwise(""), ',"tool_uses":[{"tool":"Grep","input":"pattern=x y path=src/', c, '"}]}'))
    raw = _cat('{"model":"', head, '"', F.when(c % 4 == 3, "").otherwise(_cat(',"session_id":"s', c, '"')), ',"messages":[{"role":"user","content":"q', c, '"},{"role":"user","content":"<command-name>x"},{"role":"user","content":"r"}', answer, ',{"role":"user","content":"tail"}]}')
    rows = table(spark, sf_dir, "conversations").select("conv_id").distinct().select(_s("conv_id").alias("file_path"), F.lit(1).cast("bigint").alias("line_no"), raw.alias("raw"))
    m = F.col("messages")
    done = flows.convert_recorded(rows, "S", [{"name": "Grep", "input_schema": {}}])
    return done.select(F.col("_instance_id").alias("instance"), F.substring_index("rec_id", "#", 1).cast("bigint").alias("conv_id"), "status", F.get(m, F.lit(1))["content"].alias("question"), F.get(F.get(m, F.lit(2))["tool_calls"], F.lit(0))["function"]["arguments"].alias("args"), F.get(m, F.lit(2))["reasoning_content"].alias("thought"), F.when(m.isNotNull(), F.size(m)).alias("n"))


@query(f"""WITH c AS (SELECT DISTINCT conv_id FROM conversations), p AS (SELECT conv_id AS rec_id, 0 AS place, 'system' AS role, 'S' AS content FROM c UNION ALL SELECT conv_id, 1, 'user', 'R' || chr(10) || chr(10) || 'q' || conv_id FROM c UNION ALL SELECT conv_id, 2, 'assistant', 'a' FROM c UNION ALL SELECT conv_id, 3, 'tool', 'out' || conv_id FROM c UNION ALL SELECT conv_id, 4, 'user', 'more' FROM c WHERE conv_id % 2 = 0 UNION ALL SELECT conv_id, 5, 'assistant', 'end' FROM c WHERE conv_id % 3 > 0)
SELECT 'i' || rec_id AS instance, {_NUMBERED}, role, content, CASE WHEN rec_id % 3 > 0 AND rec_id % 2 = 1 THEN 'kept' ELSE 'roles' END AS status FROM p""")
def convert_session_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("conv_id")
    line = lambda n, role, content: F.struct(F.lit(n).cast("bigint").alias("line_no"), _cat('{"type":"', role, '","message":{"role":"', role, '","content":', content, "}}").alias("raw"))
    results = _cat('[{"type":"tool_result","content":[{"type":"text","text":" out', c, ' "}]}', F.when(c % 2 == 0, ',{"type":"text","text":" more "}').otherwise(""), "]")
    every = F.array(line(1, "user", _cat('"q', c, '"')), F.struct(F.lit(2).cast("bigint").alias("line_no"), F.lit('{"type":"summary"}').alias("raw")), line(3, "assistant", F.lit('[{"type":"text","text":"a"},{"type":"tool_use","id":"1","name":"Read","input":{}}]')), line(4, "user", results), F.when(c % 3 > 0, line(5, "assistant", F.lit('"end"'))))
    path = F.when(c % 2 == 0, _cat("file:/r/i", c, "/agent/s.jsonl")).otherwise(_cat("file:/r/i", c, ".jsonl"))
    rows = table(spark, sf_dir, "conversations").select("conv_id").distinct().select(path.alias("file_path"), F.inline(F.filter(every, lambda x: x.isNotNull())))
    done = flows.convert_sessions(files.session_events(rows), "S", ["R"], [{"name": "Read", "input_schema": {}}], "file:/r")
    return _exploded(done, "_instance_id", "status").select(F.col("_instance_id").alias("instance"), "msg_idx", "role", "content", "status")


_LOGGED = '{{"request_time":{t},"request_body":{{"system":"s","tools":[{{"type":"function","function":{{"name":"Edit"}}}}],"messages":[{{"role":"user","content":"go {n}"}},{{"role":"assistant","content":"","tool_calls":[{calls}]}},{{"role":"{role}","content":"ok"}}]}},"response_body":{{"choices":[{choice}]}},"usage":{{"n":1}}}}'


def _logged(t: Column, n: Column, calls: Column, role: Column, choice: Column) -> Column:
    parts = {"t": t, "n": n, "calls": calls, "role": role, "choice": choice}
    out: list = []
    for k_, piece in enumerate(_LOGGED.replace("{{", "\u0001").replace("}}", "\u0002").split("{")):
        name, _, rest = piece.partition("}") if k_ else ("", "", piece)
        out += ([parts[name]] if k_ else []) + [rest.replace("\u0001", "{").replace("\u0002", "}")]
    return _cat(*out)


_CALL = '{"id":"1","function":{"name":"Edit","arguments":"{}"}}'
_DONE = '{"message":{"role":"assistant","content":"done"}}'


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two logged requests of each nation: of key % 4, 1 has a turn without call, 2 ends with the user, 3 lacks a response object."""
    n, t = F.col("n_nationkey"), F.col("t")
    kind = F.when(t == 2, n % 4).otherwise(0)
    raw = _logged(t, t, F.when(kind == 1, "").otherwise(_CALL), F.when(kind.isin(1, 2), "user").otherwise("tool"), F.when(kind == 2, "").otherwise(_DONE))
    raw = F.when(kind == 3, F.replace(raw, _cat('"response_body":{"choices":[', _DONE, "]}"), F.lit('"response_body":[1]'))).otherwise(raw)
    return table(spark, sf_dir, "nation").select("n_nationkey", F.explode(F.array(F.lit(1), F.lit(2))).alias("t")).select(_s("n_nationkey").alias("instance_id"), F.col("t").cast("bigint").alias("line_no"), raw.alias("raw"))


@query("SELECT CAST(n_nationkey AS VARCHAR) AS instance, 2 AS n, 'system,user,assistant,tool,assistant' AS roles FROM nation WHERE n_nationkey % 4 = 0")
def logged_instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = flows.convert_logged(_nations(spark, sf_dir))
    return kept.groupBy(F.col("_instance_id").alias("instance")).agg(F.count("*").cast("int").alias("n"), F.max(F.array_join(F.transform("messages", lambda m: m["role"]), ",")).alias("roles"))


@query("SELECT count(*) FILTER (n_nationkey % 4 IN (1, 2)) AS role_filtered, 0 AS reasoning_filtered, count(*) FILTER (n_nationkey % 4 = 3) AS failed_instances FROM nation")
def logged_skip_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.skip_counts(flows.logged_records(_nations(spark, sf_dir))).withColumn("reasoning_filtered", F.col("reasoning_filtered").cast("int"))


@query("SELECT CAST(n_nationkey AS VARCHAR) AS instance FROM (SELECT n_nationkey, row_number() OVER (ORDER BY n_nationkey DESC) AS r FROM nation WHERE n_nationkey % 4 = 0) WHERE r <= 3")
def first_kept_instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = table(spark, sf_dir, "nation").select(_s("n_nationkey").alias("_instance_id"), (-F.col("n_nationkey")).alias("position"))
    return flows.first_instances(flows.logged_records(_nations(spark, sf_dir)), listing, 3, True).select(F.col("_instance_id").alias("instance")).distinct()


@query("""SELECT CAST(n_nationkey AS VARCHAR) AS instance, CASE n_nationkey % 5 WHEN 0 THEN 'kept' WHEN 1 THEN 'no_file' WHEN 2 THEN 'all_failed' WHEN 3 THEN 'no_choices' ELSE 'invalid' END AS status, CASE WHEN n_nationkey % 5 = 0 THEN '{"model":"m","max_tokens":' || n_nationkey || ',"temperature":0.5}' END AS params, CASE WHEN n_nationkey % 5 = 0 THEN '{"n":1}' END AS usage, CASE WHEN n_nationkey % 5 = 0 THEN 'go ' || n_nationkey END AS asked FROM nation""")
def last_record_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    kind = n % 5
    raw = _logged(F.lit(1), n, F.when(kind == 4, "").otherwise(_CALL), F.lit("tool"), F.when(kind == 3, "").otherwise(_DONE))
    raw = F.replace(raw, F.lit('"system":"s",'), _cat('"model":"m","max_tokens":', n, ',"temperature":0.5,'))
    nations = table(spark, sf_dir, "nation")
    last = nations.filter(kind != 1).select(_s("n_nationkey").alias("_instance_id"), F.when(kind != 2, raw).alias("raw"))
    got = flows.convert_last_records(last, nations.select(_s("n_nationkey").alias("_instance_id")))
    kept = lambda c: F.when(F.col("status") == "kept", c)
    return got.select(F.col("_instance_id").alias("instance"), "status", kept(F.col("_gen_params")).alias("params"), kept(F.col("_usage")).alias("usage"), kept(F.get("messages", F.lit(0))["content"]).alias("asked"))


# ---- normal form ----


@query(_STEPS + """ SELECT rec_id, step, CASE WHEN k % 2 = 0 THEN 'a' || k ELSE '' END AS thought, CASE WHEN k % 2 = 0 THEN 'b' || k ELSE '<think>x' || k END AS rest, CASE WHEN k % 2 = 0 THEN 'b' || k ELSE '<think>x' || k END AS stripped FROM steps""")
def think_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    said = F.when(k % 2 == 0, _cat("<think> a", k, " </think>\n b", k, " ")).otherwise(_cat("<think>x", k))
    thought, rest = text.think_parts(F.col("c"))
    return event_steps(spark, sf_dir).withColumn("c", said).select("rec_id", "step", thought.alias("thought"), rest.alias("rest"), text.without_think(F.col("c")).alias("stripped"))


@query(_STEPS + """ SELECT rec_id, step, CASE WHEN k % 3 = 2 THEN '"{' || k || '"' ELSE '{"b":' || k || ',"a":"é","c":[1,2]}' END AS canonical, CASE WHEN k % 3 = 2 THEN '"{' || k || '"' ELSE '{"a":"é","b":' || k || ',"c":[1,2]}' END AS ordered FROM steps""")
def call_arguments(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    raw = F.when(k % 3 == 2, _cat("{", k)).otherwise(_cat('{"b": ', k, ', "a": "é", "c": [1, 2]}'))
    rows = event_steps(spark, sf_dir).withColumn("raw", raw)
    return rows.select("rec_id", "step", normalize.args_canon(F.col("raw")).alias("canonical"), normalize.args_reorder(F.col("raw"), F.array(F.lit("a"), F.lit("z"), F.lit("b"))).alias("ordered"))


_SHAPES = (("task_completed", "finish"), ("thought", "think"), ("task_list", "task_tracker"), ("old_str", "str_replace_editor"), ("command,is_input", "execute_bash"), ("command,path", "str_replace_editor"), ("other", "own"))


_SHAPE_NAMES = "list_extract([" + ", ".join(f"'{n}'" for _, n in _SHAPES) + "], (p_partkey % 7)::INT + 1)"


@query(f"SELECT p_partkey, {_SHAPE_NAMES} AS tool, {_SHAPE_NAMES} AS called FROM part")
def canonical_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = F.get(F.array(*(F.lit('{"properties":{' + ",".join(f'"{x}":{{}}' for x in p.split(",")) + "}}") for p, _ in _SHAPES)), (F.col("p_partkey") % 7).cast("int"))
    tool = F.struct(F.lit("function").alias("type"), F.struct(F.lit("own").alias("name"), F.lit("").alias("description"), params.alias("parameters")).alias("function"))
    call = F.struct(F.lit("1").alias("id"), F.lit("function").alias("type"), F.struct(F.lit("own").alias("name"), F.lit("{}").alias("arguments")).alias("function"))
    message = F.from_json(F.lit('[{"role":"assistant","content":""}]'), f"array<{schema.MESSAGE}>")
    rows = table(spark, sf_dir, "part").select("p_partkey", F.array(tool).alias("tools"), F.transform(message, lambda m: m.withField("tool_calls", F.array(call))).alias("messages"))
    done = normalize.canonicalize(rows)
    return done.select("p_partkey", F.get("tools", F.lit(0))["function"]["name"].alias("tool"), F.get(F.get("messages", F.lit(0))["tool_calls"], F.lit(0))["function"]["name"].alias("called"))


_CONV = "WITH c AS (SELECT conv_id AS rec_id, turn, role, text FROM conversations)"


def _talk(spark: SparkSession, sf_dir: str, change=lambda m: m) -> DataFrame:
    """Conversations as trajectories without tools."""
    row = F.struct("msg_idx", "role", F.lit(None).cast("string").alias("name"), "content", F.lit(None).cast("string").alias("reasoning_content"), F.lit(None).cast(f"array<{schema.CALL}>").alias("tool_calls"), F.lit(None).cast("double").alias("weight"), F.lit(None).cast("string").alias("tool_call_id"))
    rows = change(conversation_messages(spark, sf_dir)).groupBy("rec_id").agg(F.array_sort(F.collect_list(row)).alias("messages"))
    return rows.withColumn("messages", F.transform("messages", lambda m: m.dropFields("msg_idx"))).withColumn("tools", F.lit(None).cast(f"array<{schema.TOOL}>"))


@query(_CONV + """, l AS (SELECT *, repeat(text, 4) AS t, CASE role WHEN 'user' THEN 5000 WHEN 'assistant' THEN 50000 ELSE 1000000000 END AS most, CASE WHEN role = 'assistant' THEN count(*) FILTER (role = 'assistant') OVER (PARTITION BY rec_id ORDER BY turn) - 1 END AS assistant_turn FROM c)
SELECT rec_id, CAST(row_number() OVER (PARTITION BY rec_id ORDER BY turn) - 1 AS BIGINT) AS msg_idx, md5(CASE WHEN length(t) > most THEN left(t, most // 2) || chr(10) || '... [truncated] ...' || chr(10) || right(t, most // 2) ELSE t END) AS hash, CAST(assistant_turn AS INT) AS assistant_turn, CASE WHEN role = 'assistant' AND assistant_turn = 0 THEN 'why' END AS thought FROM l""")
def truncated_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _talk(spark, sf_dir, lambda m: m.withColumn("role", F.when(F.col("role") == "user", "tool").otherwise(F.col("role"))).withColumn("content", F.repeat("content", 4)))
    rows = rows.withColumn("messages", normalize.attach_reasoning(F.col("messages"), F.create_map(F.lit(0), F.lit("why"), F.lit(1_000), F.lit("never"))))
    cut = rows.select("rec_id", F.posexplode(normalize.truncate_messages(F.col("messages"))).alias("msg_idx", "m"))
    return cut.select("rec_id", F.col("msg_idx").cast("bigint").alias("msg_idx"), F.md5("m.content").alias("hash"), F.col("m.assistant_turn_index").alias("assistant_turn"), F.col("m.reasoning_content").alias("thought"))


@query(_STEPS + """, g AS (SELECT rec_id, count(*) AS n, count(*) FILTER (k % 4 = 0) AS r, count(*) FILTER (k % 50 = 0 AND step < n - 1) AS bare FROM steps GROUP BY rec_id)
SELECT CAST(rec_id AS VARCHAR) AS rec_id, r = n AS strict, r / n >= 0.2 AS fifth, r / n >= 0.3 AS third, true AS fast, bare = 0 AS calls, CASE WHEN r > 0 THEN 'slow' ELSE 'fast' END AS mode FROM g""")
def reasoning_and_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = event_steps(spark, sf_dir).groupBy("rec_id").agg(F.array_sort(F.collect_list(F.struct("step", "k"))).alias("ks"))
    rows = event_trajectories(spark, sf_dir).join(marked.withColumn("rec_id", _s("rec_id")), "rec_id")
    value = lambda i: F.get("ks", ((i - 1) / 2).cast("int"))["k"]

    def change(m: Column, i: Column) -> Column:
        acting = m["role"] == "assistant"
        calls = F.when(acting & (value(i) % 50 != 0), m["tool_calls"])
        return m.withField("reasoning_content", F.when(acting & (value(i) % 4 == 0), F.lit(" "))).withField("tool_calls", calls)

    rows = rows.withColumn("messages", F.transform("messages", change))
    m, slow = F.col("messages"), F.lit("slow")
    return rows.select("rec_id", validate.reasoning_valid(m, slow, "strict").alias("strict"), validate.reasoning_valid(m, slow).alias("fifth"), validate.reasoning_valid(m, slow, threshold=0.3).alias("third"), validate.reasoning_valid(m, F.lit("fast"), "strict").alias("fast"), validate.tool_calls_valid(m).alias("calls"), normalize.think_mode(m).alias("mode"))


# ---- other kinds of agents ----

_KINDS = (("terminal,think", "openhands_sdk"), ("Bash,Edit", "claudecode"), ("bash", "opencode"), ("execute,look", "openhands"))
_END = "CASE rec_id % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 0.8 ELSE 0.5 END"


@query(_METRICS_SQL + f""", lateobs AS (SELECT rec_id, avg(is_error::INT) AS err FROM steps WHERE step >= floor(n * 0.7::DOUBLE) GROUP BY rec_id), tested AS (SELECT rec_id, bool_or(is_test AND step + 1 >= greatest(floor((n + 1) * 0.8::DOUBLE), 1)) AS t FROM steps GROUP BY rec_id),
e AS (SELECT b.rec_id, CASE b.rec_id % 4 {' '.join(f"WHEN {i} THEN '{s}'" for i, (_, s) in enumerate(_KINDS))} END AS scaffold, CASE WHEN b.rec_id % 4 IN (0, 3) THEN {_END.replace('rec_id', 'b.rec_id')} ELSE 1.0 END::DOUBLE AS ending, err, t, wrote, loop, rep FROM base b JOIN lateobs USING (rec_id) JOIN tested USING (rec_id) JOIN raw r ON r.rec_id = b.rec_id)
SELECT CAST(rec_id AS VARCHAR) AS rec_id, scaffold, round(least(1, ending * (0.7 + 0.3 * (1 - err)) + CASE WHEN t THEN 0.15 ELSE 0 END)::DOUBLE, 4) AS sub, round(greatest(0, 1 - (CASE WHEN wrote THEN 0 ELSE 0.4 END + least(0.3, loop * 3) + least(0.3, rep * 0.6)))::DOUBLE, 4) AS dpi, false AS truncated FROM e""")
def scaffolds_and_endings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = F.col("rec_id").cast("bigint")
    named = lambda names: F.from_json(F.lit("[" + ",".join(f'{{"type":"function","function":{{"name":"{n}"}}}}' for n in names.split(",")) + "]"), f"array<{schema.TOOL}>")
    tools = F.get(F.array(*(named(n) for n, _ in _KINDS)), (rec % 4).cast("int"))
    message = lambda role, content: F.from_json(F.lit(f'[{{"role":"{role}"}}]'), f"array<{schema.MESSAGE}>")[0].withField("content", content)
    end = F.get(F.array(F.lit("The fix is complete."), F.lit("done, perhaps"), F.lit("bye")), (rec % 3).cast("int"))
    system = F.array(message("system", F.when(rec % 4 == 1, "made by Anthropic").otherwise("agent")))
    rows = event_trajectories(spark, sf_dir).withColumn("tools", tools).withColumn("messages", F.concat(system, "messages", F.array(message("assistant", end))))
    p = relations.profiles(relations.steps(rows))
    return p.select("rec_id", "scaffold", F.round(metrics.sub().cast("double"), 4).alias("sub"), F.round(metrics.dpi().cast("double"), 4).alias("dpi"), metrics.truncated().alias("truncated"))


@query(_STEPS + """ SELECT CAST(rec_id AS VARCHAR) AS rec_id, 'terminus2' AS scaffold, sum(1 + k % 2)::BIGINT AS calls, count(*) FILTER (is_error) AS errors, bool_or(step = n - 1 AND k % 2 = 0) AS finished FROM steps GROUP BY rec_id""")
def typed_command_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    steps = event_steps(spark, sf_dir, text_ids=True)
    last = F.col("step") == F.max("step").over(_by_record())
    typed = _cat('<think>x</think>{"commands":[{"keystrokes":"ls\\n"}', F.when(k % 2 == 1, ',{"keystrokes":"pwd\\n"}').otherwise(""), "]", F.when((k % 2 == 0) & F.col("last"), ',"task_complete":true').otherwise(""), "}")
    message = lambda role, content: F.from_json(F.lit(f'[{{"role":"{role}"}}]'), f"array<{schema.MESSAGE}>")[0].withField("content", content)
    pair = F.struct("step", F.array(message("assistant", typed), message("user", F.col("output"))).alias("m"))
    rows = steps.withColumn("last", last).groupBy("rec_id").agg(F.array_sort(F.collect_list(pair)).alias("pairs"))
    rows = rows.select("rec_id", F.lit(None).cast(f"array<{schema.TOOL}>").alias("tools"), F.concat(F.array(message("user", F.lit("fix"))), F.flatten(F.transform("pairs", lambda p: p["m"]))).alias("messages"))
    p = relations.profiles(relations.steps(rows))
    return metrics.error_counts(p).join(p.select("rec_id", F.col("last_turn.t2_done").alias("finished")), "rec_id")


# ---- logged requests ----


@query("""WITH o AS (SELECT o_custkey AS c, o_orderkey AS t, o_orderkey % 2 AS s, 1 + o_orderkey % 7 AS n, o_orderkey % 11 = 0 AS failed FROM orders), g AS (SELECT * FROM o WHERE NOT failed),
p AS (SELECT * FROM g a WHERE NOT EXISTS (SELECT 1 FROM g b WHERE a.c = b.c AND b.t > a.t AND b.s = a.s AND b.n >= a.n)) SELECT CAST(c AS VARCHAR) AS instance, t AS line_no FROM p WHERE n > 2""")
def logged_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = F.col("o_orderkey")
    messages = F.array_join(F.transform(F.sequence(F.lit(1), (1 + o % 7).cast("int")), lambda i: _cat('{"role":"user","content":"', o % 2, "-", i, '","cache_control":', o, "}")), ",")
    raw = _cat('{"success":', F.when(o % 11 == 0, "false").otherwise("true"), ',"request_time":', o, ',"request_body":{"messages":[', messages, "]}}")
    rows = table(spark, sf_dir, "orders").select(_s("o_custkey").alias("instance_id"), o.alias("line_no"), raw.alias("raw"))
    return dedup.dedup_requests(rows).select(F.col("instance_id").alias("instance"), "line_no")


# ---- judges ----


@query("""WITH i AS (SELECT o_custkey AS rec_id, o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'F' WHEN o_orderkey % 3 = 1 THEN 'G' ELSE 'Z' END AS category, CASE WHEN o_orderkey % 7 = 6 THEN 1 ELSE greatest(1, least(5, o_orderkey % 7)) END AS score FROM orders),
c AS (SELECT rec_id, category, (sum(score) - count(*)) / (4 * count(*)) AS reward, sum(score) AS s, count(*) AS n FROM i GROUP BY ALL)
SELECT CAST(rec_id AS VARCHAR) AS rec_id, round(avg(reward), 6) AS composite, round(max(CASE WHEN category = 'F' THEN reward END), 6) AS f, CAST(coalesce(sum(s) FILTER (category <> 'Z'), 0) AS BIGINT) AS total_score, CAST(coalesce(sum(n) FILTER (category <> 'Z'), 0) AS BIGINT) AS total_checks, CAST(coalesce(sum(5 * n) FILTER (category <> 'Z'), 0) AS BIGINT) AS total_max FROM c GROUP BY rec_id""")
def judged_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = F.col("o_orderkey")
    category = F.when(o % 3 == 0, "F").when(o % 3 == 1, "G").otherwise("Z")
    score = F.when(o % 7 == 6, '"high"').otherwise(_s(o % 7))
    by = table(spark, sf_dir, "orders").groupBy(_s("o_custkey").alias("rec_id"), category.alias("category")).agg(F.array_join(F.collect_list(_cat('"c', o, '":', score)), ",").alias("checks"))
    answers = by.groupBy("rec_id").agg(_cat('```json\n{"ratings":{', F.array_join(F.collect_list(_cat('"', F.col("category"), '":{', F.col("checks"), "}")), ","), "}}\n```").alias("llm_raw_response"))
    rated = answers.select("rec_id", F.explode(judge.ratings(F.col("llm_raw_response"))).alias("category", "checks")).select("rec_id", "category", F.explode("checks").alias("check", "value"))
    rewards = stats.rated_rewards(rated.select("rec_id", "category", text.clamp_score(F.col("value"), 1, 5).alias("score")))
    return rewards.select("rec_id", F.round("composite", 6).alias("composite"), F.round(F.try_element_at("categories", F.lit("F")), 6).alias("f")).join(reports.judge_details(answers).drop("by_category"), "rec_id")


@query("""SELECT l_orderkey AS rec_id, 'cat_' || (l_orderkey % 3) AS category_id, CASE WHEN n = 1 THEN 'check_a' ELSE 'check_a_' || n END AS check_id, 'd' || l_linenumber AS description, CASE WHEN l_linenumber % 3 = 0 THEN 0 WHEN n % 2 = 1 THEN 1 ELSE 0 END AS score, CASE WHEN l_linenumber % 3 = 0 THEN 'failed' WHEN n % 2 = 1 THEN 'passed' ELSE 'failed' END AS status, CASE WHEN l_linenumber % 3 = 0 THEN 'not judged' ELSE 'r' END AS reasoning, CASE WHEN l_linenumber % 3 = 0 THEN 0 ELSE 3 END AS evidence
FROM (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS n FROM lineitem)""")
def checklist_judgement(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    n_tasks = tasks_for(lines)
    made = lines.repartition(n_tasks, "l_orderkey").groupBy(F.col("l_orderkey").alias("rec_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("l_linenumber")), lambda x: _cat('{"check_id":" Check-A!","requirement":"d', x, '"},{"description":" "}')), ",").alias("checks"))
    rows = made.select("rec_id", _cat('```json\n{"meta":{"checks":[]},"Cat ', F.col("rec_id") % 3, '":{"checks":[', F.col("checks"), "]}}\n```").alias("answer"))
    checks = judge.checklist_rows(rows)
    n = F.coalesce(F.nullif(F.regexp_extract("check_id", r"_([0-9]+)$", 1), F.lit("")).cast("int"), F.lit(1))
    verdicts = checks.filter(F.substring("description", 2, 9).cast("int") % 3 != 0).select("rec_id", "category_id", "check_id", F.when(n % 3 == 0, F.when(n % 2 == 1, "PASSED").otherwise("failed")).alias("status"), F.when(n % 2 == 1, F.when(n % 3 == 1, "7").otherwise(" 1 ")).otherwise("no").alias("score"), F.lit("r").alias("reasoning"), F.array(F.lit("1"), F.lit(" "), F.lit("2"), F.lit(None), F.lit("3"), F.lit("4")).alias("evidence"))
    done = judge.project_judgement(checks, verdicts, n_tasks)
    return done.select("rec_id", "category_id", "check_id", "description", F.col("score").cast("int").alias("score"), "status", "reasoning", F.size("evidence").alias("evidence"))


@query("""SELECT count(*) AS records, sum(length(text) // 4)::BIGINT AS input_tokens, count(*) * 2000 AS output_tokens, round((sum(length(text) // 4) * 2.5 + count(*) * 2000 * 10.0) / 1e6, 9) AS cost FROM documents""")
def judge_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.cost_estimate(table(spark, sf_dir, "documents"), "text", 2.5, 10.0).withColumn("cost", F.round("cost", 9))


@query("""WITH l AS (SELECT doc_id, quality, toxic, doc_id % 3 AS kind FROM labels), m AS (SELECT * FROM l WHERE doc_id % 5 <> 4)
SELECT 'composite' AS name, count(quality) FILTER (kind = 0) AS scored, count(*) FILTER (kind = 1) AS failed, count(*) - count(quality) FILTER (kind = 0) - count(*) FILTER (kind = 1) AS not_scored, round(avg(quality::DOUBLE) FILTER (kind = 0), 6) AS mean, min(quality::DOUBLE) FILTER (kind = 0) AS low, max(quality::DOUBLE) FILTER (kind = 0) AS high FROM m
UNION ALL SELECT 'toxic', count(toxic), NULL, NULL, round(avg(toxic::DOUBLE), 6), min(toxic::DOUBLE), max(toxic::DOUBLE) FROM m""")
def judge_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    rows = table(spark, sf_dir, "labels").select(F.when(d % 5 == 4, "subagent").otherwise("main").alias("_agent_type"), F.when(d % 3 == 0, F.col("quality")).alias("s"), F.when(d % 3 == 1, "down").alias("e"), "toxic")
    return reports.llm_summary(rows, {"toxic": "toxic"}, "s", "e").withColumn("mean", F.round("mean", 6))


# ---- files ----


@query("""SELECT n_nationkey, 't' || n_nationkey AS folder, CASE WHEN n_nationkey % 6 = 5 THEN NULL ELSE 'id' || n_nationkey END AS instance, 'x__' || n_nationkey AS named FROM nation WHERE n_nationkey % 2 = 0""")
def job_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    nations = table(spark, sf_dir, "nation")
    by = nations.groupBy("n_regionkey", (n % 2).alias("r")).agg(F.array_join(F.collect_list(_cat('"t', n, '"')), ",").alias("f"))
    evals = by.groupBy("n_regionkey").agg(_cat('"e', F.col("n_regionkey"), '":{"reward_stats":{"reward":{', F.array_join(F.collect_list(_cat('"', F.when(F.col("r") == 0, "1.0").otherwise("0.0"), '":[', F.col("f"), "]")), ","), "}}}").alias("e"))
    result = evals.agg(_cat('{"stats":{"evals":{', F.array_join(F.collect_list("e"), ","), "}}}").alias("raw"))
    config = F.when(n % 6 == 5, '{"task":{"path":" "}}').otherwise(_cat('{"task":{"path":"', F.when(n % 3 == 0, "/abs/").otherwise("tasks/"), "id", n, F.when(n % 4 == 0, "/").otherwise(""), '"}}'))
    tasks = files.trial_tasks(nations.select(_cat("file:/job/t", n, "/config.json").alias("file_path"), config.alias("raw")))
    key = F.substring("folder", 2, 9)
    return files.job_folders(result).join(tasks, "folder").select(key.cast("int").alias("n_nationkey"), "folder", F.col("instance_id").alias("instance"), files.instance_of_folder(_cat("x__", key, "__abc")).alias("named"))


@query("""WITH l AS (SELECT o_custkey AS c, o_orderkey AS n, o_orderkey % 3 = 0 AS failed FROM orders) SELECT c, max(n) AS last, max(n) FILTER (NOT failed) AS last_good, count(*) FILTER (n <= 100) AS early FROM l GROUP BY c""")
def last_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(_s("o_custkey").alias("file_path"), o.alias("line_no"), F.when(o % 3 == 0, _cat('{"success":false,"n":', o, "}")).when(o % 3 == 1, _cat('{"success":"false","n":', o, "}")).otherwise(_cat('{"success":null,"n":', o, "}")).alias("raw"))
    n = lambda df, name: df.select("file_path", F.get_json_object("raw", "$.n").cast("bigint").alias(name))
    early = files.first_records(rows, 100, "line_no").groupBy("file_path").agg(F.count("*").alias("early"))
    found = n(files.last_records(rows), "last").join(n(files.last_records(rows, True), "last_good"), "file_path", "left").join(early, "file_path", "left")
    return found.select(F.col("file_path").cast("int").alias("c"), "last", "last_good", F.coalesce("early", F.lit(0).cast("bigint")).alias("early"))


@query("""SELECT p_partkey, row_number() OVER (PARTITION BY p_partkey % 5 ORDER BY CASE WHEN p_partkey % 4 = 0 THEN -1 ELSE (p_partkey * 7919) % 1000 + 0.5 END, name)::INT AS rank, CASE WHEN p_partkey % 2 = 0 THEN 'd' || (p_partkey % 5) ELSE 's' || p_partkey END AS instance FROM (SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'n' || p_partkey ELSE 'x' || ((p_partkey * 7919) % 1000) || '.5-' || p_partkey END AS name FROM part)""")
def file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p_partkey")
    name = F.when(p % 4 == 0, _cat("n", p)).otherwise(_cat("x", (p * 7919) % 1000, ".5-", p))
    rows = files.ordered_files(table(spark, sf_dir, "part").select("p_partkey", _cat("/a/", p % 5, "/", name).alias("file_path")))
    path = F.when(p % 2 == 0, _cat("file:/root/d", p % 5, "/x/y.jsonl")).otherwise(_cat("file:/root/s", p, ".jsonl"))
    return rows.select("p_partkey", "rank", files.session_instance(path, "file:/root").alias("instance"))


@query("""SELECT 'f#' || o_orderkey AS rec_id, CASE o_orderkey % 4 WHEN 0 THEN '0.5' WHEN 1 THEN NULL WHEN 2 THEN '' || o_custkey ELSE NULL END AS score, CASE WHEN o_orderkey % 4 = 2 THEN 'n' || o_custkey END AS instance, 2 AS n FROM orders""")
def lifted_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    nested = _cat('"meta_info":{"unique_info":{"_score":', c, ',"_instance_id":"n', c, '"}}')
    top = F.when(o % 4 == 0, '"_score":0.5,').when(o % 4 == 1, _cat('"_score":null,"_instance_id":null,', nested, ",")).when(o % 4 == 2, _cat(nested, ",")).otherwise("")
    rows = table(spark, sf_dir, "orders").select(F.lit("f").alias("file_path"), o.alias("line_no"), _cat("{", top, '"messages":[{"role":"user","content":"x"},{"role":"assistant"}],"tools":[]}').alias("raw"))
    return files.trajectories(rows).select("rec_id", F.col("_score").alias("score"), F.col("_instance_id").alias("instance"), F.size("messages").alias("n"))


@query(_CONV + f""" SELECT rec_id, CAST(row_number() OVER (PARTITION BY rec_id ORDER BY turn) - 1 AS BIGINT) AS msg_idx, role, {_W} AS content FROM c""")
def rendered_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = lambda m: m.withColumn("content", _cat(F.when((F.col("role") == "assistant") & (F.col("msg_idx") % 2 == 1), "<think>no</think>\n ").otherwise(""), "w", F.substring(F.regexp_replace("content", "[^a-zA-Z]+", ""), 1, 20)))
    lf = sinks.to_lf(_talk(spark, sf_dir, said), F.lit("fast"))
    return _exploded(lf, "rec_id")


# ---- commands, outputs and paths, composed from parts ----

_BEFORE = ("", "cd /repo && ", "FOO=1 ", "timeout 60 ", "env A=b ", "true; ")
_RUN = (("pytest -q", True, ""), ("go test ./...", True, ""), ("ls -la", False, ""), ("echo x > src/a{k}.py", False, "src/a{k}.py"), ("pip install pytest", False, ""), ("sed -i 's/a/b/' lib/b{k}.go", False, "lib/b{k}.go"), ("cat notes{k}.txt", False, ""), ("npm test", True, ""))
_AFTER = ("", " 2>&1 | tail -5", " || exit 1")


def _sql_case(expr: str, values) -> str:
    return f"CASE {expr} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


def _choose(values, index: Column) -> Column:
    return F.get(F.array(*(F.lit(v) for v in values)), index.cast("int"))


@query(_STEPS + f""" SELECT rec_id, step, {_sql_case('k % 8', [str(t).upper() for _, t, _ in _RUN])} AS test_run, replace({_sql_case('k % 8', [f"'{e}'" for *_, e in _RUN])}, '{{k}}', '' || k) AS edits FROM steps""")
def composed_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    command = F.concat(_choose(_BEFORE, F.col("step") % 6), F.replace(_choose([c for c, *_ in _RUN], k % 8), F.lit("{k}"), _s(k)), _choose(_AFTER, F.floor(F.col("step") / 6) % 3))
    rows = event_steps(spark, sf_dir).withColumn("cmd", command)
    return rows.select("rec_id", "step", shell.is_test_run(F.col("cmd")).alias("test_run"), F.array_join(shell.edit_paths(F.col("cmd")), ",").alias("edits"))


@query(_STEPS + """ SELECT rec_id, step, CASE WHEN k % 3 > 0 THEN 'fail' WHEN k % 5 > 0 THEN 'pass' ELSE 'unknown' END AS outcome FROM steps""")
def composed_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    lines = F.repeat(_cat("collecting case ", k, "\n"), (k % 40 * 20).cast("int"))
    failed = F.when(k % 3 > 0, _cat(k % 3, " failed")).otherwise("")
    passed = F.when(k % 5 > 0, _cat(k % 5, " passed")).otherwise("")
    both = F.concat_ws(", ", F.nullif(failed, F.lit("")), F.nullif(passed, F.lit("")))
    return event_steps(spark, sf_dir).select("rec_id", "step", text.test_outcome(F.concat(lines, both, F.when(both != "", " in 0.1s").otherwise("no tests ran"))).alias("outcome"))


@query(_STEPS + """ SELECT rec_id, step, 'src/m' || k || '/x.py' AS path, k % 4 = 1 AS is_test, k % 3 <> 2 AS plausible FROM steps""")
def composed_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    root = _choose(("/testbed/", "/workspace/", "./", ""), F.col("step") % 4)
    path = F.concat(root, F.lit("src/"), F.when(k % 2 == 0, "./").otherwise("q/../"), _cat("m", k), F.lit("//x.py"))
    test = F.when(k % 4 == 1, _cat("pkg/test_", k, ".py")).otherwise(_cat("pkg/contest", k, ".py"))
    odd = F.when(k % 3 == 2, _choose(("&1", "2", "/dev/null", ">x"), F.col("step") % 4)).otherwise(_cat("a/", k, ".txt"))
    return event_steps(spark, sf_dir).select("rec_id", "step", shell.norm_path(path).alias("path"), shell.is_test_file(test).alias("is_test"), shell.plausible_path(odd).alias("plausible"))


@query("SELECT event_id, round((1 / (1 + exp(-10 * (x - 0.5))) - 1 / (1 + exp(5::DOUBLE))) / (1 / (1 + exp(-5::DOUBLE)) - 1 / (1 + exp(5::DOUBLE))), 9) AS y FROM (SELECT event_id, (event_id % 101) / 100 AS x FROM events)")
def stretched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.round(metrics.sigmoid_stretch((F.col("event_id") % 101) / 100), 9).alias("y"))
