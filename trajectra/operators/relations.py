"""From nested trajectories to one profile row for each: its turns, actions and observations in order.

Messages are exploded, everything heavy (patterns on commands and output) is computed
once and row-locally, and the only exchange is the one by rec_id.  Windows over a
record's messages find each observation's call: the nearest assistant message before
it, and in this the call of the observation's ordinal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajectra.functions import patterns as P
from trajectra.functions import shell, text

T2 = "terminus2"
_T2_JSON = "struct<commands:array<struct<keystrokes:string>>,task_complete:string>"
_NO_TEXTS = "CAST(array() AS array<string>)"


def scaffold_of(tools: Column, messages: Column) -> Column:
    """The kind of agent that wrote a record, by the names of its tools."""
    names = F.filter(F.transform(F.coalesce(tools, F.array()), lambda t: t["function"]["name"]), lambda n: n.isNotNull() & (n != ""))
    lower = F.transform(names, lambda n: F.lower(n))
    systems = F.filter(messages, lambda m: m["role"] == "system")
    head = F.lower(F.substring(F.coalesce(F.get(systems, F.lit(0))["content"], F.lit("")), 1, 500))
    vendor = head.contains("claude code") | head.contains("anthropic")
    listed = lambda values: F.array(*map(F.lit, values))
    return (
        F.when(F.coalesce(F.size(names), F.lit(0)) <= 0, T2)
        .when(F.size(F.array_except(names, listed(P.SDK_TOOLS))) == 0, "openhands_sdk")
        .when(F.arrays_overlap(lower, listed(P.CLI_TOOLS)), F.when(vendor, "claudecode").otherwise("opencode"))
        .otherwise("openhands")
    )


_CALLS = "array<struct<name:string,executes:boolean,writes:boolean,path:string,target:string,raw_edits:array<string>,edits:array<string>,kind:string,sub:string,formal_test:boolean,test_run:boolean>>"


def _calls(raw: Column, name, args, command, executes) -> Column:
    """Parsed calls, in steps so that nothing costly is written twice into one expression."""
    no_texts = F.expr(_NO_TEXTS)

    def basics(c: Column) -> Column:
        return F.struct(F.lower(F.coalesce(name(c), F.lit(""))).alias("name"), args(c).alias("args"), command(c).alias("command"))

    def running(c: Column) -> Column:
        run = executes(c)
        return F.struct(c["name"].alias("name"), c["args"].alias("args"), c["command"].alias("command"), run.alias("executes"))

    def parts(c: Column) -> Column:
        edits = F.when(c["executes"], shell.edit_paths(c["command"])).otherwise(no_texts)
        segments = F.when(c["executes"], shell.run_segments(c["command"])).otherwise(no_texts)
        return F.struct(c["name"].alias("name"), c["args"].alias("args"), c["executes"].alias("executes"), edits.alias("edits"), segments.alias("segments"), shell.path_argument(c["args"]).alias("path"))

    def whole(c: Column) -> Column:
        return F.struct(
            c["name"].alias("name"),
            c["executes"].alias("executes"),
            shell.is_write(c["name"], c["args"]).alias("writes"),
            c["path"].alias("path"),
            F.when(c["path"] != "", shell.norm_path(c["path"])).alias("target"),
            c["edits"].alias("raw_edits"),
            F.transform(c["edits"], shell.norm_path).alias("edits"),
            shell.action_class(c["name"], c["args"]).alias("kind"),
            F.when(c["name"].isin(*P.EDITORS), F.coalesce(shell.arg(c["args"], "command"), F.lit(""))).otherwise("").alias("sub"),
            shell.formal_test_in(c["segments"]).alias("formal_test"),
            shell.test_run_in(c["segments"]).alias("test_run"),
        )

    return F.transform(F.transform(F.transform(F.transform(raw, basics), running), parts), whole).cast(_CALLS)


def _tool_calls(raw: Column) -> Column:
    args = lambda c: c["function"]["arguments"]
    return _calls(raw, lambda c: c["function"]["name"], args, lambda c: shell.command_text(args(c)), lambda c: shell.is_execution(c["name"], c["args"]))


def _typed_commands(raw: Column) -> Column:
    keys = lambda c: F.coalesce(c["keystrokes"], F.lit(""))
    word = lambda c: F.regexp_extract(F.regexp_extract(text.strip(keys(c)), r"(?U)^\S*", 0), r"[^/]*$", 0)
    return _calls(raw, word, lambda c: F.lit("{}"), keys, lambda c: F.lit(True))


def steps(trajectories: DataFrame) -> DataFrame:
    """One row for each message with its turn, its calls, and for an observation the call it answers.

    A record without messages has no rows.  Null roles are messages of no kind.
    """
    records = trajectories
    if "scaffold" not in records.columns:
        records = records.withColumn("scaffold", scaffold_of(F.col("tools"), F.col("messages")))
    rows = records.select("rec_id", "scaffold", F.posexplode("messages").alias("msg_idx", "m"))
    is_assistant = F.col("role") == "assistant"
    rows = rows.select("rec_id", "scaffold", "msg_idx", "m.role", F.coalesce("m.content", F.lit("")).alias("content"), F.coalesce("m.reasoning_content", F.lit("")).alias("reasoning"), "m.tool_calls")
    typed = F.when((F.col("scaffold") == T2) & is_assistant, F.from_json(text.without_think(F.col("content")), _T2_JSON))
    rows = rows.withColumn("typed", typed)
    no_calls = F.expr(f"CAST(array() AS {_CALLS})")
    parsed = F.when(F.col("scaffold") == T2, _typed_commands(F.col("typed.commands"))).otherwise(_tool_calls(F.col("tool_calls")))
    rows = rows.withColumn("calls", F.when(is_assistant, F.coalesce(parsed, no_calls)))
    # what is read from texts is small and made before the exchange, which then carries no texts unless they are asked for
    seen = (F.col("role") == "tool") | ((F.col("scaffold") == T2) & (F.col("role") == "user"))
    rows = rows.withColumn("window", F.when(seen, text.scan_window(F.col("content"))))
    rows = rows.withColumn("signs", F.when(seen, text.error_signs(F.col("window"))))
    thought = F.lower(F.concat("reasoning", F.lit(" "), "content"))
    rows = rows.withColumns(
        {
            "said": F.when(seen, text.outcome_in(F.col("window"), F.col("signs"))),
            "head": F.when(seen, F.substring(text.strip_ansi(F.col("content")), 1, 80)),
            "entropy": F.when(seen, text.char_entropy(F.col("content"))),
            "base": F.when(is_assistant, text.summary_base(F.col("content"))),
            "thought": F.when(is_assistant, thought),
        }
    ).drop("window")
    says = F.struct((text.strip(F.col("thought")) != "").alias("thinks"), *(F.exists(F.array(*map(F.lit, words)), lambda word: F.col("thought").contains(word)).alias(kind) for kind, words in P.INTENT_WORDS.items()))
    rows = rows.withColumn("says", F.when(is_assistant, says)).drop("thought")
    rows = rows.withColumn("t2_done", F.lower(F.col("typed.task_complete")) == "true").drop("typed", "tool_calls")
    w = Window.partitionBy("rec_id").orderBy("msg_idx")
    # what follows is read as what comes before in the reverse order: a frame to the end would be computed again for each row
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("rec_id").orderBy(F.col("msg_idx").desc()).rowsBetween(Window.unboundedPreceding, -1)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    t2 = F.col("scaffold") == T2
    rows = rows.withColumns(
        {
            "turn": F.sum(F.when(is_assistant, 1).otherwise(0)).over(upto),
            "asst_idx": F.last(F.when(is_assistant, F.col("msg_idx")), ignorenulls=True).over(before),
            "answered": F.last(F.when(is_assistant, F.col("calls")), ignorenulls=True).over(before),
            "tools_so_far": F.sum(F.when(F.col("role") == "tool", 1).otherwise(0)).over(upto),
            "next_call": F.last(F.when(F.size(_named(F.col("calls"))) > 0, F.get(_named(F.col("calls")), F.lit(0))), ignorenulls=True).over(after),
            "next_files": F.last(F.when(F.size(_named(F.col("calls"))) > 0, action_files(F.col("calls"), F.get(_named(F.col("calls")), F.lit(0)), t2)), ignorenulls=True).over(after),
            "is_obs": F.when(t2, (F.col("role") == "user") & (F.lag("role").over(w) == "assistant")).otherwise(F.col("role") == "tool"),
            "next_said": F.last(F.when(F.col("role") == "user", F.col("said")), ignorenulls=True).over(after),
        }
    )
    rows = rows.withColumn("tools_at_turn", F.last(F.when(is_assistant, F.col("tools_so_far")), ignorenulls=True).over(before))
    rows = rows.withColumn("pos", F.when(t2, 0).otherwise(F.col("tools_so_far") - 1 - F.coalesce("tools_at_turn", F.lit(0))).cast("int"))
    rows = rows.withColumn("call", F.when(F.col("is_obs"), F.get("answered", F.col("pos"))))
    is_test = F.when(t2, F.exists(F.coalesce("answered", no_calls), lambda c: c["formal_test"])).otherwise(F.col("call.formal_test"))
    executes = t2 | F.coalesce("call.executes", F.lit(False))
    return rows.withColumn("is_error", F.col("is_obs") & text.error_by(F.col("signs"), is_test, executes)).drop("tools_so_far", "tools_at_turn")


def _named(calls: Column) -> Column:
    """Calls with a name: the actions of a message."""
    return F.filter(calls, lambda c: c["name"] != "")


def _first_same(calls: Column, action: Column) -> Column:
    """The message's first call of the same name, by which all its namesakes are classified."""
    return F.get(F.filter(calls, lambda c: c["name"] == action["name"]), F.lit(0))


def action_files(calls: Column, action: Column, t2: Column) -> Column:
    """Distinct files that an action touches; a typed command stands for all commands of its message."""
    same = _first_same(calls, action)
    own = F.concat(F.when(same["target"].isNotNull(), F.array(same["target"])).otherwise(F.expr(_NO_TEXTS)), same["edits"])
    every = F.flatten(F.transform(calls, lambda c: c["edits"]))
    return F.array_distinct(F.when(t2, every).otherwise(own))


def _actions(calls: Column, t2: Column) -> Column:
    """kind (by the first namesake) and loop signature (null without a target) of each action of a message."""

    def action(c: Column) -> Column:
        target = F.when(t2, F.get(F.array_sort(action_files(calls, c, t2)), F.lit(0))).otherwise(F.coalesce(c["target"], F.get(c["edits"], F.lit(0))))
        signature = F.when(target.isNotNull(), F.concat_ws("\u0001", c["name"], c["sub"], target))
        return F.struct(_first_same(calls, c)["kind"].alias("kind"), signature.alias("signature"))

    return F.transform(_named(calls), action)


def profiles(step_rows: DataFrame) -> DataFrame:
    """One row for each record: turns, actions and obs as ordered arrays of small values, and the record's last messages."""
    t2 = F.col("scaffold") == T2
    is_assistant = F.col("role") == "assistant"
    calls = F.col("calls")
    step_files = F.array_distinct(F.flatten(F.transform(calls, lambda c: F.concat(F.when(c["target"].isNotNull() & ~t2, F.array(c["target"])).otherwise(F.expr(_NO_TEXTS)), c["edits"]))))
    edited = F.flatten(F.transform(calls, lambda c: F.when(c["writes"], F.when(c["target"].isNotNull(), F.array(c["target"])).otherwise(F.expr(_NO_TEXTS))).otherwise(c["edits"])))
    kinds = F.filter(F.transform(calls, lambda c: c["kind"]), lambda k: ~k.isin("other", "think"))
    intent = F.when(t2, F.when(F.col("t2_done"), "submit").when(F.size(calls) > 0, "bash")).otherwise(F.get(kinds, F.lit(0)))
    intent = F.when(F.col("says.thinks"), intent)
    says = F.lit(None).cast("boolean")
    for kind in P.INTENT_WORDS:
        says = F.when(intent == kind, F.col(f"says.{kind}")).otherwise(says)
    writes = lambda c: c["writes"] | (F.size(c["edits"]) > 0)
    test_file = lambda c: (c["writes"] & shell.is_test_file(c["path"])) | F.exists(c["raw_edits"], shell.is_test_file)
    verify = F.transform(
        calls,
        lambda c: F.struct(c["test_run"].alias("test"), F.when(t2, F.exists(c["raw_edits"], lambda p: ~shell.is_test_file(p))).otherwise(c["writes"] & (c["path"] != "") & ~shell.is_test_file(c["path"])).alias("fix")),
    )
    turn = F.struct(
        "msg_idx",
        _actions(calls, t2).alias("actions"),
        step_files.alias("files"),
        edited.alias("edited"),
        says.alias("says"),
        F.exists(calls, lambda c: c["formal_test"]).alias("formal_test"),
        F.exists(calls, test_file).alias("test_write"),
        verify.alias("verify"),
        F.size(calls).alias("n_calls"),
        F.when(t2, F.coalesce("next_said", F.lit("unknown"))).alias("t2_outcome"),
    )
    current = F.coalesce(F.get(_named(F.col("answered")), F.col("pos")), F.get(_named(F.col("answered")), F.lit(0)))
    nearby = F.size(F.array_union(action_files(F.col("answered"), current, t2), F.col("next_files")))
    shared = F.size(F.array_intersect(action_files(F.col("answered"), current, t2), F.col("next_files")))
    change = F.when(nearby == 0, 0.0).otherwise(1 - shared / nearby)
    reaction = F.when(F.col("is_error") & current.isNotNull() & F.col("next_call").isNotNull(), ((current["name"] != F.col("next_call.name")).cast("double") + change) / 2)
    wrote = F.when(t2, F.exists("answered", writes)).otherwise(F.coalesce(writes(F.col("call")), F.lit(False)))
    obs = F.struct(
        "msg_idx",
        "asst_idx",
        "pos",
        "turn",
        "is_error",
        F.when(F.col("is_error"), F.col("head")).alias("signature"),
        "entropy",
        reaction.alias("reaction"),
        (F.coalesce(wrote, F.lit(False)) & ~F.col("is_error")).alias("wrote"),
        F.when(F.col("call.test_run") & ~t2, F.col("said")).alias("outcome"),
        F.greatest(F.size("answered"), F.lit(1)).alias("weight"),
    )
    closing = F.struct("role", F.coalesce(F.size("calls"), F.lit(0)).alias("n_calls"), "base")
    final = F.struct(F.exists(calls, lambda c: c["name"] == "finish").alias("finished"), F.coalesce("t2_done", F.lit(False)).alias("t2_done"))
    small = step_rows.select("rec_id", F.col("scaffold").alias("by"), F.col("msg_idx").alias("at"), is_assistant.alias("acts"), F.when(is_assistant, turn).alias("t"), F.when(F.col("is_obs"), obs).alias("o"), closing.alias("c"), F.when(is_assistant, final).alias("f"))
    return small.groupBy("rec_id").agg(
        F.max("by").alias("scaffold"),
        F.count_if("acts").alias("n_turns"),
        F.array_sort(F.collect_list("t")).alias("turns"),
        F.array_sort(F.collect_list("o")).alias("obs"),
        F.max_by("c", "at").alias("last_message"),
        F.max_by("f", F.when(F.col("acts"), F.col("at"))).alias("last_turn"),
    )
