"""Shell commands, paths and tool calls as columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from trajectra.functions import patterns as P
from trajectra.functions.text import strip

#: One simple command: everything up to an unquoted operator.  Possessive, so its depth doesn't grow with the text.
_SEGMENT = r"""(?s)(?:\\.|"(?:[^"\\]++|\\.)*+(?:"|\\?\z)|'[^']*+(?:'|\z)|[^;|&'"\\]++|\\\z)++"""
_HEAD = r"(?U)^(?:[A-Za-z_][A-Za-z0-9_]*=\S*\s+)*+(?:timeout\s+(?:-\S*\s+)*+(?:[\d.]+[smhd]?\s+)?+|(?:sudo|env|time|nohup|exec|stdbuf)\s+)*+(\S*)"


def segments(command: Column) -> Column:
    """Simple commands of a chain, split at unquoted && || ; | &, blank ones left out; newlines don't split."""
    return F.filter(F.regexp_extract_all(F.coalesce(command, F.lit("")), F.lit(_SEGMENT), F.lit(0)), lambda s: strip(s) != "")


def segment_head(segment: Column) -> Column:
    """The command's word after assignments and wrappers, without its folder."""
    return F.regexp_extract(F.regexp_extract(F.concat(strip(segment), F.lit(" ")), _HEAD, 1), r"[^/]*$", 0)


def run_segments(command: Column) -> Column:
    """Segments that may run something: their word isn't one that only reads or moves."""
    return F.filter(segments(command), lambda s: ~segment_head(s).isin(*P.READ_ONLY_HEADS))


def formal_test_in(running: Column) -> Column:
    """is_formal_test() for segments that run_segments() has made."""
    return F.exists(running, lambda s: s.rlike(P.TEST_RUNNER))


def test_run_in(running: Column) -> Column:
    return F.exists(running, lambda s: ~s.rlike(P.NO_VERIFICATION) & (s.rlike(P.TEST_RUNNER) | s.rlike(P.VERIFIES)))


def is_formal_test(command: Column) -> Column:
    """A segment calls a test runner."""
    return formal_test_in(run_segments(command))


def is_test_run(command: Column) -> Column:
    """A test runner or another way to verify, in a segment that isn't an installation, build or edit."""
    return test_run_in(run_segments(command))


def is_test_file(path: Column) -> Column:
    path = F.coalesce(path, F.lit(""))
    return path.rlike(P.TEST_FILE) | path.rlike(P.REPRO_FILE)


def norm_path(path: Column) -> Column:
    """A path without its workspace prefix, with ., .. and doubled slashes resolved as POSIX does."""
    p = F.regexp_replace(path, P.WORKSPACES, "")
    rooted = p.startswith("/")
    root = F.when(p.startswith("//") & ~p.startswith("///"), "//").when(rooted, "/").otherwise("")

    def step(done: Column, part: Column) -> Column:
        last = F.element_at(done, -1)
        up = F.when((F.size(done) > 0) & (last != ".."), F.slice(done, F.lit(1), F.size(done) - 1)).when(rooted, done).otherwise(F.concat(done, F.array(part)))
        return F.when((part == "") | (part == "."), done).when(part == "..", up).otherwise(F.concat(done, F.array(part)))

    parts = F.aggregate(F.split(p, "/"), F.expr("CAST(array() AS array<string>)"), step)
    joined = F.concat(root, F.array_join(parts, "/"))
    return F.when(joined == "", ".").otherwise(joined)


def plausible_path(path: Column) -> Column:
    """Not an operator, redirection, number or device."""
    p = F.regexp_replace(strip(path), "^['\"]+|['\"]+$", "")
    odd = (p == "") | p.rlike(r"[><;|]") | p.startswith("&") | p.rlike(r"(?U)^[&|;\d<>]+$") | p.rlike("/dev/|/proc/|/sys/") | p.isin("/dev", "/proc", "/sys")
    return ~odd


def _in_place_targets(command: Column) -> Column:
    """Files after an in-place sed or perl: the words that follow the script, up to one that can't be a file."""
    after = F.regexp_extract(command, rf"(?sU)^.*?{P.IN_PLACE}(.*)$", 1)
    tokens = F.filter(F.split(after, r"(?U)\s+"), lambda t: t != "")
    start = F.struct(F.lit(False).alias("skip"), F.lit(False).alias("script"), F.lit(False).alias("over"), F.expr("CAST(array() AS array<string>)").alias("files"))

    def step(s: Column, t: Column) -> Column:
        new = lambda skip, script, over, files: F.struct(skip.alias("skip"), script.alias("script"), over.alias("over"), files.alias("files"))
        yes, no = F.lit(True), F.lit(False)
        ends = t.isin("&&", "||", "|", ";", "&") | t.startswith("&&") | t.startswith("||") | t.rlike("[><;]")
        begins = ~s["script"] & t.rlike("^['\"s/]")
        return (
            F.when(s["over"], s)
            .when(s["skip"], new(no, s["script"], no, s["files"]))
            .when(ends, new(no, s["script"], yes, s["files"]))
            .when(t.startswith("-"), new(t.isin("-e", "-E", "-f"), s["script"] | t.isin("-e", "-E", "-f"), no, s["files"]))
            .when(begins, new(no, yes, no, s["files"]))
            .when(s["script"] & plausible_path(t), new(no, yes, no, F.concat(s["files"], F.array(F.regexp_replace(t, "^['\"]+|['\"]+$", "")))))
            .when(s["script"], new(no, yes, yes, s["files"]))
            .otherwise(s)
        )

    return F.aggregate(tokens, start, step, lambda s: s["files"])


def edit_paths(command: Column) -> Column:
    """Files that a command writes: redirection targets by kind, then those of in-place edits."""
    text = F.coalesce(command, F.lit(""))
    found = [F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in P.WRITE_TARGETS]
    in_place = F.when(text.rlike(rf"(?U){P.IN_PLACE}"), _in_place_targets(text)).otherwise(F.expr("CAST(array() AS array<string>)"))
    return F.filter(F.concat(*found, in_place), plausible_path)


# ---- tool calls: a lower-case name and JSON arguments ----


def arg(args: Column, key: str) -> Column:
    return F.get_json_object(args, f"$.{key}")


def _has_key(args: Column, keys: tuple[str, ...]) -> Column:
    return F.coalesce(F.arrays_overlap(F.json_object_keys(args), F.array(*map(F.lit, keys))), F.lit(False))


def is_execution(name: Column, args: Column) -> Column:
    """Whether a call runs a command: by the shape of its arguments first, by its name last."""
    commands = reduce(lambda a, b: a | b, (F.coalesce(strip(arg(args, k)) != "", F.lit(False)) for k in P.COMMAND_KEYS))
    editor = F.coalesce(arg(args, "command").isin(*P.EDITOR_COMMANDS), F.lit(False))
    return F.when(editor | _has_key(args, P.NOT_EXECUTION_KEYS), False).when(commands, True).otherwise(name.isin(*P.EXECUTION_TOOLS))


def command_text(args: Column) -> Column:
    """The first command or code argument that isn't blank, else an empty text."""
    return F.coalesce(*(F.when(strip(arg(args, k)) != "", arg(args, k)) for k in P.COMMAND_TEXT_KEYS), F.lit(""))


def is_write(name: Column, args: Column) -> Column:
    return name.isin(*P.EDIT_TOOLS) | (name.isin(*P.EDITORS) & F.coalesce(arg(args, "command").isin(*P.EDITOR_WRITES), F.lit(False)))


def path_argument(args: Column) -> Column:
    return F.coalesce(*(F.when(arg(args, k) != "", arg(args, k)) for k in P.PATH_KEYS), F.lit(""))


def action_class(name: Column, args: Column) -> Column:
    """think, submit, bash, search, read, write or other."""
    command = F.coalesce(arg(args, "command"), F.lit(""))
    return (
        F.when(name == "think", "think")
        .when(name == "finish", "submit")
        .when(name.isin(*P.SHELL_TOOLS), "bash")
        .when(name.isin("grep", "glob", "search", "find", "websearch"), "search")
        .when(name.isin("read", "webfetch"), "read")
        .when(name.isin(*P.EDIT_TOOLS), "write")
        .when(name.isin(*P.EDITORS), F.when(command.isin(*P.EDITOR_WRITES), "write").otherwise("read"))
        .when(is_execution(name, args), "bash")
        .otherwise("other")
    )
