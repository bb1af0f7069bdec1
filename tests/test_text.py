"""Classifiers of output, commands and paths, row by row."""

import pytest
from pyspark.sql import functions as F

from trajectra.functions import shell, text


def column(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in rows.select("i", expression(F.col("v"))).orderBy("i").collect()]


FAILING = ["FAILED tests/a.py::t", "3 failed, 2 passed", "ERROR: x", "--- FAIL: TestX", "FAIL\tpkg", "test result: FAILED. 1", "error[E0308]: m", "Tests run: 3, Failures: 1", "BUILD FAILURE", "[ERROR] x", "FooTest > bar FAILED", "The following tests FAILED", "[  FAILED  ]", "2 failing", "FAILURES!", "2 failures", "compilation failed", "exit: 2", "exit code: -9"]
PASSING = ["test result: ok. 3", "ok  \tpkg 0.1s", "PASS", "5 passed", "100% tests passed", "BUILD SUCCESS", "Tests run: 4, Failures: 0, Errors: 0", "OK (3 tests)", "[  PASSED  ]", "7 passing", "3 examples, 0 failures", "Ran 3 tests in 0.1s\n\nOK", "exit: 0", "all tests passed"]
UNKNOWN = ["", "done", "Ran 0 tests in 0s\n\nOK", "no tests ran", "collected 0 items", "[The command completed with exit code 0.]"]


@pytest.mark.parametrize(("values", "outcome"), [(FAILING, "fail"), (PASSING, "pass"), (UNKNOWN, "unknown")])
def test_outcomes(spark, values, outcome):
    assert column(spark, values, text.test_outcome) == [outcome] * len(values)


def test_line_start_at_a_cut_is_no_line_start(spark):
    assert column(spark, ["x" * 4000 + "y" * 2995 + "FAIL x"], text.test_outcome) == ["unknown"]


def test_errors(spark):
    rows = spark.createDataFrame([("TypeError", False, True), ("TypeError", True, True), ("TypeError", False, False), ("<tool_use_error>", False, False), ("command not found", True, True), (None, False, True)], "c string, t boolean, e boolean")
    assert [r[0] for r in rows.select(text.is_error(F.col("c"), F.col("t"), F.col("e"))).collect()] == [True, False, False, True, True, False]


def test_commands(spark):
    runs = ["pytest", "cd a && npm test", "python repro_x.py", "sudo make check", "A=1 go test ./...", "./gradlew -q :m:test", "node -e 'x'", "bash -c 'a;b' ; tox"]
    others = ["", "ls", "pip install pytest", "rm -f vitest.config.ts", "grep 'go test' f", "npm run build", "gradle build -x test", "python -c \"open('a','w')\"", "git commit -m 'pytest'"]
    assert column(spark, runs + others, shell.is_test_run) == [True] * len(runs) + [False] * len(others)
    assert column(spark, ["FAIL"], shell.is_formal_test) == [False]


def test_long_commands_do_not_overflow(spark):
    long = "cat <<'EOF' > a.py\n" + "x = 1\n" * 60_000 + "EOF\npytest"
    assert column(spark, [long], lambda c: F.size(shell.segments(c))) == [1]
    assert column(spark, [long], lambda c: F.array_contains(shell.edit_paths(c), "a.py")) == [True]


@pytest.mark.parametrize(
    ("command", "files"),
    [("cat > a.py", ["a.py"]), ("cat x > b.py", ["b.py"]), ("cat x 2>/dev/null", []), ("echo a >> c.txt", ["c.txt"]), ("printf x > d && ls", ["d"]), ("cmd | tee -a e.log", ["e.log"]), ("sed -i 's/a/b/' f.py && echo", ["f.py"]), ("sed -i.bak -e 's/a/b/' g.py h.py", ["g.py", "h.py"]), ("perl -pi -e 's/a/b/' i.py", ["i.py"]), ("perl -MList::Util -e 1", []), ("git apply foo.patch && ls", []), ("patch -p1 fix.diff", ["fix.diff"])],
)
def test_edit_paths(spark, command, files):
    assert column(spark, [command], shell.edit_paths) == [files]


def test_paths(spark):
    values = ["/testbed/a/./b/../c.py", "a//b", "/x/../../y", "", "../a", "/repo/", "//a/b", "///a"]
    assert column(spark, values, shell.norm_path) == ["a/c.py", "a/b", "/y", ".", "../a", ".", "//a/b", "/a"]


def test_small_rules(spark):
    assert column(spark, ["<think> r </think> c", "<think>open", None], lambda c: text.think_parts(c)[0]) == ["r", "", ""]
    assert column(spark, ["a" * 10, "a" * 11], lambda c: text.truncate_middle(c, 10, "~")) == ["a" * 10, "aaaaa~aaaaa"]
    assert column(spark, ["Hello, World!", "", None, "__"], lambda c: text.make_id(c, "x")) == ["hello_world", "x", "x", "x"]
    assert column(spark, ["3", "9", "x", None, "3.7"], lambda c: text.clamp_score(c, 1, 5)) == [3, 5, 1, 1, 1]
    assert column(spark, ["aabb", "", None], lambda c: F.round(text.char_entropy(c), 3)) == [1.0, 0.0, 0.0]
    assert column(spark, ["```json\n{\"a\":1}\n```", "no"], text.fenced_json) == ['{"a":1}', None]


ODD_CASES = [f"{a} {b}" for a in ("", "exit:", "tests?") for b in ("3 faıled", "3 paſſed", "3 FAİLED", "3 Failed", "2 FAİLURES", "eXıT code: 3", "ran 0 teſtS", "all checKs paſs", "all checKs pass", "BUİLD failed", "compilatıon FAILED", "exit code 0", "error: x", "Error: x", "ERROR: x", "ok 1", "OK", "ö 3 failed", "\x1b[1m3 failed\r")]
TOLD = ["Traceback (most recent call last)", "KeyError", "StopIteration", "No such file or directory", "command not found", "Permission denied", "returned non-zero exit status 1", "Invalid `x` parameter", "parameter is required for 'x' command", "No replacement was performed", "Error executing tool x", "Error validating args a for tool b", " ERROR: x", "The arguments provided to the tool are invalid", "[An error occurred during execution.]", "<tool_use_error>", "error: doctest failed", "3 tests completed, 1 failed", "1 tests failed out of 3", "Errors while running CTest", "Tests: 3 passed, 1 failed", "Test Suites: 1 failed", "No test files found", "error Command failed with exit code 1", "fail: 1", "BUILD FAILURE", "Couldn't compile the test", "Pass: 3, fail: 0", "Tests run: 3, Failures: 0, Errors: 0", "error count: 0", "no tests were found"]


def test_words_only_spare_searches(spark):
    from trajectra.functions import patterns as P

    texts = [None, *FAILING, *PASSING, *UNKNOWN, *ODD_CASES, *TOLD, *(f"x\n{t.swapcase()}" for t in ODD_CASES + TOLD), *(t.upper() for t in FAILING + PASSING)]
    tried = [(p, w) for kind in (P.TOOL_MARKERS, P.HARD_ERRORS, P.SOFT_ERRORS, P.TEST_FAILED, P.NO_TESTS_RAN, P.TEST_PASSED) for p, w in kind.items()]
    plain = column(spark, texts, lambda c: F.array(*(c.rlike(p) for p, _ in tried)))
    assert column(spark, texts, lambda c: F.array(*(text.any_match(c, text.folded(c), {p: w}) for p, w in tried))) == plain
    assert [any(found) for found in zip(*plain)] == [True] * len(tried)


def test_patterns_are_not_tried_without_their_words(spark):
    slow = r"(?:(?:x+)+)+:"  # takes for ever on many x
    assert column(spark, ["x" * 4000, "3 failed"], lambda c: text.any_match(c, text.folded(c), {slow: ":", r"\d failed": "failed"})) == [False, True]
    assert column(spark, ["\x1b[31mred\r\n", "plain"], text.strip_ansi) == ["red\n", "plain"]
