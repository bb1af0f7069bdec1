"""The patterns and name sets by which tool output, commands and paths are classified.

Their results must not change, so they are stated here as they are defined for
trajectories, in Java's dialect: ``(?d)`` makes only \\n end a line, ``(?U)`` gives
\\w, \\d, \\s and \\b their Unicode meaning, ``(?m)`` and ``(?i)`` as usual.

Patterns for whole outputs come with words, one of which each of their matches holds (in small letters with ``(?i)``):
a search for a word costs far less than one for a pattern.
"""

from __future__ import annotations

# ---- fixed values: output of tools ----

#: What each escape or return that ANSI takes away holds.
ESCAPES = ("\x1b", "\r")
ANSI = r"\x1b\[[0-9;?]*[A-Za-z]|\x1b\][^\x07]*(?:\x07|\x1b\\)|\x1b[@-Z\\-_]|\r"

#: A failure reported by the tool itself, in the output of any tool.
TOOL_MARKERS = {
    r"<tool_use_error>": "<tool_use_error>",
    r"The arguments provided to the tool are invalid": "The arguments provided",
    r"\[An error occurred during execution\.\]": "An error occurred",
    r"(?dU)Error validating args\b.*\bfor tool\b": "Error validating args",
    r"(?U)Error executing tool\b": "Error executing tool",
    r"(?U)^\s*ERROR:": "ERROR:",
    r"No replacement was performed": "No replacement was performed",
    r"(?U)parameter is required for ['\"]?\w+['\"]? command": "parameter is required",
    r"Invalid `[^`]+` parameter": "Invalid `",
}

#: A command that didn't run or didn't succeed, in the output of commands.
HARD_ERRORS = {
    r"command not found": "command not found",
    r"Permission denied": "Permission denied",
    r"(?iuU)exit code[:\s]+-?[1-9]": "exit code",
    r"returned non-zero exit status": "non-zero exit status",
}

#: The same, unless the command is a test run.
SOFT_ERRORS = {
    r"Traceback \(most recent call last\)": "Traceback (most",
    r"(?U)\b(?:SyntaxError|TypeError|ValueError|KeyError|IndexError|AttributeError|ImportError|ModuleNotFoundError|FileNotFoundError|NameError|RuntimeError|OSError|IOError|PermissionError|ZeroDivisionError|NotImplementedError|StopIteration|RecursionError|AssertionError|UnicodeDecodeError)\b": ("Error", "StopIteration"),
    r"No such file or directory": "No such file",
    r"(?U)\bFAILED\b": "FAILED",
}

_N = r"(?!0+\b)\d+"
#: A number of its own; that it begins with a digit is asked first, as \b is slow with (?U).
_COUNT = rf"(?=\d)\b{_N}"

TEST_FAILED = {
    r"(?iuU)\bexit(?:\s*code)?\s*[:=]\s*-?(?!0+\b)\d{1,3}\b": "exit",
    r"(?dmU)^(?:FAILED|ERROR)\s+\S+": ("FAILED", "ERROR"),
    rf"(?iuU){_COUNT}\s+failed\b": "failed",
    r"(?dmU)^(?:FAIL|ERROR):\s": ("FAIL:", "ERROR:"),
    r"(?dmU)^\s*---\s*FAIL:": "FAIL:",
    r"(?dmU)^FAIL\b": "FAIL",
    r"(?U)test result:\s*FAILED": "test result:",
    r"(?dmU)^error(?:\[E\d+\])?:": "error",
    r"Couldn't compile the test": "Couldn't compile",
    r"(?U)\berror: (?:doctest failed|test failed)": ("doctest failed", "test failed"),
    rf"(?U)Tests run:[^\n]*?(?:Failures|Errors):\s*{_N}": "Tests run:",
    r"(?U)\bBUILD FAILURE\b": "BUILD FAILURE",
    r"(?dmU)^\s*\[ERROR\]\s": "[ERROR]",
    r"(?U)\b\w+Test\b\s*>\s*\S+\s+FAILED\b": "FAILED",
    rf"(?U)\b\d+\s+tests? completed,\s*{_N}\s+failed": "completed,",
    r"The following tests FAILED": "The following tests",
    rf"(?U){_COUNT}\s+tests? failed out of\b": "failed out of",
    r"Errors while running CTest": "Errors while",
    r"(?U)\[\s*FAILED\s*\]": "FAILED",
    rf"(?dmU)^Tests:\s+[^\n]*?{_COUNT}\s+failed": "Tests:",
    rf"(?dmU)^Test Suites:\s+[^\n]*?{_COUNT}\s+failed": "Test Suites:",
    rf"(?U){_COUNT}\s+failing\b": "failing",
    r"No test files found": "No test files",
    r"error Command failed with exit code [1-9]": "error Command",
    r"(?dm)^FAILURES!": "FAILURES!",
    rf"(?iuU){_COUNT}\s+failures?\b": "failure",
    r"(?U)\bfail:\s*[1-9]": "fail:",
    r"(?iuU)\b(?:compilation|build) failed\b": ("compilation", "build failed"),
}

NO_TESTS_RAN = {
    r"(?iuU)(?=r)\bRan 0+ tests?\b": "ran 0",
    r"(?iuU)(?=n)\bno tests? (?:ran|were found|to run|found)\b": "no test",
    r"(?iuU)(?=c)\bcollected 0+ items\b": "collected 0",
}

TEST_PASSED = {
    r"(?U)test result:\s*ok\.": "test result:",
    r"(?dmU)^ok\s+\S+": "ok",
    r"(?dmU)^PASS\b": "PASS",
    rf"(?iuU){_COUNT}\s+passed\b": "passed",
    r"(?U)\b100%\s+tests passed\b": "tests passed",
    r"(?U)\bBUILD SUCCESS(?:FUL)?\b": "BUILD SUCCESS",
    rf"(?U)Tests run:\s*{_N},\s*Failures:\s*0,\s*Errors:\s*0": "Tests run:",
    rf"(?U)\bOK\s*\({_N} tests?\)": "OK",
    r"(?dmU)^\s*\[\s*PASSED\s*\]": "PASSED",
    rf"(?U){_COUNT}\s+passing\b": "passing",
    rf"(?U){_COUNT}\s+examples?,\s*0\s+failures\b": "example",
    rf"(?U)\bPass:\s*{_N},\s*fail:\s*0\b": "Pass:",
    r"(?iuU)\ball (?:tests|checks) (?:passed|PASS)\b": "s pass",
    rf"(?U)Ran {_N} tests? in [\d.]+s\s*\n+\s*OK\b": "Ran ",
    r"(?dmU)^OK\s*(?:\(skipped=\d+\))?\s*$": "OK",
    r"(?iuU)\berror count:\s*0\b": "error count",
}

RUNTIME_TRAILER = r"(?dmU)^\[(?:The command completed with exit code -?\d+\.|Command finished with exit code -?\d+|Current working directory:[^\]]*|Python interpreter:[^\]]*|Below is the output of the previous command\.?)\]\s*$"
ECHOED_ZERO = r"(?iuU)\bexit(?:\s*code)?\s*[:=]\s*0+\b"
ECHOED = "exit"

# ---- fixed values: commands ----

TEST_RUNNER = (
    r"(?iuU)\b(?:pytest|py\.test|python3?\s+-m\s+pytest|python3?\s+-m\s+unittest|unittest|python3?\s+test_|nosetests"
    r"|go\s+test|cargo\s+test|ctest|gtest_filter"
    r"|(?:mvn|mvnw)\b[^\n|&;]{0,200}?\b(?:test|verify|surefire:test|integration-test)\b"
    r"|(?:gradle|gradlew)\b(?:(?!-x\s)[^\n|&;]){0,200}?\b[\w:]*[Tt]est[\w:]*\b"
    r"|jest|mocha|vitest|npx\s+jest|npx\s+vitest|npx\s+mocha|(?:npm|yarn|pnpm)\s+(?:run\s+)?test|make\s+(?:test|check)"
    r"|runtests\.py|manage\.py\s+test|cmake\s+--build\s+\S+\s+--target\s+(?:test|check)"
    r"|mix\s+test|swift\s+test|lein\s+test|dotnet\s+test|busted)\b"
    r"|\./[^\s]*(?:_test|test_)\S*|\bsbt\b[^\n|&;]*?\b(?:test(?:Only|Quick)?|it:test)\b|\b(?:devtools::test|testthat::test)|\bPlenaryBusted\w*"
)

_EXT = r"(?:py|js|jsx|ts|tsx|mjs|cjs|go|rs|java|kt|kts|scala|rb|php|cc|cpp|cxx|cu|c|h|hpp|hxx|cs|swift|mm|pl|pm|ex|exs|lua|cljc|cljs|clj|edn|dart|sol|jl|erl|groovy|r|sh)"

VERIFIES = (
    rf"(?iuU)(?:^|[\s/])\S*(?:reproduce|repro|verify|smoke)\w*\.{_EXT}\b|\bpython3?\s+-c\b"
    r"|\bpython3?\s+(?:-\S+\s+)*(?:\S*/)?(?:test_\S+|\S+_test)\.py\b|\bpython3?\s+(?:-\S+\s+)*(?:\S*/)?\S+\.py\b"
    r"|\b(?:node|bun|deno)\s+(?:-\S+\s+)*(?:\S*/)?\S+\.(?:m?[jt]sx?|cjs)\b|\b(?:node|deno)\s+(?:-e|--eval|eval)\b"
    r"|\b(?:node|npx|deno|bun|ts-node|tsx)\s+(?:-\S+\s+)*\S*(?:repro|verify|smoke|test|spec)\S*\.(?:m?[jt]sx?|cjs)\b"
    r"|\b(?:ruby|perl)\s+-e\b|\bphp\s+-r\b|\b(?:ruby|php|perl|Rscript)\s+(?:-\S+\s+)*\S+\.\w+\b|\bR(?:script)?\b\s+(?:--\S+\s+)*-e\b"
    r"|\bgo\s+run\b|\bcargo\s+(?:test|run)\b|\bswift\s+run\b|\bdotnet\s+run\b|\bmix\s+run\b|\b(?:elixir|iex)\s+(?:-\S+\s+)*\S+\.exs?\b"
    r"|\blein\s+run\b|\b(?:clj|clojure)\s+(?:-\S+\s+)*-[eMX]\S*|\bjava\b[^\n|&;]*?(?:-jar\s+\S+|\b(?-i:[A-Z])\w+)\b"
    r"|dofile\(\s*['\"][^'\"]*(?:test|repro|verify|spec)|\b(?:bazel|blaze)\s+test\b|\bdotnet\s+test\b|\bphpunit\b|\brspec\b|\btox\b"
    r"|\./\S*(?:_test|test_|repro|verify|smoke)\S*|\./\S+\.(?:sh|out|bin|exe)\b"
)

NO_VERIFICATION = (
    r"(?iuU)\b(?:pip3?|uv\s+pip|conda|apt|apt-get|yum|brew)\s+install\b|\b(?:npm|yarn|pnpm)\s+(?:install|i|ci|add)\b"
    r"|\bpython3?\s+(?:\S*/)?setup\.py\s+(?:install|build|develop|egg_info|sdist|bdist\w*)\b"
    r"|\bmanage\.py\s+(?:runserver|migrate|makemigrations|collectstatic|shell|startapp|startproject)\b"
    r"|\b(?:npm|yarn|pnpm)\s+(?:run\s+)?(?:dev|start|build|watch|serve|lint|format)\b"
    r"|\bcargo\s+(?:build|check|fmt|clippy|install)\b|\bgo\s+(?:build|install|mod|vet|fmt)\b"
    r"|\bpython3?\s+-c\b[\s\S]*?(?:open\s*\([^)]*['\"][wa]b?\+?['\"]|\.write\s*\()"
)

TEST_FILE = (
    rf"(?iuU)(?:^|/)(?:conftest\.py|test_[^/]+\.{_EXT}|[^/]+_tests?\.{_EXT}|[^/]+_spec\.{_EXT}|[^/]+\.(?:test|spec)\.(?:m?[jt]sx?|cjs)"
    rf"|[^/]*(?-i:[A-Z]\w*(?:Tests?|Spec))\.{_EXT}|[^/]+IT\.java)$"
    rf"|(?:^|/)(?:tests?|__tests__|specs?|testing)/(?:[^/]+/)*[^/]+\.{_EXT}$|(?:^|/)t/(?:[^/]+/)*[^/]+\.t$"
    rf"|(?:^|/)src/(?:test|integrationTest|androidTest)/(?:[^/]+/)*[^/]+\.{_EXT}$"
)
REPRO_FILE = r"(?iuU)(?:^|/)\S*(?:reproduce|repro|verify|smoke)\S*\.\w+$"

#: Command words that only read or move files, or do nothing that could run a test.
READ_ONLY_HEADS = (
    "rm", "ls", "cat", "grep", "egrep", "fgrep", "rg", "ag", "find", "git", "echo", "mkdir", "rmdir", "cp", "mv", "touch", "head", "tail", "wc", "sed", "awk",
    "diff", "which", "whereis", "chmod", "chown", "cd", "sort", "uniq", "xargs", "export", "printf", "tree", "stat", "du", "df", "ln", "tar", "unzip", "gzip",
    "curl", "wget", "pwd", "env", "true", "false", "sleep", "kill", "ps",
)

#: What a redirection, tee or patch writes to, in the order in which the targets are listed.
WRITE_TARGETS = (
    r"(?U)\bcat\s+(?:>>?)\s*([^\s|&;<>]+)",
    r"(?U)\bcat\s+(?!>>?)(?:[^|&;\n]*?)(?<![0-9&])>>?\s*([^\s|&;<>]+)",
    r"(?U)\b(?:echo|printf)\b(?:[^|&;\n]*?)(?<![0-9&])>>?\s*([^\s|&;<>]+)",
    r"(?U)\btee\s+(?:-[a-zA-Z]+\s+)*([^\s|&;<>]+)",
    r"(?U)(?:^|[\n;&|]\s*)patch\s+(?:-\S+\s+)*([^\s|&;<>]+)",
)
IN_PLACE = r"\b(?:g?sed|perl)\s+(?:-\S+\s+)*-[A-Za-z]*i[A-Za-z]*(?:\.[\w.]+)?(?=\s|$)"

# ---- fixed values: tools ----

SDK_TOOLS = ("terminal", "file_editor", "task_tracker", "finish", "think")
CLI_TOOLS = ("bash", "read", "edit", "write", "glob", "grep", "task", "webfetch", "websearch", "notebookedit", "todowrite", "taskoutput", "taskstop", "askuserquestion", "skill", "enterplanmode", "exitplanmode", "enterworktree")
EDIT_TOOLS = ("edit", "write", "multiedit", "notebookedit", "patch")
EDITORS = ("file_editor", "str_replace_editor")
EDITOR_WRITES = ("str_replace", "create", "insert")
EDITOR_COMMANDS = ("view", "create", "str_replace", "insert", "undo_edit")
SHELL_TOOLS = ("bash", "terminal", "execute_bash")
EXECUTION_TOOLS = (*SHELL_TOOLS, "shell", "cmd", "execute_ipython_cell", "run_ipython", "ipython", "python", "run_python")
NOT_EXECUTION_KEYS = ("old_str", "new_str", "file_text", "view_range", "insert_line", "task_list", "thought", "task_completed")
COMMAND_KEYS = ("command", "cmd", "keystrokes")
COMMAND_TEXT_KEYS = ("command", "code", "cmd", "keystrokes")
PATH_KEYS = ("file_path", "filePath", "path", "notebook_path", "notebookPath")
WORKSPACES = r"^(?:/workspace/|/testbed/|/repo/|/home/swe-bench/)"
INTENT_WORDS = {
    "read": ("read", "look", "check", "examine", "open", "view", "inspect", "show"),
    "write": ("write", "edit", "modify", "fix", "change", "update", "patch", "add", "insert", "replace"),
    "bash": ("run", "execute", "test", "try", "install", "pip", "npm", "build"),
    "search": ("search", "find", "grep", "locate", "list", "explore"),
    "submit": ("finish", "submit", "complete", "done"),
}

# ---- fixed values: closing texts ----

DONE_CLEARLY = r"(?iuU)\b(?:(?:fix|task|issue|bug|change|patch)\s+(?:is\s+)?(?:complete|completed|fixed|resolved|done|verified|ready)|(?:all\s+)?tests?\s+(?:now\s+)?pass(?:ed|ing)?|successfully\s+(?:fixed|resolved|implemented|verified|applied)|(?:the\s+)?(?:fix|patch|implementation)\s+(?:is\s+)?(?:complete|ready|working))\b"
DONE_PERHAPS = r"(?iuU)\b(?:complete|completed|fixed|done|resolved|verified)\b"
TURN_ERROR_STARTS = ("<tool_use_error>", "The arguments provided to the tool are invalid")
CJK = "[㐀-鿿]"
