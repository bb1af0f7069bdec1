"""Text functions as columns: windows, error and test-outcome classifiers, small string rules."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from trajectra.functions import patterns as P

WINDOW, ALIGN = 3000, 300


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def folded(text: Column) -> Column:
    """The text in small letters; whatever (?iu) takes for one of a-z is that letter here."""
    small = F.replace(F.replace(F.lower(F.replace(text, F.lit("\u0130"), F.lit("i"))), F.lit("\u0131"), F.lit("i")), F.lit("\u017f"), F.lit("s"))
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(small)


def holds(text: Column, word: str) -> Column:
    """text.contains(word); java.util.regex skips through a text by a literal's length, if that is 4 or more, and contains() goes byte by byte."""
    return text.contains(word) if len(word) < 4 else text.rlike(rf"\Q{word}\E")


def any_match(text: Column, small: Column, patterns: dict[str, str | tuple[str, ...]]) -> Column:
    """Whether one of the patterns matches; only those are tried of whose words one is in the text, or in small, which is folded(text)."""
    by_words: dict[tuple, list[str]] = {}
    for pattern, words in patterns.items():
        by_words.setdefault((pattern.startswith("(?i"), *((words,) if isinstance(words, str) else words)), []).append(pattern)
    return any_of(any_of(holds(small if any_case else text, w) for w in words) & any_of(text.rlike(p) for p in found) for (any_case, *words), found in by_words.items())


def once(value: Column, use) -> Column:
    """use(value) with the value computed once, however often the result names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(text: Column) -> Column:
    """Without white space, of any kind, on both ends."""
    return F.regexp_extract(text, r"(?Us)^\s*+(.*\S)?", 1)  # from both ends: no search for white space in between


def strip_ansi(text: Column) -> Column:
    """Without terminal escapes and carriage returns."""
    return F.when(any_of(text.contains(c) for c in P.ESCAPES), F.regexp_replace(text, P.ANSI, "")).otherwise(text)


def scan_window(text: Column) -> Column:
    """The text without escapes; of more than 6000 characters, the first and last 3000 as lines of their own.

    The tail begins after its first line end if that is among its first 300 characters.
    """

    def window(clean: Column) -> Column:
        tail = F.right(clean, F.lit(WINDOW))
        at = F.instr(tail, "\n")
        aligned = F.when((at > 0) & (at <= ALIGN), F.substring(tail, at + 1, F.lit(WINDOW))).otherwise(tail)
        return F.when(F.length(clean) <= 2 * WINDOW, clean).otherwise(F.concat(F.substring(clean, 1, WINDOW), F.lit("\n"), aligned))

    return once(strip_ansi(F.coalesce(text, F.lit(""))), window)


def _signs(window: Column, small: Column) -> Column:
    kinds = {"marked": P.TOOL_MARKERS, "hard": P.HARD_ERRORS, "soft": P.SOFT_ERRORS}
    return F.struct(*(any_match(window, small, patterns).alias(kind) for kind, patterns in kinds.items()))


def error_signs(window: Column) -> Column:
    """struct<marked, hard, soft>: the signs of an error in a text that scan_window() has made, best a column of its own."""
    return once(folded(window), lambda small: _signs(window, small))


def error_by(signs: Column, is_test: Column | bool = False, is_execution: Column | bool = True) -> Column:
    """is_error() by a text's signs."""
    col = lambda x: x if isinstance(x, Column) else F.lit(x)
    command = signs["hard"] | (~F.coalesce(col(is_test), F.lit(False)) & signs["soft"])
    return signs["marked"] | (F.coalesce(col(is_execution), F.lit(False)) & command)


def is_error(content: Column, is_test: Column | bool = False, is_execution: Column | bool = True) -> Column:
    """Whether tool output reports an error; of commands only, hard signs count, and soft ones unless it is a test run."""
    return once(once(scan_window(content), error_signs), lambda signs: error_by(signs, is_test, is_execution))


def _outcome(window: Column, small: Column, signs: Column) -> Column:
    rules = (
        (signs["marked"], "fail"),
        (signs["hard"], "fail"),
        (any_match(window, small, P.TEST_FAILED), "fail"),
        (any_match(window, small, P.NO_TESTS_RAN), "unknown"),
        (any_match(window, small, P.TEST_PASSED), "pass"),
        (holds(small, P.ECHOED) & F.regexp_replace(window, P.RUNTIME_TRAILER, "").rlike(P.ECHOED_ZERO), "pass"),
        (signs["soft"], "fail"),
    )
    out = F.when(window == "", "unknown")
    for condition, outcome in rules:
        out = out.when(condition, outcome)
    return out.otherwise("unknown")


def outcome_in(window: Column, signs: Column) -> Column:
    """test_outcome() for a text that scan_window() has made, and its signs."""
    return once(folded(window), lambda small: _outcome(window, small, signs))


def test_outcome(content: Column) -> Column:
    """fail, pass or unknown for the output of a test run; the first of the rules that applies decides."""
    return once(scan_window(content), lambda window: once(folded(window), lambda small: once(_signs(window, small), lambda signs: _outcome(window, small, signs))))


def think_parts(content: Column) -> tuple[Column, Column]:
    """Reasoning in a leading <think> block and the rest; without one, empty and the content as it is."""
    text = strip(content)
    pattern = r"(?s)^<think>(.*?)</think>(.*)$"
    has = text.rlike(pattern)
    return F.when(has, strip(F.regexp_extract(text, pattern, 1))).otherwise(F.lit("")), F.when(has, strip(F.regexp_extract(text, pattern, 2))).otherwise(content)


def without_think(content: Column) -> Column:
    """The text after a leading <think> block, trimmed."""
    text = strip(F.coalesce(content, F.lit("")))
    pattern = r"(?s)^<think>.*?</think>(.*)$"
    return F.when(text.rlike(pattern), strip(F.regexp_extract(text, pattern, 1))).otherwise(text)


def truncate_middle(text: Column, limit: int, marker: str = "\n... [truncated] ...\n") -> Column:
    """A longer text's first and last halves of the limit around a marker."""
    half = limit // 2
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, half), F.lit(marker), F.right(text, F.lit(half)))).otherwise(text)


def char_entropy(text: Column, limit: int = 5000) -> Column:
    """Entropy in bits of the characters of the first ``limit``; 0 for none."""
    head = F.substring(F.coalesce(text, F.lit("")), 1, limit)
    chars = F.array_distinct(F.split(head, ""))
    runs = F.transform(chars, lambda c: F.length(head) - F.length(F.replace(head, c)))
    n = F.length(head).cast("double")
    sums = F.aggregate(runs, F.lit(0.0), lambda total, k: total + k * F.log2(k.cast("double")))
    return F.when(n > 0, F.log2(n) - sums / n).otherwise(F.lit(0.0))


def infer_language(first_user_text: Column) -> Column:
    """zh if the text holds a CJK ideograph, else en."""
    return F.when(first_user_text.rlike(P.CJK), "zh").otherwise("en")


def make_id(text: Column, fallback: str) -> Column:
    """Lower-case id of letters and digits, all else as single underscores, 64 characters at most."""
    clean = F.substring(F.regexp_replace(F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), "[^a-zA-Z0-9]+", "_")), "^_+|_+$", ""), 1, 64)
    return once(clean, lambda c: F.when(c == "", fallback).otherwise(c))


def clamp_score(value: Column, low: int, high: int) -> Column:
    """An integer between the bounds; text that is no integer, or null, gives the lower one."""
    number = F.when(value.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(value).try_cast("bigint"))
    return F.greatest(F.lit(low), F.least(F.lit(high), F.coalesce(number, F.lit(low))))


def status_of(value: Column, score: Column) -> Column:
    """passed or failed as stated, else by the score."""
    said = F.lower(F.trim(value))
    return F.when(said.isin("passed", "failed"), said).otherwise(F.when(score >= 1, "passed").otherwise("failed"))


def summary_base(content: Column) -> Column:
    """Credit of a closing text: 1 for a clear statement of completion, 0.8 for a vague one, else 0.5."""
    text = F.coalesce(content, F.lit(""))
    return F.when(text.rlike(P.DONE_CLEARLY), 1.0).when(text.rlike(P.DONE_PERHAPS), 0.8).otherwise(0.5)


def fenced_json(text: Column) -> Column:
    """JSON text without the fence around it; null if it doesn't parse."""
    bare = strip(F.regexp_replace(strip(text), r"(?s)^```(?:json)?\s*|\s*```$", ""))
    return once(bare, lambda b: F.when(F.try_parse_json(b).isNotNull(), b))
