"""Scores of trajectories from their profiles: one row in, the same row with score columns out.

All are expressions on the arrays that profiles() collected, so a whole score is one
projection after the single exchange by rec_id.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajectra.operators.relations import T2, profiles, steps

# Weights and powers of the composite, penalties, ranges.
WEIGHTS = {"sub": (0.33, 1), "stp": (0.27, 1), "tvr": (0.23, 1), "fec": (0.10, 5), "dpi": (0.07, 3)}
COMPONENTS = ("oec", "iac", "dpi", "ped", "psn", "tte", "scp", "sub", "fec", "stp", "tvr")
NO_WRITE, CUT_SHORT = 0.4, 0.4
LOOP_SCALE, LOOP_CAP, LOOP_RUN = 3.0, 0.3, 5
REPEAT_SCALE, REPEAT_CAP = 0.6, 0.3
BASELINE, SCOPE = 5, 5
SWEET_LOW, SWEET_HIGH, SIGMA = 0.2, 0.5, 0.2
STEPS_LOW, STEPS_HIGH, STEPS_MAX = 5, 80, 200
OUTCOME_CREDIT = {"pass": 1.0, "unknown": 0.6, "fail": 0.3}
LATE_OBS, LATE_TURNS, LATE_TEST = 0.7, 0.8, 0.15

OH = ("openhands_sdk", "openhands")


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once, however often, and in whatever loop, the body reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _mean(values: Column) -> Column:
    return F.when(F.size(values) > 0, F.aggregate(values, F.lit(0.0), lambda s, x: s + x) / F.size(values))


def _field(array: str, name: str) -> Column:
    return F.transform(array, lambda x: x[name])


def _count(array: Column | str, test) -> Column:
    return F.size(F.filter(array, test))


def acts() -> Column:
    """All actions of a record in order."""
    return F.flatten(_field("turns", "actions"))


def oec() -> Column:
    """Least smoothed entropy of an observation, relative to that of the first five; null for fewer, or flat ones."""

    def relative(values: Column) -> Column:
        base = _mean(F.slice(values, 1, BASELINE))
        near = F.transform(values, lambda x, i: _mean(F.slice(values, F.greatest(i, F.lit(1)), F.when(i == 0, 2).otherwise(3))))
        return F.when(base > 0, F.greatest(F.lit(0.0), F.least(F.array_min(near) / base, F.lit(1.0))))

    return F.when(F.size("obs") >= BASELINE, _let(_field("obs", "entropy"), relative))


def iac() -> Column:
    """Share of acting turns whose text names what they do; null for fewer than three."""
    said = F.filter(_field("turns", "says"), lambda x: x.isNotNull())
    return F.when(F.size(said) >= 3, _count(said, lambda x: x) / F.size(said))


def truncated() -> Column:
    """Whether the record ends otherwise than its kind of agent should."""
    text_end = (F.col("last_message.role") == "assistant") & (F.col("last_message.n_calls") == 0)
    ended = F.when(F.col("scaffold").isin(*OH), F.coalesce("last_turn.finished", F.lit(False)) | text_end).when(F.col("scaffold") == T2, F.coalesce("last_turn.t2_done", F.lit(False))).otherwise(text_end)
    return (F.col("n_turns") == 0) | ~ended


def has_write() -> Column:
    return F.exists("obs", lambda o: o["wrote"])


def loop_fraction() -> Column:
    """Share of actions with a target that lie in runs of five or more equal ones; an action without a target breaks a run."""
    start = F.struct(F.lit("").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("looped"))

    def step(s: Column, x: Column) -> Column:
        run = F.when(x == "", 0).when(x == s["last"], s["run"] + 1).otherwise(1)
        more = F.when(run == LOOP_RUN, LOOP_RUN).when(run > LOOP_RUN, 1).otherwise(0)
        return F.struct(x.alias("last"), run.alias("run"), (s["looped"] + more).alias("looped"))

    def fraction(signatures: Column) -> Column:
        looped = F.aggregate(signatures, start, step, lambda s: s["looped"])
        targets = _count(signatures, lambda x: x != "")
        return F.when((F.size(signatures) >= LOOP_RUN) & (targets > 0), looped / targets).otherwise(0.0)

    return _let(F.transform(acts(), lambda a: F.coalesce(a["signature"], F.lit(""))), fraction)


def error_repeat() -> Column:
    """Errors that begin like the error just before them, over all errors."""
    errors = _count("obs", lambda o: o["is_error"])
    pairs = F.transform("obs", lambda o, i: F.when(i > 0, o["is_error"] & F.get("obs", i - 1)["is_error"] & (o["signature"] == F.get("obs", i - 1)["signature"])).otherwise(False))
    return F.when(errors > 0, _count(pairs, lambda x: x) / errors).otherwise(0.0)


def dpi() -> Column:
    lost = F.when(has_write(), 0.0).otherwise(NO_WRITE) + F.when(truncated(), CUT_SHORT).otherwise(0.0)
    lost = lost + F.least(F.lit(LOOP_CAP), loop_fraction() * LOOP_SCALE) + F.least(F.lit(REPEAT_CAP), error_repeat() * REPEAT_SCALE)
    return F.greatest(F.lit(0.0), 1 - lost)


def ped() -> Column:
    """Mean change of tool and files after an error; null without one."""
    return _mean(F.filter(_field("obs", "reaction"), lambda x: x.isNotNull()))


def psn() -> Column:
    """How the number of files in the last five turns falls over the late half, from Kendall's tau; null for short records."""

    def scopes(files: Column) -> Column:
        return F.transform(files, lambda x, i: F.size(F.array_distinct(F.flatten(F.slice(files, F.greatest(i - SCOPE + 2, F.lit(1)), F.least(i + 1, F.lit(SCOPE)))))))

    def tau(counts: Column) -> Column:
        total = counts["up"] + counts["down"]
        return F.when(total == 0, 0.5).otherwise((1 - (counts["up"] - counts["down"]) / total) / 2)

    def falling(late: Column) -> Column:
        """Pairs that rise and fall, from how often each of the few sizes came before."""

        def counts(sizes: Column) -> Column:
            none = F.lit(0).cast("bigint")
            state = F.struct(F.transform(sizes, lambda s: none).alias("seen"), none.alias("up"), none.alias("down"))
            of = lambda seen, fits: F.aggregate(F.transform(seen, lambda n, k: F.when(fits(F.get(sizes, k)), n).otherwise(none)), none, lambda a, n: a + n)

            def step(acc: Column, x: Column) -> Column:
                seen = F.transform(acc["seen"], lambda n, k: F.when(F.get(sizes, k) == x, n + 1).otherwise(n))
                return F.struct(seen.alias("seen"), (acc["up"] + of(acc["seen"], lambda s: s < x)).alias("up"), (acc["down"] + of(acc["seen"], lambda s: s > x)).alias("down"))

            return F.aggregate(late, state, step)

        return F.when(F.size(late) >= 3, _let(_let(F.array_distinct(late), counts), tau))

    late = _let(_let(_field("turns", "files"), scopes), lambda scope: F.slice(scope, F.floor(F.size(scope) / 2).cast("int") + 1, F.size(scope)))
    return F.when(F.size("turns") >= 2 * SCOPE, _let(late, falling))


def tte() -> Column:
    """Entropy of the transitions between kinds of actions over its maximum; null for fewer than three actions."""

    def pairs_of(kinds: Column) -> Column:
        return F.transform(F.slice(kinds, 1, F.greatest(F.size(kinds) - 1, F.lit(0))), lambda k, i: F.concat_ws(">", k, F.get(kinds, i + 1)))

    def share(pairs: Column) -> Column:
        n = F.size(pairs).cast("double")
        part = lambda p: _let(_count(pairs, lambda q: q == p).cast("double"), lambda k: k * F.log2(k))
        entropy = F.log2(n) - F.aggregate(F.array_distinct(pairs), F.lit(0.0), lambda s, p: s + part(p)) / n
        return F.when(n >= 2, F.least(F.lit(1.0), entropy / math.log2(49)))

    return _let(_let(F.transform(acts(), lambda a: a["kind"]), pairs_of), share)


def first_write_turn() -> Column:
    return F.array_min(F.transform(F.filter("obs", lambda o: o["wrote"]), lambda o: o["turn"]))


def scp() -> Column:
    """1 if the first successful write comes at 20 to 50 % of the turns, less the farther from there, 0 without one."""
    at = first_write_turn() / F.col("n_turns")
    off = F.least(F.abs(at - SWEET_LOW), F.abs(at - SWEET_HIGH))
    return F.when(at.isNull(), 0.0).when(at.between(SWEET_LOW, SWEET_HIGH), 1.0).otherwise(F.exp(-(off * off) / (2 * SIGMA * SIGMA)))


def sub() -> Column:
    """Credit of the ending, times the late observations' success, plus a bonus for a late test."""
    text_end = (F.col("last_message.role") == "assistant") & (F.col("last_message.n_calls") == 0)
    openhands = F.when(F.coalesce("last_turn.finished", F.lit(False)), 1.0).when(text_end, F.col("last_message.base")).otherwise(0.0)
    base = F.when(F.col("scaffold").isin(*OH), openhands).when(F.col("scaffold") == T2, F.coalesce("last_turn.t2_done", F.lit(False)).cast("double")).otherwise(text_end.cast("double"))
    n = F.size("obs")
    late = F.slice("obs", (n * F.lit(LATE_OBS)).cast("int") + 1, n)
    success = 1 - _count(late, lambda o: o["is_error"]) / F.size(late)
    scaled = F.when((n > 0) & (base > 0), base * (0.7 + 0.3 * success)).otherwise(base)
    from_turn = F.greatest((F.col("n_turns") * F.lit(LATE_TURNS)).cast("int"), F.lit(1))
    tested = F.exists(F.slice("turns", from_turn, F.greatest(F.size("turns"), F.lit(1))), lambda t: t["formal_test"])
    return F.when(F.col("n_turns") == 0, 0.0).otherwise(F.least(F.lit(1.0), scaled + F.when(tested, LATE_TEST).otherwise(0.0)))


def edited() -> Column:
    return F.flatten(_field("turns", "edited"))


def fec() -> Column:
    """1 for one edit a file, 0 for five or more on average; null without edits."""
    mean = F.size(edited()) / F.size(F.array_distinct(edited()))
    return F.when(F.size(edited()) > 0, 1 - F.greatest(F.lit(0.0), F.least((mean - 1) / 4, F.lit(1.0))))


def stp(turns: Column | None = None) -> Column:
    n = F.col("n_turns") if turns is None else turns
    left = 1 - (n - STEPS_HIGH) / (STEPS_MAX - STEPS_HIGH)
    return F.when(n == 0, 0.0).when(n < STEPS_LOW, n / STEPS_LOW).when(n <= STEPS_HIGH, 1.0).when(n >= STEPS_MAX, 0.0).otherwise(F.pow(left, F.lit(1.5)))


def tvr() -> Column:
    """Credit for writing tests, for running them, and for the outcome of the last run as its own output states it."""
    runs = F.flatten(F.transform("turns", lambda t: F.filter(F.transform(t["verify"], lambda v, i: F.struct(t["msg_idx"].alias("msg_idx"), i.alias("pos"), v["test"].alias("test"), t["t2_outcome"].alias("t2"))), lambda r: r["test"])))
    last = F.element_at(runs, -1)
    own = F.get(F.filter("obs", lambda o: (o["asst_idx"] == last["msg_idx"]) & (o["pos"] == last["pos"])), F.lit(0))["outcome"]
    outcome = F.coalesce(F.when(F.col("scaffold") == T2, last["t2"]).otherwise(own), F.lit("unknown"))
    credit = F.when(outcome == "pass", OUTCOME_CREDIT["pass"]).when(outcome == "fail", OUTCOME_CREDIT["fail"]).otherwise(OUTCOME_CREDIT["unknown"])
    return F.exists("turns", lambda t: t["test_write"]).cast("double") * 0.3 + F.when(F.size(runs) > 0, 0.3 + 0.4 * credit).otherwise(0.0)


def reproduce_first() -> Column:
    """1 if the first verification comes before the first edit of a file that is no test, else 0; null without such an edit."""
    every = F.flatten(_field("turns", "verify"))
    at = lambda name: F.array_position(F.transform(every, lambda v: v[name]), True)
    return F.when(at("fix") > 0, ((at("test") > 0) & (at("test") < at("fix"))).cast("double"))


def late_error_free() -> Column:
    """Share of the last 40 % of observations without an error; null for fewer than five."""
    late = F.slice("obs", (F.size("obs") * F.lit(0.6)).cast("int") + 1, F.size("obs"))
    return F.when(F.size("obs") >= 5, 1 - _count(late, lambda o: o["is_error"]) / F.size(late))


def sigmoid_stretch(x: Column, center: float = 0.5, steepness: float = 10.0) -> Column:
    """A logistic curve through (0, 0) and (1, 1)."""
    curve = lambda v: 1 / (1 + F.exp(-steepness * (v - center)))
    return (curve(x) - curve(F.lit(0.0))) / (curve(F.lit(1.0)) - curve(F.lit(0.0)))


def composite(value=F.col) -> Column:
    """Weighted mean of the components that aren't null, each raised to its power; 0 if all are."""
    got = {c: (value(f"{c}_score"), w, power) for c, (w, power) in WEIGHTS.items()}
    top = sum((F.coalesce(F.pow(v, F.lit(float(power))) * w, F.lit(0.0)) for v, w, power in got.values()), F.lit(0.0))
    bottom = sum((F.when(v.isNotNull(), w).otherwise(0.0) for v, w, _ in got.values()), F.lit(0.0))
    return F.when(bottom > 0, top / bottom).otherwise(0.0)


_METRICS = {"oec": oec, "iac": iac, "dpi": dpi, "ped": ped, "psn": psn, "tte": tte, "scp": scp, "sub": sub, "fec": fec, "stp": stp, "tvr": tvr}


def total_calls() -> Column:
    return F.aggregate("turns", F.lit(0).cast("bigint"), lambda s, t: s + F.size(t["actions"]))


def scores(profile_rows: DataFrame, digits: int = 4) -> DataFrame:
    """rec_id and all score fields, rounded half up."""
    raw = profile_rows.select("rec_id", "scaffold", F.col("n_turns").alias("assistant_turns"), total_calls().alias("total_tool_calls"), *(f().cast("double").alias(f"{c}_score") for c, f in _METRICS.items()), reproduce_first().alias("reproduce_first"))
    full = raw.withColumn("composite_score", composite())
    names = [f"{c}_score" for c in COMPONENTS] + ["composite_score"]
    return full.select("rec_id", "scaffold", "assistant_turns", "total_tool_calls", *(F.round(n, digits).alias(n) for n in names), "reproduce_first")


def score_trajectories(trajectories: DataFrame) -> DataFrame:
    """Scores of nested trajectories; a record without messages has none."""
    return scores(profiles(steps(trajectories)))


def error_counts(profile_rows: DataFrame) -> DataFrame:
    """rec_id, scaffold, calls and errors; an observation of typed commands counts once for each command."""
    calls = F.when(F.col("scaffold") == T2, F.aggregate("obs", F.lit(0).cast("bigint"), lambda s, o: s + o["weight"])).otherwise(F.size("obs").cast("bigint"))
    return profile_rows.select("rec_id", "scaffold", calls.alias("calls"), _count("obs", lambda o: o["is_error"]).cast("bigint").alias("errors"))
