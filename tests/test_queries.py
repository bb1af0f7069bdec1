"""Registered queries against DuckDB on the smallest test tables."""

import os

import duckdb
import pytest

import trajectra.queries_records  # noqa: F401
from trajectra.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
METRICS = {n for n in QUERIES if n.startswith("m_")} | {"loop_fraction", "err_repeat", "late_error_rate", "composite"}


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(DATA):
        pytest.skip("no test tables here")
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{DATA}/{f}'")
    return c


def ordered(rows):
    return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows), key=lambda r: [(x is None, str(x)) for x in r])


@pytest.mark.parametrize("name", sorted(set(ORACLES) - METRICS))  # score_record holds all metrics
def test_same_rows_as_sql(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    columns = sorted(got.columns)
    assert ordered(tuple(r) for r in got.select(*columns).collect()) == ordered(duck.sql(f"select {', '.join(columns)} from ({ORACLES[name]})").fetchall())


def test_score_is_one_exchange_after_the_input(spark):
    """Beyond the exchanges that build the test view, scoring needs only the one by record id."""
    from trajectra.operators import metrics, relations
    from trajectra.views import event_trajectories

    rows = event_trajectories(spark, DATA)
    count = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert count(metrics.scores(relations.profiles(relations.steps(rows)))) <= count(rows) + 1


def test_no_text_crosses_the_exchange_of_a_score(spark):
    """Of messages, calls and signs of errors are shuffled, and at most 80 characters of an output."""
    from trajectra.operators import metrics, relations
    from trajectra.views import event_trajectories

    base = spark.createDataFrame(event_trajectories(spark, DATA).limit(5).collect(), event_trajectories(spark, DATA).schema)
    plan = metrics.scores(relations.profiles(relations.steps(base)))._jdf.queryExecution().executedPlan()
    found, waiting = [], [plan]
    while waiting:
        p = waiting.pop()
        if p.nodeName() == "AdaptiveSparkPlan":
            p = p.initialPlan()
        kids = p.children()
        waiting += [kids.apply(i) for i in range(kids.size())]
        if p.nodeName() == "Exchange":
            found.append({p.output().apply(i).name() for i in range(p.output().size())})
    assert len(found) == 1 and not found[0] & {"content", "reasoning", "window", "messages", "m", "thought", "tool_calls"} and "head" in found[0]
