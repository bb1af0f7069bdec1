"""What a task holds stays the same on larger tables: exchanges of the queries get more partitions, texts are parsed once."""

import re

import pytest

import trajectra.queries_records  # noqa: F401
from trajectra import views
from trajectra.operators import judge
from trajectra.queries import QUERIES

DATA = "/root/testdata/sf0.001"


def exchanges(df):
    """Numbers of partitions of the plan's exchanges by hash."""
    return [int(n) for n in re.findall(r"Exchange hashpartitioning\(.*, (\d+)\), ", df._jdf.queryExecution().executedPlan().toString())]


def assert_dealt(spark, monkeypatch, name, table):
    monkeypatch.setattr(views, "TASK_ROWS", 50)
    most = -(-spark.read.parquet(f"{DATA}/{table}.parquet").count() // 50)
    found = exchanges(QUERIES[name](spark, DATA))
    if name in SUMMARIES:  # their last exchange is by a few groups
        found = found[-1:]
    assert found and min(found) >= most, found


@pytest.mark.parametrize("name", ["checklist_judgement"])
def test_tasks_grow_with_lines(spark, monkeypatch, name):
    assert_dealt(spark, monkeypatch, name, "lineitem")


SUMMARIES = {"score_summary", "tool_error_rate"}
EVENT_QUERIES = ["composite", "m_dpi", "m_sub", "m_tvr", "scaffolds_and_endings", "score_record", "score_summary", "err_repeat", "late_error_rate", "m_oec", "m_ped", "m_scp", "tool_error_counts", "tool_error_rate", "typed_command_errors", "observations"]


@pytest.mark.parametrize("name", EVENT_QUERIES)
def test_tasks_grow_with_events(spark, monkeypatch, name):
    assert_dealt(spark, monkeypatch, name, "events")


def test_an_answer_is_parsed_once(spark):
    rows = spark.createDataFrame([(1, '{"a":{"checks":[{"description":"x"}]}}')], "rec_id long, answer string")
    checks = judge.checklist_rows(rows)
    plan = checks._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"parseJson|parse_json", plan)) == 1
    assert [tuple(r) for r in checks.select("category_id", "check_id", "description").collect()] == [("a", "a_1", "x")]


@pytest.mark.parametrize("name", ["convert_typed_steps", "convert_logged_blocks"])
def test_records_go_to_python_in_small_batches(spark, name):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, str(64 << 20))
        QUERIES[name](spark, DATA)
        assert int(spark.conf.get(key)) <= 8 << 20
    finally:
        spark.conf.set(key, before)
