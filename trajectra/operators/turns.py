"""Edits of message sequences as gaps and islands: failed turns, trailing tools, merged runs, ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajectra.functions import patterns as P


def _w():
    return Window.partitionBy("rec_id").orderBy("msg_idx")


def drop_error_turns(messages: DataFrame) -> DataFrame:
    """Without turns in which a tool message begins with an error marker: its assistant message and all its tool messages."""
    failed = (F.col("role") == "tool") & F.greatest(*(F.col("content").startswith(p) for p in P.TURN_ERROR_STARTS))
    turn = F.sum(F.when(F.col("role") == "tool", 0).otherwise(1)).over(_w().rowsBetween(Window.unboundedPreceding, 0))
    rows = messages.withColumn("__turn", turn).withColumn("__bad", F.coalesce(F.max(failed.cast("int")).over(Window.partitionBy("rec_id", "__turn")), F.lit(0)) == 1)
    return rows.filter(~(F.col("__bad") & F.col("role").isin("tool", "assistant"))).drop("__turn", "__bad")


def trim_trailing_tools(messages: DataFrame) -> DataFrame:
    last = F.max(F.when(F.col("role") != "tool", F.col("msg_idx"))).over(Window.partitionBy("rec_id"))
    return messages.withColumn("__last", last).filter("msg_idx <= __last").drop("__last")


def merge_runs(messages: DataFrame, role: str, separator: str = "\n\n") -> DataFrame:
    """Runs of one role become one message with the texts joined; other messages stay.  msg_idx is the run's first."""
    start = F.when((F.col("role") == role) & (F.lag("role").over(_w()) == role), 0).otherwise(1)
    island = F.sum("__start").over(_w().rowsBetween(Window.unboundedPreceding, 0))
    grouped = messages.withColumn("__start", start).withColumn("__island", island).groupBy("rec_id", "__island")
    texts = F.transform(F.array_sort(F.collect_list(F.struct("msg_idx", F.coalesce("content", F.lit("")).alias("content")))), lambda x: x["content"])
    joined = F.array_join(F.filter(texts, lambda t: t != ""), separator)
    return grouped.agg(F.min("msg_idx").alias("msg_idx"), F.min("role").alias("role"), joined.alias("content")).drop("__island")


def empty_placeholder(role: Column, content: Column) -> Column:
    return F.when((role == "assistant") & (F.trim(content) == "(empty)"), "").otherwise(content)


def align_call_ids(calls: DataFrame, answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Missing ids of calls (rec_id, msg_idx, pos, id) and of tool messages that answer them (rec_id, asst_idx, pos, id).

    A call without an id takes that of the answer at its place, else a generated one
    numbered through its record; an answer without an id takes its call's.
    """
    blank = lambda c: F.col(c).isNull() | (F.col(c) == "")
    given = answers.filter(~blank("id")).select("rec_id", F.col("asst_idx").alias("msg_idx"), "pos", F.col("id").alias("answer_id"))
    joined = calls.join(given, ["rec_id", "msg_idx", "pos"], "left").withColumn("known", F.when(~blank("id"), F.col("id")).otherwise(F.col("answer_id")))
    order = Window.partitionBy("rec_id").orderBy("msg_idx", "pos").rowsBetween(Window.unboundedPreceding, 0)
    number = F.sum(F.col("known").isNull().cast("int")).over(order)
    called = joined.withColumn("n", number).select("rec_id", "msg_idx", "pos", F.coalesce("known", F.format_string("call_%06d", "n")).alias("id"))
    answered = answers.join(called.select("rec_id", F.col("msg_idx").alias("asst_idx"), "pos", F.col("id").alias("call_id")), ["rec_id", "asst_idx", "pos"], "left")
    return called, answered.select("rec_id", "asst_idx", "pos", F.when(blank("id"), F.col("call_id")).otherwise(F.col("id")).alias("id"))
