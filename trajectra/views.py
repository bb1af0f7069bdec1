"""Trajectories over the star-schema test tables: events as agent steps, conversations as plain records.

Each event of a user is one turn: a call of a tool and its observation.  The same rules
are stated as SQL in STEPS_SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trajectra import schema
from trajectra.batches import small_batches

TOOLS = ("Read", "Bash", "Edit", "Grep")
#: Rows that one task of an exchange gets at most, if no key has more.
TASK_ROWS = 1 << 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tasks_for(rows: DataFrame) -> int:
    """Partitions for an exchange of these rows, so that a task's share stays the same on larger tables.

    Left to itself, Spark shuffles into a fixed number of partitions or coalesces them by their compressed size, which
    tells little of the arrays that are made from them.  Rows of Parquet are counted from its footers.
    """
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // TASK_ROWS))


def event_steps(spark: SparkSession, sf_dir: str, text_ids: bool = False) -> DataFrame:
    """rec_id, step, k, tool, args and output of each event, in order of time.

    Events are dealt out by rec_id once: what is grouped by it later, as text if text_ids, isn't dealt out again.
    """
    order = Window.partitionBy("rec_id").orderBy("ts", "event_id")
    e = table(spark, sf_dir, "events")
    e = e.withColumn("rec_id", F.col("user_id").cast("string" if text_ids else "bigint")).repartition(tasks_for(e), "rec_id")
    e = e.withColumn("step", F.row_number().over(order) - 1).withColumn("k", F.coalesce(F.get_json_object("props", "$.k").cast("bigint"), F.lit(0)))
    kind = F.col("event_type")
    file = F.concat(F.lit("src/f"), (F.col("k") % 7).cast("string"), F.lit(".py"))
    command = F.when(kind == "error", "make build").when(F.col("k") % 3 == 0, "cd /repo && pytest -q tests 2>&1 | tail -5").when(F.col("k") % 3 == 1, F.concat(F.lit("echo x > "), file)).otherwise("ls -la")
    tool = F.when(kind == "view", "Read").when(kind == "purchase", "Edit").when(kind == "signup", "Grep").otherwise("Bash")
    args = F.when(kind.isin("view", "purchase"), F.to_json(F.struct(file.alias("file_path")))).when(kind == "signup", F.lit('{"pattern":"x"}')).otherwise(F.to_json(F.struct(command.alias("command"))))
    test_out = F.when(F.col("k") % 4 == 0, "3 passed in 0.1s").when(F.col("k") % 4 == 1, "1 failed, 2 passed").when(F.col("k") % 4 == 2, "collected 0 items").otherwise("done")
    output = F.when(kind == "error", "make: command not found").when((kind == "click") & (F.col("k") % 3 == 0), test_out).otherwise(F.concat(F.lit("ok "), F.col("event_type"), F.lit(" "), F.col("k").cast("string")))
    return e.select("rec_id", "step", "k", tool.alias("tool"), args.alias("args"), output.alias("output"), kind.alias("kind"))


STEPS_SQL = """
ev AS (SELECT user_id AS rec_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS step,
  coalesce(CAST(json_extract_string(props, '$.k') AS BIGINT), 0) AS k, event_type AS kind FROM events),
steps AS (SELECT rec_id, step, k, kind,
  CASE kind WHEN 'view' THEN 'Read' WHEN 'purchase' THEN 'Edit' WHEN 'signup' THEN 'Grep' ELSE 'Bash' END AS tool,
  CASE WHEN kind IN ('view', 'purchase') OR (kind = 'click' AND k % 3 = 1) THEN 'src/f' || (k % 7) || '.py' END AS file,
  CASE kind WHEN 'view' THEN 'read' WHEN 'purchase' THEN 'write' WHEN 'signup' THEN 'search' ELSE 'bash' END AS cls,
  kind = 'click' AND k % 3 = 0 AS is_test, kind = 'error' AS is_error,
  CASE WHEN kind = 'error' THEN 'make: command not found' WHEN kind = 'click' AND k % 3 = 0 THEN
    CASE k % 4 WHEN 0 THEN '3 passed in 0.1s' WHEN 1 THEN '1 failed, 2 passed' WHEN 2 THEN 'collected 0 items' ELSE 'done' END
    ELSE 'ok ' || kind || ' ' || k END AS output,
  count(*) OVER (PARTITION BY rec_id) AS n,
  kind = 'purchase' OR (kind = 'click' AND k % 3 = 1) AS writes FROM ev)
"""


def event_trajectories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested trajectory for each user: a task, and for each event a call and its output; it ends with a tool message."""
    steps = event_steps(spark, sf_dir, text_ids=True)
    call = F.array(F.struct(F.concat_ws("_", F.lit("call"), "step").alias("id"), F.lit("function").alias("type"), F.struct(F.col("tool").alias("name"), F.col("args").alias("arguments")).alias("function")))
    none = F.lit(None)
    message = lambda role, content, calls=None: F.struct(F.lit(role).alias("role"), none.cast("string").alias("name"), content.alias("content"), none.cast("string").alias("reasoning_content"), (calls if calls is not None else none.cast(f"array<{schema.CALL}>")).alias("tool_calls"), none.cast("double").alias("weight"), none.cast("string").alias("tool_call_id"))
    says = F.concat(F.lit("I will "), F.when(F.col("k") % 2 == 0, F.lit("read and run")).otherwise("go on"))
    pair = F.struct("step", F.array(message("assistant", says, call), message("tool", F.col("output"))).alias("m"))
    grouped = steps.groupBy("rec_id").agg(F.array_sort(F.collect_list(pair)).alias("pairs"))
    tools = F.array(*(F.struct(F.lit("function").alias("type"), F.struct(F.lit(t).alias("name"), F.lit("").alias("description"), F.lit("{}").alias("parameters")).alias("function")) for t in TOOLS))
    first = F.array(message("user", F.lit("fix it")))
    return grouped.select("rec_id", tools.alias("tools"), F.concat(first, F.flatten(F.transform("pairs", lambda p: p["m"]))).alias("messages"))


def conversation_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("rec_id"), F.col("turn").alias("msg_idx"), "role", F.col("text").alias("content"))
