"""Structured Streaming into the scorer: each micro-batch is scored like a data set, as scores depend on one record alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trajectra.plans.flows import score
from trajectra.sources.files import trajectories


def watch_trajectories(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """A stream of JSON lines that appear in a folder; line_no is a line's hash, as a stream has no order."""
    raw = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)
    return raw.select(F.col("_metadata.file_path").alias("file_path"), F.sha2("value", 256).alias("line_no"), F.col("value").alias("raw"))


def score_stream(rows: DataFrame, output: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Appends scored records to a Parquet folder partitioned by batch, so a batch that runs again replaces its own rows."""

    # a file comes whole in one batch, so equal lines of it can be numbered there
    again = F.row_number().over(Window.partitionBy("file_path", "line_no").orderBy(F.lit(0)))

    def each(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.withColumn("line_no", F.concat_ws("-", "line_no", again))
        score(trajectories(numbered).drop("rec_pos")).select("rec_id", "_score").write.mode("overwrite").parquet(f"{output}/batch={batch_id}")

    writer = rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
