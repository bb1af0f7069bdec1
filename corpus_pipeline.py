"""A training-corpus pipeline over the documents table, in stages that each take and return documents.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame that may be written and read again before the next stage.  All but the last
keep all columns of documents, extra ones too; columns whose names begin with
``__stage`` are reserved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trajectra.llm import bpe_ops, decontam, minhash, pii, quality
from trajectra.llm.queries import BYTE_BPE
from trajectra.llm.shared import apart, cut, small_batches, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the divergence from the languages of this stage's own input."""
    small_batches(spark)
    refs = quality.learn_references(docs)
    return docs.withColumn("__stage", quality.verdict_column(refs, F.col("text"))).filter("__stage.kept").drop("__stage")


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity 0.8): that of the smallest doc_id.

    Of rows with one doc_id one stays.  Rows without a doc_id can't be compared and all stay.
    """
    small_batches(spark)
    found = minhash.near_duplicates(docs, words=5, percent=80)
    touched = found.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n"), F.min("kept").alias("kept")).filter("n > 1 OR NOT kept")
    touched = cut(touched.select(F.col("doc_id").alias("__stage_id"), "kept"))
    maybe, others = minhash.split_by(docs, "doc_id", touched.select("__stage_id"))
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    left = maybe.join(touched.filter("NOT kept").select(F.col("__stage_id").alias("doc_id")), "doc_id", "left_anti").withColumn("__stage", first).filter("__stage = 1").drop("__stage")
    return others.unionByName(left.select(others.columns))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no full window of a benchmark item occurs, and no two items of fewer words.

    A single short item, such as an answer of one word, is no evidence alone: clean documents hold it too.
    """
    found = decontam.with_matches(docs, table(spark, sf_dir, "benchmark"), column="__stage")
    return found.filter(f"__stage.longest < {decontam.WINDOW} AND size(__stage.items) < 2").drop("__stage")


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose personal data is replaced by its kind; n_chars follows the text."""
    out = docs.withColumn("__stage", pii.find_spans(F.col("text"))).withColumn("__stage_text", pii.redact(F.col("text"), F.col("__stage")))
    changes = {"text": F.col("__stage_text")}
    if "n_chars" in docs.columns:
        changes["n_chars"] = F.when(F.size("__stage") > 0, F.length("__stage_text").cast("bigint")).otherwise(F.col("n_chars"))
    return apart(out.withColumns(changes).drop("__stage", "__stage_text"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's token count, and digests of its token ids and of the text decoded from them."""
    small_batches(spark)
    return bpe_ops.bpe_round_trip(docs, BYTE_BPE)


STAGES = [("quality rules", quality_stage), ("MinHash near-dedup", dedup_stage), ("benchmark decontamination", decontamination_stage), ("PII", pii_stage), ("BPE encoding and decoding", bpe_stage)]

#: Components, divergences and token merges are beyond SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table.  What a later stage reads several times is saved once."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < 2:
            docs = cut(docs)
    return docs
