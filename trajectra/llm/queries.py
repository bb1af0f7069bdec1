"""The subpackage's registered queries: each operator over its whole table with production parameters.

All read whole tables and texts of any length, return a row for each input row, no rows for an empty table, and don't read
columns that they don't name.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from trajectra.llm import bpe_ops, decontam, langid, minhash, pii, quality, token_files, toxicity, urls
from trajectra.llm.shared import cut, table

BYTE_BPE, WORD_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def op1_minhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of 2-word shingles at 80 %, by MinHash bands and stars.

    Null and empty texts have no shingles and stand alone, texts of fewer words are one shingle; repeated ids are one node with the
    links of all their texts; a null id is kept with a null component; of ties the smallest id names the group; equal rows are all returned.
    """
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text by the learned lexicon.  Null and empty texts score as texts without terms; see toxicity()."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), cut=cut)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every text.  Null and empty texts have no words and fail the base rules; see quality()."""
    return quality.quality(table(spark, sf_dir, "documents"))


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens and digests of every text.  Null counts as empty: no tokens, digests of nothing; repeated rows and null ids stay; texts of any length stream."""
    return bpe_ops.bpe_round_trip(table(spark, sf_dir, "documents"), BYTE_BPE)


def op5_section_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each line of every text, a token that crosses a line's end going to its first line.

    A null or empty text has one section without tokens; repeated rows and null ids stay; a text's spans are held whole.
    """
    return bpe_ops.section_token_counts(table(spark, sf_dir, "documents"), BYTE_BPE)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids as read back from token files.  Null counts as empty (the end id alone); null ids come first; repeated rows are all written."""
    return token_files.token_file_digest(spark, table(spark, sf_dir, "documents"), WORD_BPE)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text.  Null, empty and letterless texts are `und` with score 0; of ties the first language by name; see identify()."""
    return langid.identify(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every text, with the longest verbatim match and where it begins.

    Null and empty texts and items have no words; items of equal id count once; repeated rows and null ids stay; of equally long
    matches the first counts.
    """
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every url.  Null, and urls without `://`, have an empty host and path; null urls are allowed; see url_verdicts()."""
    return urls.url_verdicts(table(spark, sf_dir, "pages"), cut=cut).drop("score")


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every text.  Null and empty texts have none; spans of different kinds may overlap; see personal_data()."""
    return pii.span_digest(pii.personal_data(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_minhash_groups, op2_toxicity, op3_quality_rules, op4_bpe_round_trip, op5_section_token_counts, op6_token_files, op7_language_id, op8_decontamination, op9_url_filter, op10_personal_data)}

_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: Queries that DuckDB can express over whole tables.
ORACLES: dict[str, str] = {
    "op8_decontamination": f"""WITH i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS (SELECT item_id, k, p AS ip, array_to_string(w[p:p + k - 1], ' ') AS key FROM (SELECT item_id, w, least(8, len(w)) AS k, unnest(range(1, len(w) - least(8, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)),
d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
s AS (SELECT DISTINCT k FROM iw),
dw AS (SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS key FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, s WHERE len(w) >= k)),
m AS (SELECT doc_id, dw.k AS k, p, item_id, ip FROM dw JOIN iw ON dw.k = iw.k AND dw.key = iw.key),
r AS (SELECT doc_id, min(p) AS begins, count(*) + min(k) - 1 AS words FROM (SELECT *, p - row_number() OVER (PARTITION BY doc_id, item_id, k, p - ip ORDER BY p) AS run FROM m) GROUP BY doc_id, item_id, k, p - ip, run),
b AS (SELECT doc_id, max(words) AS longest, arg_min(begins, (-words, begins)) - 1 AS longest_at FROM r GROUP BY doc_id),
h AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM m) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS c, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(c, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(c, 0) >= 2 AS contaminated, coalesce(longest, 0) AS longest, longest_at
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN b ON d.doc_id = b.doc_id""",
}
