"""DataFrame operators over the streaming BPE transducer: round trips and token counts by section."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajectra.llm import bpe


def encode_column(text: Column | str, vocabulary: str) -> Column:
    """Token ids of a text column as array<int>; null and empty texts give an empty array."""

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = bpe.load(vocabulary)
        for texts in batches:
            packed = [b"".join(coder.encode_packed(t.as_py() or "")) for t in texts]
            ends = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), np.int32)))

    return ids(text)


def decode_column(ids: Column | str, vocabulary: str) -> Column:
    """Text of an array<int> column of token ids; bytes that are no UTF-8 become U+FFFD."""

    @F.arrow_udf("string")
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = bpe.load(vocabulary)
        for batch in batches:
            yield pa.array([coder.decode(x.as_py() or []) for x in batch], pa.string())

    return texts(ids)


def round_trip_column(text: Column | str, vocabulary: str) -> Column:
    """struct<n_tokens, ids_sha256, decoded_sha256> of each text; a null text counts as empty.

    Texts of any length pass window by window: neither all ids nor the decoded
    text of a document are ever held.  Equal texts give equal results.
    """

    @F.arrow_udf("struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")
    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = bpe.load(vocabulary)
        for texts in batches:
            n, ids, decoded = zip(*(bpe.round_trip(coder, t.as_py()) for t in texts)) if len(texts) else ((), (), ())
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], ["n_tokens", "ids_sha256", "decoded_sha256"])

    return digest(text)


def bpe_round_trip(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every row; repeated rows and null ids stay as they are."""
    return docs.select(F.col(doc_id).alias("doc_id"), round_trip_column(F.col(text), vocabulary).alias("r")).select("doc_id", "r.n_tokens", "r.ids_sha256", "r.decoded_sha256")


#: Ways to allocate a token whose characters lie in several sections.
RULES = ("first", "last", "most")


def allocate(token_start: np.ndarray, token_end: np.ndarray, section_start: np.ndarray, rule: str = "first") -> tuple[np.ndarray, int]:
    """Tokens of each section, and how many tokens crossed a boundary.

    Spans are character offsets, end exclusive, in ascending order; section k goes
    from section_start[k] to the next one's start, and the first starts at 0.
    ``first`` and ``last`` give a crossing token to the section of its first or
    last character, ``most`` to the one with most of its characters, the earlier
    one on a tie.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    low = np.searchsorted(section_start, token_start, "right") - 1
    high = np.searchsorted(section_start, np.maximum(token_end - 1, token_start), "right") - 1
    to = {"first": low, "last": high, "most": low.copy()}[rule]
    crossing = np.flatnonzero(high > low)
    if rule == "most":
        ends = np.append(section_start[1:], np.iinfo(np.int64).max)
        for i in crossing:
            k = np.arange(low[i], high[i] + 1)
            to[i] = k[np.argmax(np.minimum(ends[k], token_end[i]) - np.maximum(section_start[k], token_start[i]))]
    return np.bincount(to, minlength=len(section_start)), len(crossing)


def line_starts(text: str) -> np.ndarray:
    """Character offsets at which the \\n-ended lines of a text begin; an empty text has one, empty, section."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    starts = np.append(0, np.flatnonzero(codes == 10) + 1)
    return starts[: max(1, len(starts) - (starts[-1] == len(codes)))]


def token_spans(coder: bpe.ByteBPE, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Character spans of a text's tokens; a token that holds part of a character's bytes spans that character."""
    ids = np.frombuffer(b"".join(coder.encode_packed(text)), np.uint32)
    ends = np.cumsum(coder.byte_len[ids])
    starts = ends - coder.byte_len[ids]
    data = np.frombuffer(text.encode(), np.uint8)
    char_of = np.cumsum((data & 0xC0) != 0x80) - 1
    return (char_of[starts], char_of[ends - 1] + 1) if len(ids) else (starts, ends)


def section_token_counts(docs: DataFrame, vocabulary: str, rule: str = "first", doc_id: str = "doc_id", text: str = "text", starts: str | None = None) -> DataFrame:
    """Tokens of each section of each document, from one encoding of the whole document.

    ``starts`` names an array<bigint> column of ascending section starts (character
    offsets, 0 first; null: one section); without it sections are lines.  Returns
    doc_id, n_tokens, n_sections, n_crossing and section_tokens (array<bigint>,
    summing to n_tokens).  A null or empty text has no tokens and one section.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    kind = "struct<n_tokens:bigint,n_sections:bigint,n_crossing:bigint,section_tokens:array<bigint>>"

    def counts(coder: bpe.ByteBPE, value: str, begins: np.ndarray) -> tuple:
        begin, end = token_spans(coder, value)
        got, crossing = allocate(begin, end, begins, rule)
        return len(begin), len(begins), crossing, got.tolist()

    def rows(found: list[tuple]) -> pa.Array:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
        return pa.StructArray.from_arrays([pa.array([f[k] for f in found], t) for k, t in enumerate(kinds)], ["n_tokens", "n_sections", "n_crossing", "section_tokens"])

    @F.arrow_udf(kind)
    def by_line(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = bpe.load(vocabulary)
        for texts in batches:
            yield rows([counts(coder, v := t.as_py() or "", line_starts(v)) for t in texts])

    @F.arrow_udf(kind)
    def by_starts(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        coder = bpe.load(vocabulary)
        for texts, begins in batches:
            yield rows([counts(coder, t.as_py() or "", np.array(b.as_py() or [0], np.int64)) for t, b in zip(texts, begins)])

    found = by_line(F.col(text)) if starts is None else by_starts(F.col(text), F.col(starts))
    return docs.select(F.col(doc_id).alias("doc_id"), found.alias("r")).select("doc_id", "r.*")
