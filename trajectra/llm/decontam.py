"""Benchmark decontamination with suffix arrays over shards of the training text.

Each Arrow batch of documents is cut into shards.  A shard's words become ids of the
benchmark's vocabulary (any other word is 0, and no suffix starts with it or is
compared beyond it), its word suffixes are sorted by prefix doubling to the longest
benchmark item's length, and every suffix of every item is binary-searched, word by
word, for its interval of the suffix array.  The interval at the window's length holds
all verbatim occurrences of the window; narrowing it further gives the longest match
and its locations.  Shards are independent, so an executor's loss repeats only its own.

Benchmarks of any size: the items are taken in blocks of at most ``BLOCK_CHARS``
characters, each against all shards, and what they find is united by document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajectra.llm import textscan as ts

#: Characters of benchmark text that go to the executors at once (a proven bound on what is broadcast).
BLOCK_CHARS = 16_000_000
WINDOW = 8


@dataclass
class Benchmark:
    """A block of items: sorted vocabulary hashes, item word ids joined with 0 between, and each item's range."""

    names: list[str]
    vocabulary: np.ndarray
    stream: np.ndarray
    begin: np.ndarray
    length: np.ndarray
    window: int

    @classmethod
    def build(cls, items: list[tuple[str, str | None]], window: int = WINDOW) -> Benchmark:
        names, hashes = [], []
        for g in ts.groups(pa.array([t for _, t in items], pa.large_string())):
            w = ts.words(g, ts.ALNUM, ts.LOWER[g.data])
            for k in range(g.n):
                part = w.hash[w.first[k] : w.first[k + 1]]
                if len(part):
                    names.append(items[g.first + k][0])
                    hashes.append(part)
        vocabulary = np.unique(np.concatenate(hashes)) if hashes else np.zeros(0, np.uint64)
        parts, begin, at = [], [], 0
        for h in hashes:
            begin.append(at)
            parts += [np.searchsorted(vocabulary, h) + 1, [0]]
            at += len(h) + 1
        stream = np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
        return cls(names, vocabulary, stream, np.array(begin, np.int64), np.array([len(h) for h in hashes], np.int64), window)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Vocabulary ids from 1, or 0."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)

    def queries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Item, offset in the stream and words that must match, of every suffix that can hold a window."""
        need = np.minimum(self.length, self.window)
        n = self.length - need + 1
        item = np.repeat(np.arange(len(n)), n)
        first = np.cumsum(n) - n
        return item, self.begin[item] + np.arange(len(item)) - first[item], need[item]


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Positions of non-zero ids, their suffixes sorted by at least ``depth`` ids; a 0 ends a suffix."""
    padded = np.append(ids, 0)
    at = np.flatnonzero(ids)
    rank = padded.astype(np.int64)
    done = 1
    order = at[np.argsort(rank[at], kind="stable")]
    while done < depth and len(at):
        after = np.minimum(at + done, len(ids))
        key = rank[at] * (int(rank.max()) + 1) + rank[after]
        by = np.argsort(key, kind="stable")
        order = at[by]
        sorted_key = key[by]
        new = np.cumsum(np.append(True, sorted_key[1:] != sorted_key[:-1]))
        rank = np.zeros(len(padded), np.int64)
        rank[order] = new
        done *= 2
        if new[-1] == len(at):
            break
    return order


def narrow(ids: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Binary search in intervals of suffixes that agree on ``depth`` ids for those whose next id is ``want``."""
    padded = np.append(ids, np.zeros(depth + 1, np.int64))
    out = []
    for strict in (False, True):
        a, b = low.copy(), high.copy()
        while len(open_ := np.flatnonzero(a < b)):
            mid = (a[open_] + b[open_]) >> 1
            value = padded[order[mid] + depth]
            right = value <= want[open_] if strict else value < want[open_]
            a[open_] = np.where(right, mid + 1, a[open_])
            b[open_] = np.where(right, b[open_], mid)
        out.append(a)
    return out[0], out[1]


def search(ids: np.ndarray, bench: Benchmark) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All occurrences of windows in a shard: query suffix, position, and the words of the longest match there."""
    item, offset, need = bench.queries()
    empty = np.zeros(0, np.int64)
    if not len(item) or not ids.any():
        return empty, empty, empty, empty
    order = suffix_array(ids, int(bench.length.max()))
    query = np.arange(len(item))
    low, high = np.zeros(len(item), np.int64), np.full(len(item), len(order), np.int64)
    for depth in range(bench.window):
        going = np.flatnonzero(depth < need[query])
        if not len(going):
            break
        low[going], high[going] = narrow(ids, order, low[going], high[going], depth, bench.stream[offset[query[going]] + depth])
        kept = low < high
        query, low, high = query[kept], low[kept], high[kept]
    counts = high - low
    hit = np.repeat(query, counts)
    first = np.cumsum(counts) - counts
    position = order[np.repeat(low, counts) + np.arange(len(hit)) - np.repeat(first, counts)] if len(hit) else empty
    length = need[hit].copy()
    going = np.arange(len(hit))
    while len(going):  # extend each occurrence to its longest verbatim match
        p, q = position[going] + length[going], offset[hit[going]] + length[going]
        inside = p < len(ids)
        same = np.zeros(len(going), bool)
        same[inside] = (ids[p[inside]] == bench.stream[q[inside]]) & (ids[p[inside]] > 0)
        going = going[same]
        length[going] += 1
    return hit, position, length, need[hit] if len(hit) else empty


def _shards(texts: pa.Array, bench: Benchmark):
    """Each shard's group, words and ids with a 0 after each document; ``at`` gives a word's place among the ids."""
    for g in ts.groups(texts):
        w = ts.words(g, ts.ALNUM, ts.LOWER[g.data])
        ids = np.zeros(len(w.hash) + g.n, np.int64)
        at = np.arange(len(w.hash)) + w.doc
        ids[at] = bench.ids(w.hash)
        yield g, w, ids, at


def _hits(texts: pa.Array, bench: Benchmark):
    """For each document: words, hit flags of its words, names of the items found, its longest match and the word at which it first begins (-1: none)."""
    item, _, _ = bench.queries()
    for g, w, ids, at in _shards(texts, bench):
        query, position, length, need = search(ids, bench)
        cover = np.zeros(len(ids) + 1, np.int64)
        np.add.at(cover, position, 1)
        np.add.at(cover, position + need, -1)
        hit = (np.cumsum(cover)[: len(ids)] > 0)[at]
        doc_of = np.searchsorted(w.first[1:] + np.arange(1, g.n + 1), position, "right")
        n_words = np.diff(w.first)
        pairs = np.unique(doc_of * max(1, len(bench.names)) + item[query]) if len(query) else np.zeros(0, np.int64)
        found: dict[int, list[str]] = {}
        for p in pairs.tolist():
            found.setdefault(p // len(bench.names), []).append(bench.names[p % len(bench.names)])
        longest, begins = np.zeros(g.n, np.int64), np.full(g.n, -1, np.int64)
        best = np.lexsort((position, -length, doc_of))
        which, first = np.unique(doc_of[best], return_index=True)
        longest[which] = length[best[first]]
        begins[which] = position[best[first]] - w.first[which] - which
        for k in range(g.n):
            yield int(n_words[k]), hit[w.first[k] : w.first[k + 1]], sorted(set(found.get(k, ()))), int(longest[k]), int(begins[k])


_FOUND = "struct<n_words:bigint,hits:binary,items:array<string>,longest:bigint,longest_at:bigint>"


def _scan_column(bench: Benchmark):
    @F.arrow_udf(_FOUND)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = [(n, np.packbits(h).tobytes() if h.any() else b"", *more) for n, h, *more in _hits(texts, bench)]
            kinds = (pa.int64(), pa.binary(), pa.list_(pa.string()), pa.int64(), pa.int64())
            yield pa.StructArray.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(kinds)], ["n_words", "hits", "items", "longest", "longest_at"])

    return scan


def _summary(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for hits, items in batches:
        n_hit = [int(np.unpackbits(np.frombuffer(h.as_py(), np.uint8)).sum()) for h in hits]
        names = [sorted(set(x.as_py())) for x in items]
        sha = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in names]
        yield pa.StructArray.from_arrays([pa.array(n_hit, pa.int64()), pa.array([len(x) for x in names], pa.int64()), pa.array(sha, pa.string())], ["n_hit", "n_items", "items_sha256"])


def _either(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for left, right in batches:
        out = []
        for a, b in zip(left, right):
            a, b = a.as_py(), b.as_py()
            out.append((np.frombuffer(a, np.uint8) | np.frombuffer(b, np.uint8)).tobytes() if a and b else a or b)
        yield pa.array(out, pa.binary())


def with_matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", column: str = "found", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """All columns of docs and ``column``: struct<n_words, hits (bit per word), items (ids as strings), longest, longest_at>.

    longest is the number of words of the longest verbatim match of a window or more, longest_at the word (from 0) at which the
    first such match begins, -1 without one.  Repeated rows and clashing columns stay as they are.

    A window is ``window`` consecutive item words, or all words of a shorter item.
    Items of null text or id, or without words, match nothing; a null text has no
    words; items of equal id count once.  An empty benchmark finds nothing.  An
    item longer than a block is a block of its own.
    """
    items = benchmark.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).alias("text")).filter("id IS NOT NULL AND text IS NOT NULL")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars * 3 // (2 * block_chars))) if chars > block_chars else 1
    out = docs
    for k in range(blocks):
        part = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k)
        bench = Benchmark.build([(r["id"], r["text"]) for r in part.toLocalIterator()], window)
        one = column if k == 0 else f"__{column}_{k}"
        out = out.withColumn(one, _scan_column(bench)(F.col(text)))
        if k:
            a, b = F.col(column), F.col(one)
            merged = F.struct(a["n_words"].alias("n_words"), F.arrow_udf(_either, "binary")(a["hits"], b["hits"]).alias("hits"), F.array_union(a["items"], b["items"]).alias("items"), F.greatest(a["longest"], b["longest"]).alias("longest"), F.when((a["longest"] > b["longest"]) | ((a["longest"] == b["longest"]) & (a["longest_at"] <= b["longest_at"])), a["longest_at"]).otherwise(b["longest_at"]).alias("longest_at"))
            out = out.withColumn(column, merged).drop(one)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", min_items: int = 2, **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated (n_items >= min_items), longest and longest_at (null without a match), for every row."""
    found = with_matches(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), benchmark, **options)
    out = found.select("doc_id", "found.n_words", "found.longest", F.nullif("found.longest_at", F.lit(-1)).alias("longest_at"), F.arrow_udf(_summary, "struct<n_hit:bigint,n_items:bigint,items_sha256:string>")(F.col("found.hits"), F.col("found.items")).alias("s"))
    return out.select("doc_id", "n_words", "s.n_hit", "s.n_items", "s.items_sha256", (F.col("s.n_items") >= min_items).alias("contaminated"), "longest", "longest_at")


def matches(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Longest verbatim matches with their places: doc_id, item_id, doc_word, item_word, n_words (0-based words).

    One row for each maximal match of ``window`` words or more (or of a whole shorter
    item).  For benchmarks within one block.
    """
    items = [(r["item_id"], r["text"]) for r in benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").filter("item_id IS NOT NULL AND text IS NOT NULL").toLocalIterator()]
    bench = Benchmark.build(items, window)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item, offset, _ = bench.queries()
        for batch in batches:
            rows: list[tuple] = []
            for g, w, ids, at in _shards(batch.column(1), bench):
                query, position, length, _ = search(ids, bench)
                bounds = w.first[1:] + np.arange(1, g.n + 1)
                for q, p, n in zip(query.tolist(), position.tolist(), length.tolist()):
                    if p and offset[q] and ids[p - 1] and ids[p - 1] == bench.stream[offset[q] - 1]:
                        continue  # the match began earlier
                    d = int(np.searchsorted(bounds, p, "right"))
                    rows.append((batch.column(0)[g.first + d].as_py(), bench.names[item[q]], p - int(w.first[d]) - d, int(offset[q] - bench.begin[item[q]]), n))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(kinds)], ["doc_id", "item_id", "doc_word", "item_word", "n_words"])

    return docs.select(F.col(doc_id).cast("bigint"), F.col(text)).mapInArrow(find, "doc_id bigint, item_id string, doc_word bigint, item_word bigint, n_words bigint")
