"""Quality rules: repetition counts, and divergence of a text's histograms from language references.

References are sums over all documents that pass the base rules: for each language
the counts of character classes and of its common words.  A text is compared
with every reference by the Jensen-Shannon distance (square root of the divergence to
base 2, 0 to 1) and its least distance counts, so a wrong language label does no
harm.  A histogram of too few items says little; below a minimum length its test is
left out.

A language's common words are its ``COMMON`` most frequent of a share of ``SHARE`` or more.  They are found exactly in
two passes.  The first keeps 1 / SHARE counters a language (heavy hitters after Misra and Gries):
what they lose of a word's count is less than SHARE of all words, so each common word
keeps a counter, and counters of parts of the corpus are merged in a tree.  The second counts the words that have
one over everything.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajectra.llm import textscan as ts

#: Base rules.
MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WINDOW = 20, 30, 8
#: Method: a text of n characters or words may be at most BASE + ALLOWANCE / sqrt(n) away, as a short sample strays
#: further from its own language; below the minimum length it isn't compared.
CLASS_BASE, CLASS_ALLOWANCE, MIN_CHARS = 0.25, 1.5, 100
WORD_BASE, WORD_ALLOWANCE, MIN_COMMON_WORDS = 0.12, 2.5, 60
#: Common words of a language, and their least share of its words, one in so many.
COMMON, ONE_IN = 48, 500
SHARE = 1 / ONE_IN

CLASSES = ("lower", "upper", "digit", "space", "line", "stop", "mark", "symbol", "other", "wide")
_CLASS = np.full(256, 8, np.uint8)
for _k, _chars in enumerate((range(0x61, 0x7B), range(0x41, 0x5B), range(0x30, 0x3A), b" ", b"\t\n\x0b\x0c\r", b".,;:'\"()-", b"!?", b"#*$%&|<>")):
    _CLASS[[*_chars]] = _k
_CLASS[0xC0:] = 9
#: A byte of this class continues a character and isn't counted.
_CLASS[0x80:0xC0] = 255
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[*b"#*$%&|<>"]] = True


@dataclass
class Base:
    """Base counts of a group's documents."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray

    @property
    def failed(self) -> np.ndarray:
        return (self.n_words < MIN_WORDS) | (100 * self.n_repeat_words > MAX_REPEAT_PERCENT * self.n_words)


def _again(keys: np.ndarray) -> np.ndarray:
    """Flags of the keys that occur at least twice."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def base_counts(g: ts.Group) -> Base:
    prefix = ts.prefix_hash(g.data)
    w = ts.words(g, ts.NOT_SPACE, g.data, prefix)
    per_doc = lambda flags: ts.per_doc(flags, g.bounds)
    # words in windows found at least twice
    at, h = ts.windows(w, REPEAT_WINDOW)
    cover = np.zeros(len(w.hash) + 1, np.int64)
    if len(at):
        found = at[_again(ts.mix(h + w.doc[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))]
        np.add.at(cover, found, 1)
        np.add.at(cover, found + REPEAT_WINDOW, -1)
    repeat = np.bincount(w.doc[np.cumsum(cover)[:-1] > 0], minlength=g.n)
    # lines: cut at \n and at document bounds
    breaks = np.flatnonzero(g.data == 10)
    starts = np.unique(np.append(breaks + 1, g.bounds[:-1]))
    starts = starts[starts < len(g.data)]
    doc = np.searchsorted(g.bounds, starts, "right") - 1
    ends = np.minimum(np.append(breaks, len(g.data))[np.searchsorted(breaks, starts)], g.bounds[doc + 1])
    has_word = np.searchsorted(w.start, ends) > np.searchsorted(w.start, starts)
    starts, ends, doc = starts[has_word], ends[has_word], doc[has_word]
    lines = ts.mix(ts.span_hash(prefix, starts, ends) + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(lines, return_index=True)
    dups = np.bincount(doc, minlength=g.n) - np.bincount(doc[first], minlength=g.n)
    visible = ts.NOT_SPACE[g.data] & ((g.data & 0xC0) != 0x80)
    return Base(np.diff(w.first), per_doc(visible), per_doc(_SYMBOL[g.data]), dups, repeat)


def class_histograms(g: ts.Group) -> np.ndarray:
    kind = _CLASS[g.data]
    counted = kind != 255
    doc = np.repeat(np.arange(g.n), np.diff(g.bounds))
    return np.bincount(doc[counted] * len(CLASSES) + kind[counted], minlength=g.n * len(CLASSES)).reshape(g.n, -1)


def lexical_words(g: ts.Group) -> ts.Words:
    """Lower-cased runs of letters, digits and characters beyond ASCII."""
    return ts.words(g, ts.ALNUM, ts.LOWER[g.data])


@dataclass
class References:
    """Character class and common word counts of each language; words by hash, sorted."""

    names: list[str]
    classes: np.ndarray
    words: np.ndarray
    counts: np.ndarray
    totals: np.ndarray
    common: np.ndarray


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distances of rows of counts p to one row of counts q."""
    p = p / np.maximum(p.sum(1, keepdims=True), 1)
    q = q / max(q.sum(), 1)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        kl = lambda a: np.where(a > 0, a * np.log2(a / m), 0).sum(1)
        return np.sqrt(np.clip((kl(p) + kl(np.broadcast_to(q, p.shape))) / 2, 0, 1))


def divergences(g: ts.Group, refs: References) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Characters, words, and the least class and word distance of each document; 0 without references."""
    classes = class_histograms(g)
    chars = classes.sum(1)
    w = lexical_words(g)
    n = np.diff(w.first)
    if not refs.names:
        return chars, n, np.zeros(g.n), np.zeros(g.n)
    by_class = np.min([distance(classes, c) for c in refs.classes], axis=0)
    by_word = np.ones(g.n)
    if len(refs.words):
        at = np.minimum(np.searchsorted(refs.words, w.hash), len(refs.words) - 1)
        known = refs.words[at] == w.hash
        grid = np.bincount(w.doc[known] * len(refs.words) + at[known], minlength=g.n * len(refs.words)).reshape(g.n, -1)
        for k in range(len(refs.names)):
            cols = np.flatnonzero(refs.common[k])
            mine = grid[:, cols]
            rows = np.column_stack([mine, n - mine.sum(1)])
            ref = refs.counts[k, cols]
            by_word = np.minimum(by_word, distance(rows, np.append(ref, refs.totals[k] - ref.sum())))
    return chars, n, by_class, by_word


_BASE_FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _by_language(langs: pa.Array, g: ts.Group, good: np.ndarray):
    """Names and document indexes of each language among a group's good documents."""
    names = np.array([x or "" for x in langs.slice(g.first, g.n).to_pylist()], object)
    for name in set(names[good].tolist()) - {""}:
        yield name, np.flatnonzero(good & (names == name))


def heavy_hitters(words: np.ndarray, counts: np.ndarray, keep: int = ONE_IN) -> tuple[np.ndarray, np.ndarray]:
    """Counters of at most ``keep`` words, from counters that may name a word several times.

    All are lowered by the greatest that doesn't fit: keep + 1 of them are, so that over all mergers a word
    loses at most one in keep + 1 of all that was counted.
    """
    every, at = np.unique(words, return_inverse=True)
    total = np.bincount(at, counts, len(every)).astype(np.int64)
    if len(every) > keep:
        total -= np.partition(total, -keep - 1)[-keep - 1]
    return every[total > 0], total[total > 0]


_COUNTERS = "lang string, part int, word bigint, n bigint"


def _counters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Heavy hitters of each language among the words of good documents in this partition."""
    found: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for g in ts.groups(batch.column(0)):
            good, w = ~base_counts(g).failed, lexical_words(g)
            for name, docs in _by_language(batch.column(1), g, good):
                mine = np.zeros(g.n, bool)
                mine[docs] = True
                h, c = np.unique(w.hash[mine[w.doc]], return_counts=True)
                old = found.get(name, (h[:0], c[:0]))
                found[name] = heavy_hitters(np.append(old[0], h), np.append(old[1], c))
    context = TaskContext.get()
    part = context.partitionId() if context else 0
    for name, (h, c) in found.items():
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(h), pa.string()), pa.array(np.full(len(h), part, np.int32)), pa.array(h.view(np.int64)), pa.array(c)], ["lang", "part", "word", "n"])


def _merged(rows: DataFrame, parts: int) -> DataFrame:
    """Counters merged into those of fewer parts."""

    def merge(table: pa.Table) -> pa.Table:
        h, c = heavy_hitters(table["word"].to_numpy().view(np.uint64), table["n"].to_numpy())
        return pa.table({"lang": pa.array([table["lang"][0].as_py()] * len(h), pa.string()), "part": pa.array([table["part"][0].as_py()] * len(h), pa.int32()), "word": h.view(np.int64), "n": c})

    return rows.withColumn("part", F.col("part") % parts).groupBy("lang", "part").applyInArrow(merge, _COUNTERS)


def _sums(candidates: dict[str, np.ndarray]):
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes: dict[str, np.ndarray] = {}
        words: dict[str, np.ndarray] = {}
        totals: dict[str, int] = {}
        for batch in batches:
            for g in ts.groups(batch.column(0)):
                good, w, hist = ~base_counts(g).failed, lexical_words(g), class_histograms(g)
                for name, docs in _by_language(batch.column(1), g, good):
                    if name not in candidates:
                        continue
                    mine = np.zeros(g.n, bool)
                    mine[docs] = True
                    h = w.hash[mine[w.doc]]
                    known = candidates[name]
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    c = np.bincount(at[known[at] == h], minlength=len(known))
                    words[name] = words.get(name, 0) + c
                    classes[name] = classes.get(name, 0) + hist[docs].sum(0)
                    totals[name] = totals.get(name, 0) + len(h)
        rows = [(n, "class", k, int(v)) for n, x in classes.items() for k, v in enumerate(x)]
        rows += [(n, "word", int(h), int(v)) for n, x in words.items() for h, v in zip(candidates[n].view(np.int64), x)]
        rows += [(n, "total", 0, v) for n, v in totals.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.int64()))], ["lang", "kind", "item", "n"])

    return sums


def learn_references(docs: DataFrame, text: str = "text", lang: str = "lang") -> References:
    """References of the languages named in ``lang`` (null or empty: no language), over all documents."""
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    counters = rows.mapInArrow(_counters, _COUNTERS)
    for parts in (4096, 64, 1):  # a merger reads some thousand rows, whatever the number of partitions
        counters = _merged(counters, parts)
    found: dict[str, list[int]] = {}
    for r in counters.select("lang", "word").collect():
        found.setdefault(r["lang"], []).append(r["word"])
    candidates = {name: np.sort(np.array(words, np.int64).view(np.uint64)) for name, words in found.items()}
    if not candidates:
        return References([], np.zeros((0, len(CLASSES))), np.zeros(0, np.uint64), np.zeros((0, 0)), np.zeros(0), np.zeros((0, 0), bool))
    got = rows.mapInArrow(_sums(candidates), "lang string, kind string, item bigint, n bigint").groupBy("lang", "kind", "item").agg(F.sum("n").alias("n")).collect()
    classes: dict[str, list[int]] = {}
    words: dict[str, list[tuple[int, int]]] = {}
    totals: dict[str, int] = {}
    for r in got:
        if r["kind"] == "class":
            classes.setdefault(r["lang"], [0] * len(CLASSES))[r["item"]] = r["n"]
        elif r["kind"] == "word":
            words.setdefault(r["lang"], []).append((-r["n"], int(np.int64(r["item"]).view(np.uint64))))
        else:
            totals[r["lang"]] = r["n"]
    names = sorted(n for n in totals if totals[n])
    top = {n: [(h, -c) for c, h in sorted(words[n])[:COMMON] if -c >= SHARE * totals[n]] for n in names}
    every = np.unique(np.array([h for n in names for h, _ in top[n]], np.uint64))
    counts, common = np.zeros((len(names), len(every))), np.zeros((len(names), len(every)), bool)
    for k, n in enumerate(names):
        for h, c in top[n]:
            at = np.searchsorted(every, np.uint64(h))
            counts[k, at], common[k, at] = c, True
    return References(names, np.array([classes[n] for n in names], float), every, counts, np.array([totals[n] for n in names], float), common)


_VERDICT = "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,base_failed:boolean,kept:boolean,class_distance:double,word_distance:double>"


def verdict_column(refs: References, text: Column | str) -> Column:
    """Base counts, distances and verdict of a text column; a null or empty text has no words and isn't kept."""

    @F.arrow_udf(_VERDICT)
    def verdicts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts: list[list[np.ndarray]] = [[] for _ in range(9)]
            for g in ts.groups(texts):
                b = base_counts(g)
                chars, words, by_class, by_word = divergences(g, refs)
                class_fits = by_class <= CLASS_BASE + CLASS_ALLOWANCE / np.sqrt(np.maximum(chars, 1))
                word_fits = by_word <= WORD_BASE + WORD_ALLOWANCE / np.sqrt(np.maximum(words, 1))
                kept = ~b.failed & ((chars < MIN_CHARS) | class_fits) & ((words < MIN_COMMON_WORDS) | word_fits)
                for part, x in zip(parts, (*(getattr(b, f) for f in _BASE_FIELDS), b.failed, kept, by_class, by_word)):
                    part.append(x)
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
            columns = [pa.array(np.concatenate(p) if p else [], k) for p, k in zip(parts, kinds)]
            yield pa.StructArray.from_arrays(columns, [*_BASE_FIELDS, "base_failed", "kept", "class_distance", "word_distance"])

    return verdicts(text)


def quality(docs: DataFrame, refs: References | None = None, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id and verdict for every row; repeated rows and null ids stay, an empty table gives no rows.

    A null or empty text has no words, so it fails the base rules.  Texts of any length are read whole.  Words of equal
    count are common in the order of their hashes.  Other columns are not read, whatever their names.
    """
    refs = learn_references(docs, text, lang) if refs is None else refs
    return docs.select(F.col(doc_id).alias("doc_id"), verdict_column(refs, F.col(text)).alias("v")).select("doc_id", "v.*")
