"""Language identification by words first, then by ever shorter character n-grams.

A word that the model knows counts with its log frequency in each language.  Any
other word takes the mean log frequencies of its known 5-grams (with one blank
before and after the word), or if none is known of its 4-grams, and so on down to
single characters.  A text's language is the one with the largest sum.

Words are runs of letters, lower-cased.  The model learns from at most ``TRAIN_ROWS``
different whole texts of each language, those with the smallest hashes; it keeps all their
words and grams.  So what is sent to executors is bounded by the labelled rows.
A word or gram has an entry for each language that it was seen in, and counts for the others
with the language's log frequency of the unseen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajectra.llm import textscan as ts

UNKNOWN = "und"
TRAIN_ROWS, LONGEST = 500, 5
_U = np.uint64
_BLANK = 0x20
_tables: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    if "letters" not in _tables:
        _tables["letters"] = np.array([chr(i).isalpha() for i in range(0x110000)])
        _tables["values"] = ts.mix(np.arange(0x110000, dtype=np.uint64) + _U(77)) | _U(1)
    return _tables["letters"]


@dataclass
class Runs:
    """Words of several texts: prefix hashes over characters, word bounds, the text of each word."""

    prefix: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return ts.span_hash(self.prefix, start, end)


def runs(texts: list[str]) -> Runs:
    """Letter runs of lower-cased texts; blanks stand for all else and lie between texts."""
    letters = _letters()
    codes = np.frombuffer(" ".join(["", *(t.lower() for t in texts), ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(t.lower()) + 1 for t in texts], np.int64)
    inside = letters[codes]
    codes = np.where(inside, codes, _BLANK)
    start = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    end = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    up, _ = ts._power_table(len(codes) + 1)
    prefix = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_tables["values"][codes] * up[: len(codes)], out=prefix[1:])
    return Runs(prefix, start, end, np.searchsorted(np.cumsum(lengths), start, "right"))


def _text_groups(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Index of the first text and the texts of each group of about half a million characters."""
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        held.append(t.as_py() or "")
        size += len(held[-1])
        if size >= ts.GROUP_BYTES // 2:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def gram_spans(r: Runs, n: int, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the n-grams of some words, a blank on each side included, and the word of each."""
    low, count = r.start[words] - 1, np.maximum(r.end[words] - r.start[words] + 3 - n, 0)
    word = np.repeat(np.arange(len(words)), count)
    first = np.cumsum(count) - count
    return low[word] + np.arange(len(word)) - first[word], word


@dataclass
class Model:
    """For words (0) and grams of each length: sorted hashes, whose entries lie between ``bounds``, and the entries.

    An entry is a language and what its log frequency is above ``unseen`` (level, language).
    """

    names: list[str]
    keys: list[np.ndarray]
    bounds: list[np.ndarray]
    langs: list[np.ndarray]
    gains: list[np.ndarray]
    unseen: np.ndarray

    def find(self, level: int, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = self.keys[level]
        if not len(keys):
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        return at, keys[at] == h

    def add(self, sums: np.ndarray, level: int, at: np.ndarray, doc: np.ndarray, weight: np.ndarray) -> None:
        """Add the log frequencies of the keys ``at``, each with a weight, to the sums of their documents."""
        sums += np.outer(np.bincount(doc, weight, len(sums)), self.unseen[level])
        n = self.bounds[level][at + 1] - self.bounds[level][at]
        key = np.repeat(np.arange(len(at)), n)
        entry = self.bounds[level][at][key] + np.arange(len(key)) - (np.cumsum(n) - n)[key]
        cell = doc[key] * sums.shape[1] + self.langs[level][entry]
        sums += np.bincount(cell, self.gains[level][entry] * weight[key], sums.size).reshape(sums.shape)

    def score_texts(self, r: Runs, n_texts: int) -> np.ndarray:
        """Summed log frequencies of each text's words."""
        sums = np.zeros((n_texts, len(self.names)))
        at, known = self.find(0, r.hash(r.start, r.end))
        self.add(sums, 0, at[known], r.doc[known], np.ones(int(known.sum())))
        left = np.flatnonzero(~known)
        for n in range(LONGEST, 0, -1):
            if not len(left):
                break
            start, word = gram_spans(r, n, left)
            at, known = self.find(n, r.hash(start, start + n))
            word, at = word[known], at[known]
            found = np.bincount(word, minlength=len(left))
            self.add(sums, n, at, r.doc[left[word]], 1 / found[word])
            left = left[found == 0]
        return sums


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, level, hash, n of the words and grams of each batch."""
    for batch in batches:
        langs = batch.column(1).to_pylist()
        for first, texts in _text_groups(batch.column(0)):
            r = runs(texts)
            names = sorted({langs[first + k] for k in range(len(texts))})
            lang = np.array([names.index(langs[first + k]) for k in range(len(texts))], np.int64)[r.doc]
            for k, name in enumerate(names):
                mine = np.flatnonzero(lang == k)
                for n in range(LONGEST + 1):
                    if n:
                        start, _ = gram_spans(r, n, mine)
                        h = r.hash(start, start + n)
                    else:
                        h = r.hash(r.start[mine], r.end[mine])
                    h, c = np.unique(h, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(h), pa.string()), pa.array(np.full(len(h), n), pa.int32()), pa.array(h.view(np.int64)), pa.array(c)], ["lang", "level", "hash", "n"])


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """A model from rows with text and language; null texts or languages are left out, a text that occurs often counts once."""
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    rows = rows.withColumn("h", F.xxhash64("text"))
    # the hashes alone are ranked
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    limits = rows.groupBy("lang", "h").agg(F.lit(1).alias("one")).withColumn("rank", rank).filter(F.col("rank") <= TRAIN_ROWS).groupBy("lang").agg(F.max("h").alias("limit"))
    chosen = rows.join(F.broadcast(limits), "lang").filter("h <= limit").groupBy("lang", "h").agg(F.min("text").alias("text"))
    counts = chosen.select("text", "lang").mapInArrow(_counts, "lang string, level int, hash bigint, n bigint").groupBy("lang", "level", "hash").agg(F.sum("n").alias("n"))
    got = counts.toArrow()
    coded = got["lang"].combine_chunks().dictionary_encode()
    names = sorted(coded.dictionary.to_pylist())
    lang_at = np.array([names.index(x) for x in coded.dictionary.to_pylist()], np.int64)[coded.indices.to_numpy()]
    level, h, n = got["level"].to_numpy(), got["hash"].to_numpy().view(np.uint64), got["n"].to_numpy()
    model = Model(names, [], [], [], [], np.zeros((LONGEST + 1, len(names))))
    for k in range(LONGEST + 1):
        mine = np.flatnonzero(level == k)
        mine = mine[np.lexsort((lang_at[mine], h[mine]))]
        every, first = np.unique(h[mine], return_index=True)
        floor = np.bincount(lang_at[mine], n[mine], len(names)) + 0.5 * (len(every) + 1)
        model.keys.append(every)
        model.bounds.append(np.append(first, len(mine)))
        model.langs.append(lang_at[mine].astype(np.int32))
        model.gains.append(np.log((n[mine] + 0.5) / 0.5).astype(np.float32))
        model.unseen[k] = np.log(0.5 / floor)
    return model


def predict_column(model: Model, text: Column | str) -> Column:
    """struct<lang, score>; ``und`` and 0 for null, for a text without letters, or for a model without languages.

    Of languages with equal sums the first by name is taken.  The score is the language's share of the evidence, that of at most 20 words, in 0 to 1.
    """

    @F.arrow_udf("struct<lang:string,score:double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            langs, scores = [], []
            for _, group in _text_groups(texts):
                r = runs(group)
                words = np.bincount(r.doc, minlength=len(group))
                if model.names:
                    sums = model.score_texts(r, len(group))
                    best = sums.argmax(1)
                    scaled = sums * (np.minimum(words, 20) / np.maximum(words, 1))[:, None]
                    share = 1 / np.exp(np.clip(scaled - scaled.max(1, keepdims=True), -700, 0)).sum(1)
                for k in range(len(group)):
                    known = bool(words[k]) and bool(model.names)
                    langs.append(model.names[best[k]] if known else UNKNOWN)
                    scores.append(float(share[k]) if known else 0.0)
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return predict(text)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; a null id is in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def identify(docs: DataFrame, folds: int = 3, fold: int = 1, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row; learns only from rows that aren't held out (and have an id).

    Repeated rows and null ids stay, equal texts get equal results; an empty table gives no rows; other columns aren't
    read, whatever their names.  Texts of any length are read whole, in time in proportion to it.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    model = train(rows.filter(~held_out(F.col("doc_id"), folds, fold) & F.col("doc_id").isNotNull()))
    out = rows.select("doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), predict_column(model, F.col("text")).alias("p"))
    return out.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score")
