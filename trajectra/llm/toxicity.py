"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding lower-cases, removes invisible characters, maps look-alike letters of other
scripts and full-width forms to Latin, and reads digits and symbols next to letters as
the letters they stand for.  Terms match as whole words; matches inside an
exception phrase don't count.  The sum of the weights is normalised by length and
a logistic curve makes it a score.

A term is a whole word, or a stem with any ending, written ``stem*``.  The lexicon and
the curve are learned from at most ``TRAIN_ROWS`` labelled rows (those of the smallest
hashes).  A term enters with its log odds if it is frequent and significant enough;
copies of one toxic text count once, by a one-value MinHash of its five-word shingles.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajectra.llm.langid import held_out

TRAIN_ROWS, MIN_TEXTS, MIN_LOG_ODDS, MIN_Z = 20_000, 6, 3.0, 3.0
KEY_WORDS = 5
#: Lengths of stems.
STEM = range(4, 11)
#: Words at which the length norm has grown to sqrt(2).
NORM_WORDS = 200
#: Harmless phrases that hold terms which may be in the lexicon.
EXCEPTIONS = ("trash can", "trash bin", "take out the trash", "pond scum", "clown fish", "class clown", "sore loser", "idiot proof", "killer whale", "kill time", "not stupid", "dead end")

_LATIN = "abcdehijklmnopqrstuvwxyz"
_LOOKALIKES = {
    "Cyrillic": ("асеһіјӏорԛѕтухԁԝв", "acehijlopqstyxdwb"),
    "Greek": ("αεικνορτυχβ", "aeiknoptyxb"),
    "other": ("ıɑɡℓⅼⅰⅴⅹ", "iagllivx"),
}
_FOLD = {ord(a): b for odd, plain in _LOOKALIKES.values() for a, b in zip(odd, plain)} | {ord(c): None for c in "­​‌‍⁠﻿"}
_ODD = re.compile("[" + "".join(map(chr, _FOLD)) + "℀-⅏＀-￯\U0001d400-\U0001d7ff]")
_STAND_IN = str.maketrans("013457@$!", "oieastasi")
# possessive, and begun only where a run begins: linear on long runs
_BEFORE_LETTER = re.compile(r"(?<![013457@$!])[013457@$!]++(?=[a-z])")
_AFTER_LETTER = re.compile(r"(?<=[a-z])[013457]++(?![0-9a-z])")
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    low = text.lower()
    if not low.isascii() and _ODD.search(low):
        low = unicodedata.normalize("NFKC", low).lower().translate(_FOLD)
    swap = lambda m: m.group().translate(_STAND_IN)
    return _AFTER_LETTER.sub(swap, _BEFORE_LETTER.sub(swap, low))


@dataclass
class Lexicon:
    """Weights of folded terms, harmless phrases, and the curve: score = 1 / (1 + exp(-(bias + slope * x)))."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    bias: float = -3.0
    slope: float = 1.0
    _automaton: object = field(default=None, repr=False, compare=False)

    def automaton(self):
        if self._automaton is None:
            a = ahocorasick.Automaton()
            for p in self.exceptions:
                a.add_word(fold(p), (len(fold(p)), None, None))
            for t in {t.rstrip("*") for t in self.weights} - set(a.keys()):
                a.add_word(t, (len(t), self.weights.get(t), self.weights.get(t + "*")))
            a.make_automaton()
            self._automaton = a
        return self._automaton

    def __getstate__(self):
        return self.__dict__ | {"_automaton": None}

    def spans(self, folded: str) -> list[tuple[int, int, float]]:
        """Start, end and weight of each term found as a whole word outside exception phrases."""
        if not self.weights:
            return []
        terms, harmless = [], []
        for last, (n, whole, stem) in self.automaton().iter(folded):
            a, b = last - n + 1, last + 1
            if a and folded[a - 1].isalpha():
                continue
            ended = b == len(folded) or not folded[b].isalpha()
            if whole is None and stem is None:
                if ended:
                    harmless.append((a, b))
            elif ended and whole is not None:
                terms.append((a, b, whole))
            elif stem is not None:
                terms.append((a, b, stem))
        if not harmless:
            return terms
        # of the phrases that begin at or before a term, the one that ends last decides
        harmless.sort()
        begins, ends = [x for x, _ in harmless], list(accumulate((y for _, y in harmless), max))
        return [(a, b, w) for a, b, w in terms if not ((k := bisect_right(begins, a)) and b <= ends[k - 1])]

    def strength(self, text: str) -> float:
        """Summed weights over the length norm."""
        found = self.spans(fold(text))
        return sum(w for _, _, w in found) / np.sqrt(1 + len(text.split()) / NORM_WORDS) if found else 0.0

    def score(self, strength: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.slope * strength, -50, 50))))


def _terms(text: str) -> tuple[list[str], set[str]]:
    """A text's words in order, and the different ones with all their stems."""
    words = [w for w in _WORD.findall(fold(text)) if 2 < len(w) < 40]
    return words, {*words} | {w[:n] + "*" for w in {*words} for n in STEM if n <= len(w)}


def _toxic_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """term and text key for each term of each text."""
    for batch in batches:
        terms, keys = [], []
        for text in batch.column(0):
            words, every = _terms(text.as_py() or "")
            if words:
                terms += every
                keys += [min(xxhash.xxh64_intdigest(" ".join(words[i : i + KEY_WORDS])) for i in range(max(1, len(words) - KEY_WORDS + 1))) >> 1] * len(every)
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(keys, pa.int64())], ["term", "key"])


def _count_terms(wanted: frozenset[str]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0):
                counts.update(_terms(text.as_py() or "")[1] & wanted)
        yield pa.RecordBatch.from_arrays([pa.array([*counts], pa.string()), pa.array([*counts.values()], pa.int64())], ["term", "n"])

    return count


def choose(candidates: list[tuple[str, int, int]], n_a: int, n_b: int) -> dict[str, float]:
    """Weights of the chosen of (term, toxic texts, other texts); strongest first, without terms that add little to these."""
    scored = []
    for term, a, b in candidates:
        a, b = a + 0.5, b + 0.5
        odds = float(np.log(a / max(n_a - a + 1, 0.5)) - np.log(b / max(n_b - b + 1, 0.5)))
        z = odds / float(np.sqrt(1 / a + 1 / b))
        if odds >= MIN_LOG_ODDS and z >= MIN_Z:
            scored.append((-a, term.endswith("*"), -len(term), term, odds))
    weights: dict[str, float] = {}
    reach: dict[str, float] = {}
    for minus_a, is_stem, _, term, odds in sorted(scored):
        bare = term.rstrip("*")
        covered = any(bare[:n] + "*" in weights for n in STEM if n <= len(bare))
        if not covered and not (is_stem and reach.get(bare, 0) >= 0.9 * -minus_a):
            weights[term] = odds
            for n in STEM:
                reach[bare[:n]] = max(reach.get(bare[:n], 0), -minus_a)
    return weights


def fit_curve(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Bias and slope of a logistic regression with a small ridge, by Newton steps."""
    a = np.column_stack([np.ones_like(x), x])
    b = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -50, 50)))
        grad = a.T @ (p - y) + 1e-2 * b
        hess = (a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        b -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(b[0]), float(b[1])


def train(labelled: DataFrame, seed: dict[str, float] | None = None) -> Lexicon:
    """A lexicon from rows (text, toxic 0/1), at most TRAIN_ROWS of them.  ``seed`` terms are always in it."""
    fields = labelled.select(F.col("text"), F.col("toxic").cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in fields.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_a, n_b = sizes.get(1, 0), sizes.get(0, 0)
    weights = dict(seed or {})
    if n_a and n_b:
        seen = fields.filter("toxic = 1").select("text").mapInArrow(_toxic_terms, "term string, key bigint").groupBy("term", "key").agg(F.lit(1).alias("one"))
        found = {r["term"]: r["n"] for r in seen.groupBy("term").agg(F.count("*").alias("n")).filter(F.col("n") >= MIN_TEXTS).collect()}
        other = fields.filter("toxic = 0").select("text").mapInArrow(_count_terms(frozenset(found)), "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
        clean = {r["term"]: r["n"] for r in other.collect()}
        weights = choose([(t, n, clean.get(t, 0)) for t, n in found.items()], n_a, n_b) | weights
    lexicon = Lexicon(weights)
    rate = (n_a + 0.5) / (n_a + n_b + 1)
    lexicon.bias = float(np.log(rate / (1 - rate))) if n_a + n_b else -3.0
    if weights and n_a and n_b:
        got = fields.select("toxic", strength_column(lexicon, F.col("text")).alias("x")).toArrow()
        lexicon.bias, lexicon.slope = fit_curve(got["x"].to_numpy(), got["toxic"].to_numpy().astype(float))
    return lexicon


def strength_column(lexicon: Lexicon, text: Column | str) -> Column:
    @F.arrow_udf("double")
    def strength(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([float(lexicon.strength(t.as_py() or "")) for t in texts], pa.float64())

    return strength(text)


def training_rows(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0) -> DataFrame:
    """text and toxic of at most TRAIN_ROWS labelled documents that aren't held out.

    A document's label is its largest non-null one; of several rows with one doc_id the least non-null text counts.
    """
    usable = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out(F.col("doc_id"), folds, fold))
    chosen = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").filter("text IS NOT NULL")
    return found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("text", "toxic")


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, cut=lambda df: df) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs.

    A null or empty text has the score of a text without terms.  Without labels of
    both classes nothing matches and every score is the share of toxic labels (or
    low, without labels).  Repeated rows and null ids stay, with equal scores for equal texts; an empty table gives
    no rows; other columns of docs and labels are not read, whatever their names.  Folding and matching take time
    in proportion to a text's length.  ``cut`` may save the labelled rows, which are used twice.
    """
    lexicon = train(cut(training_rows(docs, labels, folds, fold)))
    rows = docs.select(F.col("doc_id"), held_out(F.col("doc_id"), folds, fold).alias("held_out"), strength_column(lexicon, F.col("text")).alias("x"))
    score = 1 / (1 + F.exp(-(F.lit(lexicon.bias) + F.lit(lexicon.slope) * F.col("x"))))
    return rows.select("doc_id", "held_out", score.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
