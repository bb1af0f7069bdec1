"""Vectorised word scanning of UTF-8 text.

An Arrow string column is cut into groups of whole documents of about
``GROUP_BYTES`` each (a longer document is a group of its own).  In a group all
words are found and hashed with a handful of numpy passes, so no Python code
runs for each word.  A word's hash is a polynomial over random 64-bit byte values
modulo 2**64, finished with a bijective mixer; equal words have equal hashes
whatever group they lie in.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

GROUP_BYTES = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C55 | 5
_BASE_INV = pow(_BASE, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64) | _U(1)

#: Bytes that are white space for `[^\x20\x09-\x0D]+`.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~SPACE
#: Bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` once A-Z are lower-cased.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
#: A-Z to a-z, all else as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, GROUP_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            step = np.full(size, base, np.uint64)
            step[0] = 1
            _powers[name] = np.cumprod(step, dtype=np.uint64)
    return _powers["up"], _powers["down"]


@dataclass
class Group:
    """Documents ``first`` to ``last`` (exclusive) of a column; ``bounds`` are their byte offsets in ``data``."""

    first: int
    last: int
    data: np.ndarray
    bounds: np.ndarray

    @property
    def n(self) -> int:
        return self.last - self.first


@dataclass
class Words:
    """Words in text order: byte offsets, hash, document (within the group) and words before each document."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    doc: np.ndarray
    first: np.ndarray


def groups(texts: pa.Array, limit: int = GROUP_BYTES) -> Iterator[Group]:
    """Cut a string column into groups; a null counts as an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return
    _, raw_offsets, raw = texts.buffers()
    offsets = np.frombuffer(raw_offsets, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        j = min(j, n)
        yield Group(i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        i = j


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which span_hash() takes the hash of any byte range."""
    up, _ = _power_table(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = _power_table(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def words(g: Group, is_word: np.ndarray, data: np.ndarray | None = None, prefix: np.ndarray | None = None) -> Words:
    """Maximal runs of word bytes that lie in one document."""
    data = g.data if data is None else data
    inside = is_word[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[g.bounds] = True
    before = np.empty(len(data) + 1, bool)
    before[0], before[1:] = False, inside
    after = np.empty(len(data) + 1, bool)
    after[-1], after[:-1] = False, inside
    start = np.flatnonzero(after & (~before | edge))
    end = np.flatnonzero(before & (~after | edge))
    first = np.searchsorted(start, g.bounds[:-1])
    counts = np.diff(np.append(first, len(start)))
    prefix = prefix_hash(data) if prefix is None else prefix
    return Words(start, end, span_hash(prefix, start, end), np.repeat(np.arange(g.n), counts), np.append(first, len(start)))


def windows(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Word positions at which ``size`` words of one document begin, and the hash of these words."""
    n = len(w.hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(w.doc[:n] == w.doc[size - 1 :])
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h = h * _U(0x9E3779B97F4A7C15) + w.hash[k : k + n]
    return at, mix(h[at])


def per_doc(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of a byte-wise array over each document."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[bounds])
