"""Byte-level BPE as a bounded-lookahead streaming transducer, and its inverse.

Lookahead.  Let a prefix ``w`` be tokenized once alone and once with any
continuation, merges applied by rank.  At every rank both runs have the same
tokens left of some position ``p`` that is a token edge in both; at first
``p = |w|``.  ``p`` moves left only when a merge ``(u, v)`` joins the last common
token ``u`` to something beyond ``p``; after that the text beyond the new ``p``
starts with ``u``.  So a chain of merges of rising rank in which each right part
starts with the left part before it bounds the move, and the longest such chain,
weighed by the lengths of the left parts, is the merge list's sufficient
lookahead (:func:`sufficient_lookahead`).  Token edges that lie at least that many
bytes before the end of what was read are final: tokens before them are emitted
and their bytes forgotten.  No merge crosses a final edge, so the rest is
tokenized as if it began there.  The proof needs that a merge's parts are single bytes or made by
merges of lower rank, which is checked when a vocabulary is loaded.

Beside the text itself, memory is bounded for texts of any length and kind: a window of characters, or in
runs without white space single pieces, a long one passed to the transducer in chunks; a buffer of
a few lookaheads and a cache of a fixed number of entries.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import regex

#: White space of the pre-tokenizer's pattern (Unicode White_Space).
_WS = r"\t-\r \x85\xa0" + "".join(map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: Fixed value: the public pattern that splits text before the merges.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Runs between white space, each with one space before it: unions of whole pieces.
UNITS = re.compile(rf" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
_SPACE_RUN = re.compile(rf"[{_WS}]+")
_IS_SPACE = re.compile(rf"[{_WS}]")

WINDOW_CHARS, CHUNK_CHARS = 1 << 16, 1 << 12
CACHE_ENTRIES = 100_000
CACHED_UNIT = 256


def byte_alphabet() -> dict[str, int]:
    """Character of the vocabulary file to byte: printable Latin-1 stands for itself, the rest for 256 and up."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def sufficient_lookahead(merges: Iterable[tuple[bytes, bytes]]) -> int:
    """Bytes that must follow a token edge before it is final; merges in rank order."""
    best: dict[bytes, int] = {}
    most = 0
    for u, v in merges:
        reach = len(u) + max((best.get(v[:i], 0) for i in range(1, len(v) + 1)), default=0)
        most = max(most, reach)
        best[u] = max(best.get(u, 0), reach)
    return most


def check_order(merges: Iterable[tuple[bytes, bytes]]) -> None:
    """Raise unless every merge's parts are single bytes or made by merges before it."""
    made: set[bytes] = set()
    for u, v in merges:
        for part in (u, v):
            if len(part) != 1 and part not in made:
                raise ValueError(f"the merge of {u!r} and {v!r} comes before one that makes {part!r}")
        made.add(u + v)


class Generations(dict):
    """A cache that forgets: when full it becomes the old generation, from which used entries come back."""

    def __init__(self, make, limit: int = CACHE_ENTRIES):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= CACHED_UNIT:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class ByteBPE:
    """Encoder and decoder for one vocabulary file in the tokenizers library's JSON form."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = byte_alphabet()
        raw = lambda s: bytes(to_byte[c] for c in s)
        vocab = {raw(t): i for t, i in spec["model"]["vocab"].items() if all(c in to_byte for c in t)}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = 1 + max([*vocab.values(), *self.added.values()])
        self.bytes_of: list[bytes] = [b""] * size
        for t, i in vocab.items():
            self.bytes_of[i] = t
        for t, i in self.added.items():
            self.bytes_of[i] = t.encode()
        self.byte_len = np.array([len(b) for b in self.bytes_of], np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        merges = [(raw(a), raw(b)) for a, b in pairs]
        check_order(merges)
        self.start = [vocab[bytes([b])] for b in range(256)]
        self.size = size
        #: (left id * size + right id) to rank * size + id of the union
        self.merge = {vocab[a] * size + vocab[b]: r * size + vocab[a + b] for r, (a, b) in enumerate(merges)}
        self.lookahead = sufficient_lookahead(merges)
        self._split_added = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self._pieces: Generations = Generations(self._piece)
        self._units: Generations = Generations(self._unit)

    # ---- encoding

    def merge_ids(self, data: bytes) -> list[int]:
        """All merges of one buffer, lowest rank first and leftmost among equals."""
        ids = [self.start[b] for b in data]
        if len(ids) > 64:
            return self._merge_long(ids)
        size, find, never = self.size, self.merge.get, 1 << 62
        ranks = [find(a * size + b, never) for a, b in zip(ids, ids[1:])]
        while ranks:
            low = min(ranks)
            if low == never:
                break
            i = ranks.index(low)
            ids[i : i + 2] = [low % size]
            del ranks[i]
            if i:
                ranks[i - 1] = find(ids[i - 1] * size + ids[i], never)
            if i < len(ranks):
                ranks[i] = find(ids[i] * size + ids[i + 1], never)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap and linked neighbours, for long buffers."""
        import heapq

        size, find, n = self.size, self.merge.get, len(ids)
        right, left = [*range(1, n + 1)], [*range(-1, n - 1)]
        heap = [(m // size, i, m % size, ids[i], ids[i + 1]) for i in range(n - 1) if (m := find(ids[i] * size + ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, new, a, b = heapq.heappop(heap)
            j = right[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = new, -1
            right[i] = k = right[j]
            if k < n:
                left[k] = i
                if (m := find(new * size + ids[k])) is not None:
                    heapq.heappush(heap, (m // size, i, m % size, new, ids[k]))
            if (h := left[i]) >= 0 and (m := find(ids[h] * size + new)) is not None:
                heapq.heappush(heap, (m // size, h, m % size, ids[h], new))
        return [t for t in ids if t >= 0]

    def transduce(self, chunks: Iterable[bytes]) -> Iterator[bytes]:
        """One piece that comes in chunks: packed ids as soon as they are final."""
        buffer = b""
        limit = max(4 * self.lookahead, 1024)
        for chunk in chunks:
            buffer += chunk
            at = 0
            while len(buffer) - at >= limit:
                ids = self.merge_ids(buffer[at : at + limit])
                ends = np.cumsum(self.byte_len[ids])
                n = int(np.searchsorted(ends, limit - self.lookahead, "right"))
                yield array("I", ids[:n]).tobytes()
                at += int(ends[n - 1]) if n else 0
            buffer = buffer[at:]
        if buffer:
            yield array("I", self.merge_ids(buffer)).tobytes()

    def _piece(self, piece: str) -> bytes:
        data = piece.encode()
        if len(data) <= 512:
            return array("I", self.merge_ids(data)).tobytes()
        return b"".join(self.transduce([data]))

    def _unit(self, unit: str) -> bytes:
        return b"".join(map(self._pieces.__getitem__, PIECES.findall(unit)))

    def _windows(self, text: str, i: int, n: int) -> Iterator[tuple[int, int]]:
        """Slices of text[i:n] that end where a piece ends: before white space that follows other characters.

        Where a window has no such place, as in a text without spaces, it goes on to the next one.
        """
        while i < n:
            j = min(i + WINDOW_CHARS, n)
            while j < n and not (_IS_SPACE.match(text, j) and not _IS_SPACE.match(text, j - 1)):
                m = _IS_SPACE.search(text, j + 1, n)
                j = m.start() if m else n
            yield i, j
            i = j

    def _long_window(self, text: str, i: int, j: int) -> Iterator[bytes]:
        """A window of any length, piece by piece; long pieces pass the transducer in chunks."""
        for m in PIECES.finditer(text, i, j):
            a, b = m.span()
            if b - a <= CACHED_UNIT:
                yield self._pieces[text[a:b]]
            else:
                yield from self.transduce(text[k : min(k + CHUNK_CHARS, b)].encode() for k in range(a, b, CHUNK_CHARS))

    def _parts(self, text: str) -> Iterator[tuple[int, int, int | None]]:
        """Start and end of what lies between added tokens, and of these, with their ids."""
        at = 0
        for m in self._split_added.finditer(text) if self._split_added else ():
            yield at, m.start(), None
            yield *m.span(), self.added[m.group()]
            at = m.end()
        yield at, len(text), None

    def encode_packed(self, text: str) -> Iterator[bytes]:
        """Ids of a text as little-endian unsigned 32-bit integers, window by window."""
        for a, b, added in self._parts(text):
            if added is not None:
                yield array("I", [added]).tobytes()
                continue
            for i, j in self._windows(text, a, b):
                if j - i <= 2 * WINDOW_CHARS:
                    yield b"".join(map(self._units.__getitem__, UNITS.findall(text, i, j)))
                else:
                    yield from self._long_window(text, i, j)

    def encode(self, text: str) -> list[int]:
        out = array("I")
        for packed in self.encode_packed(text):
            out.frombytes(packed)
        return out.tolist()

    # ---- decoding

    def decode_stream(self, packed: Iterable[bytes]) -> Iterator[str]:
        """Text of packed ids: an incremental UTF-8 state machine keeps at most three bytes between windows."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        of = self.bytes_of.__getitem__
        for window in packed:
            yield machine.decode(b"".join(map(of, memoryview(window).cast("I"))))
        yield machine.decode(b"", True)

    def decode(self, ids: Iterable[int]) -> str:
        return "".join(self.decode_stream([array("I", ids).tobytes()]))


_loaded: dict[str, ByteBPE] = {}


def load(path: str) -> ByteBPE:
    """One encoder, with its cache, for each worker process."""
    if path not in _loaded:
        _loaded[path] = ByteBPE(path)
    return _loaded[path]


def round_trip(bpe: ByteBPE, text: str | None) -> tuple[int, str, str]:
    """Tokens, SHA-256 of the packed ids and SHA-256 of the decoded text, in one streaming pass; a null text counts as empty."""
    ids_hash, text_hash, n = hashlib.sha256(), hashlib.sha256(), 0

    def tee() -> Iterator[bytes]:
        nonlocal n
        for packed in bpe.encode_packed(text or ""):
            ids_hash.update(packed)
            n += len(packed) // 4
            yield packed

    for part in bpe.decode_stream(tee()):
        text_hash.update(part.encode())
    return n, ids_hash.hexdigest(), text_hash.hexdigest()
