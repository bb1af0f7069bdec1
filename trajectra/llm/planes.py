"""Token-id files of bit- or byte-plane shuffled, zstandard-compressed blocks with a chunk index.

File layout, integers little-endian::

    magic "TJPL", u16 version, u8 planes (8 * 4 bit planes or 4 byte planes), u8 zero, u32 ids in a block
    blocks: each plane of each block as a zstandard frame
    index: u32 ids and u64 offset of each block, then u32 sizes of all frames   (zstandard frame)
    documents: i64 doc ids, u8 null flags, u64 tokens of each document             (zstandard frame)
    u64 offset of the index, u64 offset of the documents, u64 documents, u64 ids, magic "TJPL"

A block holds a fixed number of ids, only the last has fewer, so a range of ids is
found by division and read without the rest of the file.
"""

from __future__ import annotations

import struct
from array import array
from collections.abc import Iterator

import numpy as np
import zstandard

MAGIC, VERSION = b"TJPL", 1
BLOCK_IDS = 1 << 16
_HEAD, _FOOT = struct.Struct("<4sHBBI"), struct.Struct("<QQQQ4s")


def to_planes(ids: np.ndarray, planes: int) -> list[bytes]:
    """Byte planes (4) or bit planes (32) of unsigned 32-bit ids."""
    by_byte = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    if planes == 4:
        return [row.tobytes() for row in by_byte]
    return [np.packbits((row >> k) & 1).tobytes() for row in by_byte for k in range(8)]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    rows = [np.frombuffer(p, np.uint8) for p in planes]
    if len(rows) == 32:
        rows = [sum((np.unpackbits(rows[8 * b + k], count=n) << k) for k in range(8)).astype(np.uint8) for b in range(4)]
    return np.ascontiguousarray(np.stack(rows, 1)).view("<u4").reshape(-1)


class Writer:
    """Appends documents to an open binary file; only one block of ids is held."""

    def __init__(self, out, planes: int = 4, block_ids: int = BLOCK_IDS, level: int = 3):
        if planes not in (4, 32):
            raise ValueError("planes must be 4 (bytes) or 32 (bits)")
        self.out, self.planes, self.block_ids = out, planes, block_ids
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.at, self.n_ids = 0, 0
        self.blocks: list[tuple[int, int]] = []
        self.frames: list[int] = []
        self.docs, self.nulls, self.tokens = array("q"), bytearray(), array("Q")
        self.waiting: list[bytes] = []
        self.n_waiting = 0
        self._write(_HEAD.pack(MAGIC, VERSION, planes, 0, block_ids))

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, doc_id: int | None, packed: bytes) -> None:
        """A document's ids as little-endian unsigned 32-bit integers."""
        n = len(packed) // 4
        self.docs.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.tokens.append(n)
        self.waiting.append(packed)
        self.n_waiting += n
        self.n_ids += n
        if self.n_waiting >= self.block_ids:
            data, step = b"".join(self.waiting), 4 * self.block_ids
            whole = len(data) // step * step
            for k in range(0, whole, step):
                self._block(data[k : k + step])
            self.waiting, self.n_waiting = [data[whole:]], (len(data) - whole) // 4

    def _block(self, data: bytes) -> None:
        self.blocks.append((len(data) // 4, self.at))
        for plane in to_planes(np.frombuffer(data, "<u4"), self.planes):
            frame = self.zstd.compress(plane)
            self.frames.append(len(frame))
            self._write(frame)

    def close(self) -> None:
        if self.n_waiting:
            self._block(b"".join(self.waiting))
        index_at = self.at
        ns, offsets = (np.array([b[k] for b in self.blocks], t) for k, t in ((0, "<u4"), (1, "<u8")))
        self._write(self.zstd.compress(ns.tobytes() + offsets.tobytes() + np.array(self.frames, "<u4").tobytes()))
        docs_at = self.at
        self._write(self.zstd.compress(np.array(self.docs, "<i8").tobytes() + bytes(self.nulls) + np.array(self.tokens, "<u8").tobytes()))
        self._write(_FOOT.pack(index_at, docs_at, len(self.docs), self.n_ids, MAGIC))


class Reader:
    """Reads a seekable binary file; holds the index and one block."""

    def __init__(self, source, size: int):
        self.source, self.zstd = source, zstandard.ZstdDecompressor()
        magic, version, self.planes, _, self.block_ids = _HEAD.unpack(self._at(0, _HEAD.size))
        index_at, docs_at, self.n_docs, self.n_ids, end = _FOOT.unpack(self._at(size - _FOOT.size, _FOOT.size))
        if magic != MAGIC or end != MAGIC or version != VERSION:
            raise ValueError("no complete token-id file")
        index = self.zstd.decompress(self._at(index_at, docs_at - index_at))
        n = -(-self.n_ids // self.block_ids)
        self.ns, self.offsets = np.frombuffer(index, "<u4", n), np.frombuffer(index, "<u8", n, 4 * n)
        self.frames = np.frombuffer(index, "<u4", n * self.planes, 12 * n).reshape(n, self.planes)
        docs = self.zstd.decompress(self._at(docs_at, size - _FOOT.size - docs_at))
        k = self.n_docs
        self.doc_ids, self.nulls, self.tokens = np.frombuffer(docs, "<i8", k), np.frombuffer(docs, np.uint8, k, 8 * k), np.frombuffer(docs, "<u8", k, 9 * k).astype(np.int64)

    def _at(self, offset: int, n: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(n)

    def block(self, k: int) -> np.ndarray:
        sizes = self.frames[k]
        data, ends = self._at(int(self.offsets[k]), int(sizes.sum())), np.cumsum(sizes)
        return from_planes([self.zstd.decompress(data[e - s : e]) for s, e in zip(sizes.tolist(), ends.tolist())], int(self.ns[k]))

    def ids(self, start: int, n: int) -> np.ndarray:
        """Any range of the file's ids, from the blocks that hold it."""
        if n <= 0:
            return np.zeros(0, np.uint32)
        first, last = start // self.block_ids, (start + n - 1) // self.block_ids
        return np.concatenate([self.block(k) for k in range(first, last + 1)])[start - first * self.block_ids :][:n]

    def documents(self) -> Iterator[tuple[int | None, int, list[np.ndarray]]]:
        """doc id, start within the file and the parts of the ids, block by block, in file order."""
        at, k, block = 0, -1, np.zeros(0, np.uint32)
        for doc, null, n in zip(self.doc_ids.tolist(), self.nulls.tolist(), self.tokens.tolist()):
            parts, left, pos = [], n, at
            while left:
                if pos // self.block_ids != k:
                    k = pos // self.block_ids
                    block = self.block(k)
                i = pos - k * self.block_ids
                parts.append(block[i : i + left])
                left -= len(parts[-1])
                pos += len(parts[-1])
            yield (None if null else doc), at, parts
            at += n
