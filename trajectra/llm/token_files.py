"""Writes documents as token-id files in ascending doc_id order, and reads such files back as rows."""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trajectra.llm import planes, textscan
from trajectra.llm.shared import cut, shared_dir

CACHE_WORDS = 500_000
#: Texts of these characters only (Latin, no combining marks, no unusual white space): a piece is tokenized alike
#: alone and in the text, as none of its characters composes with a neighbour or has a lower case that depends on it.
_PLAIN = re.compile(rf"[\t\n\r\x20-\x7e\xa1-\xac\xae-{chr(0x12F)}{chr(0x131)}-{chr(0x148)}{chr(0x14A)}-{chr(0x17F)}]*")
_LETTERS = rf"a-z\xaa\xb5\xba\xdf-\xf6\xf8-{chr(0x17F)}"
_NUMBERS = r"0-9\xb2\xb3\xb9\xbc-\xbe"
#: The vocabulary's own pattern (a fixed value) over lower-cased plain texts.
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\s{_LETTERS}{_NUMBERS}]+")


class WordCoder:
    """The tokenizers library's ids, with the pieces of plain texts from a bounded cache."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(1 + max(vocab.values()), bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.cache: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, pieces: list[str]) -> None:
        """Encode new pieces together; the last token of each is marked as a word's end."""
        for i in range(0, len(pieces), 2_000):
            part = pieces[i : i + 2_000]
            ids = np.array(self.tok.encode(" ".join(part), add_special_tokens=False).ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(part):
                data, at = ids.tobytes(), [0, *(4 * ends).tolist()]
                self.cache.update((w, data[a:b]) for w, a, b in zip(part, at, at[1:]))
            else:
                self.cache.update((w, self._whole(w)) for w in part)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text; a call's texts share one batch of new pieces."""
        split = [_PIECES.findall(t.lower()) if _PLAIN.fullmatch(t) and not any(s in t for s in self.special) else None for t in texts]
        seen = set().union(*filter(None, split))
        new = seen.difference(self.cache)
        if len(self.cache) + len(new) > CACHE_WORDS:
            self.cache.clear()
            new = seen
        self._learn(list(new))
        get = self.cache.__getitem__
        return [self._whole(t) if ps is None else b"".join(map(get, ps)) for t, ps in zip(texts, split)]


_coders: dict[str, WordCoder] = {}


def coder(path: str) -> WordCoder:
    if path not in _coders:
        _coders[path] = WordCoder(path)
    return _coders[path]


def write_token_files(docs: DataFrame, vocabulary: str, folder: str, end_id: int | None = 1, plane_count: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokenize, order by doc_id over all files, and write one file for each range of ids.

    A null text is an empty one; null ids come first; rows of equal id are ordered by their texts' hashes, over several files
    if they are many, and repeated rows are all written.  An empty table gives no files; other columns aren't read.  An executor's loss only repeats its
    files: a file appears under its name by a rename when complete, with the same
    content each time.  Returns the manifest: part, path, n_docs, n_ids, start.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        path, half = f"{root}/part-{part:06d}.tjp", f"{root}/_part-{part:06d}-{attempt}"
        end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        with store.open_output_stream(half) as out:
            w, c = planes.Writer(out, plane_count), coder(vocabulary)
            for batch in batches:
                ids, texts = batch.column(0), batch.column(1)
                size = 0
                held: list[tuple[int | None, str]] = []
                for i in range(len(ids)):
                    value = texts[i].as_py() or ""
                    held.append((ids[i].as_py(), value))
                    size += len(value)
                    if size > textscan.GROUP_BYTES or i == len(ids) - 1:
                        for (d, _), packed in zip(held, c.encode([t for _, t in held])):
                            w.add(d, packed + end)
                        held, size = [], 0
            w.close()
        if w.docs:
            if store.get_file_info(path).type != fs.FileType.NotFound:
                store.delete_file(path)
            store.move(half, path)
            yield pa.RecordBatch.from_pydict({"part": [part], "path": [path], "n_docs": [len(w.docs)], "n_ids": [w.n_ids]}, pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))
        else:
            store.delete_file(half)

    order = (F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    ordered = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).repartitionByRange(*order).sortWithinPartitions(*order)
    files = cut(ordered.mapInArrow(write, "part int, path string, n_docs bigint, n_ids bigint"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("bigint")))


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of every document in the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_input_file(path) as source:
                    rows: list[tuple] = []
                    for doc, start, parts in planes.Reader(source, source.size()).documents():
                        crc = 0
                        for p in parts:
                            crc = zlib.crc32(np.ascontiguousarray(p), crc)
                        rows.append((doc, base + start, sum(map(len, parts)), crc))
                        if len(rows) == 10_000:
                            yield _rows(rows)
                            rows = []
                    yield _rows(rows)

    # a task for each file: a number given explicitly isn't coalesced, however short the manifest's rows are
    files = max(1, min(manifest.count(), 100_000))
    return manifest.select("path", "start").repartition(files, "path").mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(4)], ["doc_id", "start", "n_tokens", "ids_crc32"])


def token_file_digest(spark: SparkSession, docs: DataFrame, vocabulary: str, end_id: int = 1) -> DataFrame:
    """Write all documents to a new folder of the shared directory, read the files back, and remove them."""
    folder = f"{shared_dir(spark)}/token-files-{uuid.uuid4().hex}"
    folder = folder if "://" in folder else f"file://{folder}" if folder.startswith("/") else folder.replace("file:/", "file:///", 1)
    found = cut(read_token_files(write_token_files(docs, vocabulary, folder, end_id), folder))
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return found
