"""Token-id files: independent zstandard frames with a trailing seek table and per-frame checksums.

A file holds the ids of a run of documents in ascending ``doc_id`` order:

    frame*        zstandard frames, each with whole documents' ids (little-endian, 2 or 4 bytes each)
    index frame   zstandard frame: per document its id (i8), whether that is null (u1) and its number of ids (u8)
    seek table    per frame: compressed bytes, plain bytes, crc32 of the plain bytes, documents (u8 each);
                  the last entry is the index frame's
    footer        entries (u8), bytes per id (u8), magic (8 bytes)

A reader takes the footer, the table and the index, and then only the frames of the documents it
wants.  Every frame is checked against its checksum.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..session import materialize, scratch_path
from .tokens import encoder, slices, vocabulary

MAGIC = b"PSIDSEEK"
FRAME_IDS = 1 << 18
END_ID = 0
HEAD_CHARS = 64
_FOOT = np.dtype([("entries", "<u8"), ("width", "<u8"), ("magic", "S8")])
_ENTRY = np.dtype([("packed", "<u8"), ("plain", "<u8"), ("crc", "<u8"), ("docs", "<u8")])
_DOC = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("n", "<u8")])


def _fs(path: str):
    from pyarrow import fs
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


class ShardWriter:
    """Writes one file; it takes its final name when it is complete, so repeated and speculative
    tasks leave one whole file."""

    def __init__(self, path: str, width: int, frame_ids: int = FRAME_IDS, level: int = 3):
        import zstandard
        self.fs, self.path = _fs(path)
        self.fs.create_dir(os.path.dirname(self.path), recursive=True)
        self.temp = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.out = self.fs.open_output_stream(self.temp)
        self.zip = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.width, self.frame_ids = width, frame_ids
        self.table: list[tuple] = []
        self.index: list[tuple] = []
        self.parts: list[bytes] = []
        self.size = self.docs = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """ids: little-endian unsigned 32-bit."""
        self.index.append((doc_id or 0, doc_id is None, len(ids) // 4))
        self.parts.append(ids if self.width == 4 else np.frombuffer(ids, "<u4").astype(f"<u{self.width}").tobytes())
        self.size += len(ids) // 4
        self.docs += 1
        if self.size >= self.frame_ids:
            self._frame()

    def _put(self, plain: bytes, docs: int) -> None:
        packed = self.zip.compress(plain)
        self.out.write(packed)
        self.table.append((len(packed), len(plain), zlib.crc32(plain), docs))

    def _frame(self) -> None:
        if self.docs:
            self._put(b"".join(self.parts), self.docs)
        self.parts, self.size, self.docs = [], 0, 0

    def close(self) -> int:
        """Number of ids in the file."""
        self._frame()
        self._put(np.array(self.index, _DOC).tobytes(), 0)
        self.out.write(np.array(self.table, _ENTRY).tobytes())
        self.out.write(np.array([(len(self.table), self.width, MAGIC)], _FOOT).tobytes())
        self.out.close()
        self.fs.move(self.temp, self.path)
        return sum(n for _, _, n in self.index)


class ShardReader:
    """Random access to one file."""

    def __init__(self, path: str):
        import zstandard
        fs, name = _fs(path)
        self.file = fs.open_input_file(name)
        self.unzip = zstandard.ZstdDecompressor()
        size = self.file.size()
        foot = np.frombuffer(self._bytes(size - _FOOT.itemsize, _FOOT.itemsize), _FOOT)[0]
        if foot["magic"] != MAGIC:
            raise ValueError(f"not a token-id file: {path}")
        self.width, n = int(foot["width"]), int(foot["entries"])
        table_at = size - _FOOT.itemsize - n * _ENTRY.itemsize
        self.table = np.frombuffer(self._bytes(table_at, n * _ENTRY.itemsize), _ENTRY)
        self.at = np.concatenate([[0], np.cumsum(self.table["packed"].astype("i8"))])
        if self.at[-1] != table_at:
            raise ValueError(f"the seek table does not match the file: {path}")
        self.index = np.frombuffer(self.frame(n - 1), _DOC)
        self.first = np.concatenate([[0], np.cumsum(self.table["docs"].astype("i8"))])
        self.start = np.concatenate([[0], np.cumsum(self.index["n"].astype("i8"))])

    def _bytes(self, at: int, n: int) -> bytes:
        self.file.seek(int(at))
        return self.file.read(int(n))

    def frame(self, k: int) -> bytes:
        e = self.table[k]
        plain = self.unzip.decompress(self._bytes(self.at[k], e["packed"]), max_output_size=int(e["plain"]) or 1)
        if len(plain) != e["plain"] or zlib.crc32(plain) != e["crc"]:
            raise ValueError(f"frame {k} is damaged")
        return plain

    def read(self, rows: Iterable[int] | None = None) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, ids before it in the file, ids) of the given rows of the index, all by default;
        only the frames that hold them are read."""
        rows = range(len(self.index)) if rows is None else sorted(rows)
        held, ids = -1, np.empty(0, "<u4")
        for row in rows:
            k = int(np.searchsorted(self.first, row, side="right")) - 1
            if k != held:
                held, ids = k, np.frombuffer(self.frame(k), f"<u{self.width}").astype("<u4")
            base = self.start[self.first[k]]
            lo = int(self.start[row] - base)
            d = self.index[row]
            yield (None if d["null"] else int(d["doc_id"])), int(self.start[row]), ids[lo:lo + int(d["n"])]

    def rows_of(self, doc_id: int) -> range:
        """Rows of the index with this id (ascending in the file, null ids first)."""
        ids = self.index["doc_id"][(nulls := int(self.index["null"].sum())):]
        return range(nulls + int(np.searchsorted(ids, doc_id)), nulls + int(np.searchsorted(ids, doc_id, side="right")))

    def close(self) -> None:
        self.file.close()


def write_token_files(docs: DataFrame, out: str | None = None, *, vocab: str | None = None,
                      lower_words: bool = False, end_id: int = END_ID, width: int | None = None) -> DataFrame:
    """Writes the ids of all documents and returns the stored list of files:
    ``shard, path, first_doc, n_docs, n_tokens``, in ascending order of ``doc_id`` by ``shard``.

    Documents are dealt to files by ranges of their id (null ids first; equal ids by the first
    ``HEAD_CHARS`` characters of the text, then by its hash, so that many rows of one id are many
    tasks) and tokenised in the task that writes the file, so that the texts are the only thing moved.  A null
    or empty text has the end id alone.  An empty table gives no files.
    """
    path = vocab or vocabulary("byte_bpe_50k.json")
    out = out or scratch_path(docs.sparkSession, "token-files")
    if width is None:
        from tokenizers import Tokenizer
        width = 2 if max(Tokenizer.from_file(path).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        import pyarrow as pa
        enc, shard = encoder(path, lower_words), TaskContext.get().partitionId()
        file, writer, first, n = f"{out}/ids-{shard:06d}.zst", None, None, 0
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lo, hi in slices(texts):
                if writer is None:
                    writer, first = ShardWriter(file, width), ids[lo]
                for doc_id, data in zip(ids[lo:hi], enc.encode(texts[lo:hi])):
                    writer.add(doc_id, data + end)
                    n += 1
        if writer is not None:
            row = {"shard": shard, "path": file, "first_doc": first, "n_docs": n, "n_tokens": writer.close()}
            yield pa.RecordBatch.from_pylist([row], pa.schema([("shard", pa.int32()), ("path", pa.string()), (
                "first_doc", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    key = ["doc_id", "_head", "_hash"]
    dealt = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")) \
                .select("*", F.substring("text", 1, HEAD_CHARS).alias("_head"), F.xxhash64("text").alias("_hash")) \
                .repartitionByRange(*key).sortWithinPartitions(*key, "text").select("doc_id", "text")
    return materialize(dealt.mapInArrow(run, "shard int, path string, first_doc bigint, n_docs bigint, n_tokens bigint"),
                       "token-file-list")


def read_token_files(files: DataFrame, *, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids``) of every document, from the files.

    start: ids of all documents before it.  The list of files (one row per task that wrote one) is
    the only thing that passes through the driver.
    """
    spark = files.sparkSession
    rows, base = [], 0
    for r in files.orderBy("shard").collect():
        rows.append((r["path"], base))
        base += r["n_tokens"]
    listed = spark.createDataFrame(rows, "path string, base bigint").repartition(max(1, len(rows)))

    def run(batches):
        import pyarrow as pa
        for b in batches:
            for path, at in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                reader, out = ShardReader(path), []
                for doc_id, start, ids in reader.read():
                    row = {"doc_id": doc_id, "start": at + start, "n_tokens": len(ids), "ids_crc32": zlib.crc32(ids)}
                    out.append(row | {"ids": ids.astype("i4")} if with_ids else row)
                    if len(out) >= (64 if with_ids else 4096):
                        yield pa.RecordBatch.from_pylist(out, schema(pa))
                        out = []
                reader.close()
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema(pa))

    def schema(pa):
        cols = [(c, pa.int64()) for c in ("doc_id", "start", "n_tokens", "ids_crc32")]
        return pa.schema(cols + [("ids", pa.list_(pa.int32()))] * with_ids)

    return listed.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
                             + (", ids array<int>" if with_ids else ""))
