"""Token ids in files of independent zstandard frames.

A file holds the ids of consecutive documents, cut into frames of at most
``FRAME_IDS`` ids, each a zstandard frame of its own; one more frame holds the
index (document ids and lengths). The file ends with a seek table in a
skippable frame: compressed size, plain size and checksum (low 32 bits of the
XXH64 of the plain bytes) of every frame, their number, a flag byte and a magic
number. Any zstandard tool unpacks the file; ``read_documents`` unpacks only
the index and the frames that hold the wanted documents.

Writing sorts the documents into ranges of doc_id, one task per range, which
writes its files one after the other, each first under a name of its own
attempt and then moved to its final name: a repeated task replaces equal bytes.
The driver sees one row per file. Files lie in the shared folder.

Defined cases: a null text is empty and has the end id alone; documents with
equal ids are ordered by text; a null id comes first and stays null; an empty
table writes no file and gives no row.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch
from .tokens import encoder

FRAME_IDS = 65_536
FILE_IDS = 16_000_000
KNOWN_PIECES = 1_200_000  # of text, with their ids, kept by a worker
# Fixed values of the seekable zstandard format.
SKIPPABLE, SEEK_MAGIC, CHECKSUM_FLAG = 0x184D2A5E, 0x8F92EAB1, 0x80
FOOTER = 9


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


class FrameWriter:
    """Writes one file; ``add`` takes the ids of one document."""

    def __init__(self, uri: str):
        self.fs, self.path = filesystem(uri)
        self.temp = f"{self.path}.{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.temp, compression=None)
        self.zstd = zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.seek: list[tuple[int, int, int]] = []
        self.ids, self.rest = 0, bytearray()
        self.docs, self.known, self.lengths = array("q"), bytearray(), array("q")

    def _frame(self, plain: bytes) -> None:
        packed = self.zstd.compress(plain)
        self.out.write(packed)
        self.seek.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append(doc_id or 0)
        self.known.append(doc_id is not None)
        self.lengths.append(len(ids) // 4)
        self.ids += len(ids) // 4
        self.rest += ids
        while len(self.rest) >= 4 * FRAME_IDS:
            self._frame(bytes(self.rest[:4 * FRAME_IDS]))
            del self.rest[:4 * FRAME_IDS]

    def close(self) -> tuple[int, int]:
        """Documents and ids written."""
        if self.rest:
            self._frame(bytes(self.rest))
        self._frame(self.docs.tobytes() + self.lengths.tobytes() + bytes(self.known))
        table = b"".join(struct.pack("<III", *s) for s in self.seek)
        table += struct.pack("<IBI", len(self.seek), CHECKSUM_FLAG, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()
        self.fs.move(self.temp, self.path)
        return len(self.docs), self.ids


class FrameReader:
    """Reads one file by frames; raises ValueError where it is damaged."""

    def __init__(self, uri: str):
        fs, path = filesystem(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        if size < FOOTER + 8:
            raise ValueError(f"{uri}: too short")
        self.file.seek(size - FOOTER)
        n, flags, magic = struct.unpack("<IBI", self.file.read(FOOTER))
        if magic != SEEK_MAGIC or flags != CHECKSUM_FLAG or size < 8 + 12 * n + FOOTER:
            raise ValueError(f"{uri}: no seek table")
        self.file.seek(size - FOOTER - 12 * n - 8)
        head = struct.unpack("<II", self.file.read(8))
        table = np.frombuffer(self.file.read(12 * n), "<u4").reshape(n, 3)
        self.at = np.concatenate([[0], np.cumsum(table[:, 0], dtype=np.int64)])
        if head != (SKIPPABLE, 12 * n + FOOTER) or self.at[-1] != size - FOOTER - 12 * n - 8 or not n:
            raise ValueError(f"{uri}: seek table does not fit the file")
        self.table, self.uri, self.zstd = table, uri, zstandard.ZstdDecompressor()
        index = self._frame(n - 1)
        k = len(index) // 17
        self.doc_ids = np.frombuffer(index, "<i8", k)
        self.lengths = np.frombuffer(index, "<i8", k, 8 * k)
        self.known = np.frombuffer(index, np.bool_, k, 16 * k)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        if len(index) != 17 * k or self.starts[-1] * 4 != table[:-1, 1].sum(dtype=np.int64):
            raise ValueError(f"{uri}: index does not fit the ids")

    def _frame(self, i: int) -> bytes:
        self.file.seek(int(self.at[i]))
        plain = self.zstd.decompress(self.file.read(int(self.table[i, 0])), max_output_size=int(self.table[i, 1]))
        if len(plain) != self.table[i, 1] or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self.table[i, 2]:
            raise ValueError(f"{self.uri}: frame {i} is damaged")
        return plain

    def documents(self, wanted: list[int] | None = None) -> Iterator[tuple[int, bytes]]:
        """``(place in the file, ids)`` of the documents at the ascending places
        ``wanted`` (None: all); unpacks each frame that holds them once."""
        last, plain = -1, b""
        for k in range(len(self.lengths)) if wanted is None else wanted:
            a, b, parts = int(self.starts[k]), int(self.starts[k + 1]), []
            while a < b:
                i, off = divmod(a, FRAME_IDS)
                if i != last:
                    last, plain = i, self._frame(i)
                parts.append(plain[4 * off:4 * (off + b - a)])
                a += len(parts[-1]) // 4
            yield k, b"".join(parts)


def write_documents(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
                    text_col: str = "text", file_ids: int = FILE_IDS) -> DataFrame:
    """Writes the files into ``folder`` when the result is computed: one row
    ``(part, file, uri, n_docs, n_ids)`` per file, in order of (part, file)."""
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all, part = encoder(tokenizer_path, KNOWN_PIECES).encode_all, TaskContext.get().partitionId()
        rows, out = [], None
        fs, path = filesystem(folder)

        def finish() -> None:
            rows.append((part, len(rows), uri, *out.close()))

        for batch in batches:
            texts = (text.as_py() or "" for text in batch.column(1))
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode_all(texts)):
                if out is None:
                    fs.create_dir(path, recursive=True)
                    uri = f"{folder}/{part:06d}-{len(rows):06d}.ids.zst"
                    out = FrameWriter(uri)
                out.add(doc_id, ids + end)
                if out.ids >= file_ids:
                    finish()
                    out = None
        if out is not None:
            finish()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)],
                                             names=["part", "file", "uri", "n_docs", "n_ids"])

    n = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("doc_id"), F.col("text")]
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .repartitionByRange(n, "doc_id").sortWithinPartitions(*order)
            .mapInArrow(run, "part long, file long, uri string, n_docs long, n_ids long"))


def read_documents(spark: SparkSession, uris: list[tuple[str, int]], wanted: list[int] | None = None,
                   digest: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of the documents in the files ``(uri,
    ids of all documents before the file)``; ``wanted`` doc_ids only, if given.
    ``digest``: ``ids_crc32`` in place of the ids."""
    ids = None if wanted is None else np.array(sorted(wanted), np.int64)
    last = pa.field("ids_crc32", pa.int64()) if digest else pa.field("ids", pa.binary())
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), last])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                file = FrameReader(uri)
                places = None if ids is None else np.flatnonzero(np.isin(file.doc_ids, ids) & file.known).tolist()
                rows, held = [], 0
                for k, own in file.documents(places):
                    rows.append((int(file.doc_ids[k]) if file.known[k] else None, before + int(file.starts[k]),
                                 int(file.lengths[k]), zlib.crc32(own) if digest else own))
                    held += 100 if digest else len(own)
                    if held > 8_000_000:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.createDataFrame(uris, "uri string, before long").repartition(max(1, len(uris)), "uri")
    return files.mapInArrow(run, f"doc_id long, start long, n_tokens long, {'ids_crc32 long' if digest else 'ids binary'}")


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int, file_ids: int = FILE_IDS) -> list[tuple[str, int]]:
    """Writes all documents and returns ``(uri, ids before the file)`` of every
    file in order: one entry per ``file_ids`` ids or range of doc_ids."""
    scratch = Scratch(docs.sparkSession, "token-files")
    files = scratch.save(write_documents(docs, f"{scratch.path}/ids", tokenizer_path, end_id, file_ids=file_ids), "files")
    before, found = 0, []
    for r in files.orderBy("part", "file").collect():
        found.append((r["uri"], before))
        before += r["n_ids"]
    return found

