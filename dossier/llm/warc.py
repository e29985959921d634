"""WARC archives as Zstandard files with a dictionary.

Layout of a file (.warc.zst): a leading skippable frame that holds the
dictionary, then one Zstandard frame per record, each with its content size
and checksum, compressed with that dictionary. Records are WARC/1.1: a
``response`` holds HTTP headers and the payload; a ``revisit`` (profile:
identical payload digest) the HTTP headers alone and the id of the response.

The reader takes the dictionary from the leading frame, unpacks one frame at a
time, and raises ValueError where a frame, a header, a length or a digest does
not hold.

The dictionary is trained on a bounded sample: the beginnings (``SAMPLE_CHARS``
characters) of the ``SAMPLE_PAGES`` pages with the smallest hash of their url.
It only affects size. Payloads are found equal by SHA-1 and length; groups are
summed before the shuffle and joined to (page_id, digest) and html once, where
Spark splits hot digests. A task writes its files one after the other in the
shared folder, first under a name of its attempt.

Defined cases: null html is empty; a null url is written as ``about:blank``; a
null page_id is a record of its own without id and counts as smallest; rows
that repeat page_id and payload are equal payloads: all with the largest id are
responses; an empty table writes no file and gives no row.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import urllib.parse
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch
from .token_files import filesystem

MIN_REVISIT_BYTES = 1000
SAMPLE_PAGES, SAMPLE_CHARS, DICT_BYTES = 256, 16_384, 65_536
FILE_BYTES = 256_000_000
# Fixed values of the formats.
DICT_FRAME, ZSTD_MAGIC = 0x184D2A5D, 0xFD2FB528
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"
RECORD_SCHEMA = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, "
                 "payload_digest string, payload binary")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; ``digest``: hex SHA-1 of the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    kind = "response" if refers_to is None else "revisit"
    head = ["WARC/1.1", f"WARC-Type: {kind}",
            f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>",
            f"WARC-Target-URI: {urllib.parse.quote(url or 'about:blank', safe=':/?#[]@!$&()*+,;=%~' + chr(39))}",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
            f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}",
            "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(text: bytes) -> tuple[str, dict[str, str]]:
    first, *rest = text.decode().split("\r\n")
    out = {}
    for line in rest:
        k, colon, v = line.partition(":")
        if not colon or not re.fullmatch(r"[A-Za-z0-9-]+", k):
            raise ValueError(f"bad header line {line[:80]!r}")
        out[k.lower()] = v.strip()
    return first, out


def parse(data: bytes) -> tuple:
    """The row (``RECORD_SCHEMA``) of one whole record."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    version, h = _headers(head)
    need = {"warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest", "warc-block-digest"}
    if not gap or version != "WARC/1.1" or not need <= h.keys() or not h["content-length"].isdecimal():
        raise ValueError("not a complete WARC record")
    size = int(h["content-length"])
    block = rest[:size]
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError("record length does not hold")
    sha1 = lambda b: "sha1:" + base64.b32encode(hashlib.sha1(b).digest()).decode()
    if sha1(block) != h["warc-block-digest"]:
        raise ValueError("block digest does not hold")
    http, gap, payload = block.partition(b"\r\n\r\n")
    status, hh = _headers(http)
    if not gap or not status.startswith("HTTP/1.1 ") or not hh.get("content-length", "").isdecimal():
        raise ValueError("bad HTTP headers")
    ids = [re.fullmatch(r"<urn:page:(none|-?\d+)>", h.get(k, "<urn:page:none>"))
           for k in ("warc-record-id", "warc-refers-to")]
    if not all(ids):
        raise ValueError("bad record id")
    page_id, refers_to = (None if m[1] == "none" else int(m[1]) for m in ids)
    n = int(hh["content-length"])
    if h["warc-type"] == "response":
        if len(payload) != n or sha1(payload) != h["warc-payload-digest"] or refers_to is not None:
            raise ValueError("payload does not hold")
    elif h["warc-type"] != "revisit" or h.get("warc-profile") != REVISIT_PROFILE or payload or refers_to is None:
        raise ValueError("bad record type")
    digest = base64.b32decode(h["warc-payload-digest"].removeprefix("sha1:")).hex()
    return page_id, urllib.parse.unquote(h.get("warc-target-uri", "")), h["warc-type"], refers_to, n, digest, \
        payload if h["warc-type"] == "response" else None


class WarcWriter:
    def __init__(self, uri: str, dictionary: bytes):
        self.fs, self.path = filesystem(uri)
        self.temp = f"{self.path}.{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.temp, compression=None)
        self.out.write(struct.pack("<II", DICT_FRAME, len(dictionary)) + dictionary)
        own = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.zstd = zstandard.ZstdCompressor(level=3, dict_data=own, write_checksum=True, write_content_size=True)
        self.records = self.bytes = 0

    def add(self, data: bytes) -> None:
        frame = self.zstd.compress(data)
        self.out.write(frame)
        self.records += 1
        self.bytes += len(frame)

    def close(self) -> int:
        self.out.close()
        self.fs.move(self.temp, self.path)
        return self.records


def read_warc(uri: str, chunk: int = 1 << 17) -> Iterator[tuple]:
    """The records of one file in order, one frame in memory at a time."""
    fs, path = filesystem(uri)
    with fs.open_input_stream(path, compression=None) as f:
        head = f.read(8)
        if len(head) < 8 or struct.unpack("<I", head[:4])[0] != DICT_FRAME:
            raise ValueError(f"{uri}: no dictionary frame")
        n = struct.unpack("<I", head[4:])[0]
        dictionary = f.read(n)
        if len(dictionary) != n:
            raise ValueError(f"{uri}: dictionary is cut off")
        if dictionary[:4] == struct.pack("<I", ZSTD_MAGIC):  # the dictionary may itself be compressed
            dictionary = zstandard.ZstdDecompressor().decompress(dictionary)
        own = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        zstd = zstandard.ZstdDecompressor(dict_data=own)
        held = b""
        while True:
            while len(held) < 18 and (more := f.read(max(chunk, 18))):  # a whole frame header
                held += more
            if not held:
                return
            frame, parts = zstd.decompressobj(), []
            if struct.unpack("<I", held[:4].ljust(4, b"\0"))[0] != ZSTD_MAGIC:
                raise ValueError(f"{uri}: no Zstandard frame")
            size = zstandard.frame_content_size(held[:18])
            while not frame.eof:
                if not held:
                    raise ValueError(f"{uri}: the last frame is cut off")
                parts.append(frame.decompress(held))
                held = frame.unused_data if frame.eof else f.read(chunk)
            data = b"".join(parts)
            if size >= 0 and size != len(data):
                raise ValueError(f"{uri}: frame length does not hold")
            yield parse(data)


def train_dictionary(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> bytes:
    """A dictionary from a bounded sample; empty where there is too little."""
    own = pages.filter("html is not null").select("url", "page_id", F.substring("html", 1, SAMPLE_CHARS).alias("h"))
    # names first: only the pages that are taken come to the driver
    names = own.select("url", "page_id").orderBy(F.xxhash64("url", "page_id"), "page_id").limit(sample_pages)
    names = names.distinct().select(F.col("url").alias("u"), F.col("page_id").alias("p"))
    taken = own.join(F.broadcast(names), F.col("url").eqNullSafe(F.col("u")) & F.col("page_id").eqNullSafe(F.col("p")), "left_semi")
    rows = sorted(taken.groupBy("url", "page_id").agg(F.min("h").alias("h")).collect(), key=repr)
    samples = [r["h"].encode() for r in rows if len(r["h"]) >= 64]
    if len(samples) < 16:
        return b""
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # the trainer finds nothing common: a file without a dictionary is as right
        return b""


def write_archives(pages: DataFrame, folder: str, dictionary: bytes, min_bytes: int = MIN_REVISIT_BYTES,
                   file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes ``(page_id, url, html)`` as archives when the result is computed:
    one row ``(uri, n_records)`` per file."""
    spark = pages.sparkSession
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                       html.alias("payload"), F.sha1(html).alias("digest"), F.octet_length(html).alias("n"))
    big = own.filter(F.col("n") >= min_bytes)
    groups = big.groupBy("digest", "n").agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("k")) \
                .filter("k > 1 and first_id is not null").drop("k")
    groups = Scratch(spark, "warc-groups").save(groups, "groups")
    rows = own.join(groups, ["digest", "n"], "left").select(
        "page_id", "url", "payload", "digest",
        F.when(F.col("page_id").eqNullSafe(F.col("first_id")), F.lit(None)).otherwise(F.col("first_id")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, done = TaskContext.get().partitionId(), None, []
        fs, path = filesystem(folder)
        for batch in batches:
            for i in range(batch.num_rows):
                if out is None:
                    fs.create_dir(path, recursive=True)
                    uri = f"{folder}/{part:06d}-{len(done):06d}.warc.zst"
                    out = WarcWriter(uri, dictionary)
                out.add(record(*(c[i].as_py() for c in batch.columns)))
                if out.bytes >= file_bytes:
                    done.append((uri, out.close()))
                    out = None
        if out is not None:
            done.append((uri, out.close()))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["uri", "n_records"])

    return rows.mapInArrow(run, "uri string, n_records long")


def read_archives(spark: SparkSession, files: DataFrame, payloads: bool = True) -> DataFrame:
    """``RECORD_SCHEMA`` of every record of the files ``uri``, one file a task
    at a time; ValueError where a file is damaged."""
    schema = RECORD_SCHEMA if payloads else RECORD_SCHEMA.rsplit(", ", 1)[0]
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))[:len(fields)]
        return pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(columns, fields)],
                                          names=[n for n, _ in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                rows, held = [], 0
                for row in read_warc(uri):
                    rows.append(row)
                    held += 200 + (row[4] if payloads else 0)
                    if held > 8_000_000:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return files.select("uri").repartition(n, "uri").mapInArrow(run, schema)


def archive(pages: DataFrame) -> DataFrame:
    """Writes all pages as archives in the shared folder; ``(uri, n_records)``."""
    scratch = Scratch(pages.sparkSession, "warc")
    return scratch.save(write_archives(pages, f"{scratch.path}/archives", train_dictionary(pages)), "files")
