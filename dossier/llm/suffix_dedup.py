"""Repeated substrings by run-length indexes.

Removes every byte that lies in a string of ``length`` bytes which starts
anywhere else too, in the same or another document. Three steps:

1. *Routing.* In every window of ``length`` bytes the smallest hash of its
   ``gram``-byte strings is the window's key; equal windows have equal keys.
   Neighbouring windows of one key form a piece. Only keys that occur twice can
   hold repeats; counts per key are combined before the shuffle.
2. *Run-length index.* The distinct pieces of some keys are joined to one text
   of about ``BLOCK_BYTES``, its suffixes sorted, and the Burrows-Wheeler
   transform kept as runs with the text positions sampled at both ends of every
   run. Copies of a piece have equal suffixes, which stand next to each other in
   that order: they are kept once with a count, and runs are as long as their
   counts say. At a run's end the match with the neighbouring suffix is measured;
   in between it is one byte shorter at each further position, so one pass over
   the text streams the matching statistics: for each position the longest match
   that starts anywhere else. Windows with a match of ``length`` repeat.
3. *Removal.* Intervals go back to the texts by (key, piece).

Every removed byte is found by an index; nothing is marked beside it. Equal
documents are read once, and their pieces occur as often as they do. A piece
leaves a task once, however many documents of the task hold it, and distinct
pieces are combined before they meet by key. A key with more than ``most_pieces``
distinct pieces (a passage between ever different neighbours) is too large for
one index. Each of its windows gets a longer key: the string that the key stood
for is extended by half of the rest of the window, to the side where more of the
window lies. Equal windows still agree. That is done again while a key is
crowded, at most until the key is the window itself. Texts are shuffled once,
into a bucketed table; later steps join that table without moving it.

Very long texts are read in parts of ``CHUNK`` windows and a piece has at most
``MOST_WINDOWS``, so a task holds a text, its spans, and about 100 MB more.

Defined cases: a null text is empty; texts under ``length`` bytes lose nothing
and nothing is found in them; rows that repeat an id are documents of their
own; a null id stays null; an empty table gives an empty result. Bytes are
judged on the input, so a cut may fall inside a character: the kept bytes need
not be valid UTF-8.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

LENGTH, GRAM = 200, 32
BLOCK_BYTES, MOST_PIECES = 1 << 20, 4096
CHUNK, MOST_WINDOWS = 1 << 20, 512
SEEN = 500_000
_U = np.uint64
_TABLE = np.random.default_rng(31).integers(0, 2 ** 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15


def _sliding(a: np.ndarray, w: int, f: np.ufunc) -> np.ndarray:
    """``f`` (minimum, maximum) over every ``w`` neighbours."""
    out, span = a, 1
    while 2 * span <= w:
        out = f(out[:-span], out[span:])
        span *= 2
    return f(out[:len(a) - w + 1], out[w - span:]) if span < w else out


def _grams(b: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every ``k`` neighbouring bytes; ``k`` a power of two."""
    h, span = _TABLE[b], 1
    while span < k:
        h = h[:-span] * _U(pow(_BASE, span, 2 ** 64)) + h[span:]
        span *= 2
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _chunks(text: bytes, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """Place and bytes of the parts of a text that have ``CHUNK`` windows each."""
    b = np.frombuffer(text, np.uint8)
    for at in range(0, len(text) - length + 1, CHUNK):
        yield at, b[at:at + CHUNK + length - 1]


def keys_of(text: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """The keys of a text's windows whose gram occurs once in it, and those
    whose gram occurs more often (or is met in two chunks)."""
    found, w = [], length - gram + 1
    pad = np.zeros(w - 1, _U)
    for _, b in _chunks(text, length):
        g = _grams(b, gram)
        least = _sliding(g, w, np.minimum)
        chosen = g[_sliding(np.concatenate([pad, least, pad]), w, np.maximum) == g]
        found.append(np.unique(chosen, return_counts=True))
    if not found:
        return np.empty(0, _U), np.empty(0, _U)
    keys, at = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
    counts = np.bincount(at, np.concatenate([n for _, n in found]))
    return keys[counts == 1], keys[counts > 1]


def pieces_of(text: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, first and last window start of the text's pieces."""
    keys, first, last = [], [], []
    for at, b in _chunks(text, length):
        least = _sliding(_grams(b, gram), length - gram + 1, np.minimum)
        start = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        size = np.diff(np.append(start, len(least)))
        parts = -(-size // MOST_WINDOWS)  # a long piece is cut: a window stays in one part
        turn = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        start = np.repeat(start, parts) + turn * MOST_WINDOWS
        keys.append(least[start])
        first.append(start + at)
        last.append(np.append(start[1:], len(least)) - 1 + at)
    return np.concatenate(keys), np.concatenate(first), np.concatenate(last)


class RunLengthIndex:
    """Run-compressed Burrows-Wheeler transform of some pieces, each followed by
    a separator of its own, with the text positions at the ends of every run.
    ``counts`` tells how often each piece stands in the indexed text; its copies'
    suffixes are neighbours, so one of them is sorted and counted for all."""

    def __init__(self, pieces: list[bytes], counts: list[int] | None = None):
        k = len(pieces)
        self.counts = np.ones(k, np.int64) if counts is None else np.array(counts, np.int64)
        self.starts = np.cumsum([0] + [len(p) + 1 for p in pieces])
        text = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8).astype(np.int64) + k
        text[self.starts[1:] - 1] = np.arange(k)
        self.text = text
        suffixes, self.levels = self._sorted(text, int(k + 256).bit_length())
        bwt = text[suffixes - 1]
        head = np.flatnonzero(np.concatenate([[True], bwt[1:] != bwt[:-1]]))
        each = np.repeat(self.counts, np.diff(self.starts))[suffixes]
        self.symbols, self.lengths = bwt[head], np.add.reduceat(each, head)
        self.first, self.last = suffixes[head], suffixes[np.append(head[1:], len(bwt)) - 1]

    @staticmethod
    def _sorted(text: np.ndarray, bits: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
        """Suffixes in order, and the ranks by their first 4, 8, 16, ... symbols."""
        n, key, levels, depth = len(text), text.copy(), [], 4
        for i in range(1, 4):
            key <<= bits
            key[:n - i] |= text[i:] if i < n else 0
        order = np.argsort(key)
        slots, ranked, rank = np.arange(n), key[order], np.empty(n, np.int64)
        while True:  # a suffix's rank: the first place of those that are equal so far
            new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
            rank[order[slots]] = slots[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
            slots = slots[~(new & np.append(new[1:], True))]  # only suffixes with equals are sorted on
            if not len(slots):
                return order, levels
            levels.append((depth, rank.astype(np.int32)))
            own = order[slots]
            after = own + depth
            key = rank[own] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
            by = np.argsort(key)
            order[slots], ranked = own[by], key[by]
            depth *= 2

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common beginning of the suffixes at ``a`` and ``b``."""
        size = np.zeros(len(a), np.int64)
        for depth, rank in reversed(self.levels):
            size[rank[a + size] == rank[b + size]] += depth
        for _ in range(3):  # under 4: a separator ends the rest
            size[self.text[a + size] == self.text[b + size]] += 1
        return size

    def matching_statistics(self) -> np.ndarray:
        """For each text position the longest match that starts elsewhere."""
        at_runs = self._common(self.last[:-1], self.first[1:])
        none = np.zeros(1, np.int64)
        found = np.maximum(self._streamed(self.first, np.concatenate([none, at_runs])),
                           self._streamed(self.last, np.concatenate([at_runs, none])))
        size = np.diff(self.starts)
        rest = np.repeat(self.starts[1:] - 1, size) - np.arange(len(self.text))  # shared with a copy's suffix
        return np.where(np.repeat(self.counts, size) > 1, rest, found)

    def _streamed(self, samples: np.ndarray, size: np.ndarray) -> np.ndarray:
        order = np.argsort(samples)
        samples, size = samples[order], size[order]
        each = np.diff(np.append(samples, len(self.text)))
        return np.maximum(np.repeat(size + samples, each) - np.arange(len(self.text)), 0)


def merged(starts: np.ndarray, length: int) -> tuple[list[int], list[int]]:
    """The union of the intervals of ``length`` at the ascending ``starts``."""
    if not len(starts):
        return [], []
    cut = np.flatnonzero(np.diff(starts) > length)
    return starts[np.concatenate([[0], cut + 1])].tolist(), (starts[np.append(cut, len(starts) - 1)] + length).tolist()


def repeats(pieces: list[tuple[int, bytes]], length: int = LENGTH) -> list[tuple[list[int], list[int]]]:
    """For ``(occurrences, piece)`` of the same keys: the repeated intervals of
    each piece, by an index of them all."""
    index = RunLengthIndex([p for _, p in pieces], [n for n, _ in pieces])
    found = index.matching_statistics() >= length
    return [merged(np.flatnonzero(found[s:s + len(p)]), length) for s, (_, p) in zip(index.starts.tolist(), pieces)]


def _signed(h: int) -> tuple[int, int]:
    return (h >> 64) - (1 << 63), (h & (1 << 64) - 1) - (1 << 63)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


_PIECE = pa.schema([("c1", pa.int64()), ("c2", pa.int32()), ("start", pa.int64()), ("key", pa.int64()), ("p1", pa.int64()),
                    ("p2", pa.int64()), ("weight", pa.int64()), ("piece", pa.binary())])
_PART = pa.schema([("key", pa.int64()), ("p1", pa.int64()), ("p2", pa.int64()), ("key0", pa.int64()), ("o1", pa.int64()),
                   ("o2", pa.int64()), ("at", pa.int64()), ("anchor", pa.int64()), ("weight", pa.int64()), ("piece", pa.binary())])
_FOUND = pa.schema([("key", pa.int64()), ("p1", pa.int64()), ("p2", pa.int64()),
                    ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))])


def _ddl(schema: pa.Schema) -> str:
    names = {"int64": "long", "int32": "int", "binary": "binary", "list<item: int64>": "array<long>",
             "list<element: int64>": "array<long>", "string": "string"}
    return ", ".join(f"{f.name} {names[str(f.type)]}" for f in schema)


def _pieces(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """From ``(c1, c2, copies, text, keys)``: where the pieces of the keys lie.
    The first place of a piece in a task has its text; ``weight`` (its
    occurrences) ends once two are told of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, int] = {}
        for batch in batches:
            rows, size = [], 0
            for i in range(batch.num_rows):
                c1, c2, copies, text, wanted = (c[i].as_py() for c in batch.columns)
                text = text.encode()
                keys, first, last = pieces_of(text, length, gram)
                own = np.isin(keys, np.array(wanted, np.int64).astype(_U))
                for key, a, e in zip(keys[own].astype(np.int64).tolist(), first[own].tolist(), last[own].tolist()):
                    piece = text[a:e + length]
                    name = (key, *_signed(xxhash.xxh3_128_intdigest(piece)))
                    before, weight = seen.get(name, 0), min(copies, 2)
                    if before > 1:
                        weight = 0
                    elif len(seen) < SEEN or before:
                        seen[name] = before + weight
                    rows.append((c1, c2, a, *name, weight, None if before else piece))
                    size += 0 if before else len(piece)
                if len(rows) > 50_000 or size > 8_000_000:
                    yield _batch(rows, _PIECE)
                    rows, size = [], 0
            if rows:
                yield _batch(rows, _PIECE)

    return texts.select("c1", "c2", "copies", "text", "keys").mapInArrow(run, _ddl(_PIECE))


def _distinct(pieces: DataFrame) -> DataFrame:
    return pieces.groupBy("key", "p1", "p2").agg(F.sum("weight").alias("weight"), F.max("piece").alias("piece"))


def _indexed(pieces: DataFrame, length: int, block_bytes: int) -> DataFrame:
    """The repeated intervals of each of the distinct pieces, keys taken together
    until ``block_bytes`` are reached."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[tuple] = []  # (key, p1, p2)
        block: list[tuple[int, bytes]] = []
        size, last = 0, None

        def finish() -> Iterator[pa.RecordBatch]:
            rows = [(*name, *own) for name, own in zip(names, repeats(block, length)) if own[0]] if block else []
            if rows:
                yield _batch(rows, _FOUND)
            names.clear()
            block.clear()

        for batch in batches:
            for key, p1, p2, n, piece in zip(*(c.to_pylist() for c in batch.columns)):
                if key != last and size >= block_bytes:
                    yield from finish()
                    size = 0
                last = key
                names.append((key, p1, p2))
                block.append((n, piece))
                size += len(piece)
        yield from finish()

    own = pieces.select("key", "p1", "p2", "weight", "piece").repartition("key").sortWithinPartitions("key")
    return own.mapInArrow(run, _ddl(_FOUND))


def _longer(size: int, length: int) -> int:
    """The size of the anchor after one of ``size``."""
    return size + (length - size + 1) // 2


def _split(parts: DataFrame, size: int, length: int, gram: int) -> DataFrame:
    """Pieces by longer keys. All windows of a piece hold its anchor, ``size``
    bytes; where it is not known yet, it is the first gram in a window that is the
    key. The longer one reaches further left in windows that have room there, else
    further right."""
    after = _longer(size, length)
    more = after - size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, _, _, *origin, at, anchor, weight, piece in zip(*(c.to_pylist() for c in batch.columns)):
                last = len(piece) - length
                if anchor is None:
                    hits = np.flatnonzero(_grams(np.frombuffer(piece, np.uint8), gram).astype(np.int64) == key)
                    place = hits[np.searchsorted(hits, np.arange(last + 1))]
                    head = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
                    spans = zip(head.tolist(), (np.append(head[1:], last + 1) - 1).tolist(), place[head].tolist())
                else:
                    spans = [(0, last, anchor)]
                for a, e, p in spans:
                    for s, t, q in ((a, min(e, p - more), p - more), (max(a, p - more + 1), e, p)):
                        if s <= t:
                            own = piece[s:t + length]
                            name = xxhash.xxh3_64_intdigest(piece[q:q + after], seed=after) - (1 << 63)
                            rows.append((name, *_signed(xxhash.xxh3_128_intdigest(own)), *origin, at + s, q - s, weight, own))
                if len(rows) > 20_000:
                    yield _batch(rows, _PART)
                    rows = []
            if rows:
                yield _batch(rows, _PART)

    return parts.select(*_PART.names).mapInArrow(run, _ddl(_PART))


def _repeated(pieces: DataFrame, length: int, gram: int, block_bytes: int, most_pieces: int, scratch: Scratch) -> DataFrame:
    """The repeated intervals of the distinct pieces, by indexes of keys that
    aren't crowded; the others get longer keys."""
    parts = pieces.select("key", "p1", "p2", F.col("key").alias("key0"), F.col("p1").alias("o1"), F.col("p2").alias("o2"),
                          F.lit(0).cast("long").alias("at"), F.lit(None).cast("long").alias("anchor"), "weight", "piece")
    found, size = [], gram
    while True:
        crowded = scratch.save(pieces.groupBy("key").count().filter(F.col("count") > most_pieces).select("key"), f"crowded-{size}")
        last = size == length or crowded.isEmpty()
        fit = pieces if last else pieces.join(crowded, "key", "left_anti")
        own = scratch.save(_indexed(fit, length, block_bytes), f"found-{size}")
        if size > gram:
            moved = parts.drop("weight", "piece").join(own, ["key", "p1", "p2"])
            own = moved.select(F.col("key0").alias("key"), F.col("o1").alias("p1"), F.col("o2").alias("p2"),
                               *[F.transform(c, lambda x: x + F.col("at")).alias(c) for c in ("starts", "ends")])
        found.append(own)
        if last:
            return reduce(DataFrame.unionByName, found)
        parts = scratch.save(_split(parts.join(crowded, "key", "left_semi"), size, length, gram), f"parts-{size}")
        pieces = scratch.save(_distinct(parts), f"pieces-{size}")
        size = _longer(size, length)


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                 block_bytes: int = BLOCK_BYTES, most_pieces: int = MOST_PIECES, with_kept: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`` (start, end of
    the removed runs) for every row of ``docs``, and ``kept`` (binary) if asked."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffix-dedup")
    free = spark.sparkContext._jvm.System.gc  # lets Spark's cleaner delete the shuffle files of finished steps
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")) \
               .withColumn("c1", F.xxhash64("text")).withColumn("c2", F.hash("text"))  # 96 bits name a text
    classes = rows.groupBy("c1", "c2").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    table = f"suffix_dedup_{uuid.uuid4().hex}"
    classes.write.bucketBy(buckets, "c1", "c2").option("path", f"{scratch.path}/texts") \
           .option("compression", "zstd").format("parquet").saveAsTable(table)
    texts = spark.table(table)
    free()

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            once, often = [], []
            for copies, text in zip(batch.column(2).to_pylist(), batch.column(3)):
                a, b = keys_of(text.as_py().encode(), length, gram)
                if copies > 1:
                    a, b = a[:0], np.concatenate([a, b])
                once.append(a.astype(np.int64))
                often.append(b.astype(np.int64))
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(once, lists), pa.array(often, lists)],
                                             names=["c1", "c2", "once", "often"])

    long = texts.filter(F.octet_length("text") >= length)
    keys = scratch.save(long.select("c1", "c2", "copies", "text")
                        .mapInArrow(keyed, "c1 long, c2 int, once array<long>, often array<long>"), "keys")
    each = keys.select("c1", "c2", F.explode("once").alias("key"), F.lit(1).alias("n")).unionByName(
        keys.select("c1", "c2", F.explode("often").alias("key"), F.lit(2).alias("n")))
    shared = scratch.save(each.groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1").select("key"), "shared")
    wanted = each.select("c1", "c2", "key").join(shared, "key", "left_semi").groupBy("c1", "c2").agg(F.collect_set("key").alias("keys"))
    wanted = scratch.save(wanted, "wanted")
    scratch.drop("keys")
    free()

    own = long.join(wanted, ["c1", "c2"])
    places = scratch.save(_pieces(own, length, gram), "places")
    pieces = scratch.save(_distinct(places.filter("weight > 0")), "pieces")
    free()
    found = _repeated(pieces, length, gram, block_bytes, most_pieces, scratch)
    free()

    parts = places.join(found, ["key", "p1", "p2"]).select(
        "c1", "c2", F.transform(F.arrays_zip("starts", "ends"), lambda x: F.struct(
            (x["starts"] + F.col("start")).alias("start"), (x["ends"] + F.col("start")).alias("end"))).alias("parts"))
    marks = scratch.save(parts.groupBy("c1", "c2").agg(F.flatten(F.collect_list("parts")).alias("parts")), "marks")

    fields = [("c1", pa.int64()), ("c2", pa.int32()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
              ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("starts", pa.list_(pa.int64())),
              ("ends", pa.list_(pa.int64()))] + [("kept", pa.binary())] * with_kept
    schema = pa.schema(fields)

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                c1, c2, own_text, parts = (c[i].as_py() for c in batch.columns)
                b = own_text.encode()
                spans: list[list[int]] = []
                for s, e in sorted((p["start"], p["end"]) for p in parts or []):
                    if spans and s <= spans[-1][1]:
                        spans[-1][1] = max(e, spans[-1][1])
                    else:
                        spans.append([s, e])
                at, kept = 0, []
                for s, e in spans:
                    kept.append(b[at:s])
                    at = e
                kept = b"".join([*kept, b[at:]])
                out.append((c1, c2, len(b), len(b) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(),
                            [s for s, _ in spans], [e for _, e in spans], kept)[:len(schema)])
            yield _batch(out, schema)

    done = texts.join(marks, ["c1", "c2"], "left").select("c1", "c2", "text", "parts") \
                .mapInArrow(removed, _ddl(schema))
    done = scratch.save(done, "done")
    spark.sql(f"DROP TABLE {table}")
    scratch.drop("texts", "places", "wanted", "pieces")
    spans = F.arrays_zip(F.col("starts").alias("start"), F.col("ends").alias("end"))
    return rows.drop("text").join(done, ["c1", "c2"], "left").select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", spans.alias("spans"), *["kept"] * with_kept)
