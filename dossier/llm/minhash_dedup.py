"""Near-dedup by SuperMinHash signatures, banding, verification and union-find.

A document's set is its distinct ``WORDS``-word shingles (words: lower-cased
A-Z, split at white space; the whole sequence where it has fewer words), as
64-bit hashes. SuperMinHash gives every element a random order of the
signature's slots: in step j it offers j plus a random fraction to its j-th
slot, and steps end as soon as no slot can still get lower. Documents with
equal sets are one class first; classes that agree on all rows of a band share
a bucket. With 24 bands of 6 rows a pair at the threshold 0.85 shares none with
probability 1e-5.

Links are confirmed on the full sets. Every bucket ties its members to its first
one, and union-find joins the ties to families: any two documents that share a
bucket are in one family. A family's sets meet once, in blocks of at most about
``BLOCK_ROWS`` sets or ``BLOCK_BYTES``, every pair of blocks a task's work of its
own; there the overlaps of all pairs are counted and only a spanning forest of
the confirmed links goes out. So neither pairs nor copies of sets by band are
written, no pair of a bucket is left out, and a large family is many tasks.

Defined cases: null and empty texts have no shingle and link with nothing;
documents with equal sets are linked, whatever their order of words; rows that
repeat a doc_id are documents of their own; a null id is never a component
while an id is among its members; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, components, kept, union

WORDS = 5
PERCENT = 85
BANDS, ROWS = 24, 6
BLOCK_ROWS, BLOCK_BYTES = 1024, 8_000_000
_U = np.uint64
_PRIME, _GOLD = _U(0x9E3779B97F4A7C15 | 1), _U(0xD1B54A32D192ED03)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Words(dict):
    """Word -> 64-bit hash; remembers a bounded number of words."""

    def __missing__(self, w: bytes) -> int:
        h = xxhash.xxh64_intdigest(w)
        if len(self) < 300_000:
            self[w] = h
        return h


def shingles(text: str | None, k: int = WORDS) -> np.ndarray:
    """The document's set as ascending 64-bit hashes."""
    words = (text or "").encode().lower().split()  # bytes: A-Z, and blanks 0x20, 0x09-0x0D only
    if not words:
        return np.empty(0, _U)
    w = np.fromiter(map(kept("words", _Words).__getitem__, words), _U, len(words))
    n = max(len(w) - k + 1, 1)
    h = np.full(n, min(len(w), k), _U)
    for i in range(min(len(w), k)):
        h = h * _PRIME + w[i:i + n]
    return np.unique(_mix(h))


def signature(s: np.ndarray, slots: int = BANDS * ROWS, chunk: int = 1 << 16) -> np.ndarray:
    """SuperMinHash of a set: per slot (step << 48 | 48 random bits)."""
    sig = np.full(slots, np.iinfo(np.uint64).max, _U)
    for at in range(0, len(s), chunk):
        part, order = s[at:at + chunk], None
        rows = np.arange(len(part))
        for j in range(slots):
            if j and int(sig.max()) < j << 48:
                break
            x = _mix(part + _U((j + 1) * int(_GOLD) % 2 ** 64))
            to = j + ((x & _U(0xFFFF)).astype(np.int64) * (slots - j) >> 16)
            if j == 0:
                first, slot = to, to
            else:
                if order is None:
                    order = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16), (len(part), 1))
                    order[rows, first], order[:, 0] = order[:, 0].copy(), order[rows, first]
                slot = order[rows, to]
                order[rows, to] = order[:, j]
                order[:, j] = slot
            np.minimum.at(sig, slot, (x >> _U(16)) | _U(j << 48))
    return sig


def band_keys(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    own = sig.reshape(bands, -1)
    h = np.arange(1, bands + 1, dtype=_U) * _GOLD
    for i in range(own.shape[1]):
        h = _mix(h * _PRIME + own[:, i])
    return h.astype(np.int64)


def _profiles(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, a, b, keys = [], [], [], []
            for text in batch.column(1):
                s = shingles(text.as_py())
                h = xxhash.xxh3_128_intdigest(s.tobytes())
                n.append(len(s))
                a.append((h >> 64) - (1 << 63))
                b.append((h & (1 << 64) - 1) - (1 << 63))
                keys.append(band_keys(signature(s, bands * rows), bands) if len(s) else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "n", "fp1", "fp2", "keys"])

    return docs.mapInArrow(run, "doc_id long, n long, fp1 long, fp2 long, keys array<long>")


def _sets(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                s = shingles(batch.column(1)[i].as_py())
                h = xxhash.xxh3_128_intdigest(s.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i:i + 1], pa.array([(h >> 64) - (1 << 63)]),
                     pa.array([(h & (1 << 64) - 1) - (1 << 63)]), pa.array([s.tobytes()])],
                    names=["rep", "fp1", "fp2", "items"])

    return docs.mapInArrow(run, "rep long, fp1 long, fp2 long, items binary")


def overlapping(sets: list[np.ndarray], first: int, percent: int = PERCENT) -> np.ndarray:
    """A spanning forest (parent by place) of the links between the ``first``
    sets and the others; ``first`` = 0: among all sets."""
    parent, n = np.arange(len(sets)), np.array([len(s) for s in sets])
    a, b = (slice(0, first), slice(first, None)) if first else (slice(None), slice(None))
    _, item, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), n)
    often = counts > 1  # others are in no overlap
    item, row = (np.cumsum(often) - 1)[item[often[item]]], row[often[item]]
    order = np.argsort(item, kind="stable")
    item, row = item[order], row[order]
    both = np.zeros((len(n[a]), len(n[b])), np.float32)
    for at in range(0, int(often.sum()), 2048):
        i, j = np.searchsorted(item, [at, at + 2048])
        own, place = np.unique(row[i:j], return_inverse=True)
        has = np.zeros((len(own), 2048), np.float32)
        has[place, item[i:j] - at] = 1
        cut = int(np.searchsorted(own, first)) if first else 0
        x, y = (own[:cut], own[cut:]) if first else (own, own)
        hx, hy = (has[:cut], has[cut:]) if first else (has, has)
        both[np.ix_(x, y - first)] += hx @ hy.T
    r, s = np.nonzero(both * 100 >= (n[a, None] + n[None, b] - both) * percent)
    union(parent, r, s + first)
    return parent


def _forest(rows: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` that join what the confirmed links of the blocks join."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def linked(group: list[tuple]) -> list[tuple]:
        group.sort(key=lambda r: (r[0], r[1]))  # the first block's sets, then the second's
        ids = [r[1] for r in group]
        first = sum(r[0] == group[0][0] for r in group)
        if len(group) < 2 or (group[0][2] and first == len(group)):
            return []
        parent = overlapping([np.frombuffer(r[3], _U) for r in group], first if first < len(group) else 0, percent)
        return [(x, ids[p]) for x, p in zip(ids, parent.tolist()) if x != ids[p]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, group = None, []
        for batch in batches:
            out = []
            for family, i, j, own, cls, items in zip(*(c.to_pylist() for c in batch.columns)):
                if (family, i, j) != last:
                    out += linked(group) if group else []
                    last, group = (family, i, j), []
                group.append((own, cls, i != j, items))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=schema)
        out = linked(group) if group else []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=schema)

    return rows.select("family", "i", "j", "own", "cls", "items").repartition("family", "i", "j") \
               .sortWithinPartitions("family", "i", "j").mapInArrow(run, "a long, b long")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
               bands: int = BANDS, rows: int = ROWS, block_rows: int = BLOCK_ROWS,
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``."""
    scratch = Scratch(docs.sparkSession, "minhash")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    own = scratch.save(_profiles(docs, bands, rows), "profiles")
    key = ["n", "fp1", "fp2"]
    classes = own.filter("n > 0").groupBy(*key).agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("keys").alias("keys"))
    classes = scratch.save(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")

    each = classes.select("cls", F.explode("keys").alias("key"))
    centres = each.groupBy("key").agg(F.min("cls").alias("centre"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    centres = scratch.save(centres.select("key", "centre"), "centres")
    ties = scratch.save(each.join(centres, "key").select(F.col("cls").alias("a"), F.col("centre").alias("b")).distinct(), "ties")
    families = scratch.save(components(ties, scratch, "families"), "families")

    wanted = families.select(F.col("node").alias("cls"), F.col("component").alias("family")) \
                     .join(classes.select("cls", *key, "rep"), "cls")
    wanted = scratch.save(wanted, "wanted")
    sizes = wanted.groupBy("family").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / block_rows), F.ceil(F.sum("n") * 8 / block_bytes)).cast("int").alias("blocks"))
    sizes = scratch.save(sizes.filter("blocks > 1"), "sizes")
    reps = wanted.select(F.col("rep").alias("doc_id")).distinct()
    texts = docs.join(reps, docs["doc_id"].eqNullSafe(reps["doc_id"]), "left_semi")
    found = wanted.select("family", "cls", F.col("rep").alias("doc_id"), F.col("fp1").alias("f1"), F.col("fp2").alias("f2"))
    texts = _sets(texts)
    sets = texts.join(found, texts["rep"].eqNullSafe(found["doc_id"]) & (F.col("fp1") == F.col("f1")) & (F.col("fp2") == F.col("f2")))
    sets = sets.dropDuplicates(["cls"]).select("family", "cls", "items")
    sets = sets.join(sizes, "family", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    sets = sets.withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    pair = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(
        F.least(o, F.col("own")).alias("i"), F.greatest(o, F.col("own")).alias("j")))
    links = scratch.save(_forest(sets.select("family", "cls", "items", "own", F.inline(pair)), percent), "links")
    joined = components(links, scratch, "components").withColumnRenamed("node", "cls")

    member = classes.select("cls", *key, "rep", "copies").join(joined, "cls", "left") \
                    .filter("component is not null or copies > 1").withColumn("component", F.coalesce("component", "cls"))
    member = scratch.save(member, "member")
    least = scratch.save(member.groupBy("component").agg(F.min("rep").alias("component_id")), "least")
    groups = scratch.save(member.join(least, "component").select(*key, "component_id"), "groups")
    return own.join(groups, key, "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")) \
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
