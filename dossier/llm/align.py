"""Alignment of two tokenizers over the same texts.

Tokenizer A (tokenizers, byte-level BPE) encodes a space and the text, tokenizer B
(sentencepiece with byte fallback) the text, before which it puts a space itself.
Where a token ends is taken from the libraries' spans as a coarse cut: character
offsets of A, turned into bytes, and the proto spans of B, which are bytes. Tokens
that end inside a character have no span of their own (A repeats the character's,
B's byte-fallback pieces but the last have an empty one, as has its leading space);
their ends are refined by the length of their decoded bytes. Places where tokens of
both end cut the tokens into groups, and the two tokens that end there are linked.

Both tokenizers begin anew at a single blank or line end between two other
characters, so a text is aligned in such chunks, and a worker remembers the
alignments of chunks that it has seen. A text counts only if the decoded bytes of
both are the text's; null, empty and all other texts have no tokens.

How often an id pair is linked is summed per block of documents (about ``LINKS``
links) where it lies, then over the blocks; what a block's documents need to know
goes back to the block. So neither a frequent pair nor a frequent id is a hot
key: a block has one row per pair.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, kept, ship

LINKS = 1 << 20  # of one block of documents, if it has more than one
KNOWN = 900_000  # chunks that a worker remembers
CHARS = 300_000  # of texts aligned together
CHUNKS = 2000  # encoded in one call
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
B_BITS = 32

Aligned = tuple[int, int, bytes, bytes]  # tokens of A, of B, linked pairs (int64), groups as text


def _byte_alphabet() -> dict[str, int]:
    """Bytes by the characters that byte-level vocabularies write for them:
    visible Latin-1 characters stand for themselves, the others count up from 256."""
    shown = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + k): b for k, b in enumerate(hidden)}}


class Aligner:
    """``align(text)``: groups of token ids and ends in bytes, by both tokenizers."""

    def __init__(self, path_a: str, path_b: str, limit: int = KNOWN):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks in parallel
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = _byte_alphabet()
        entries = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.bytes_a = [bytes(map(alphabet.__getitem__, e)) if all(c in alphabet for c in e) else e.encode() for e in entries]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        if any("▁" in p.lstrip("▁") or "\n" in p for p in pieces):
            raise ValueError("tokenizer B has pieces that reach over a blank or a line end")
        self.lead = self.b.piece_to_id("▁")
        self.limit = limit
        self.known: dict[str, Aligned | None] = {}

    def _ends_a(self, chunk: str, ids: list[int], spans: list[tuple[int, int]]) -> list[int]:
        """Ends in bytes from character offsets; inside a character by decoded bytes."""
        at = None if chunk.isascii() else [0, *np.cumsum([len(c.encode()) for c in chunk]).tolist()]
        out, pos = [], 0
        for k, i in enumerate(ids):
            end = spans[k][1]
            inside = k + 1 < len(ids) and spans[k + 1][0] < end
            pos = pos + len(self.bytes_a[i]) if inside else at[end] if at else end
            out.append(pos)
        return out

    def _ends_b(self, pieces: list, shift: int) -> list[int]:
        """Ends in bytes from proto spans; pieces without a span by decoded bytes."""
        out, pos = [], 0
        for i, begin, end in pieces:
            pos = pos + len(self.bytes_b[i]) if begin == end else end + shift
            out.append(pos)
        return out

    def spans(self, chunks: list[str]) -> Iterator[tuple | None]:
        """``(ids, ends)`` of A and of B for texts that begin with a blank or a line
        end; None where the decoded bytes differ. A blank is left to B to put there."""
        found_a = self.a.encode_batch(chunks, add_special_tokens=False)
        found_b = self.b.encode([c[1:] if c[0] == " " else c for c in chunks], return_type="proto", num_threads=1)
        for chunk, x, proto in zip(chunks, found_a, found_b):
            shift = 1 if chunk[0] == " " else 0
            pieces = [(p.id, p.begin, p.end) for p in proto.pieces]
            if not shift:  # B's own blank before a line end
                if not pieces or pieces[0] != (self.lead, 0, 0):
                    yield None
                    continue
                pieces = pieces[1:]
            ids_a, ids_b, told = x.ids, [p[0] for p in pieces], chunk.encode()
            if (b"".join([self.bytes_a[i] for i in ids_a]) != told or b"".join([self.bytes_b[i] for i in ids_b]) != told):
                yield None
                continue
            yield ids_a, self._ends_a(chunk, ids_a, x.offsets), ids_b, self._ends_b(pieces, shift)

    @staticmethod
    def groups(ids_a: list[int], ends_a: list[int], ids_b: list[int], ends_b: list[int]) -> Iterator[tuple[list[int], list[int]]]:
        """Token ids of both between the ends that they have in common."""
        i = j = x = y = 0
        while x < len(ends_a) and y < len(ends_b):
            if ends_a[x] < ends_b[y]:
                x += 1
            elif ends_b[y] < ends_a[x]:
                y += 1
            else:
                x, y = x + 1, y + 1
                yield ids_a[i:x], ids_b[j:y]
                i, j = x, y

    def _learn(self, chunks: list[str]) -> dict[str, Aligned | None]:
        new: dict[str, Aligned | None] = {}
        for k in range(0, len(chunks), CHUNKS):
            own = chunks[k:k + CHUNKS]
            for chunk, s in zip(own, self.spans(own)):
                if s is None:
                    new[chunk] = None
                    continue
                cut = list(self.groups(*s))
                pairs = np.array([(a[-1] << B_BITS) | b[-1] for a, b in cut], np.int64).tobytes()
                told = ";".join([",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in cut]).encode()
                new[chunk] = (len(s[0]), len(s[2]), pairs, told)
        if len(self.known) < self.limit:
            self.known.update(new)
        return new

    def align_all(self, texts: Iterable[str]) -> Iterator[list[Aligned]]:
        """Each text's chunks, aligned; none for a text that has no tokens."""
        group, size = [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size > CHARS:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, texts: list[str]) -> Iterator[list[Aligned]]:
        cut = [_CUT.split(" " + t) if t else [] for t in texts]
        known = self.known
        new = self._learn([c for c in dict.fromkeys(c for chunks in cut for c in chunks) if c not in known])
        for chunks in cut:
            found = [new[c] if c in new else known[c] for c in chunks]
            yield [] if None in found else found


def _rows(path_a: str, path_b: str, links: int, keep_groups: bool):
    """Documents in blocks: each with the places of its pairs among the block's
    (and how often), the block's pairs and their sums at its first document."""
    ids = pa.list_(pa.int32())
    fields = [("block", pa.int64()), ("own", pa.int32()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_links", pa.int64()),
              ("groups_sha256", pa.string()), ("groups", pa.string()), ("at", ids), ("times", ids),
              ("pair", pa.list_(pa.int64())), ("n", pa.list_(pa.int64()))]

    def block(batch: pa.RecordBatch, name: int, first: int, docs: list[tuple]) -> pa.RecordBatch:
        sizes = [len(d[5]) for d in docs]
        every, times = np.concatenate([d[5] for d in docs]), np.concatenate([d[6] for d in docs])
        pair, at = np.unique(every, return_inverse=True)
        n = np.bincount(at.reshape(-1), times, len(pair)).astype(np.int64) if len(pair) else np.zeros(0, np.int64)
        offsets = pa.array(np.cumsum([0, *sizes]), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(v.astype(np.int32))) for v in (at.reshape(-1), times)]
        rest = [None] * (len(docs) - 1)
        columns = [pa.array([name] * len(docs), pa.int64()), pa.array(range(len(docs)), pa.int32()),
                   *[pa.array([d[k] for d in docs], pa.int64()) for k in (0, 1, 2)],
                   pa.array([d[3] for d in docs], pa.string()), pa.array([d[4] for d in docs], pa.string()), *lists,
                   pa.array([pair.tolist(), *rest], pa.list_(pa.int64())), pa.array([n.tolist(), *rest], pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, len(docs)), *columns],
                                          schema=pa.schema([batch.schema.field("doc_id"), *fields]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = kept(("aligner", path_a, path_b), lambda: Aligner(path_a, path_b))
        name = TaskContext.get().partitionId() << 32
        for batch in batches:
            docs, total, first = [], 0, 0
            texts = ("" if not t.is_valid else t.as_py() for t in batch.column("text"))
            for found in aligner.align_all(texts):
                pairs, times = np.unique(np.frombuffer(b"".join([f[2] for f in found]), np.int64), return_counts=True)
                told = b";".join([f[3] for f in found])
                n = int(times.sum())
                docs.append((sum([f[0] for f in found]), sum([f[1] for f in found]), n,
                             hashlib.sha256(told).hexdigest() if found else "", told.decode() if keep_groups else None, pairs, times))
                total += len(pairs)
                if total >= links:
                    yield block(batch, name, first, docs)
                    first, name, docs, total = first + len(docs), name + 1, [], 0
            if docs:
                yield block(batch, name, first, docs)
                name += 1
    return run


def _summed(key: tuple, docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """Sums over each document's links of what the block's pairs are found to be."""
    pairs = pairs.sort_by("place")
    docs = docs.combine_chunks()
    out = {c: docs.column(c) for c in ("doc_id", "n_a", "n_b", "n_links", "groups_sha256", "groups")}
    lists = [docs.column(c).combine_chunks() for c in ("at", "times")]
    at, times = (np.asarray(c.flatten(), np.int64) for c in lists)
    offsets = np.cumsum([0, *[len(x) for x in lists[0]]])
    for name, source in (("n_best", "best"), ("count_sum", "total")):
        each = np.asarray(pairs.column(source).combine_chunks(), np.int64)
        sums = np.concatenate([[0], np.cumsum(each[at] * times)]) if len(at) else np.zeros(1, np.int64)
        out[name] = pa.array(sums[offsets[1:]] - sums[offsets[:-1]] if len(at) else np.zeros(len(offsets) - 1, np.int64))
    return pa.table(out)


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
          keep_groups: bool = False, links: int = LINKS) -> tuple[DataFrame, DataFrame]:
    """The documents' alignments and the table of linked ids.

    Documents, one row each: id, ``n_a`` and ``n_b`` tokens, ``n_groups``,
    ``n_links``, ``n_best`` (links whose pair is the most frequent, ties included, of
    its B id), ``count_sum`` (of the links' pair counts) and ``groups_sha256`` of
    ``a1,a2|b1;a3|b2,b3`` (ids in order, empty string without tokens); the text itself
    as ``groups`` on request. Linked ids: ``a_id``, ``b_id``, ``total``, ``best``.

    Repeated rows and null ids stay rows of their own; an empty table has no rows;
    other columns are not read. A long text is one row and one task's work, about 100
    bytes a token at a time for a chunk without blanks or line ends."""
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "align")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    done = scratch.save(rows.mapInArrow(_rows(path_a, path_b, links, keep_groups), f"""doc_id {kind}, block long, own int, n_a long,
        n_b long, n_links long, groups_sha256 string, groups string, at array<int>, times array<int>, pair array<long>, n array<long>"""),
                        "documents")
    pairs = done.filter("pair is not null").select(F.col("block").alias("owner"), F.posexplode(F.arrays_zip("pair", "n")).alias("place", "p")) \
                .select("owner", "place", "p.pair", "p.n")
    b_id = F.col("pair").bitwiseAND((1 << B_BITS) - 1)
    totals = pairs.groupBy("pair").agg(F.sum("n").alias("total"))
    totals = totals.withColumn("best", (F.col("total") == F.max("total").over(Window.partitionBy(b_id))).cast("long"))
    totals = scratch.save(totals, "pairs")
    own = pairs.join(totals, "pair").select("owner", "place", "total", "best")
    schema = f"doc_id {kind}, n_a long, n_b long, n_links long, groups_sha256 string, groups string, n_best long, count_sum long"
    kept_docs = done.select("block", "doc_id", "n_a", "n_b", "n_links", "groups_sha256", "groups", "at", "times")
    summed = kept_docs.groupBy("block").cogroup(own.groupBy("owner")).applyInArrow(_summed, schema)
    columns = [F.col("doc_id").alias(id_col), "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", "n_best", "count_sum",
               "groups_sha256"]
    return (summed.select(*columns, *(["groups"] if keep_groups else [])),
            totals.select(F.shiftright("pair", B_BITS).cast("int").alias("a_id"), b_id.cast("int").alias("b_id"), "total",
                          (F.col("best") == 1).alias("best")))
