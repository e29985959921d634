"""Hierarchical multi-length packing.

Every text becomes token ids with an end id. Full windows of the longest
context go out as they are. The rest of a document goes to the smallest
context size (4096, 2048, ..., 256) that holds it and opens a window there,
longest documents first; the gap of a window is filled with whole shorter
documents from its own or shorter tiers, largest first, and then by cutting one
to the exact rest. So every window but the last of a pack group is full; that
last one is cut into windows of powers of two. Windows of one size are dealt
into step groups of equal tokens, with about as many pieces in each.

A pack group is what one task reads until ``group_tokens`` are together: tasks
need no shuffle, hold one group at a time, and a repeated task gives the same
rows. Defined cases: a null text is empty and has the end id alone; equal texts
and repeated rows are documents of their own; a null id stays null; an empty
table gives no piece.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import encoder

CONTEXT = 4096
SMALLEST = 256
GROUP_TOKENS = 2_000_000
STEP_TOKENS = 65_536
KNOWN_PIECES = 650_000  # of text, with their ids, kept by a worker
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, sequence_tokens long, step_id long")


def pack(lengths: list[int], context: int = CONTEXT, smallest: int = SMALLEST) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces ``(document, start, length)``; each sequence is as
    long as a power of two up to ``context``."""
    sequences, pool = [], []  # pool: (length, document, start), ascending
    for d, n in enumerate(lengths):
        sequences += [[(d, s, context)] for s in range(0, n - context + 1, context)]
        if n % context:
            pool.append((n % context, d, n - n % context))
    pool.sort()
    while pool:
        n, d, s = pool.pop()
        window, size = [(d, s, n)], smallest
        while size < n:
            size *= 2
        gap = size - n
        while gap and pool:
            at = bisect_right(pool, (gap, float("inf"), 0))
            if at:  # the largest that fits whole
                n, d, s = pool.pop(at - 1)
            else:  # none does: cut the smallest
                n, d, s = pool.pop(0)
                insort(pool, (n - gap, d, s + gap))
                n = gap
            window.append((d, s, n))
            gap -= n
        sequences += [window] if not gap else _powers(window, size - gap)
    return sequences


def _powers(window: list[tuple[int, int, int]], total: int) -> list[list[tuple[int, int, int]]]:
    """The last window, cut into sequences as long as powers of two."""
    out, window = [], window[::-1]
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        out.append([])
        while room:
            d, s, n = window.pop()
            if n > room:
                window.append((d, s + room, n - room))
                n = room
            out[-1].append((d, s, n))
            room -= n
    return out


def steps(sequences: list[list[tuple[int, int, int]]], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A step number for each sequence: sequences of one size, equal tokens,
    dealt back and forth by their number of pieces."""
    by_size: dict[int, list[int]] = {}
    for i, q in enumerate(sequences):
        by_size.setdefault(sum(n for _, _, n in q), []).append(i)
    step, out = 0, [0] * len(sequences)
    for size in sorted(by_size, reverse=True):
        own = sorted(by_size[size], key=lambda i: -len(sequences[i]))
        n = -(-len(own) * size // step_tokens)
        for k, i in enumerate(own):
            turn, at = divmod(k, n)
            out[i] = step + (at if turn % 2 == 0 else n - 1 - at)
        step += n
    return out


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
                   text_col: str = "text", context: int = CONTEXT, group_tokens: int = GROUP_TOKENS,
                   step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row per piece, see ``SCHEMA``. ``sequence_id`` and ``step_id`` are
    unique over all tasks."""
    end = end_id.to_bytes(4, "little")

    def packed(group: list[tuple[int | None, bytes]], first: int, first_step: int) -> tuple[pa.RecordBatch, int, int]:
        sequences = pack([len(b) // 4 for _, b in group], context, min(SMALLEST, context))
        step = steps(sequences, step_tokens)
        rows = []
        for k, q in enumerate(sequences):
            offset, size = 0, sum(n for _, _, n in q)
            for d, s, n in q:
                doc_id, ids = group[d]
                rows.append((doc_id, s, n, zlib.crc32(memoryview(ids)[4 * s:4 * (s + n)]), len(ids) // 4,
                             first + k, offset, size, first_step + step[k]))
                offset += n
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)
        return batch, first + len(sequences), first_step + max(step) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = encoder(tokenizer_path, KNOWN_PIECES).encode_all
        sequence = step = TaskContext.get().partitionId() << 32
        group, size = [], 0
        for batch in batches:
            texts = (text.as_py() or "" for text in batch.column(1))
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode_all(texts)):
                ids += end
                group.append((doc_id, ids))
                size += len(ids) // 4
                if size >= group_tokens:
                    out, sequence, step = packed(group, sequence, step)
                    group, size = [], 0
                    yield out
        if group:
            yield packed(group, sequence, step)[0]

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
               .mapInArrow(run, SCHEMA)
