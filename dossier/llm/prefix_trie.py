"""Prefix trie of conversations: one row per distinct beginning.

A turn is known by its id, 16 bytes of a SHA-256 of role and text, and a
conversation by its ids in order. ``prefix_trie`` sorts the conversations by ids
(range shards, cut at conversations, so that copies of one conversation spread
over shards) and reads a shard as padded matrices of dense turn numbers, zeros
behind the last turn. Of a matrix in ``lexsort`` order, the column changes from
row to row, OR-accumulated along the columns, mark where the nodes of every depth
start, and ``reduceat`` over those starts gives their figures. Every figure is a
sum or a minimum over the node's rows:

* a child of a node is counted at the row where it starts, a leaf at the last row
  of its copies if the row behind does not go on from it;
* saved tokens are the words of all rows from that depth on, less those of the
  turns that start a node at their row.

Rows beside a matrix only count by the number of turns that they share with its
first and last row, so a node that reaches over a matrix border is the sum of its
parts. Only those boundary nodes, at most one path per border, are combined by a
shuffle; all others are complete where they are found.

Results for odd input: a null role or text is empty; rows without conv_id are in
no conversation; turns that share a place (``turn`` null first, equal, or
repeated rows) stay apart, in the order of their ids; an empty table has no node,
not even a root. A conversation is one row of about 24 bytes a turn; texts of any
length are read once, where they lie. Other columns of the table are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, ship

TURN = 16  # bytes of a turn's id
CELLS = 1 << 21  # of one padded matrix, if it has more than one row
PIECE = 1024  # conv_ids in one piece of a boundary node's list
SALT = 16  # copies of a boundary node's row when its children look it up
WORD = r"[^\x20\x09-\x0D]+"

_PARTS = pa.schema([("path", pa.binary()), ("parent_path", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()),
                    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
                    ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("ends", pa.string())])
PARTS = ("path binary, parent_path binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
         "n_leaves long, saved_tokens long, ends_sha256 string, ends string")
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_lists(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turns)``: each conversation's turns in order, as structs of
    ``id`` and ``words`` (number of words of the text)."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"),
                    F.unhex(F.left(F.sha2(told, 256), F.lit(2 * TURN))).alias("id"),
                    F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    lists = conversations.filter("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return lists.select(F.col("conv_id").cast("long").alias("conv_id"),
                        F.transform("turns", lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("turns"))


def with_shared_heads(lists: DataFrame, head: Column, base: Column, most: int) -> DataFrame:
    """``lists`` with the first ``head`` (at most ``most``) turns of each conversation
    taken from conversation ``base`` instead (all of it if shorter, none if absent)."""
    own = lists.select("conv_id", "turns", head.cast("int").alias("head"), base.alias("base"))
    heads = lists.select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("first"))
    heads = heads.join(own.select("base").distinct(), "base", "left_semi")
    none = F.slice("turns", 1, 0)
    return own.join(heads, "base", "left").select(
        "conv_id", F.concat(F.slice(F.coalesce("first", none), F.lit(1), F.col("head")),
                            F.slice("turns", F.col("head") + 1, F.greatest(F.size("turns") - F.col("head"), F.lit(0)))).alias("turns"))


def shared(a: bytes, b: bytes) -> int:
    """Number of turns that two conversations begin with together."""
    n = min(len(a), len(b)) // TURN
    x, y = (np.frombuffer(s, np.uint8, n * TURN).reshape(n, TURN) for s in (a, b))
    apart = np.flatnonzero((x != y).any(axis=1))
    return int(apart[0]) if len(apart) else n


def _paths(key: bytes, depth: int) -> list[bytes]:
    """Names of the nodes of depth 0 to ``depth`` that a conversation passes."""
    h, out = hashlib.sha256(), []
    for d in range(depth + 1):
        out.append(h.copy().digest()[:TURN])
        h.update(key[d * TURN:(d + 1) * TURN])
    return out


def matrix_nodes(conv: np.ndarray, keys: list[bytes], words: np.ndarray, before: int, after: int) -> Iterator[pa.RecordBatch]:
    """Nodes of some conversations that are neighbours in the order of keys.

    ``words``: of all turns, row by row. ``before`` and ``after``: turns that the
    first and last row share with the rows beside them, -1 where there is none."""
    n, lens = len(keys), np.array([len(k) // TURN for k in keys])
    depths = int(lens.max())
    inside = np.arange(depths) < lens[:, None]
    ids = np.zeros((n, depths), np.int64)
    ids[inside] = np.unique(np.frombuffer(b"".join(keys), f"S{TURN}"), return_inverse=True)[1].reshape(-1) + 1
    load = np.zeros((n, depths + 1), np.int64)  # words by depth; the root has none
    load[:, 1:][inside] = words
    order = np.lexsort((conv, *ids.T[::-1]))
    conv, lens, ids, load = conv[order], lens[order], ids[order], load[order]

    starts = np.zeros((n, depths + 1), bool)
    starts[0] = True
    starts[1:, 1:] = np.logical_or.accumulate(ids[1:] != ids[:-1], axis=1)
    new = starts & (np.arange(depths + 1) <= lens[:, None])
    new[0] &= np.arange(depths + 1) > before  # the others started in an earlier matrix
    spare = np.cumsum((load * ~new)[:, ::-1], axis=1)[:, ::-1]
    last = np.empty(n, bool)  # of the copies of a leaf
    last[:-1] = starts[np.arange(1, n), lens[:-1]]
    last[-1] = after < lens[-1]
    first_path, last_path = _paths(keys[order[0]], before), _paths(keys[order[-1]], after)

    ends, digests = np.flatnonzero(starts[np.arange(n), lens]), {}
    for a, b in zip(ends.tolist(), [*ends[1:].tolist(), n]):
        digests[a] = (a, b)
    found: list[list] = [[] for _ in _PARTS]
    up = None  # starts, smallest conv_ids and paths of the depth above
    for d in range(depths + 1):
        at = np.flatnonzero(starts[:, d])
        size = np.diff(np.append(at, n))
        smallest = np.minimum.reduceat(conv, at)
        children = np.add.reduceat(new[:, d + 1].astype(np.int64), at) if d < depths else np.zeros(len(at), np.int64)
        leaves = np.add.reduceat(last.astype(np.int64), at)
        saved = np.add.reduceat(spare[:, d], at)
        path = {}
        if d <= before:
            path[0] = first_path[d]
        if d <= after:
            path[len(at) - 1] = last_path[d]
        above = np.searchsorted(up[0], at, "right") - 1 if up else None
        for k in np.flatnonzero(lens[at] >= d).tolist():
            own, a = path.get(k), int(at[k])
            p = int(above[k]) if up else None
            listed = lens[a] == d
            text = None
            if listed and own is None:
                lo, hi = digests[a]
                text = hashlib.sha256(",".join(map(str, conv[lo:hi].tolist())).encode()).hexdigest()
            row = (own, up[2].get(p) if up else None, int(smallest[k]), d,
                   int(up[1][p]) if up and p not in up[2] else None, int(size[k]), int(children[k]), int(leaves[k]),
                   int(saved[k]), None if own is not None else text or NO_ENDS, None)
            for column, value in zip(found, row):
                column.append(value)
            if listed and own is not None:
                lo, hi = digests[a]
                for i in range(lo, hi, PIECE):
                    told = conv[i:min(i + PIECE, hi)].tolist()
                    for column, value in zip(found, (own, None, told[0], d, None, 0, 0, 0, 0, None, ",".join(map(str, told)))):
                        column.append(value)
        up = (at, smallest, path)
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(found, _PARTS)], schema=_PARTS)


def _matrices(batches: Iterator[pa.RecordBatch], cells: int) -> Iterator[tuple]:
    """``(shard, conv_ids, keys, words)`` of consecutive rows of one shard."""
    for batch in batches:
        shard, conv = (np.asarray(batch.column(c)) for c in ("shard", "conv_id"))
        keys = batch.column("key").to_pylist()
        turns = batch.column("words")
        offsets, words = np.asarray(turns.offsets), np.asarray(turns.values)
        width = np.array([len(k) // TURN + 1 for k in keys])
        edges = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(keys)]
        for a, b in zip(edges, edges[1:]):
            while a < b:
                fits = np.arange(1, b - a + 1) * np.maximum.accumulate(width[a:b]) <= cells
                z = a + max(1, int(fits.sum()))
                yield int(shard[a]), conv[a:z], keys[a:z], words[offsets[a]:offsets[z]]
                a = z


def _run(borders: dict[int, tuple[int, int]], cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before = None, -1
        for m in _matrices(batches, cells):
            if held is not None:
                same = held[0] == m[0]
                after = shared(held[2][-1], m[2][0]) if same else borders[held[0]][1]
                yield from matrix_nodes(*held[1:], before, after)
                before = after if same else borders[m[0]][0]
            else:
                before = borders[m[0]][0]
            held = m
        if held is not None:
            yield from matrix_nodes(*held[1:], before, borders[held[0]][1])
    return run


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each path, which come one after the other."""
    schema = pa.schema([("path", pa.binary()), ("ends_sha256", pa.string())])
    path, h = None, None

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([path], pa.binary()), pa.array([h.hexdigest()], pa.string())], schema=schema)

    for batch in batches:
        for p, text in zip(batch.column("path").to_pylist(), batch.column("ends").to_pylist()):
            if p != path:
                if h is not None:
                    yield told()
                path, h = p, hashlib.sha256(text.encode())
            else:
                h.update(b"," + text.encode())
    if h is not None:
        yield told()


def prefix_trie(lists: DataFrame, cells: int = CELLS) -> DataFrame:
    """The trie of ``(conv_id, turns)`` (see ``turn_lists``; conv_ids unique), one
    row per node: ``conv_id`` (smallest member) and ``depth`` name it; parent's
    ``parent_conv_id`` (null at the root), ``n_convs`` members, ``n_children``,
    ``n_leaves`` and ``saved_tokens`` of its subtree (each node's members but one,
    times its last turn's words), ``ends_sha256`` of the comma-joined members that
    end there.

    The driver holds the first and last conversation of every shard. A
    SHA-256 is made in one pass, so the members that end at one boundary node go
    through one task as a stream of pieces, nothing of which is kept."""
    spark = lists.sparkSession
    ship(spark)
    scratch = Scratch(spark, "prefix-trie")
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = lists.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), "")).alias("key"),
                        F.transform("turns", lambda t: t["words"]).alias("words"))
    ranged = scratch.save(rows.repartitionByRange(n, "key", "conv_id").withColumn("shard", F.spark_partition_id()), "ranged")
    edges = ranged.groupBy("shard").agg(F.min("key").alias("a"), F.max("key").alias("z")).orderBy("shard").collect()
    common = [-1, *[shared(x["z"], y["a"]) for x, y in zip(edges, edges[1:])], -1]
    borders = {e["shard"]: (common[k], common[k + 1]) for k, e in enumerate(edges)}
    parts = (ranged.repartition(n, "shard").sortWithinPartitions("shard", "key", "conv_id")
             .select("shard", "conv_id", "key", "words").mapInArrow(_run(borders, cells), PARTS))
    parts = scratch.save(parts, "parts")
    scratch.drop("ranged")

    bound = parts.filter("path is not null")
    pieces = bound.filter("ends is not null").select("path", "conv_id", "ends")
    digests = pieces.repartition(n, "path").sortWithinPartitions("path", "conv_id").mapInArrow(_hashed, "path binary, ends_sha256 string")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    whole = bound.filter("ends is null").groupBy("path").agg(
        F.max("parent_path").alias("parent_path"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), *sums)
    whole = scratch.save(whole.join(digests, "path", "left").fillna({"ends_sha256": NO_ENDS}), "boundary")

    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    known = parts.filter("path is null and parent_path is null").select(columns)
    root = whole.filter("parent_path is null").withColumn("parent_conv_id", F.lit(None).cast("long")).select(columns)
    open_ = parts.filter("path is null and parent_path is not null").select("parent_path", *columns).unionByName(
        whole.filter("parent_path is not null").withColumn("parent_conv_id", F.lit(None).cast("long")).select("parent_path", *columns))
    salt = F.pmod(F.xxhash64("conv_id", "depth"), F.lit(SALT)).cast("int")
    parents = whole.select(F.col("path").alias("parent_path"), F.col("conv_id").alias("found"),
                           F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    looked_up = open_.withColumn("salt", salt).join(parents, ["parent_path", "salt"]).withColumn("parent_conv_id", F.col("found"))
    return known.unionByName(root).unionByName(looked_up.select(columns))


def shared_heads(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """``turn_lists`` in which a conversation c begins with the first
    crc32(c) % 4 turns of conversation c - c % 20 (SQL's remainder)."""
    lists = scratch.save(turn_lists(conversations), "lists")
    head = F.crc32(F.col("conv_id").cast("string")) % 4
    return with_shared_heads(lists, head, F.col("conv_id") - F.col("conv_id") % 20, most=3)
