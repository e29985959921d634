"""Embedding near-dedup by collision-counting projections.

Vectors are scaled to length 1 and projected on ``projections`` random
directions. Two vectors at the least similarity are at most ``d = sqrt(2 - 2
s)`` apart, and their difference along one direction is close to normal with
deviation ``d / sqrt(dimension)``. Around every vector (the query) stands a
window of ``WINDOW`` deviations on each projection; another vector collides
where it falls into the window. A pair is a candidate when it collides on at
least ``needed`` projections: the largest count that a pair at the least
similarity reaches with probability ``recall`` (binomial tail). Candidates are
verified by their cosine in double precision, so no false pair is linked.

Work is split by label and by a grid over the first ``ROUTE`` projections. A
vector lies in one cell and visits the neighbour cells whose border is within
``ROUTE_WINDOW`` deviations, so each query finds every vector of its routing
window in its own cell. There every projection is sorted, the windows are found
by bisection, and only what lies in them is counted. Equal vectors are one representative with a count beforehand. A cell of more than
``BLOCK`` members is split into blocks of queries and candidates, all pairs of
blocks, so one dense cell is many tasks. A task returns per query the number of
its links and, for the links together, a spanning forest: rows grow with the
vectors, not with the pairs.

Defined cases: a vector that is null, empty, zero or holds null or non-finite
components, or whose label is null, links with nothing; vectors of different
dimension never link; rows that repeat a vec_id are rows of their own that
share a component; a vector without vec_id is searched and counted like any
other, and its component is the smallest id that links give it, null (and the
row kept) where they give none; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, components, union

THRESHOLD = 0.98
PROJECTIONS, WINDOW, RECALL = 32, 2.2, 0.9999
ROUTE, ROUTE_WINDOW, CELL = 3, 4.5, 3.0
BLOCK = 4096
SEED = 29


def directions(dim: int, n: int = PROJECTIONS, seed: int = SEED) -> np.ndarray:
    """``n`` unit directions: random rotations, as many as are needed."""
    rng, parts = np.random.default_rng([seed, dim]), []
    while sum(len(p) for p in parts) < n:
        parts.append(np.linalg.qr(rng.standard_normal((dim, dim)))[0].T)
    return np.concatenate(parts)[:n]


def needed(projections: int = PROJECTIONS, window: float = WINDOW, recall: float = RECALL) -> int:
    """The collisions that a pair at the least similarity reaches with
    probability ``recall``."""
    p, tail = math.erf(window / math.sqrt(2)), 0.0
    for k in range(projections, -1, -1):
        tail += math.comb(projections, k) * p ** k * (1 - p) ** (projections - k)
        if tail >= recall:
            return k
    return 0


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _scale(threshold: float, dim: int) -> float:
    return math.sqrt(max(2 - 2 * threshold, 0)) / math.sqrt(dim)


def cell_links(x: np.ndarray, is_query: np.ndarray, is_candidate: np.ndarray, weight: np.ndarray, threshold: float,
               chunk: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """For the members of one cell: the weight of each query's links, and a
    forest (``parent`` by place) that joins what the links join."""
    dim, parent, links = x.shape[1], np.arange(len(x)), np.zeros(len(x), np.int64)
    unit, scale = _unit(x), _scale(threshold, x.shape[1])
    p = unit @ directions(dim).T
    count, w, wide = needed(), WINDOW * scale, ROUTE_WINDOW * scale
    slack = 1e-12  # equal directions differ by rounding alone
    q, c = np.flatnonzero(is_query), np.flatnonzero(is_candidate)
    order = np.argsort(p[c], axis=0, kind="stable")  # every projection sorted once
    line = np.take_along_axis(p[c], order, axis=0)
    for i in range(0, len(q), chunk):
        own = q[i:i + chunk]
        row = np.arange(len(own)) * len(c)
        hits = np.zeros(len(own) * len(c), np.uint8)
        for j in range(p.shape[1]):  # a pair collides at most once on a projection
            a = np.searchsorted(line[:, j], p[own, j] - w - slack)
            n = np.searchsorted(line[:, j], p[own, j] + w + slack, "right") - a
            within = np.arange(n.sum()) + np.repeat(a - np.cumsum(n) + n, n)
            hits[np.repeat(row, n) + order[within, j]] += 1
        r, s = np.divmod(np.flatnonzero(hits >= count), len(c))
        r, s = own[r], c[s]
        routed = (r != s) & (np.abs(p[r, :ROUTE] - p[s, :ROUTE]) <= wide + slack).all(axis=1)
        r, s = r[routed], s[routed]
        keep = np.concatenate([np.einsum("ij,ij->i", unit[r[k:k + 50_000]], unit[s[k:k + 50_000]]) >= threshold
                               for k in range(0, len(r), 50_000)] or [np.empty(0, bool)])
        r, s = r[keep], s[keep]
        np.add.at(links, r, weight[s])
        union(parent, r, s)
    return links, parent


def near_links(vectors: DataFrame, scratch: Scratch, threshold: float = THRESHOLD,
               block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """From distinct valid vectors ``(id, label, vec, weight)``: ``(id, n)`` with
    the weight of each one's links, and links ``(a, b)`` that join the same."""
    label_type = dict(vectors.dtypes)["label"]
    vec_type = dict(vectors.dtypes)["vec"]
    route = [f"c{k}" for k in range(ROUTE)]

    def visit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dim, f in frame.groupby(frame["vec"].map(len)):
                scale = _scale(threshold, dim)
                side, wide = max(CELL * ROUTE_WINDOW * scale, 1e-9), ROUTE_WINDOW * scale + 1e-12
                p = _unit(np.stack(f["vec"].to_numpy()).astype(float)) @ directions(dim)[:ROUTE].T
                home = np.floor(p / side)
                for step in itertools.product((-1, 0, 1), repeat=ROUTE):
                    move = np.array(step)
                    border = (home + (move > 0)) * side
                    reach = ((move == 0) | (np.abs(p - border) <= wide)).all(axis=1)
                    if reach.any():
                        out = f[reach].assign(dim=dim, native=not any(step))
                        for k, name in enumerate(route):
                            out[name] = (home[reach, k] + move[k]).astype("int64")
                        yield out

    cell = ["label", "dim", *route]
    members = vectors.select("id", "label", "vec", "weight").mapInPandas(
        visit, f"id long, label {label_type}, vec {vec_type}, weight long, dim long, native boolean, "
        + ", ".join(f"{c} long" for c in route))
    members = scratch.save(members, "members")
    parts = members.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts")).filter("parts > 1")
    parts = scratch.save(parts, "parts")
    members = members.join(parts, cell, "left").withColumn("parts", F.coalesce("parts", F.lit(1))) \
                     .withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    as_query = F.transform(every, lambda t: F.struct(F.col("own").alias("s"), t.alias("t"), F.lit(True).alias("q"),
                                                     (t == F.col("own")).alias("c")))
    as_candidate = F.transform(every, lambda s: F.struct(s.alias("s"), F.col("own").alias("t"), F.lit(False).alias("q"),
                                                         F.lit(True).alias("c")))
    roles = F.when(F.col("native"), F.concat(as_query, F.filter(as_candidate, lambda r: r["s"] != F.col("own")))) \
             .otherwise(as_candidate)
    blocks = members.select("id", "vec", "weight", *cell, F.inline(roles))

    def linked(g: pd.DataFrame) -> pd.DataFrame:
        ids = g["id"].to_numpy()
        if not g["q"].any() or len(g) < 2:
            found, parent = np.zeros(len(g), np.int64), np.arange(len(g))
        else:
            order = np.argsort(ids, kind="stable")
            g, ids = g.iloc[order], ids[order]
            found, parent = cell_links(np.stack(g["vec"].to_numpy()).astype(float), g["q"].to_numpy(), g["c"].to_numpy(),
                                       g["weight"].to_numpy(), threshold)
        out = pd.DataFrame({"id": ids, "n": found, "up": ids[parent]})
        return out[(out["n"] > 0) | (out["id"] != out["up"])]

    found = blocks.groupBy(*cell, "s", "t").applyInPandas(linked, "id long, n long, up long")
    found = scratch.save(found, "found")
    return (found.filter("n > 0").groupBy("id").agg(F.sum("n").alias("n")),
            found.filter("id <> up").select(F.col("id").alias("a"), F.col("up").alias("b")))


def embedding_dedup(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``table``."""
    scratch = Scratch(table.sparkSession, "embed-dedup")
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"),
                        F.col(vec_col).alias("vec"), F.monotonically_increasing_id().alias("key"))
    rows = scratch.save(rows, "rows")  # from here on a row is its key; ids can be null or repeated
    finite = F.forall("vec", lambda v: v.isNotNull() & (F.abs(v) < float("inf")) & ~F.isnan(v))
    valid = F.col("label").isNotNull() & F.coalesce(finite & F.exists("vec", lambda v: v != 0), F.lit(False))
    rows = rows.withColumn("valid", valid)
    classes = rows.filter("valid").groupBy("label", "vec").agg(
        F.min("key").alias("rep"), F.min("id").alias("least"), F.count(F.lit(1)).alias("weight"))
    classes = scratch.save(classes, "classes")
    counts, links = near_links(classes.select(F.col("rep").alias("id"), "label", "vec", "weight"), scratch, threshold, block)
    copies = classes.filter("weight > 1").withColumn("valid", F.lit(True))
    own = rows.join(copies, ["label", "vec", "valid"], "left").select(
        "id", F.coalesce("rep", "key").alias("rep"), F.coalesce("least", "id").alias("least"),
        F.coalesce("weight", F.lit(1)).alias("weight"))
    own = scratch.save(own, "own")
    named = own.filter("id is not null").select("id", "rep").distinct()
    again = named.groupBy("id").agg(F.min("rep").alias("a"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    same_id = named.join(again, "id").select("a", F.col("rep").alias("b"))
    joined = components(links.unionByName(same_id), scratch, "links").withColumnRenamed("node", "rep")
    joined = scratch.save(joined.join(own.select("rep", "least").distinct(), "rep"), "joined")
    least = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    found = counts.withColumnRenamed("id", "rep").join(joined.join(least, "component"), "rep", "full")
    found = scratch.save(found.select("rep", "n", "component_id"), "groups")
    out = own.join(found, "rep", "left").select(
        F.col("id").alias("vec_id"), (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        F.coalesce("component_id", "least").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
