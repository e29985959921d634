"""Mixing sources to target weights by subset-sum budget fitting.

Targets share a budget (a multiple of all sizes) by weight; a target above its
cap (``max_epochs`` times its source) stops there and the excess goes to the
others by weight, until none is above.

Whole epochs of a source are taken first. For the budget that is left, the
documents of a source are counted by exact length. A length count is first
taken in proportion; the rest of the budget, by then under the sum of the
distinct lengths, is lowered with the largest lengths that fit to less than
``DP_WORDS`` and then met by a bounded-knapsack dynamic programme over the
counts that are left (counts split into powers of two, reachable sums as the
bits of an integer). A source is one row per distinct length there, never its
documents. The documents of a length are then selected by seeded hash: counted
per hash bucket, whole buckets first, and only the last bucket is ordered, so
a source or length that holds a third of all rows is never one task.

The rank of a source (its weight) comes from ranges numbered in parallel; the
targets from sums over the source table.

Defined cases: a null text has size 0 and is never taken; a null source is a
source of its own, last; a source of size 0 has target 0; repeated rows are
documents of their own; an empty table gives an empty result. The same rows
give the same mix on every run (of rows with one doc_id and size, in the bucket
that is ordered, any may be the one taken).
"""

from __future__ import annotations

import math
from decimal import Decimal
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, numbered

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
BUDGET = Fraction(3, 2)
MAX_EPOCHS = 2
SEED = 17
BUCKETS = 1 << 16
DP_WORDS = 1 << 17
EXACT = "decimal(38,0)"


def _exact(n: int) -> Column:
    return F.lit(Decimal(n)).cast(EXACT)


def targets(sources: DataFrame, scratch: Scratch, weights: tuple[int, ...] = WEIGHTS,
            budget: Fraction = BUDGET, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(source, source_size)`` with ``target``; the shares are exact integers
    until the last division."""
    ranked = numbered(sources, scratch, "sources-ranked", "source")
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("_index") % len(weights) + 1).cast("int"))
    ranked = scratch.save(ranked.withColumn("_w", w.cast("long")), "sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    share, capped = Fraction(0), None
    while True:  # words per unit of weight; grows until no further source is above its cap
        above = F.col("source_size").cast(EXACT) * _exact(max_epochs * share.denominator) \
            <= F.col("_w").cast(EXACT) * _exact(share.numerator)
        r = ranked.agg(F.sum(F.when(above, F.col("source_size"))).alias("cap"), F.count_if(above).alias("n"),
                       F.sum(F.when(~above, F.col("_w"))).alias("w")).first()
        if r["n"] == capped or not r["w"]:
            break
        capped, share = r["n"], (budget * total - max_epochs * (r["cap"] or 0)) / r["w"]
    target = F.least(F.col("source_size") * float(max_epochs), F.col("_w") * F.lit(float(share)))
    return ranked.select("source", "source_size", target.cast("double").alias("target"))


def fit(lengths: list[int], counts: list[int], budget: int, dp_words: int = DP_WORDS) -> list[int]:
    """How many documents of each length to take so that their words come as
    near to ``budget`` as the counts allow, without passing it."""
    total = sum(n * c for n, c in zip(lengths, counts))
    if budget >= total:
        return list(counts)
    take = [c * budget // total for c in counts]
    rest = budget - sum(n * t for n, t in zip(lengths, take))
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    for i in order:  # largest first, until the programme can hold the rest
        if rest < dp_words:
            break
        k = min(counts[i] - take[i], (rest - dp_words // 2) // lengths[i])
        take[i] += max(k, 0)
        rest -= lengths[i] * max(k, 0)
    while rest >= dp_words:  # only lengths near the programme's size are left
        i = next((i for i in order if lengths[i] <= rest and take[i] < counts[i]), None)
        if i is None:
            return take
        take[i] += 1
        rest -= lengths[i]
    for i in order[::-1]:  # give some back, so that the programme can choose
        k = max(0, min(take[i], 4, (dp_words - 1 - rest) // lengths[i]))
        take[i] -= k
        rest += k * lengths[i]
    parts = []  # (length, documents): every count as powers of two and a rest
    for i in order:
        left, k = min(counts[i] - take[i], rest // lengths[i]), 1
        while left > 0:
            k = min(k, left)
            parts.append((i, k))
            left -= k
            k *= 2
    mask, every = (1 << (rest + 1)) - 1, math.isqrt(len(parts)) + 1

    def reached(sums: int, step: int) -> int:
        i, k = parts[step]
        return (sums | sums << (k * lengths[i])) & mask

    marks, sums, used = [], 1, 0  # the sums before every so many parts; those between are made again
    while used < len(parts) and not sums >> rest & 1:
        if used % every == 0:
            marks.append(sums)
        sums = reached(sums, used)
        used += 1
    at = sums.bit_length() - 1  # the largest sum that can be reached
    for first in range((len(marks) - 1) * every, -1, -every):
        before = [marks.pop()]
        for step in range(first, min(first + every, used) - 1):
            before.append(reached(before[-1], step))
        for step in range(first + len(before) - 1, first - 1, -1):
            i, k = parts[step]
            if not before[step - first] >> at & 1:
                take[i] += k
                at -= k * lengths[i]
    return take


def _null_safe(a: DataFrame, b: DataFrame, keys: list[str], how: str) -> DataFrame:
    b = b.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in b.columns if c not in keys])
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return a.join(b, cond, how).drop(*[f"_{k}" for k in keys])


def _bucket(seed: int) -> tuple[Column, Column]:
    h = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("size"))
    return F.shiftrightunsigned(h, 64 - (BUCKETS.bit_length() - 1)).cast("int"), h


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, budget: Fraction = BUDGET, max_epochs: int = MAX_EPOCHS,
        seed: int = SEED) -> DataFrame:
    """``doc_id, size, source, source_size, target, copies, taken``: one row per
    row of ``docs``; ``copies`` says how often the mix takes it."""
    scratch = Scratch(docs.sparkSession, "mixing")
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    sized = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                        size.alias("size"))
    bucket, h = _bucket(seed)
    sized = scratch.save(sized.withColumn("hash", h).withColumn("bucket", bucket), "sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = scratch.save(targets(sources, scratch, weights, budget, max_epochs), "targets")

    # documents of each length to take besides the whole epochs
    lengths = scratch.save(sized.filter("size > 0").groupBy("source", "size", "bucket")
                           .agg(F.count(F.lit(1)).alias("n")), "lengths")
    by_length = _null_safe(lengths.groupBy("source", "size").agg(F.sum("n").alias("n")), goal, ["source"], "inner")

    def fitted(g: pd.DataFrame) -> pd.DataFrame:
        total, target = int(g["source_size"].iloc[0]), float(g["target"].iloc[0])
        epochs = min(int(target // total), max_epochs)
        left = 0 if epochs == max_epochs else round(target) - epochs * total
        g = g.sort_values("size")
        take = fit(g["size"].tolist(), g["n"].tolist(), max(left, 0))
        return pd.DataFrame({"source": g["source"], "size": g["size"], "epochs": epochs, "more": take})

    takes = by_length.groupBy("source").applyInPandas(fitted, "source string, size long, epochs long, more long")
    takes = scratch.save(takes, "takes")

    # whole hash buckets up to that number, the last one by hash and id
    w = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    filled = _null_safe(lengths, takes, ["source", "size"], "inner") \
        .withColumn("left", F.col("more") - F.coalesce(F.sum("n").over(w), F.lit(0))) \
        .select("source", "size", "bucket", "epochs",
                F.greatest(F.least("left", "n"), F.lit(0)).alias("pick"), "n")
    filled = scratch.save(filled, "picks")
    rows = _null_safe(sized, filled, ["source", "size", "bucket"], "left")
    whole = rows.filter("pick is null or pick = 0 or pick = n").withColumn(
        "copies", F.when(F.col("n").isNull(), F.lit(0))
        .otherwise(F.col("epochs") + F.when(F.col("pick") == F.col("n"), 1).otherwise(0)))
    order = Window.partitionBy("source", "size", "bucket").orderBy("hash", "doc_id")
    partial = rows.filter("pick > 0 and pick < n").withColumn(
        "copies", F.col("epochs") + F.when(F.row_number().over(order) <= F.col("pick"), 1).otherwise(0))
    out = whole.unionByName(partial).select("doc_id", "source", "size", F.col("copies").cast("long").alias("copies"))
    return _null_safe(out, goal, ["source"], "left").select(
        "doc_id", "size", "source", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
