"""Exact dedup by deterministic block naming.

A text is cut into blocks of fixed size. Every distinct block gets an integer
name: the 64-bit hash of its content picks a bucket, the distinct blocks of a
bucket are sorted, and the name is (bucket, place in the sorted bucket). Two
blocks have the same name exactly when they are equal. Adjacent names are then
paired, and the distinct pairs named the same way, until one name is left for
each text. Texts of equal length pass through the same levels, so (length, last
name) is equal exactly for equal texts.

Almost every bucket holds one distinct block, whose place is 0. The distinct
blocks of every level are shuffled once, combined before the shuffle, so a
block that a third of all texts share costs no more than any other; only
buckets with several distinct blocks are sent back to the texts. Names stay in
an array beside their row, so pairing needs no shuffle.

Everything is DataFrame functions. Defined cases: a null text is empty; empty
texts equal each other; of equal texts the row with the largest doc_id stays (a
null id counts as smallest), and of rows that repeat an id too exactly one
stays; an empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

BLOCK_CHARS = 1024


def _name(bucket: Column, place: Column) -> Column:
    return F.struct(bucket.alias("bucket"), place.alias("place"))


def _bucket(content: Column, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(content), 64 - bits) if bits < 64 else F.xxhash64(content)


def _shared_buckets(df: DataFrame, bits: int) -> DataFrame:
    """``(content, bucket, place)`` of every distinct content whose bucket holds
    more than one; the sorted bucket gives the place."""
    each = df.select(F.explode("contents").alias("content")) \
             .select(_bucket(F.col("content"), bits).alias("bucket"), "content")
    sets = each.groupBy("bucket").agg(F.collect_set("content").alias("distinct"))
    return (sets.filter(F.size("distinct") > 1)
            .select("bucket", F.posexplode(F.array_sort("distinct")).alias("place", "content")))


def _named(df: DataFrame, keep: list[str], shared: DataFrame | None, bits: int) -> DataFrame:
    """``keep`` and ``names``: ``contents`` replaced by their names."""
    if shared is None:
        names = F.transform("contents", lambda c: _name(_bucket(c, bits), F.lit(0)))
        return df.select(*keep, names.alias("names"))
    each = df.select(*keep, F.posexplode("contents").alias("pos", "content")) \
             .withColumn("bucket", _bucket(F.col("content"), bits))
    found = each.join(shared, ["bucket", "content"], "left").select(
        *keep, F.struct("pos", _name(F.col("bucket"), F.coalesce("place", F.lit(0))).alias("name")).alias("at"))
    first = [F.first(c).alias(c) for c in keep if c != "row"]
    return found.groupBy("row").agg(*first, F.array_sort(F.collect_list("at")).alias("at")).select(
        *keep, F.transform("at", lambda a: a["name"]).alias("names"))


def _pairs(names: Column) -> Column:
    half = F.ceil(F.size(names) / 2).cast("int")
    return F.transform(F.sequence(F.lit(0), half - 1),
                       lambda i: F.struct(F.get(names, i * 2).alias("a"), F.get(names, i * 2 + 1).alias("b")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                block_chars: int = BLOCK_CHARS, bucket_bits: int = 64) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``,
    ``kept``, ``text_sha256``. ``bucket_bits`` under 64 makes buckets shared on
    purpose; the result is the same."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact-dedup")
    keep = ["row", "doc_id", "n_chars", "text_sha256"]
    text = F.coalesce(F.col(text_col), F.lit(""))
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))
    level = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
        F.char_length(text).alias("n_chars"), F.sha2(text, 256).alias("text_sha256"),
        F.when(F.size(blocks) == 0, F.array(F.lit(""))).otherwise(blocks).alias("contents"))
    step = 0
    while True:
        shared = scratch.save(_shared_buckets(level, bucket_bits), f"shared-{step}")
        state = scratch.save(_named(level, keep, None if shared.isEmpty() else shared, bucket_bits),
                             f"names-{step}")
        if step:
            scratch.drop(f"names-{step - 1}")
        if state.filter(F.size("names") > 1).isEmpty():
            break
        # one name is the end for a text; it goes on unpaired beside longer ones
        level = state.withColumn("contents", _pairs(F.col("names")))
        step += 1
    state = state.select("row", "doc_id", "text_sha256", "n_chars", F.col("names")[0]["bucket"].alias("bucket"),
                         F.col("names")[0]["place"].alias("place"))
    key = ["n_chars", "bucket", "place"]
    groups = state.groupBy(*key).agg(
        F.max(F.struct("doc_id", "row")).alias("keep"), F.count(F.lit(1)).alias("group_size"))
    groups = scratch.save(groups.filter("group_size > 1"), "groups")
    return state.join(groups, key, "left").select(
        "doc_id", F.when(F.col("keep").isNull(), F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("keep.row") == F.col("row"), F.lit(True)).alias("kept"), "text_sha256")
