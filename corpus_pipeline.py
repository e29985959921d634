"""From ``documents`` to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` with the columns of ``documents``
and works on all rows that its predecessor kept; between stages the rows are a
Parquet table. All but the last return those columns:

1. language: rows whose text has no language (null, or without any letter) go;
   where no language can be learned, or one is labelled ``und``, the same rows go;
2. exact dedup: of equal texts the row with the largest doc_id stays;
3. near dedup: of linked documents (five-word shingles, Jaccard ``NEAR_PERCENT``
   or more) the one with the smallest doc_id stays; with ``NEAR_BANDS`` bands of
   ``NEAR_ROWS`` a pair at 0.80 shares none with probability 3e-6;
4. mixing: each row is there as often as the mix takes it (0, 1 or 2 times);
5. packing: one row per piece, see ``packing.SCHEMA``; a row that is there
   twice is packed twice.

Rows are matched to decisions by doc_id (and text or size): rows that repeat a
doc_id with different texts are decided by stage 3 together, and by stage 4
together where source and size agree (the larger count holds for both). Rows
without doc_id are matched with each other. An empty table stays empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.llm.common import Scratch, read, ship
from dossier.llm.exact_dedup import exact_dedup
from dossier.llm.langid import UNKNOWN, has_letter, language, learn
from dossier.llm.minhash_dedup import near_dedup
from dossier.llm.mixing import WORD, mix
from dossier.llm.packing import pack_documents
from dossier.llm.queries import tokenizer

END_ID = 2
NEAR_PERCENT, NEAR_BANDS, NEAR_ROWS = 80, 32, 5


def _tag() -> str:
    """Begins names that no column of the documents has."""
    return f"_{uuid.uuid4().hex}_"


def _matched(docs: DataFrame, decisions: DataFrame, keys: dict[str, Column], how: str, tag: str) -> DataFrame:
    """``docs`` joined to ``decisions`` (their columns begin with ``tag``) on
    ``keys`` (name there: value here); nulls match."""
    own = decisions.select([F.col(c).alias(tag + c) for c in decisions.columns])
    cond = F.lit(True)
    for name, value in keys.items():
        cond = cond & value.eqNullSafe(F.col(tag + name))
    return docs.join(own, cond, how)


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    profiles = learn(docs)
    if not profiles.langs or UNKNOWN in profiles.langs:  # und is no sign of a text without letters
        return docs.filter(has_letter()(F.col("text")))
    return docs.filter(language(profiles)(F.col("text"))["lang_pred"] != UNKNOWN)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    stays = exact_dedup(docs).filter("kept").select("doc_id", "text_sha256")
    sha = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    once = _matched(docs, stays.distinct(), {"doc_id": F.col("doc_id"), "text_sha256": sha}, "left_semi", _tag())
    again = docs.select("doc_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if again.isEmpty():  # ids must be unique; where not, equal rows are one
        return once
    own = _tag()
    return once.withColumn(own, sha).dropDuplicates(["doc_id", own]).drop(own)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    found = near_dedup(docs, percent=NEAR_PERCENT, bands=NEAR_BANDS, rows=NEAR_ROWS)
    stays = found.filter("kept").select("doc_id").distinct()
    return _matched(docs, stays, {"doc_id": F.col("doc_id")}, "left_semi", _tag())


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    takes = mix(docs).filter("copies > 0").groupBy("doc_id", "source", "size").agg(F.max("copies").alias("copies"))
    size = F.regexp_count(F.col("text"), F.lit(WORD)).cast("long")
    own = _tag()
    rows = _matched(docs, takes, {"doc_id": F.col("doc_id"), "source": F.col("source"), "size": size}, "inner", own)
    return rows.withColumn(own, F.explode(F.sequence(F.lit(1).cast("long"), F.col(own + "copies")))).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return pack_documents(docs, tokenizer("word_bpe_49k.json"), END_ID)


STAGES = [("language", by_language), ("exact_dedup", without_copies), ("near_dedup", without_near_copies),
          ("mixing", mixed), ("packing", packed)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
