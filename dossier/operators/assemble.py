"""Assemble one text per document from ordered parts (pages, turns).

Two aggregation levels keep a very long document from being sorted in one
task: parts are first joined in runs of ``PARTS_PER_RUN`` consecutive
positions (a shuffle on ``(doc, run)``, spread over many tasks even for one
huge document), then the runs -- ``1/PARTS_PER_RUN`` as many rows -- are
joined per document. The output row itself is the whole document, as asked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTS_PER_RUN = 1024


def _ordered_join(col: str, sep: str) -> F.Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_pos", col))),
                                    lambda s: s[col]), sep)


def assemble_documents(parts: DataFrame, doc_col: str, pos_col: str, text_col: str,
                       sep: str = "", out: str = "text",
                       parts_per_run: int = PARTS_PER_RUN) -> DataFrame:
    """``(doc_col, out)``: ``text_col`` of each document's parts joined with
    ``sep`` in ``pos_col`` order (pages are joined with no separator)."""
    p = parts.select(F.col(doc_col), F.col(pos_col).alias("_pos"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    runs = (p.withColumn("_run", F.floor(F.col("_pos") / parts_per_run))
             .groupBy(doc_col, "_run")
             .agg(F.min("_pos").alias("_first"), _ordered_join("_t", sep).alias("_t")))
    runs = runs.select(doc_col, F.col("_first").alias("_pos"), "_t")
    return runs.groupBy(doc_col).agg(_ordered_join("_t", sep).alias(out))
