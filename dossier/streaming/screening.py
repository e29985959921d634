"""Screening documents as they arrive (Structured Streaming).

No new operator: the batch scoring (sectioning, exact-then-fuzzy matching,
per-document totals) is row-local and stateless, so the very same plan runs
on a stream in append mode -- each document is scored once, when it
arrives, with no state store and no watermark. The sink is a file table
(exactly-once through the checkpoint), so a lost executor or a restarted
driver resumes where the last committed batch ended.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.search import score_documents

SCORE_COLUMNS = ("total_matches", "match_priority", "matched_keywords")


def screen_stream(docs: DataFrame, keywords: str | Iterable[str],
                  id_cols: Sequence[str] = ("doc_id", "cv_path"), text_col: str = "cv_text") -> DataFrame:
    """Streaming (or batch) frame of ``(ids..., total_matches,
    match_priority, matched_keywords)`` for documents with a positive score."""
    return score_documents(docs, keywords, id_cols, text_col).select(*id_cols, *SCORE_COLUMNS)


def start_screening(spark: SparkSession, source_dir: str, schema: str, keywords: str | Iterable[str],
                    out_dir: str, checkpoint_location: str,
                    id_cols: Sequence[str] = ("doc_id", "cv_path"), text_col: str = "cv_text",
                    available_now: bool = False, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Watch ``source_dir`` (parquet files of ``schema``) and append scores
    to ``out_dir``. ``checkpoint_location``: a shared folder of this stream's
    own."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    docs = reader.parquet(source_dir)
    scores = screen_stream(docs, keywords, id_cols, text_col)
    writer = (scores.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint_location).option("path", out_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
