"""C1 search and C2 candidate summary.

Plan shape (see ``explain``): documents are scanned once and sectioned,
flattened, matched and scored inside their own rows (a map-only stage);
applications meet profiles first, then only (path, total, priority) of the
documents with a positive score, and the ranking is a
``TakeOrderedAndProject``. Scoring per document (not per application) means a
CV shared by many applications is matched once.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rows import fence
from ..operators.entries import entries_sql, skills_sql
from ..operators.match import parse_keywords, with_hits
from ..operators.profiles import (attach_biodata, candidate_name, decrypt_names, has_path,
                                  profile_lookup)
from ..operators.score import label_column, top_n, with_scores
from ..operators.sections import flat_text_column, section_content_sql, with_sections

DEFAULT_TOP_N = 3
RANK_TIE_BREAK = ("applicant_id", "cv_path", "detail_id")


def _keywords(keywords: str | Iterable[str]) -> list[str]:
    return parse_keywords(keywords)


def flat_documents(docs: DataFrame, id_cols: Sequence[str] = ("doc_id", "cv_path"),
                   text_col: str = "cv_text") -> DataFrame:
    """``(ids..., flat_text)`` for documents that have text and
    at least one recognised section."""
    d = docs.select(*id_cols, text_col).filter(F.length(text_col) > 0)
    d = with_sections(d, text_col)
    return fence(d.select(*id_cols, flat_text_column().alias("flat_text"))).filter(F.length("flat_text") > 0)


def score_documents(docs: DataFrame, keywords: str | Iterable[str],
                    id_cols: Sequence[str] = ("doc_id", "cv_path"),
                    text_col: str = "cv_text") -> DataFrame:
    """M6/M7 + A1-A3 + P6: per document ``hits``, ``total_matches``,
    ``match_priority`` and ``matched_keywords``; only positive totals."""
    kws = _keywords(keywords)
    d = with_hits(flat_documents(docs, id_cols, text_col), "flat_text", kws)
    return with_scores(d.drop("flat_text"))


def match_details(scores: DataFrame, id_cols: Sequence[str] = ("doc_id", "cv_path")) -> DataFrame:
    """per document the label and the ordered detail strings."""
    return scores.select(*id_cols, "total_matches", "match_priority",
                         label_column(F.col("total_matches"), F.col("match_priority")).alias("match_label"),
                         "matched_keywords")


def top_matches(apps: DataFrame, profiles: DataFrame, docs: DataFrame,
                keywords: str | Iterable[str], n: int = DEFAULT_TOP_N,
                key: str | None = None, doc_key: str = "cv_path") -> DataFrame:
    """The ``n`` best applications -- exact matches first, then by total,
    ties by applicant_id, cv_path, detail_id.

    All texts are read once, for totals and priorities: applications meet their
    profiles first (narrow rows), then those. The ``n`` best rows (the caller's
    number) are found here and now; detail strings are made for their documents
    only, which a second scan finds by the literal values of ``doc_key``: a
    filter that Parquet is asked with, so that it reads the row groups that hold
    them (few, where the documents are sorted by it). A path names one document."""
    kws = _keywords(keywords)
    keys = list(dict.fromkeys(["cv_path", doc_key]))
    scores = score_documents(docs, kws, keys).select(*keys, "total_matches", "match_priority")
    a = apps.select("detail_id", "applicant_id", "cv_path").filter(has_path())
    p = decrypt_names(profiles.select("applicant_id", "first_name", "last_name"), key)
    named = a.join(p, "applicant_id", "inner").select("detail_id", "applicant_id", "cv_path", candidate_name().alias("name"))
    best = top_n(named.join(scores, "cv_path", "inner"), n, RANK_TIE_BREAK).select("detail_id", "applicant_id", "name", *keys)
    rows = best.collect()
    best = docs.sparkSession.createDataFrame(rows, best.schema)
    wanted = sorted({r[doc_key] for r in rows})
    picked = docs.filter(F.col(doc_key).isin(wanted)).select(*keys, "cv_text").join(F.broadcast(best), keys)
    out = score_documents(picked, kws, best.columns)
    return top_n(out.select("applicant_id", "name", "total_matches", "matched_keywords", "cv_path", "match_priority",
                            "detail_id"), n, RANK_TIE_BREAK)


def scan_totals(apps: DataFrame, profiles: DataFrame, docs: DataFrame,
                keywords: str | Iterable[str]) -> DataFrame:
    """A5: applications read (joined to a profile) and applications matched,
    in one pass (left join of scores, one global aggregate)."""
    scores = score_documents(docs, keywords).select("cv_path", "total_matches")
    a = apps.select("applicant_id", "cv_path")
    p = profiles.select("applicant_id")
    j = (a.join(p, "applicant_id", "inner")
          .join(scores, (a["cv_path"] == scores["cv_path"]) & has_path_on(a), "left"))
    return j.agg(F.count(F.lit(1)).alias("cvs_from_db"),
                 F.count_if(F.col("total_matches").isNotNull()).alias("cvs_matched"))


def has_path_on(df: DataFrame):
    return df["cv_path"].isNotNull() & (df["cv_path"] != "")


def document_summaries(docs: DataFrame, id_cols: Sequence[str] = ("doc_id", "cv_path"),
                       text_col: str = "cv_text") -> DataFrame:
    """E2 + E6-E8 per document: skills, experience and education entries."""
    d = with_sections(docs.select(*id_cols, text_col), text_col)
    return d.select(
        *id_cols,
        F.expr(skills_sql(section_content_sql("Skills", "sections"))).alias("skills"),
        F.expr(entries_sql(section_content_sql("Experience", "sections"), "title")).alias("experience"),
        F.expr(entries_sql(section_content_sql("Education", "sections"), "main_info")).alias("education"),
    )


def candidate_summary(apps: DataFrame, profiles: DataFrame, docs: DataFrame,
                      key: str | None = None, require_profile: bool = True) -> DataFrame:
    """For every application with an existing CV, the candidate's name
    and biodata, skills, experience and education. Without ``require_profile``
    an application whose profile is absent stays, with N/A defaults. Narrow
    applications meet their profiles first; the documents' summaries are
    shuffled once, for the last join on ``cv_path``."""
    a = apps.select("detail_id", "applicant_id", "cv_path").filter(has_path())
    named = attach_biodata(a, profile_lookup(profiles, key), require_profile)
    out = named.join(document_summaries(docs).drop("doc_id"), "cv_path", "inner")
    return out.select("detail_id", "applicant_id", "cv_path", "name", "birthdate", "address",
                      "phone", "skills", "experience", "education")
