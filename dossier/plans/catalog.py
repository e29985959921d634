"""The registered queries: each reads the test tables under a base folder and
returns one DataFrame. Parameters (keywords, top-N, key) are fixed here so a
query always means the same thing; array results are rendered as joined text
so they compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import col_
from ..operators import assemble, entries, manifest, match, match_table, obfuscate, profiles, sections
from ..sources import fixtures as fx
from ..sources.tables import read_table
from . import report, search

# Query parameters.
RAW_KEYWORDS = "License, lisense, thing, reserved,, nation , license, machine, the and, tionre, intelligence"
SEARCH_KEYWORDS = "License, lisense, thing, reserved,, nation , license, the and, experienec, tionre"
TOP_N = 20
DEMO_KEY = "dossier-demo-key-é"  # any key works; non-ASCII on purpose
LOOKUP_SECTION = "Education"
LOOKUP_ID = 7
# nested and overlapping keywords and prefixes of each other: 392 of them
SYLLABLES = ["".join(x) for n in (2, 3) for x in product("aeinrst", repeat=n)]
MANY_WORDS = [a + b for a in ("licens", "report", "analyst", "financ", "python", "account", "manag", "engineer")
              for b in ("", "e", "s", "ed", "er", "ing")]
REPORT_KEYWORDS = "license, thing, tionre, pyton"
REPORT_SECTION = "Experience"
LIST_SEP = " | "
ENTRY_SEP = " :: "

ID = ["doc_id"]


def _raw_docs(spark: SparkSession, base: str) -> DataFrame:
    d = read_table(spark, base, "documents", ["doc_id", "text"], fx.scan_tasks(spark), ["doc_id"])
    return d.select("doc_id", F.lower("text").alias("text"))


def _joined(c, sep: str = LIST_SEP):
    return F.array_join(col_(c), sep)


def _entries_text(c, first: str):
    return F.array_join(F.transform(col_(c), lambda e: F.concat_ws(ENTRY_SEP, e[first], e["details"])), LIST_SEP)


def _sectioned(spark, base):
    return sections.with_sections(fx.cv_documents(spark, base), "cv_text")


# ----------------------------------------------------------------- queries
def q_application_profiles(spark, base):
    return profiles.application_profiles(fx.applications(spark, base), fx.profiles(spark, base))


def q_existing_applications(spark, base):
    return profiles.existing_applications(fx.applications(spark, base), fx.profiles(spark, base),
                                          fx.cv_documents(spark, base))


def q_profile_lookup(spark, base):
    p = profiles.profile_lookup(fx.profiles(spark, base))
    return p.withColumn("date_of_birth", F.col("date_of_birth").cast("string"))


def q_profile_by_id(spark, base):
    p = profiles.profile_lookup(fx.profiles(spark, base), applicant_id=LOOKUP_ID)
    return p.withColumn("date_of_birth", F.col("date_of_birth").cast("string"))


def q_parse_keywords(spark, base):
    conv = read_table(spark, base, "conversations", ["conv_id", "turn", "text"], fx.scan_tasks(spark),
                      ["conv_id", "turn"])
    return match.parse_keyword_table(conv, ["conv_id", "turn"], "text")


def q_keyword_counts(spark, base):
    return match.keyword_counts(_raw_docs(spark, base), ID, "text", match.parse_keywords(RAW_KEYWORDS))


def q_keyword_counts_many(spark, base):
    return match.keyword_counts(_raw_docs(spark, base), ID, "text", match.parse_keywords(SYLLABLES))


def _keyword_table(spark, base):
    """A table of keywords: the first long word of each turn."""
    conv = read_table(spark, base, "conversations", ["text"], None)
    return conv.select(F.regexp_extract("text", "[A-Za-z]{4,9}", 0).alias("keyword"))


def q_keyword_table_counts(spark, base):
    return match_table.count_keyword_table(_raw_docs(spark, base), ID, "text", _keyword_table(spark, base))


def q_keyword_table_near(spark, base):
    h = match_table.near_keyword_table(_raw_docs(spark, base), ID, "text", _keyword_table(spark, base))
    return h.withColumn("words", _joined("words", ", "))


def q_edit_distance(spark, base):
    p = fx.profiles(spark, base)
    return p.select("applicant_id", "first_name", "last_name",
                    match.edit_distance("first_name", "last_name").alias("distance"),
                    match.edit_distance("first_name", "last_name", 9).alias("distance_within_9"))


def q_fuzzy_hits(spark, base):
    h = match.fuzzy_hits(_raw_docs(spark, base), ID, "text", match.parse_keywords(RAW_KEYWORDS))
    return h.withColumn("words", _joined("words", ", "))


def q_keyword_hits(spark, base):
    flat = search.flat_documents(fx.cv_documents(spark, base), ID)
    h = match.keyword_hits(flat, ID, "flat_text", match.parse_keywords(SEARCH_KEYWORDS))
    return h.withColumn("words", _joined("words", ", "))


def q_keyword_hits_many(spark, base):
    flat = search.flat_documents(fx.cv_documents(spark, base), ID)
    h = match.keyword_hits(flat, ID, "flat_text", match.parse_keywords(MANY_WORDS))
    return h.withColumn("words", _joined("words", ", "))


def q_document_scores(spark, base):
    s = search.score_documents(fx.cv_documents(spark, base), SEARCH_KEYWORDS)
    return s.select("doc_id", "cv_path", "total_matches", "match_priority")


def q_match_details(spark, base):
    s = search.match_details(search.score_documents(fx.cv_documents(spark, base), SEARCH_KEYWORDS))
    return s.withColumn("matched_keywords", _joined("matched_keywords"))


def q_top_matches(spark, base):
    t = search.top_matches(fx.applications(spark, base), fx.profiles(spark, base),
                           fx.cv_documents(spark, base), SEARCH_KEYWORDS, TOP_N, doc_key="doc_id")
    return t.withColumn("matched_keywords", _joined("matched_keywords"))


def q_search_encrypted(spark, base):
    hidden = obfuscate.encrypt_profiles(fx.profiles(spark, base), DEMO_KEY)
    t = search.top_matches(fx.applications(spark, base), hidden, fx.cv_documents(spark, base), SEARCH_KEYWORDS,
                           TOP_N, DEMO_KEY, doc_key="doc_id")
    return t.withColumn("matched_keywords", _joined("matched_keywords"))


def q_document_report(spark, base):
    r = report.document_report(fx.cv_documents(spark, base), REPORT_KEYWORDS, REPORT_SECTION, ID)
    told = F.transform("counts", lambda c: F.concat_ws(":", c["keyword"], c["exact"].cast("string"),
                                                       c["fuzzy_n"].cast("string"), F.array_join(c["fuzzy_words"], ",")))
    return r.withColumn("counts", F.array_join(told, LIST_SEP))


def q_scan_totals(spark, base):
    return search.scan_totals(fx.applications(spark, base), fx.profiles(spark, base),
                              fx.cv_documents(spark, base), SEARCH_KEYWORDS)


def q_section_starts(spark, base):
    return sections.section_starts(fx.cv_documents(spark, base), ID, "cv_text")


def q_sections(spark, base):
    return sections.section_rows(_sectioned(spark, base), ID)


def q_flat_text(spark, base):
    return sections.flat_texts(fx.cv_documents(spark, base), ID, "cv_text")


def q_structured_text(spark, base):
    return _sectioned(spark, base).select("doc_id", sections.structured_text_column().alias("structured_text"))


def q_section_lookup(spark, base):
    return sections.section_lookup(_sectioned(spark, base), ID, LOOKUP_SECTION)


def q_experience_entries(spark, base):
    return entries.experience_entries(_sectioned(spark, base), ID)


def q_education_entries(spark, base):
    return entries.education_entries(_sectioned(spark, base), ID)


def q_skills(spark, base):
    s = entries.skills(_sectioned(spark, base), ID)
    return s.select("doc_id", F.size("skills").alias("n_skills"), _joined("skills").alias("skills"))


def q_candidate_summary(spark, base, require_profile=True):
    s = search.candidate_summary(fx.applications(spark, base), fx.profiles(spark, base),
                                 fx.cv_documents(spark, base), require_profile=require_profile)
    return s.select("detail_id", "applicant_id", "cv_path", "name", "birthdate", "address", "phone",
                    _joined("skills").alias("skills"),
                    _entries_text("experience", "title").alias("experience"),
                    _entries_text("education", "main_info").alias("education"))


def q_candidate_summary_all(spark, base):
    return q_candidate_summary(spark, base, require_profile=False)


def q_encrypt_profiles(spark, base):
    return obfuscate.encrypt_profiles(fx.profiles(spark, base), DEMO_KEY)


def q_decrypt_profiles(spark, base):
    enc = obfuscate.encrypt_profiles(fx.profiles(spark, base), DEMO_KEY)
    p = profiles.profile_lookup(enc, DEMO_KEY)
    return p.withColumn("date_of_birth", F.col("date_of_birth").cast("string"))


def q_encryption_audit(spark, base):
    return obfuscate.encryption_audit(fx.profiles(spark, base), DEMO_KEY)


def _listing(spark, base):
    d = read_table(spark, base, "documents", ["doc_id", "source"])
    return d.select(F.col("source").alias("application_role"),
                    F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("file_name"))


def q_manifest_top_per_role(spark, base):
    return manifest.manifest_top_per_role(_listing(spark, base))


def q_append_applications(spark, base):
    return manifest.append_applications(fx.applications(spark, base),
                                        manifest.manifest_top_per_role(_listing(spark, base)))


def q_append_checked(spark, base):
    return manifest.append_applications(fx.applications(spark, base), fx.manifest_rows(spark, base))


def q_append_audit(spark, base):
    return manifest.append_audit(fx.manifest_rows(spark, base))


def q_manifest_preview(spark, base):
    return manifest.manifest_preview(manifest.manifest_top_per_role(_listing(spark, base)))


def q_assemble_documents(spark, base):
    conv = read_table(spark, base, "conversations", ["conv_id", "turn", "text"])
    return assemble.assemble_documents(conv, "conv_id", "turn", "text", out="text")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "application_profiles": q_application_profiles,
    "existing_applications": q_existing_applications,
    "profile_lookup": q_profile_lookup,
    "profile_by_id": q_profile_by_id,
    "parse_keywords": q_parse_keywords,
    "keyword_counts": q_keyword_counts,
    "keyword_table_counts": q_keyword_table_counts,
    "keyword_table_near": q_keyword_table_near,
    "keyword_counts_many": q_keyword_counts_many,
    "edit_distance": q_edit_distance,
    "fuzzy_hits": q_fuzzy_hits,
    "keyword_hits": q_keyword_hits,
    "keyword_hits_many": q_keyword_hits_many,
    "document_scores": q_document_scores,
    "match_details": q_match_details,
    "top_matches": q_top_matches,
    "search_encrypted": q_search_encrypted,
    "scan_totals": q_scan_totals,
    "document_report": q_document_report,
    "section_starts": q_section_starts,
    "sections": q_sections,
    "flat_text": q_flat_text,
    "structured_text": q_structured_text,
    "section_lookup": q_section_lookup,
    "experience_entries": q_experience_entries,
    "education_entries": q_education_entries,
    "skills": q_skills,
    "candidate_summary": q_candidate_summary,
    "candidate_summary_all": q_candidate_summary_all,
    "encrypt_profiles": q_encrypt_profiles,
    "decrypt_profiles": q_decrypt_profiles,
    "encryption_audit": q_encryption_audit,
    "manifest_top_per_role": q_manifest_top_per_role,
    "append_applications": q_append_applications,
    "append_checked": q_append_checked,
    "append_audit": q_append_audit,
    "manifest_preview": q_manifest_preview,
    "assemble_documents": q_assemble_documents,
}
