"""Sectioning of document text (heading detection, sections, flat text).

Everything here is row-local: a document's lines live in one array column and
are processed with higher-order functions, so sectioning a corpus needs no
shuffle at all -- a 100 TB corpus is sectioned by a map-only stage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rows import explode_rows, fence
from ..functions.sqltext import NL, ident, let, lit, splitlines, strip
from ..functions.text import col_, python_ws_pattern

# The heading vocabulary. Section name and the pattern that
# recognises its heading line. They are tried in this order, case-insensitively,
# from the start of the stripped line; a pattern counts only if what follows
# its match on the line, stripped, is shorter than HEADING_TAIL_LIMIT.
HEADING_PATTERNS: tuple[tuple[str, str], ...] = (
    ("Summary", r"^\s*(SUMMARY|OBJECTIVE|PROFILE|ABOUT\s+ME|RINGKASAN\s*(PRIBADI)?)\s*:?\s*$"),
    ("Experience", r"^\s*(PROFESSIONAL\s+)?EXPERIENCE(S)?|WORK\s+HISTORY|PENGALAMAN\s*(KERJA)?\s*:?\s*$"),
    ("Education", r"^\s*(EDUCATION|EDUCATION\s+AND\s+TRAINING|EDUCATION\s*&\s*TRAINING|ACADEMIC\s+(BACKGROUND|QUALIFICATIONS)|TRAINING|PENDIDIKAN|KUALIFIKASI\s*(AKADEMIK)?)\s*:?\s*$"),
    ("Skills", r"^\s*(TECHNICAL\s+)?SKILLS|COMPETENCIES|PROFICIENCIES|KEMAMPUAN|KEAHLIAN\s*:?\s*$"),
    ("Projects", r"^\s*(PROJECTS|PROYEK)\s*:?\s*$"),
    ("Awards", r"^\s*(AWARDS|HONORS|PENGHARGAAN)\s*:?\s*$"),
    ("Certifications", r"^\s*(CERTIFICATIONS|CERTIFICATES|SERTIFIKASI)\s*:?\s*$"),
    ("Accomplishments", r"^\s*(ACCOMPLISHMENTS|ACHIEVEMENTS|PRESTASI)\s*:?\s*$"),
    ("Languages", r"^\s*(LANGUAGES|BAHASA)\s*:?\s*$"),
    ("Interests", r"^\s*(INTERESTS|MINAT)\s*:?\s*$"),
    ("Personal Information", r"^\s*(PERSONAL\s+INFORMATION|INFORMASI\s+PRIBADI)\s*:?\s*$"),
    ("Additional Information", r"^\s*(ADDITIONAL\s+INFORMATION|INFORMASI\s+TAMBAHAN|LAIN-LAIN)\s*:?\s*$"),
)
HEADING_TAIL_LIMIT = 20

# Fixed value: text given for a section a document does not have.
MISSING_SECTION_FORMAT = "{name} section not found."

def _java_heading_regex(pattern: str) -> str:
    # `match` semantics (every alternative anchored at the line start),
    # Unicode case-insensitivity and Python's notion of whitespace.
    return "(?iu)^(?:" + python_ws_pattern(pattern) + ")"


def heading_sql(s: str, patterns: Sequence[tuple[str, str]] = HEADING_PATTERNS,
                tail_limit: int = HEADING_TAIL_LIMIT) -> str:
    """SQL: section name for the already stripped line ``s``, or null. The
    first pattern that matches *and* leaves a short tail wins; a pattern that
    matches with a long tail falls through to the next one."""
    # A line matching none of the patterns (almost every line) is rejected by
    # one combined regex at the line's start, whatever follows there.
    no_heading = "(?iu)^(?!" + "|".join("(?:" + python_ws_pattern(p) + ")" for _, p in patterns) + ")"
    parts = [f"WHEN {s} RLIKE {lit(no_heading)} THEN CAST(NULL AS string)"]
    for name, pattern in patterns:
        m = f"regexp_extract({s}, {lit(_java_heading_regex(pattern))}, 0)"
        parts.append(f"WHEN length({m}) > 0 AND length({strip(f'substr({s}, length({m}) + 1)')}) "
                     f"< {tail_limit} THEN {lit(name)}")
    return "CASE " + " ".join(parts) + " END"


def starts_sql(lines: str, patterns: Sequence[tuple[str, str]] = HEADING_PATTERNS) -> str:
    """SQL: heading lines ``array<struct<pos, section>>`` of a lines array."""
    tagged = (f"transform(transform({lines}, _l -> {strip('_l')}), "
              f"(_s, _i) -> named_struct('pos', _i, 'section', {heading_sql('_s', patterns)}))")
    return f"filter({tagged}, _x -> _x.section IS NOT NULL)"


def raw_sections_sql(lines: str, starts: str) -> str:
    """SQL: every heading with its content, repeats included: the lines after
    the heading up to the next heading (or the end), joined with newlines and
    stripped. Text before the first heading belongs to no section."""
    content = strip(f"array_join(slice({lines}, _h.pos + 2, "
                    f"coalesce(get({starts}, _j + 1).pos, size({lines})) - _h.pos - 1), {NL})")
    return (f"transform({starts}, (_h, _j) -> named_struct('pos', _h.pos, 'section', _h.section, "
            f"'content', {content}))")


def dedup_sections_sql(raw: str) -> str:
    """SQL: repeated headings keep the first position and the last content,
    in first-seen order."""
    return (f"transform(array_distinct(transform({raw}, _r -> _r.section)), _n -> named_struct("
            f"'section', _n, 'first_pos', get(filter({raw}, _r -> _r.section = _n), 0).pos, "
            f"'content', element_at(filter({raw}, _r -> _r.section = _n), -1).content))")


def sections_sql(text: str, patterns: Sequence[tuple[str, str]] = HEADING_PATTERNS) -> str:
    """SQL: ``array<struct<section, first_pos, content>>`` of a text column;
    lines, heading starts and raw sections are each computed once (``let``)."""
    return let(splitlines(text), "_ls",
               let(starts_sql("_ls", patterns), "_st",
                   let(raw_sections_sql("_ls", "_st"), "_rw", dedup_sections_sql("_rw"))))


def with_sections(df: DataFrame, text_col: str = "cv_text", out: str = "sections",
                  patterns: Sequence[tuple[str, str]] = HEADING_PATTERNS) -> DataFrame:
    """Adds ``out``: the ordered sections of ``text_col`` (row-local)."""
    return df.withColumn(out, F.expr(sections_sql(ident(text_col), patterns)))


def section_starts(df: DataFrame, id_cols: Sequence[str], text_col: str = "cv_text",
                   patterns: Sequence[tuple[str, str]] = HEADING_PATTERNS) -> DataFrame:
    """One row per heading line ``(ids..., pos, section, line_text)``
    (the line as written, before stripping)."""
    heading = let(strip("_l"), "_s", heading_sql("_s", patterns))
    tagged = f"transform(_ls, (_l, _i) -> named_struct('pos', _i, 'section', {heading}, 'line_text', _l))"
    starts = let(splitlines(ident(text_col)), "_ls", f"filter({tagged}, _x -> _x.section IS NOT NULL)")
    return explode_rows(df.select(*id_cols, text_col), id_cols, F.expr(starts), "section")


def section_rows(df: DataFrame, id_cols: Sequence[str], sections_col: str = "sections") -> DataFrame:
    """E2 as a long table ``(ids..., section, first_pos, content)``."""
    return explode_rows(df, id_cols, sections_col, "section")


def flat_text_sql(sections: str) -> str:
    return (f"lower(array_join(transform({sections}, _s -> concat(_s.section, ' ', "
            f"replace(replace(_s.content, {NL}, ' '), {lit('•')}, ''))), ' '))")


def flat_text_column(sections_col: str = "sections") -> Column:
    """``lower(heading) + ' ' + lower(content)`` per section, newlines as
    spaces and bullets (U+2022) removed, joined by a space, lowercased."""
    return F.expr(flat_text_sql(ident(sections_col)))


def structured_text_column(sections_col: str = "sections") -> Column:
    """Heading, blank line, content, blank line -- for every section."""
    c = ident(sections_col)
    return F.expr(f"array_join(transform({c}, _s -> concat(_s.section, {lit(chr(10) * 2)}, "
                  f"_s.content, {lit(chr(10) * 2)})), '')")


def section_content_sql(name: str, sections: str) -> str:
    return f"get(filter({sections}, _s -> _s.section = {lit(name)}), 0).content"


def section_content(name: str, sections_col: str = "sections", default: str | None = None) -> Column:
    """Content of section ``name``; ``default`` (or null) when absent."""
    found = section_content_sql(name, ident(sections_col))
    return F.expr(found if default is None else f"coalesce({found}, {lit(default)})")


def section_lookup(df: DataFrame, id_cols: Sequence[str], name: str,
                   sections_col: str = "sections") -> DataFrame:
    """Per document the named section, or ``'<name> section not found.'``."""
    return df.select(*id_cols, F.lit(name).alias("section"),
                     section_content(name, sections_col,
                                     MISSING_SECTION_FORMAT.format(name=name)).alias("content"))


def flat_texts(df: DataFrame, id_cols: Sequence[str], text_col: str = "cv_text",
               out: str = "flat_text") -> DataFrame:
    """Documents with non-empty text and non-empty flat text."""
    d = df.select(*id_cols, text_col).filter(F.length(col_(text_col)) > 0)
    d = with_sections(d, text_col)
    return fence(d.select(*id_cols, flat_text_column().alias(out))).filter(F.length(out) > 0)
