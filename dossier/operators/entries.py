"""Entry and skill extraction from section blocks.

Row-local like sectioning: a block's lines are an array in the document's
row, the "next line" look-ahead is ``get(lines, i + 1)`` and the
gaps-and-islands grouping of lines into entries is done by marking entry
starts inside one joined string, so no window or shuffle is involved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rows import explode_rows
from ..functions.sqltext import NL, ident, let, lit, split_ws, splitlines, starts_with_any, strip
from ..functions.text import WS_CLASS
from .sections import section_content_sql

# Line prefixes treated as bullets, the year pattern, the word
# limit of a title line, the block guard text.
BULLET_PREFIXES = ("-", "*", "•", "#", "o ")
YEAR_PATTERN = r"(?U)\b\d{4}\b"
TITLE_MAX_WORDS = 7
GUARD_TEXT = "not found"

# Fixed values for skills: leading bullet characters, item separators.
SKILL_BULLETS = "-*•–✔"
SKILL_MIN_LENGTH = 1  # items must be longer than this
SKILL_COLON_MIN_WORDS = 4  # items with ':' need at least this many words


def _guarded_sql(b: str) -> str:
    """SQL: the block is present, not blank and has no guard text."""
    return f"({b} IS NOT NULL AND {strip(b)} != '' AND NOT contains(lower({b}), {lit(GUARD_TEXT)}))"


def _is_entry_start_sql(line: str, nxt: str) -> str:
    """SQL E5: a non-blank, non-bullet line that has a year, or is short
    (< 7 words) and followed by a non-bullet line with a year."""
    s, ns = strip(line), strip(nxt)
    year = lit(YEAR_PATTERN)
    return (f"({s} != '' AND NOT {starts_with_any(s, BULLET_PREFIXES)} AND ("
            f"{s} RLIKE {year} OR ({nxt} IS NOT NULL AND {ns} RLIKE {year} "
            f"AND NOT {starts_with_any(ns, BULLET_PREFIXES)} "
            f"AND size({split_ws(s, '_t')}) < {TITLE_MAX_WORDS})))")


def entries_sql(block: str, first_field: str = "title") -> str:
    """SQL E6/E7: ``array<struct<entry_no, <first_field>, details>>``.

    Lines are the block stripped and split on newlines; blank lines still
    count as the next line for E5 but are dropped from entries. Each start
    line opens a new entry (lines before the first start form their own
    entry); the first line of an entry is its title, the rest (joined,
    stripped) its details. Starts are marked with an extra newline in one
    joined string -- lines never contain one, so a blank line can only be an
    entry boundary -- and the string is split on it (no window, no shuffle)."""
    flagged = (f"filter(transform(_bl, (_l, _i) -> named_struct('line', _l, 'start', "
               f"{_is_entry_start_sql('_l', 'get(_bl, _i + 1)')})), _x -> {strip('_x.line')} != '')")
    joined = (f"array_join(transform(_kl, (_x, _j) -> concat(CASE WHEN _x.start AND _j > 0 "
              f"THEN {NL} ELSE '' END, _x.line)), {NL})")
    chunks = f"filter(split({joined}, {lit(chr(10) * 2)}, -1), _e -> _e != '')"
    entry = (f"named_struct('entry_no', _k + 1, {lit(first_field)}, {strip(f'get(split(_e, {NL}, 2), 0)')}, "
             f"'details', {strip(f'coalesce(get(split(_e, {NL}, 2), 1), {chr(39)}{chr(39)})')})")
    body = let(f"split({strip('_b')}, {NL}, -1)", "_bl",
               let(flagged, "_kl", f"transform({chunks}, (_e, _k) -> {entry})"))
    empty = f"CAST(array() AS array<struct<entry_no:int,{first_field}:string,details:string>>)"
    return let(block, "_b", f"CASE WHEN {_guarded_sql('_b')} THEN {body} ELSE {empty} END")


def entries_column(block_col: str, first_field: str = "title") -> Column:
    """E6/E7 over a column holding section blocks."""
    return F.expr(entries_sql(ident(block_col), first_field))


def skills_sql(block: str) -> str:
    """SQL E8: sorted distinct skills of a block (case-insensitive order,
    equal lowercase forms ordered by their exact text)."""
    ws = WS_CLASS
    t = f"regexp_replace(_b, {lit('(?md)^' + ws + '*[' + SKILL_BULLETS + ']' + ws + '+')}, '')"
    t = f"regexp_replace({t}, {lit(ws + '*;' + ws + '*')}, ',')"
    lines = f"filter(transform({splitlines(t)}, _l -> {strip('_l')}), _l -> _l != '')"
    parts = f"transform({lines}, _l -> element_at(split(_l, {lit(':' + ws + '+')}, 2), -1))"
    items = (f"flatten(transform({parts}, _p -> transform(split(_p, {lit(',' + ws + '*')}, -1), "
             f"_i -> regexp_replace({strip('_i')}, {lit(chr(92) + '.+' + chr(92) + 'z')}, ''))))")
    keep = (f"filter({items}, _i -> length(_i) > {SKILL_MIN_LENGTH} AND NOT (contains(_i, ':') "
            f"AND size({split_ws('_i', '_u')}) < {SKILL_COLON_MIN_WORDS}))")
    order = ("(_a, _z) -> CASE WHEN lower(_a) < lower(_z) THEN -1 WHEN lower(_a) > lower(_z) THEN 1 "
             "WHEN _a < _z THEN -1 WHEN _a > _z THEN 1 ELSE 0 END")
    return let(block, "_b", f"CASE WHEN {_guarded_sql('_b')} THEN array_sort(array_distinct({keep}), {order}) "
                            f"ELSE CAST(array() AS array<string>) END")


def skills_column(block_col: str) -> Column:
    """E8 over a column holding section blocks."""
    return F.expr(skills_sql(ident(block_col)))


def experience_entries(df: DataFrame, id_cols: Sequence[str], sections_col: str = "sections",
                       section: str = "Experience") -> DataFrame:
    """E6 rows ``(ids..., entry_no, title, details)``."""
    block = section_content_sql(section, ident(sections_col))
    return explode_rows(df, id_cols, F.expr(entries_sql(block, "title")), "entry_no")


def education_entries(df: DataFrame, id_cols: Sequence[str], sections_col: str = "sections",
                      section: str = "Education") -> DataFrame:
    """E7 rows ``(ids..., entry_no, main_info, details)``."""
    block = section_content_sql(section, ident(sections_col))
    return explode_rows(df, id_cols, F.expr(entries_sql(block, "main_info")), "entry_no")


def skills(df: DataFrame, id_cols: Sequence[str], sections_col: str = "sections",
           section: str = "Skills") -> DataFrame:
    """E8 per document ``(ids..., skills array<string>)``."""
    block = section_content_sql(section, ident(sections_col))
    return df.select(*id_cols, F.expr(skills_sql(block)).alias("skills"))
