"""Per-document report -- one section, structured text, flat text,
exact counts (the reference's two exact matchers give the same numbers) and
the fuzzy search -- for every document of a frame (filter the frame first
to report on one document; the filter is pushed to the scan)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sqltext import ident, let, table
from ..operators.match import exact_counts_sql, filled_sql, fuzzy_finish_sql, near_sql, parse_keywords, words_sql
from ..operators.sections import (MISSING_SECTION_FORMAT, flat_text_column, section_content,
                                  structured_text_column, with_sections)


def document_report(docs: DataFrame, keywords: str | Iterable[str], section: str = "Experience",
                    id_cols: Sequence[str] = ("doc_id",), text_col: str = "cv_text") -> DataFrame:
    """``(ids..., section_text, structured_text, flat_text, counts)`` where
    ``counts`` is ``array<struct<keyword, exact, fuzzy_n, fuzzy_words>>`` over
    the flat text, every keyword reported (zeros included)."""
    kws = parse_keywords(keywords)
    d = with_sections(docs.select(*id_cols, text_col), text_col)
    d = d.select(*id_cols,
                 section_content(section, default=MISSING_SECTION_FORMAT.format(name=section)).alias("section_text"),
                 structured_text_column().alias("structured_text"),
                 flat_text_column().alias("flat_text"))
    f = ident("flat_text")
    every = filled_sql(near_sql(kws), kws, "'f', CAST(array() AS array<string>)")
    item = let(fuzzy_finish_sql("_t.f"), "_z",
               f"named_struct('keyword', get({table(kws, 'array<string>')}, _t.i), 'exact', get(_c, _t.i), "
               f"'fuzzy_n', _z.n, 'fuzzy_words', _z.words)")
    body = let(exact_counts_sql(f, kws), "_c", words_sql(f, kws, f"transform({every}, _t -> {item})"))
    return d.withColumn("counts", F.expr(body))
