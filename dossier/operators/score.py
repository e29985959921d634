"""Per-document scores, detail strings and ranking.

Totals, priority and details are folded from the document's own hit array
(``aggregate``/``transform``), so scoring adds no shuffle; only the final
top-N goes through ``TakeOrderedAndProject`` (per-partition top-N, then a
merge of N rows per partition).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rows import fence
from ..functions.sqltext import ident, lit

# Result text formats.
OCCURRENCE_SINGULAR, OCCURRENCE_PLURAL = "occurrence", "occurrences"
FUZZY_TAG = " (fuzzy)"
MATCHED_WORDS_OPEN, MATCHED_WORDS_CLOSE = " (kata cocok: ", ")"
MATCH_SINGULAR, MATCH_PLURAL = "match", "matches"
EXACT_LABEL, FUZZY_ONLY_LABEL = "(Exact)", "(Fuzzy Only)"
PRIORITY_EXACT, PRIORITY_FUZZY_ONLY = 1, 2


def _cap(x: str) -> str:
    return f"concat(upper(substr({x}, 1, 1)), lower(substr({x}, 2)))"


def total_sql(hits: str) -> str:
    """A1: sum of exact and fuzzy counts."""
    return f"CAST(aggregate({hits}, 0, (_a, _h) -> _a + _h.n) AS int)"


def priority_sql(hits: str) -> str:
    """A2: 1 when any keyword matched exactly, else 2."""
    return (f"CASE WHEN exists({hits}, _h -> _h.kind = 'exact') THEN {PRIORITY_EXACT} "
            f"ELSE {PRIORITY_FUZZY_ONLY} END")


def detail_sql(h: str) -> str:
    """``Kw: n occurrence[s]`` or
    ``Kw (fuzzy): n occurrence[s] (kata cocok: a, b)``."""
    occ = f"CASE WHEN {h}.n > 1 THEN {lit(OCCURRENCE_PLURAL)} ELSE {lit(OCCURRENCE_SINGULAR)} END"
    tag = f"CASE WHEN {h}.kind = 'fuzzy' THEN {lit(FUZZY_TAG)} ELSE '' END"
    words = (f"CASE WHEN {h}.kind = 'fuzzy' AND size({h}.words) > 0 THEN concat({lit(MATCHED_WORDS_OPEN)}, "
             f"array_join({h}.words, ', '), {lit(MATCHED_WORDS_CLOSE)}) ELSE '' END")
    return f"concat({_cap(h + '.keyword')}, {tag}, ': ', CAST({h}.n AS string), ' ', {occ}, {words})"


def details_sql(hits: str) -> str:
    """A3: detail strings in keyword order (hits are already in that order)."""
    return f"transform({hits}, _d -> {detail_sql('_d')})"


def label_column(total: Column, priority: Column) -> Column:
    """``n match[es] (Exact)`` / ``n match[es] (Fuzzy Only)``."""
    m = F.when(total != 1, F.lit(MATCH_PLURAL)).otherwise(F.lit(MATCH_SINGULAR))
    tag = F.when(priority == PRIORITY_EXACT, F.lit(EXACT_LABEL)) \
           .when(priority == PRIORITY_FUZZY_ONLY, F.lit(FUZZY_ONLY_LABEL)).otherwise(F.lit(""))
    return F.concat(total.cast("string"), F.lit(" "), m, F.lit(" "), tag)


def with_scores(df: DataFrame, hits_col: str = "hits") -> DataFrame:
    """Adds ``total_matches``, ``match_priority`` and ``matched_keywords``;
    keeps documents with a positive total (P6). The filter sits above a
    fence so the hit arrays are not recomputed inside it."""
    h = ident(hits_col)
    return (fence(df.withColumn("total_matches", F.expr(total_sql(h))))
              .filter(F.col("total_matches") > 0)
              .withColumn("match_priority", F.expr(priority_sql(h)))
              .withColumn("matched_keywords", F.expr(details_sql(h))))


def rank_order(extra: Sequence[str] = ()) -> list[Column]:
    """Priority ascending, total descending, then a deterministic tie-break."""
    return [F.col("match_priority").asc(), F.col("total_matches").desc()] + \
           [F.col(c).asc_nulls_last() for c in extra]


def top_n(df: DataFrame, n: int, tie_break: Sequence[str]) -> DataFrame:
    """First ``n`` in rank order (``TakeOrderedAndProject``)."""
    if not isinstance(n, int) or isinstance(n, bool):
        raise ValueError("top-N must be an integer")
    if n < 0:
        raise ValueError("top-N must be >= 0")
    return df.orderBy(*rank_order(tie_break)).limit(n)
