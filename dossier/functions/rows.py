"""Row-shaping helpers that keep expensive per-row expressions evaluated once.

Catalyst pushes a filter below a projection by substituting the projected
expression into the condition. For a cheap column that is what we want; for
a column computed by a long chain of higher-order functions (sections,
keyword hits) it means the whole chain runs again inside the filter -- and,
once substituted into lambdas, once per array element. The generators
below are the barrier: a filter on a generator's output cannot move under
it, and the ``_outer`` generators infer no ``size(array) > 0`` filter of their
own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_rows(df: DataFrame, keep: Sequence[str | Column], array_col: str | Column,
                 not_null_field: str) -> DataFrame:
    """``inline`` an array of structs into rows next to ``keep`` columns.

    ``not_null_field`` names a struct field that is never null in a real
    element; the placeholder row ``inline_outer`` emits for an empty or null
    array is dropped by it."""
    arr = F.col(array_col) if isinstance(array_col, str) else array_col
    return df.select(*keep, F.inline_outer(arr)).filter(F.col(not_null_field).isNotNull())


def fence(df: DataFrame) -> DataFrame:
    """Same rows and columns, but computed columns are evaluated here once:
    filters applied to the result are not pushed (and re-evaluated) below."""
    cols = df.columns
    packed = F.array(F.struct(*[F.col(f"`{c}`") for c in cols]))
    return df.select(F.inline_outer(packed))
