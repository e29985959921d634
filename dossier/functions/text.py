"""Column helpers that reproduce Python string semantics with built-in Spark
expressions (JVM-side, no UDFs).

Python's ``str.strip``/``str.split``/``str.splitlines`` use a wider notion of
whitespace and line breaks than Spark's ``trim``/``split('\\s+')``; the helpers
here close that gap so results are equal character for character.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's whitespace set (``str.isspace``), derived from Python itself.
PY_WHITESPACE = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())


def _char_class(chars: str) -> str:
    """A Java regex character class matching exactly ``chars``."""
    return "[" + "".join(f"\\x{{{ord(c):x}}}" for c in chars) + "]"


# visible ASCII is told by the first test
WS_CLASS = f"[[^!-~]&&{_char_class(PY_WHITESPACE)}]"

def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """``str.strip()``: remove Python whitespace from both ends."""
    return F.btrim(col_(c), F.lit(PY_WHITESPACE))


def python_ws_pattern(pattern: str) -> str:
    """Make ``\\s`` in a Python regex mean Python's whitespace set in Java."""
    return pattern.replace(r"\s", WS_CLASS)


def regex_literal(s: str) -> str:
    """Escape ``s`` character by character for a Java regex (no \\Q..\\E, so
    a keyword containing ``\\E`` stays literal)."""
    return "".join(ch if ch.isalnum() else "\\" + ch for ch in s)


def regex_quote(c) -> Column:
    """A column's value as a Java regex that matches just it."""
    return F.concat(F.lit("\\Q"), F.replace(col_(c), F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))


# Tolerance and cap of the dynamic edit bound.
FUZZY_TOLERANCE = 0.15
FUZZY_MAX_EDITS = 3


def fuzzy_bound(keyword: str, tolerance: float = FUZZY_TOLERANCE,
                max_edits: int = FUZZY_MAX_EDITS) -> int:
    """Allowed edits for a keyword: ``min(ceil(tolerance * len), max_edits)``."""
    return min(math.ceil(tolerance * len(keyword)), max_edits)
