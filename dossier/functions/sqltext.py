"""Builders for Spark SQL expression text.

Large per-row expressions (heading detection, sections, hits) are written as
SQL text and handed to ``F.expr`` in one call: the JVM parses the whole tree
at once, instead of one py4j round trip per node, which keeps query
construction in milliseconds however many patterns or keywords there are.

``let(value, var, body)`` binds ``value`` to a lambda variable once
(``transform(array(value), var -> body)[0]``) so a body can use it many
times without Catalyst copying the value's expression into each use.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from .text import PY_WHITESPACE


def lit(s: str) -> str:
    """A Spark SQL string literal for ``s`` (every character survives)."""
    out = []
    for ch in s:
        o = ord(ch)
        if ch == "\\":
            out.append("\\\\")
        elif ch == "'":
            out.append("\\'")
        elif 32 <= o < 127:
            out.append(ch)
        elif o <= 0xFFFF:
            out.append("\\u%04x" % o)
        else:  # outside the BMP: a UTF-16 surrogate pair
            v = o - 0x10000
            out.append("\\u%04x\\u%04x" % (0xD800 + (v >> 10), 0xDC00 + (v & 0x3FF)))
    return "'" + "".join(out) + "'"


def ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def let(value: str, var: str, body: str) -> str:
    return f"get(transform(array({value}), {var} -> {body}), 0)"


WS_LIT = lit(PY_WHITESPACE)
NL = lit("\n")


def strip(x: str) -> str:
    """``str.strip()``."""
    return f"btrim({x}, {WS_LIT})"


# Python whitespace other than the space, and line breaks other than \n
_OTHER_WS = PY_WHITESPACE.replace(" ", "")
_OTHER_BREAKS = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"


def _made(x: str, chars: str, to: str, changed: str) -> str:
    """``changed`` with its ``chars`` made ``to``; ``x`` itself where it has none of
    them (one quick pass: printable ASCII is told by the first test)."""
    has = lit("[[^ -~]&&[" + "".join(f"\\x{{{ord(c):x}}}" for c in chars) + "]]")
    return f"CASE WHEN {x} RLIKE {has} THEN translate({changed}, {lit(chars)}, {lit(to * len(chars))}) ELSE {x} END"


def split_ws(x: str, var: str = "_w") -> str:
    """``str.split()``: every whitespace character becomes a space
    (``translate``), then a single-character split (no regex)."""
    t = _made(x, _OTHER_WS, " ", x)
    return f"filter(split({t}, ' ', -1), {var} -> {var} != '')"


def splitlines(x: str) -> str:
    """``str.splitlines()``: ``\r\n`` and every other line break become
    ``\n``, then a single-character split; one trailing break does not start
    an extra line and empty text has no lines."""
    t = _made(x, _OTHER_BREAKS, "\n", f"replace({x}, {lit(chr(13) + chr(10))}, {NL})")
    body = (f"CASE WHEN _t = '' THEN CAST(array() AS array<string>) "
            f"WHEN endswith(_t, {NL}) THEN split(substr(_t, 1, length(_t) - 1), {NL}, -1) "
            f"ELSE split(_t, {NL}, -1) END")
    return let(t, "_t", body)


def starts_with_any(x: str, prefixes) -> str:
    return "(" + " OR ".join(f"startswith({x}, {lit(p)})" for p in prefixes) + ")"


def table(value, schema: str) -> str:
    """A literal of any size: parsed as one string, folded into a constant."""
    return f"from_json({lit(json.dumps(value))}, {lit(schema)})"


def runs(array: str, var: str, same: Callable[[str, str], str], item: Callable[[str, str, str], str]) -> str:
    """One ``item`` per run of a sorted array (bound to ``var``). ``same`` tells of
    two neighbours whether they are of one run; ``item`` is made of a run's
    first element, its place (from 0) and its length."""
    at = f"{var}_at"
    first = f"filter(sequence(0, size({var}) - 1), _p -> _p = 0 OR NOT ({same(f'get({var}, _p - 1)', f'get({var}, _p)')}))"
    each = let(f"named_struct('x', get({var}, _p), 'p', _p, 'n', coalesce(get({at}, _j + 1), size({var})) - _p)", "_r",
               item("_r.x", "_r.p", "_r.n"))
    body = f"CASE WHEN size({var}) > 0 THEN {let(first, at, f'transform({at}, (_p, _j) -> {each})')} ELSE array() END"
    return let(array, var, body)
