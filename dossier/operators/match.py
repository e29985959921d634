"""Keyword matching: exact (overlapping) counts and edit-distance fallback.

Exact counts
    One pass over a text for any number of keywords: a lookahead at every place
    returns the longest keyword that starts there. The returned ones are sorted and
    counted in runs, and a run counts for every keyword that its keyword begins
    with (a literal table). The keywords are one pattern that shares their common
    beginnings, behind a test of the next characters.

Fuzzy fallback
    For a keyword whose exact count in a document is 0, every whitespace word
    of the document whose lowercase form is within
    ``min(ceil(0.15 * len(keyword)), 3)`` edits counts (with repeats). One pass over
    the distinct words finds those that hold an unchanged part of a keyword (one pattern
    for all); they are tested, by bounded ``levenshtein``, against the keywords whose
    edit band covers their length; it stays row-local (no token shuffle, no pairing of documents with
    keywords).

All per-document results are arrays in the document's row; nothing here
shuffles. The expressions have one form whatever the number of keywords.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rows import explode_rows
from ..functions.sqltext import ident, let, lit, runs, split_ws, table
from ..functions.text import col_, fuzzy_bound, py_strip, regex_literal

HIT_TYPE = "array<struct<kw_pos:int,keyword:string,kind:string,n:int,words:array<string>>>"


# --------------------------------------------------------------------------- P9
def parse_keywords(keywords: str | Iterable[str]) -> list[str]:
    """Split a comma-separated keyword string: strip, lowercase, drop empty
    items, drop repeats (first position kept). Raises ``ValueError`` when no
    keyword remains."""
    if isinstance(keywords, str):
        items = keywords.split(",")
    else:
        items = list(keywords)
        if not all(isinstance(k, str) for k in items):
            raise ValueError("keywords must be strings")
    out: list[str] = []
    for k in items:
        k = k.strip().lower()
        if k and k not in out:
            out.append(k)
    if not out:
        raise ValueError("no valid keywords")
    return out


def keyword_list_column(c) -> Column:
    """P9 as a column expression over a column of keyword strings:
    ``array<string>`` of distinct, stripped, lowercased non-empty items."""
    items = F.transform(F.split(col_(c), ",", -1), lambda k: F.lower(py_strip(k)))
    return F.array_distinct(F.filter(items, lambda k: k != ""))


def parse_keyword_table(df: DataFrame, id_cols: Sequence[str], text_col: str) -> DataFrame:
    """P9 over a table: one row per ``(ids..., kw_pos, keyword)``."""
    return df.select(*id_cols, F.posexplode(keyword_list_column(text_col)).alias("kw_pos", "keyword")) \
             .withColumn("kw_pos", (F.col("kw_pos") + 1).cast("int"))


# ------------------------------------------------------------------ M1/M2/M3
def _tree_pattern(keywords: Iterable[str]) -> str:
    """A Java pattern of the keywords as a tree of characters: longer ones are tried
    before the one that begins them."""
    tree: dict = {}
    for k in keywords:
        node = tree
        for ch in k:
            node = node.setdefault(ch, {})
        node[""] = {}

    def told(node: dict) -> str:
        parts = [regex_literal(ch) + told(sub) for ch, sub in node.items() if ch]
        if not parts:
            return ""
        return "(?:" + "|".join(parts) + ")" + ("?" if "" in node else "")

    return told(tree)


def _heads(words: Iterable[str], most: int) -> str:
    """A test of the next characters, ``most`` at the most, that every word passes."""
    words = list(words)
    n = min(most, *map(len, words))
    classes = ("[" + "".join(regex_literal(ch) for ch in dict.fromkeys(w[i] for w in words)) + "]" for i in range(n))
    return f"(?={''.join(classes)})" if n else ""


def longest_keyword_pattern(keywords: Iterable[str]) -> str:
    """A Java pattern for the longest keyword at a place."""
    kws = list(keywords)
    return f"{_heads(kws, 3)}(?=({_tree_pattern(kws)}))"


def _beginnings_sql(keywords: Sequence[str]) -> tuple[str, int]:
    """Literal: by CRC-32 of a keyword modulo their number, the keyword and the
    (0-based) places of all keywords that it begins with, itself included."""
    places: dict[str, list[int]] = {}
    for i, k in enumerate(keywords):
        if k:
            places.setdefault(k, []).append(i)
    buckets: list[list] = [[] for _ in places]
    for k in places:
        own = [i for n in range(1, len(k) + 1) for i in places.get(k[:n], ())]
        buckets[zlib.crc32(k.encode()) % len(buckets)].append({"k": k, "i": own})
    return table(buckets, "array<array<struct<k:string,i:array<int>>>>"), len(buckets)


def exact_found_sql(text: str, keywords: Sequence[str]) -> str:
    """SQL ``array<struct<i, n>>``: overlapping occurrences of the keywords that
    occur, by place (0-based). The longest keywords found are sorted, their
    runs are counted, and each run's length goes to all keywords that begin its
    keyword; so the cost follows the matches, not the list."""
    if not any(keywords):
        return "CAST(array() AS array<struct<i:int,n:int>>)"
    found = f"regexp_extract_all({text}, {lit(longest_keyword_pattern(k for k in keywords if k))}, 1)"
    buckets, size = _beginnings_sql(keywords)

    def begun(k: str) -> str:
        return f"get(filter(get({buckets}, CAST(crc32({k}) % {size} AS int)), _e -> _e.k = {k}), 0).i"

    rolled = runs(f"sort_array(coalesce({found}, CAST(array() AS array<string>)))", "_f", lambda x, y: f"{x} = {y}",
                  lambda x, p, n: f"transform({begun(x)}, _i -> named_struct('i', _i, 'n', {n}))")
    return runs(f"sort_array(flatten({rolled}))", "_g", lambda x, y: f"{x}.i = {y}.i", lambda x, p, n:
                f"named_struct('i', {x}.i, 'n', aggregate(slice(_g, {p} + 1, {n}), 0, (_a, _e) -> _a + _e.n))")


def filled_sql(found: str, keywords: Sequence[str], rest: str) -> str:
    """``found`` (structs that begin with ``i``) with ``rest`` (the other fields,
    as SQL) for each keyword that is not in it, in the order of keywords."""
    missing = f"array_except(sequence(0, {len(keywords) - 1}), transform(_h, _e -> _e.i))"
    return let(found, "_h", f"sort_array(concat(_h, transform({missing}, _i -> named_struct('i', _i, {rest}))))")


def exact_counts_sql(text: str, keywords: Sequence[str]) -> str:
    """SQL ``array<int>``: the counts aligned with ``keywords``, zeros included."""
    return f"transform({filled_sql(exact_found_sql(text, keywords), keywords, chr(39) + 'n' + chr(39) + ', 0')}, _e -> _e.n)"


def keyword_counts(df: DataFrame, id_cols: Sequence[str], text_col: str, keywords: Sequence[str],
                   keep_zeros: bool = False) -> DataFrame:
    """M1/M2/M3: ``(ids..., kw_pos, keyword, n)`` exact overlapping counts of
    the keywords that occur; zeros only on request."""
    found = exact_found_sql(ident(text_col), keywords)
    if keep_zeros:
        found = filled_sql(found, keywords, "'n', 0")
    rows = (f"transform({found}, _t -> named_struct('kw_pos', _t.i + 1, "
            f"'keyword', get({table(list(keywords), 'array<string>')}, _t.i), 'n', _t.n))")
    return explode_rows(df.select(*id_cols, text_col), id_cols, F.expr(rows), "kw_pos")


# ---------------------------------------------------------------- M4/M5/M8
def edit_distance(a, b, bound: int | None = None) -> Column:
    """M4: code-point Levenshtein distance (unit costs). With ``bound``,
    -1 when the distance exceeds it."""
    return F.levenshtein(col_(a), col_(b)) if bound is None else F.levenshtein(col_(a), col_(b), bound)


def _bound(keyword: str, tolerance: float | None, max_edits: int | None) -> int:
    kwargs = {}
    if tolerance is not None:
        kwargs["tolerance"] = tolerance
    if max_edits is not None:
        kwargs["max_edits"] = max_edits
    return fuzzy_bound(keyword, **kwargs)


def fuzzy_finish_sql(matched: str) -> str:
    """SQL ``struct<n, words>`` from the matched lowercase forms: only when
    something matched are the original-case words of ``_v`` collected and every
    occurrence (repeats included) counted. Of a text in lower case the forms are
    the words."""
    occurs = "aggregate(_f, 0, (_a, _x) -> _a + size(_v.w) - size(array_remove(_v.w, _x)))"
    same = f"named_struct('n', {occurs}, 'words', _f)"
    hits = "filter(_v.w, _o -> array_contains(_f, lower(_o)))"
    found = let(hits, "_g", "named_struct('n', size(_g), 'words', array_sort(array_distinct(_g)))")
    empty = "named_struct('n', 0, 'words', CAST(array() AS array<string>))"
    return let(matched, "_f", f"CASE WHEN size(_f) = 0 THEN {empty} WHEN _v.low THEN {same} ELSE {found} END")


def near_word_pattern(keywords: Sequence[str], bounds: Sequence[int], start: str = "^") -> str:
    """A Java pattern that finds, as group 1, every word within a keyword's bound (few
    others) between ``start`` and a line's end. Of k + 1 even parts of a keyword one is unchanged in
    a word within k edits: part i at most i places away, and at most k - i from that
    place plus what the word is longer. By the part's place, then by how many characters
    follow it: a word is walked through once."""
    after: dict[int, dict[str, set[int]]] = {}
    for f, k in zip(keywords, bounds):
        for n in range(max(1, len(f) - k), len(f) + k + 1) if f else ():
            for i in range(k + 1):
                begin, end, more = i * len(f) // (k + 1), (i + 1) * len(f) // (k + 1), n - len(f)
                if any(map(str.isspace, f[begin:end])):  # in no word
                    continue
                low = max(begin - i, begin + more - (k - i), 0)
                for at in range(low, min(begin + i, begin + more + (k - i), n - (end - begin)) + 1):
                    after.setdefault(at, {}).setdefault(f[begin:end], set()).add(n - at - (end - begin))

    def rest(lengths: set[int]) -> list[str]:
        starts = sorted(n for n in lengths if n - 1 not in lengths)
        ends = sorted(n for n in lengths if n + 1 not in lengths)
        return [(f"[^\\n]{{{a},{b}}}+" if b else "") + "(?![^\\n])" for a, b in zip(starts, ends)]

    def told(node: dict) -> str:
        parts = [regex_literal(ch) + told(sub) for ch, sub in node.items() if ch] + rest(node.get("", set()))
        return parts[0] if len(parts) == 1 else "(?:" + "|".join(parts) + ")"

    pattern = ""
    places = sorted(after)
    for at, before in reversed(list(zip(places, [0, *places]))):
        tree: dict = {}
        for part, lengths in sorted(after[at].items()):
            node = tree
            for ch in part:
                node = node.setdefault(ch, {})
            node[""] = lengths
        step = f"[^\\n]{{{at - before}}}" if at > before else ""
        pattern = f"{step}(?:{_heads(after[at], 2)}{told(tree)}{'|' + pattern if pattern else ''})"
    return f"{start}({pattern or '(?!)'})"


def _lows_bounds(keywords: Sequence[str]) -> tuple[list[str], list[int]]:
    lows = [k.lower() for k in keywords]
    return lows, [_bound(f, None, None) if f else 0 for f in lows]


def near_sql(keywords: Sequence[str]) -> str:
    """SQL ``array<struct<i, f>>``: for each keyword (0-based place) that is near a
    word of ``_v.u``, the near words. Each is tested against the keywords whose edit
    band covers its length; the pairs, sorted, are taken together by keyword."""
    lows, bounds = _lows_bounds(keywords)
    by_length: list[list[int]] = [[] for _ in range(max(len(f) + b for f, b in zip(lows, bounds)) + 1)]
    for i, (f, b) in enumerate(zip(lows, bounds)):
        if f:
            for n in range(max(1, len(f) - b), len(f) + b + 1):
                by_length[n].append(i)
    near = f"levenshtein(_d, get({table(lows, 'array<string>')}, _i), get({table(bounds, 'array<int>')}, _i)) >= 0"
    of_length = f"coalesce(get({table(by_length, 'array<array<int>>')}, length(_d)), CAST(array() AS array<int>))"
    pairs = (f"sort_array(flatten(transform(_v.u, _d -> transform(filter({of_length}, _i -> {near}), "
             f"_i -> named_struct('i', _i, 'w', _d)))))")
    return runs(pairs, "_q", lambda x, y: f"{x}.i = {y}.i", lambda x, p, n:
                f"named_struct('i', {x}.i, 'f', transform(slice(_q, {p} + 1, {n}), _e -> _e.w))")


def words_sql(text: str, keywords: Sequence[str], body: str) -> str:
    """``body`` with ``_v``, bound once per row: ``w``, the words of ``text``, ``low``,
    whether they are in lower case, and ``u``, the distinct lowercase ones that hold a
    part of a keyword: one pass over the distinct words, a line each, finds them."""
    lows, bounds = _lows_bounds(keywords)
    lines = "concat('\\n', array_join(array_distinct(_lw), '\\n'))"
    near = (f"regexp_extract_all({lines}, {lit(near_word_pattern(lows, bounds, chr(92) + 'n'))}, 1)" if any(lows)
            else "CAST(array() AS array<string>)")
    written = f"CASE WHEN _lt = {text} OR size(_u) = 0 THEN _lw ELSE {split_ws(text, '_q')} END"
    body = let(f"named_struct('w', {written}, 'low', _lt = {text}, 'u', _u)", "_v", body)
    return let(f"lower({text})", "_lt", let(split_ws("_lt", "_q"), "_lw", let(near, "_u", body)))


def fuzzy_hits(df: DataFrame, id_cols: Sequence[str], text_col: str,
               keywords: Sequence[str]) -> DataFrame:
    """M5/M8 (fuzzy-only mode): ``(ids..., kw_pos, keyword, n, words)`` for
    every keyword with at least one near word; ``n`` counts repeats and
    ``words`` is the sorted distinct list of matched words."""
    names = table([k.lower() for k in keywords], "array<string>")
    item = let(fuzzy_finish_sql("_t.f"), "_z",
               f"named_struct('kw_pos', _t.i + 1, 'keyword', get({names}, _t.i), 'n', _z.n, 'words', _z.words)")
    expr = words_sql(ident(text_col), keywords, f"transform({near_sql(keywords)}, _t -> {item})")
    return explode_rows(df.select(*id_cols, text_col), id_cols, F.expr(expr), "kw_pos")


# ---------------------------------------------------------------- M6/M7
def hits_sql(keywords: Sequence[str], found: str, text: str) -> str:
    """SQL M6/M7: per keyword (in keyword order) the exact count if it is
    positive, else the fuzzy fallback; keywords with neither are left out.
    ``HIT_TYPE``. ``found``: see ``exact_found_sql``."""
    name = f"get({table(list(keywords), 'array<string>')}, _t.i)"
    head = f"'kw_pos', _t.i + 1, 'keyword', {name}"
    exact = f"transform(_ex, _t -> named_struct({head}, 'kind', 'exact', 'n', _t.n, 'words', CAST(NULL AS array<string>)))"
    fuzzy = let(fuzzy_finish_sql("_t.f"), "_z", f"named_struct({head}, 'kind', 'fuzzy', 'n', _z.n, 'words', _z.words)")
    fuzzy = f"transform(filter({near_sql(keywords)}, _t -> NOT array_contains(_xi, _t.i)), _t -> {fuzzy})"
    body = words_sql(text, keywords, f"sort_array(concat({exact}, {fuzzy}))")
    return let(found, "_ex", let("transform(_ex, _t -> _t.i)", "_xi", body))


def with_hits(df: DataFrame, text_col: str, keywords: Sequence[str], out: str = "hits") -> DataFrame:
    """Adds ``out`` (``HIT_TYPE``): exact-then-fuzzy hits of each keyword."""
    t = ident(text_col)
    return df.withColumn(out, F.expr(hits_sql(keywords, exact_found_sql(t, keywords), t)))


def keyword_hits(df: DataFrame, id_cols: Sequence[str], text_col: str, keywords: Sequence[str]) -> DataFrame:
    """M6/M7 as rows ``(ids..., kw_pos, keyword, kind, n, words)``."""
    return explode_rows(with_hits(df.select(*id_cols, text_col), text_col, keywords), id_cols, "hits", "kw_pos")
