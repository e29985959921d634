"""Personal data: patterns propose spans, validators confirm them, context scores them.

Kinds, in output order. Base kinds (kept whenever they are valid):

* ``email``; ``ip`` (parts at most 255); ``card`` (16 to 19 digits, Luhn);
  ``phone`` (leading plus, 8 to 15 digits).

Kinds that the method adds, kept from a score of ``THRESHOLD`` on:

* ``iban``: country, two check digits and 11 to 30 letters or digits in groups
  of four or none; counts only where its number mod 97 is 1;
* ``ssn``: ddd-dd-dddd with a valid area, group and number, no hyphen on
  either side; needs one of its context words.

A span's score is its kind's base plus ``CONTEXT`` if one of the kind's words
stands within ``NEAR`` characters of it, not past another span of the kind.

Everything is Spark's own functions on the row: the texts between the matches
(``split`` by the same pattern) give each match's place in code points and its
context, so nothing is shuffled and no text is searched twice for a place. The
patterns are the stated ones with possessive repeats and, for email, a look
back that starts it only where a longer one can't: the same matches, in time
linear in the text. Running sums go by chunks, so many thousand matches in one
text stay cheap.

Defined cases: a null text is empty and has no span (the digest is that of the
empty string); repeated rows are judged one by one; a null id stays null; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD, CONTEXT, NEAR, CHUNK = 0.6, 0.3, 40, 256
_LOCAL, _WORD = "[A-Za-z0-9._%+-]", "[A-Za-z0-9_]"
# kind: pattern, a cheap condition for it, base score, context words
KINDS: dict[str, tuple[str, str, float, str]] = {
    "email": (rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.8,
              "mail|contact|write to"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", 0.6, "ip|address|host|server"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", "", 0.7, "card|credit|visa|mastercard|payment"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.6, "phone|tel|call|mobile|fax"),
    "iban": (rf"(?<!{_WORD})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{2,7}}(?:\x20?[A-Z0-9]{{1,3}})?(?!{_WORD})", "", 0.7,
             "iban|account|bank|konto"),
    "ssn": (rf"(?<!{_WORD})[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}(?!{_WORD})", "-", 0.4,
            "ssn|social security|social"),
}
BASE = ("email", "ip", "card", "phone")


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _folded(s: Column, start: int, step) -> Column:
    """``step(acc, character, place)`` over the characters of a short string."""
    places = F.sequence(F.lit(1), F.char_length(s))
    return F.aggregate(places, F.lit(start), lambda a, i: step(a, F.substr(s, i, F.lit(1)), i))


def luhn(digits: Column) -> Column:
    def step(a: Column, c: Column, i: Column) -> Column:
        d = c.cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return a + F.when(d > 9, d - 9).otherwise(d)

    return _folded(F.reverse(digits), 0, step) % 10 == 0


def mod97(iban: Column) -> Column:
    """Remainder of the rearranged number: letters count as 10 to 35."""
    moved = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))

    def step(a: Column, c: Column, i: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 58, (a * 10 + code - 48) % 97).otherwise((a * 100 + code - 55) % 97)

    return _folded(moved, 0, step)


def _small_part(p: Column) -> Column:
    own = F.ltrim(p, F.lit("0"))
    return (F.char_length(own) <= 3) & (F.when(F.char_length(own) == 0, 0).when(F.char_length(own) > 3, 256)
                                        .otherwise(own.cast("int")) <= 255)


def _valid(kind: str, m: Column, before: Column, after: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(m, r"\."), _small_part)
    if kind == "card":
        return F.when(F.char_length(_digits(m)).between(16, 19), luhn(_digits(m))).otherwise(F.lit(False))
    if kind == "phone":
        return F.char_length(_digits(m)).between(8, 15)
    if kind == "iban":
        own = F.regexp_replace(m, " ", "")
        return F.char_length(own).between(15, 34) & (mod97(own) == 1)
    if kind == "ssn":
        return ~m.rlike("^(000|666|9)|-00-|-0000$") & (F.right(before, F.lit(1)) != "-") & (F.left(after, F.lit(1)) != "-")
    return F.lit(True)


def _running(steps: Column) -> Column:
    """Running sums of an array that isn't empty, by chunks."""
    none = F.array().cast("array<bigint>")
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / CHUNK).cast("int")),
                         lambda c: F.slice(steps, c * CHUNK + 1, F.lit(CHUNK)))
    last = lambda a: F.coalesce(F.get(a, F.size(a) - 1), F.lit(0).cast("bigint"))
    inner = F.transform(chunks, lambda c: F.aggregate(c, none, lambda a, x: F.concat(a, F.array(last(a) + x))))
    before = F.aggregate(inner, none, lambda a, c: F.concat(a, F.array(last(a) + last(c))))
    before = F.concat(F.array(F.lit(0).cast("bigint")), before)
    return F.flatten(F.zip_with(inner, F.slice(before, F.lit(1), F.size(inner)),
                                lambda c, b: F.transform(c, lambda x: x + b)))


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and, for every kind, ``<kind>``: its spans ``(start, end,
    score)`` in order, ends exclusive, in code points."""
    df = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    df = df.withColumn("digits", F.col("text").rlike("[0-9]"))
    empty = F.array().cast("array<string>")
    for kind, (pattern, sign, _, _) in KINDS.items():
        likely = F.lit(True) if kind == "email" else F.col("digits")
        likely = likely & F.contains("text", F.lit(sign)) if sign else likely
        df = df.withColumn(f"{kind}_m", F.when(likely, F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
                           .otherwise(empty))
    for kind, (pattern, *_) in KINDS.items():
        df = df.withColumn(f"{kind}_g", F.when(F.size(f"{kind}_m") > 0, F.split("text", pattern, -1)).otherwise(empty))
    df = df.drop("text", "digits")
    for kind in KINDS:
        m, g = F.col(f"{kind}_m"), F.col(f"{kind}_g")
        lengths = F.zip_with(F.slice(g, F.lit(1), F.size(m)), F.concat(F.array(F.lit("")), m), lambda a, b: (
            F.char_length(a) + F.char_length(b)).cast("bigint"))
        df = df.withColumn(f"{kind}_s", F.when(F.size(m) > 0, _running(F.slice(lengths, F.lit(1), F.size(m))))
                           .otherwise(F.array().cast("array<bigint>")))
    for kind, (_, _, score, words) in KINDS.items():
        m, g = F.col(f"{kind}_m"), F.col(f"{kind}_g")
        each = F.arrays_zip(m.alias("m"), F.col(f"{kind}_s").alias("s"), F.slice(g, F.lit(1), F.size(m)).alias("a"),
                            F.slice(g, F.lit(2), F.size(m)).alias("b"))

        def span(x: Column) -> Column:
            near = F.lower(F.concat(F.right(x["a"], F.lit(NEAR)), F.lit(" "), F.left(x["b"], F.lit(NEAR))))
            found = near.rlike(rf"(?<![a-z])(?:{words})(?![a-z])")
            return F.struct(x["s"].alias("start"), (x["s"] + F.char_length(x["m"])).alias("end"),
                            F.round(F.lit(score) + F.when(found, CONTEXT).otherwise(0.0), 2).alias("score"))

        spans = F.transform(F.filter(each, lambda x: _valid(kind, x["m"], x["a"], x["b"])), span)
        if kind not in BASE:
            spans = F.filter(spans, lambda x: x["score"] >= THRESHOLD)
        df = df.withColumn(kind, F.when(F.size(m) > 0, spans).otherwise(
            F.array().cast("array<struct<start:bigint,end:bigint,score:double>>")))
    return df.select("doc_id", *KINDS)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, counts of the base kinds, ``base_sha256``, ``spans`` and
    ``scores`` (of the spans in their order)."""
    found = find_spans(docs, id_col, text_col)

    def told(kind: str) -> Column:
        return F.transform(kind, lambda x: F.concat_ws(":", F.lit(kind), x["start"].cast("string"), x["end"].cast("string")))

    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(F.array_join(F.concat(*[told(k) for k in BASE]), ","), 256).alias("base_sha256"),
        F.array_join(F.concat(*[told(k) for k in KINDS]), ",").alias("spans"),
        F.array_join(F.concat(*[F.transform(k, lambda x: x["score"].cast("string")) for k in KINDS]), ",").alias("scores"))
