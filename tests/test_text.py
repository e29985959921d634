import pytest

from pyspark.sql import functions as F

from dossier.functions import sqltext as Q
from dossier.functions import text as T
from dossier.operators.match import exact_counts_sql
from dossier.operators.score import _cap

SAMPLES = ["", " ", "a", "  a b  ", "\x1c x \x1f", "\xa0word　", "a\r\nb\n\nc\n", "a b\x85c",
           "x\x0by\x0cz", "line\r", "\n\n", "tab\tsep  arated"]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([(i, s) for i, s in enumerate(SAMPLES)], "i int, s string")


def test_strip_split_lines_match_python(df):
    rows = df.select("i", F.expr(Q.strip("s")).alias("st"), F.expr(Q.split_ws("s")).alias("ws"),
                     F.expr(Q.splitlines("s")).alias("ln"), T.py_strip("s").alias("st2")).collect()
    for r in rows:
        s = SAMPLES[r.i]
        assert r.st == r.st2 == s.strip()
        assert r.ws == s.split()
        assert r.ln == s.splitlines()


def test_capitalize(spark):
    vals = ["react", "the AND", "x", ""]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r[0] for r in df.select(F.expr(_cap("v"))).collect()]
    assert got == [v.capitalize() for v in vals]


def test_fuzzy_bound_rule():
    assert [T.fuzzy_bound("x" * n) for n in (1, 6, 7, 13, 14, 20, 40)] == [1, 1, 2, 2, 3, 3, 3]


def test_keyword_pattern_is_literal(spark):
    kws = ["a.b", "(x)", "c++", "\\E", "$1", "[z]", "^", "-]", "a&&b"]
    text = "a.b axb (x) c++ \\E $1 [z] a.b ^ -] a&&b a&b"
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(F.expr(exact_counts_sql("t", kws))).first()[0]
    assert got == [text.count(k) for k in kws]
