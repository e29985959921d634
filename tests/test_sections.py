
from dossier.operators import sections as S
import pyref
from samples import CV_A, DOCS


def _docs(spark):
    return spark.createDataFrame(DOCS, "doc_id int, cv_text string")


def test_sections_match_rules(spark):
    sec = S.with_sections(_docs(spark), "cv_text")
    rows = S.section_rows(sec, ["doc_id"]).collect()
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append((r.section, r.first_pos, r.content))
    for doc_id, text in DOCS:
        want = pyref.sections(text)
        assert sorted(got.get(doc_id, []), key=lambda x: x[1]) == want, doc_id


def test_golden_sample_details(spark):
    secs = dict((n, (p, c)) for n, p, c in pyref.sections(CV_A))
    # preamble dropped, repeated Summary keeps first position and last content
    assert list(secs)[0] == "Summary" and secs["Summary"] == (2, "Replaced summary text.")
    # unknown heading stays inside the previous section
    df = spark.createDataFrame([(1, CV_A)], "doc_id int, cv_text string")
    sec = S.with_sections(df, "cv_text")
    r = sec.select(S.section_content("Summary").alias("s"), S.section_content("Education").alias("e"),
                   S.flat_text_column().alias("f")).first()
    assert r.s == "Replaced summary text."
    assert r.e == "Bachelor of Arts : Economics , June 2012\nCity College"
    assert r.f == pyref.flat_text(pyref.sections(CV_A))
    assert "•" not in r.f and "\n" not in r.f


def test_section_starts_and_lookup(spark):
    d = _docs(spark)
    starts = S.section_starts(d, ["doc_id"], "cv_text").collect()
    for doc_id, text in DOCS:
        lines = text.splitlines()
        want = [(i, pyref.heading_of(l), l) for i, l in enumerate(lines) if pyref.heading_of(l)]
        got = sorted((r.pos, r.section, r.line_text) for r in starts if r.doc_id == doc_id)
        assert got == want
    look = S.section_lookup(S.with_sections(d, "cv_text"), ["doc_id"], "Projects").collect()
    assert {r.content for r in look} == {"Projects section not found."}


def test_flat_texts_drop_unsearchable(spark):
    flat = S.flat_texts(_docs(spark), ["doc_id"], "cv_text").collect()
    assert {r.doc_id for r in flat} == {1, 3, 5}
    for r in flat:
        assert r.flat_text == pyref.flat_text(pyref.sections(dict(DOCS)[r.doc_id]))


def test_structured_text(spark):
    sec = S.with_sections(spark.createDataFrame([(1, CV_A)], "doc_id int, cv_text string"), "cv_text")
    got = sec.select(S.structured_text_column()).first()[0]
    assert got == "".join(f"{n}\n\n{c}\n\n" for n, _, c in pyref.sections(CV_A))


def test_sectioning_is_map_only(spark):
    df = S.section_rows(S.with_sections(_docs(spark), "cv_text"), ["doc_id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
