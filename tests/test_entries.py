import random

from dossier.operators import entries as E
from dossier.operators import sections as S
from samples import DOCS

BLOCKS = [
    "Junior Analyst\nMarch 2013 to May 2015 Some Firm\n- Reconciled accounts in 2014\n- Built reports\n\n"
    "Senior Analyst\n2015 to 2019 Other Firm\nLed a team",
    "",
    "  \n ",
    "File not found, moved on in 2019",
    "intro line without year\nTitle Here\n2001\n\n\nCompany 1999\n* bullet 2000\nlast",
    "One two three four five six seven\n2010\no bullet\n2011 line",
    "- Tools: Excel, SQL; Python.\npython,  R, Spark\n• Languages: English, French\nStack: a, b: c\n"
    "Data: cleaning, modelling.\n✔ Go\n–  Rust\nkey: value: more words here now",
]


# worked out by hand from the rules
ENTRIES = [
    [("Junior Analyst", ""), ("March 2013 to May 2015 Some Firm", "- Reconciled accounts in 2014\n- Built reports"),
     ("Senior Analyst", ""), ("2015 to 2019 Other Firm", "Led a team")],
    [], [], [],
    [("intro line without year", ""), ("Title Here", ""), ("2001", ""), ("Company 1999", "* bullet 2000\nlast")],
    [("One two three four five six seven", ""), ("2010", "o bullet"), ("2011 line", "")],
    [("- Tools: Excel, SQL; Python.", BLOCKS[6].split("\n", 1)[1])],
]
SKILLS = {
    1: [], 2: [], 3: [], 5: ["2010", "2011 line", "o bullet", "One two three four five six seven"],
    4: ["2001", "bullet 2000", "Company 1999", "intro line without year", "last", "Title Here"],
    6: ["cleaning", "English", "Excel", "French", "Go", "modelling", "Python", "python", "Rust", "Spark", "SQL",
        "value: more words here now"],
}


def test_entries(spark):
    df = spark.createDataFrame(list(enumerate(BLOCKS)), "i int, b string")
    for r in df.select("i", E.entries_column("b").alias("e")).collect():
        assert [(e.title, e.details) for e in r.e] == ENTRIES[r.i], r.i
        assert [e.entry_no for e in r.e] == list(range(1, len(r.e) + 1))


def test_kept_lines_appear_once_and_in_order(spark):
    rng = random.Random(5)
    parts = ["Title", "2001", "* b 2001", "a b c d e f g", "x 1999 y", "", "  ", "o two", "note", "- z"]
    blocks = ["\n".join(rng.choice(parts) for _ in range(rng.randrange(1, 12))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(blocks)), "i int, b string")
    for r in df.select("i", E.entries_column("b").alias("e")).collect():
        told = [line.strip() for e in r.e for line in (e.title + "\n" + e.details).split("\n") if line.strip()]
        assert told == [line.strip() for line in blocks[r.i].split("\n") if line.strip()]
        for e in r.e:  # a line with a year that is no bullet starts an entry, so no body holds one
            assert not any(line.strip() in ("2001", "x 1999 y") for line in e.details.split("\n"))


def test_skills(spark):
    df = spark.createDataFrame(list(enumerate(BLOCKS)), "i int, b string")
    for r in df.select("i", E.skills_column("b").alias("s")).collect():
        assert r.i not in SKILLS or r.s == SKILLS[r.i], r.i


def test_entry_tables_from_sections(spark):
    df = spark.createDataFrame(DOCS, "doc_id int, cv_text string")
    sec = S.with_sections(df, "cv_text")
    exp = sorted(E.experience_entries(sec, ["doc_id"]).collect(), key=lambda r: (r.doc_id, r.entry_no))
    assert [(r.title, r.details) for r in exp if r.doc_id == 1] == [
        ("Junior Analyst", ""), ("March 2013 to May 2015 Some Firm", "- Reconciled accounts in 2014\n- Built reports"),
        ("Senior Analyst", ""), ("2015 to 2019 Other Firm", ""),
        ("Led a team of four across the 2016 and 2017 audit seasons while also mentoring staff",
         "Experience with Java and other tools noted here")]
    edu = E.education_entries(sec, ["doc_id"]).collect()
    assert {r.doc_id for r in edu} == {1}
    sk = {r.doc_id: r.skills for r in E.skills(sec, ["doc_id"]).collect()}
    assert sk[1] == ["cleaning", "English", "Excel", "French", "modelling", "Python", "python", "Spark", "SQL"]
    assert sk[2] == [] and sk[5] == []
