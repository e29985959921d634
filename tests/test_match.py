import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from dossier.operators import match as M
import pyref


def test_parse_keywords():
    assert M.parse_keywords("License, lisense, thing, reserved,, nation , license") == \
        ["license", "lisense", "thing", "reserved", "nation"]
    with pytest.raises(ValueError):
        M.parse_keywords(" , ,")
    with pytest.raises(ValueError):
        M.parse_keywords(["a", 3])


def test_parse_keyword_table(spark):
    df = spark.createDataFrame([(1, "B, a ,, b, A"), (2, " ")], "id int, t string")
    got = [(r.id, r.kw_pos, r.keyword) for r in M.parse_keyword_table(df, ["id"], "t").collect()]
    assert sorted(got) == [(1, 1, "b"), (1, 2, "a")]


TEXTS = ["aaaa", "the theme then the", "nationation nation", "", "xx yy",
         "café cafe caffè", "react reacts preact redact"]
KWS = ["aa", "the", "nation", "a", "react", "café", "x y"]


def test_counts_equal_naive(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)) + [(99, None)], "doc_id int, t string")
    rows = M.keyword_counts(df, ["doc_id"], "t", KWS, keep_zeros=True).collect()
    assert len(rows) == (len(TEXTS) + 1) * len(KWS)
    for r in rows:
        assert r.n == (pyref.overlap_count(TEXTS[r.doc_id], r.keyword) if r.doc_id < 99 else 0), r
    found = M.keyword_counts(df, ["doc_id"], "t", KWS).collect()
    assert sorted(found) == sorted(r for r in rows if r.n > 0)


def test_long_lists_nested_and_overlapping(spark):
    import itertools
    kws = ["".join(p) for n in (1, 2, 3, 4) for p in itertools.product("ab ", repeat=n)] + ["x", "\x01", "abababab"]
    texts = ["abababab ab  ba", "", "a" * 50, "\x01a\x01", "bbb a bbb"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, t string")
    for r in M.keyword_counts(df, ["doc_id"], "t", kws, keep_zeros=True).collect():
        assert r.n == pyref.overlap_count(texts[r.doc_id], r.keyword), r


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab c", max_size=30), min_size=1, max_size=4),
       st.lists(st.text(alphabet="abc", min_size=1, max_size=3), min_size=1, max_size=3, unique=True))
def test_overlap_property(spark, texts, kws):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, t string")
    got = {(r.doc_id, r.keyword): r.n for r in M.keyword_counts(df, ["doc_id"], "t", kws, keep_zeros=True).collect()}
    for (d, k), n in got.items():
        assert n == pyref.overlap_count(texts[d], k)


def test_fuzzy_hits_match_naive(spark):
    texts = ["Licence lisence license LICENSE lic", "nation natoin nations", "experience experiance exp"]
    kws = ["license", "nation", "experienec", "c"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, t string")
    got = {(r.doc_id, r.keyword): (r.n, r.words) for r in M.fuzzy_hits(df, ["doc_id"], "t", kws).collect()}
    for d, t in enumerate(texts):
        for k in kws:
            n, words = pyref.fuzzy(t, k)
            if n:
                assert got[(d, k)] == (n, sorted(set(words)))
            else:
                assert (d, k) not in got


def test_exact_then_fuzzy_gate(spark):
    texts = ["python pyton", "pyton pythn", "nothing here"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, t string")
    rows = {(r.doc_id, r.keyword): r for r in M.keyword_hits(df, ["doc_id"], "t", ["python"]).collect()}
    assert rows[(0, "python")].kind == "exact" and rows[(0, "python")].n == 1
    assert rows[(1, "python")].kind == "fuzzy" and rows[(1, "python")].n == 2
    assert rows[(1, "python")].words == ["pythn", "pyton"]
    assert (2, "python") not in rows


def test_edit_distance(spark):
    pairs = [("kitten", "sitting"), ("", "abc"), ("naïve", "naive"), ("flaw", "lawn")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in df.select(M.edit_distance("a", "b")).collect()]
    assert got == [pyref.edit_distance(a, b) for a, b in pairs]
    bounded = [r[0] for r in df.select(M.edit_distance("a", "b", 2)).collect()]
    assert bounded == [d if d <= 2 else -1 for d in got]


def test_matching_does_not_shuffle(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, t string")
    plan = M.keyword_hits(df, ["doc_id"], "t", KWS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_long_keyword_list(spark):
    kws = [f"w{i:03d}" for i in range(40)] + ["python"]
    df = spark.createDataFrame([(0, "w001 w001 w01 pyton w039x"), (1, "nothing")], "doc_id int, t string")
    rows = {(r.doc_id, r.keyword): r for r in M.keyword_hits(df, ["doc_id"], "t", kws).collect()}
    assert rows[(0, "w001")].kind == "exact" and rows[(0, "w001")].n == 2
    assert rows[(0, "python")].kind == "fuzzy" and rows[(0, "python")].words == ["pyton"]
    fz = {(r.doc_id, r.keyword): r.n for r in M.fuzzy_hits(df, ["doc_id"], "t", kws).collect()}
    text = "w001 w001 w01 pyton w039x"
    for k in kws:
        n, _ = pyref.fuzzy(text, k)
        assert fz.get((0, k), 0) == n


def test_repeated_keywords(spark):
    df = spark.createDataFrame([(0, "abab ab")], "doc_id int, t string")
    got = [(r.kw_pos, r.n) for r in M.keyword_counts(df, ["doc_id"], "t", ["ab", "b", "ab", ""]).orderBy("kw_pos").collect()]
    assert got == [(1, 3), (2, 3), (3, 3)]


def test_a_list_equals_its_parts(spark):
    from samples import CV_A
    texts = [CV_A.lower(), "reviews reveiws view veiw previews", "nation natoin national nations", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, t string")
    kws = ["view", "analyst", "exel", "nation", "python", "ledgers", "reports"] + [f"zz{i:02d}" for i in range(30)]
    long_rows = sorted(tuple(r) for r in M.keyword_hits(df, ["doc_id"], "t", kws).collect())
    short = []
    for chunk in (kws[:20], kws[20:]):
        offset = kws.index(chunk[0])
        for r in M.keyword_hits(df, ["doc_id"], "t", chunk).collect():
            short.append((r.doc_id, r.kw_pos + offset, r.keyword, r.kind, r.n, r.words))
    assert long_rows == sorted(short) and long_rows
    long_fz = sorted(tuple(r) for r in M.fuzzy_hits(df, ["doc_id"], "t", kws).collect())
    short_fz = []
    for chunk in (kws[:20], kws[20:]):
        offset = kws.index(chunk[0])
        for r in M.fuzzy_hits(df, ["doc_id"], "t", chunk).collect():
            short_fz.append((r.doc_id, r.kw_pos + offset, r.keyword, r.n, r.words))
    assert long_fz == sorted(short_fz)


def test_names_inside_keywords(spark):
    kws = ["_x", "_n", "_p", "'_r.x'", "a\\b", "\"q\"", "{j}", "_x.i = _y.i"]
    text = "_x _n _n_p '_r.x' a\\b \"q\" {j} _x.i = _y.i _xx"
    df = spark.createDataFrame([(0, text)], "doc_id int, t string")
    for r in M.keyword_counts(df, ["doc_id"], "t", kws, keep_zeros=True).collect():
        assert r.n == pyref.overlap_count(text, r.keyword), r
    got = {r.keyword: r.kind for r in M.keyword_hits(df, ["doc_id"], "t", kws).collect()}
    assert got == dict.fromkeys(kws, "exact")


def test_cost_follows_matches_not_the_list(spark):
    import time
    few = [f"k{i:03d}" for i in range(400)]
    many = few + [f"zz{i:05d}q" for i in range(9_600)]
    texts = [(d, " ".join(f"k{(d * 7 + j) % 400:03d}" for j in range(60))) for d in range(2000)]
    df = spark.createDataFrame(texts, "doc_id int, t string").cache()
    df.count()
    took, found = {}, {}
    for name, kws in (("few", few), ("many", many)):
        q = M.keyword_counts(df, ["doc_id"], "t", kws)
        best = []
        for _ in range(3):
            t0 = time.perf_counter()
            found[name] = sorted(map(tuple, q.collect()))
            best.append(time.perf_counter() - t0)
        took[name] = min(best)
    df.unpersist()
    assert found["few"] == found["many"]
    assert took["many"] < 2 * took["few"] + 0.3, took


def test_words_without_a_part_are_not_measured(spark):
    """Every near word matches the pattern that precedes the edit distance; most others do not."""
    import random
    rng = random.Random(5)
    keywords = ["license", "licensing", "a", "né", "c++", "aaaa", "characteristically", "tionre", "😀😀x.y", "engineering"]
    bounds = [M.fuzzy_bound(k) for k in keywords]

    def bent(w, n):
        for _ in range(n):
            i = rng.randrange(len(w) + 1)
            w = rng.choice([w[:i] + rng.choice("ae😀x") + w[i:], w[:i] + w[i + 1:], w[:i] + "c" + w[i + 1:]])
        return w
    words = {bent(k, rng.randrange(5)) for k in keywords for _ in range(60)} - {""}
    other = {"".join(rng.choices("bdfghjkmopquvwz", k=rng.randrange(4, 20))) for _ in range(300)}
    df = spark.createDataFrame([(w,) for w in words | other], "w string")
    pattern = M.near_word_pattern([k for k in keywords if len(k) > 2], [b for k, b in zip(keywords, bounds) if len(k) > 2])
    passed = {r.w for r in df.filter(F.col("w").rlike(pattern)).collect()}
    near = {w for w in words | other for k, b in zip(keywords, bounds) if len(k) > 2 and pyref.edit_distance(w, k) <= b}
    assert near <= passed and len(passed & other) < len(other) / 10
    texts = spark.createDataFrame([(1, " ".join(sorted(words | other)))], "doc_id int, t string")
    got = {r.keyword: (r.n, r.words) for r in M.fuzzy_hits(texts, ["doc_id"], "t", keywords).collect()}
    want = {k: pyref.fuzzy(" ".join(sorted(words | other)), k) for k in keywords}
    assert got == {k: (n, sorted(set(f))) for k, (n, f) in want.items() if n}


def test_one_pass_finds_the_words_of_all_lines(spark):
    """The pattern goes through all distinct words at once; parts that no word holds join no lines."""
    keywords = ["license", "thing", "the\nand", "nation"]
    bounds = [M.fuzzy_bound(k) for k in keywords]
    lines = ["the", "and", "licence", "thin", "zebra", "nations", "xthingx", "", "license\t"]
    df = spark.createDataFrame([("\n" + "\n".join(lines),)], "t string")
    found = df.select(F.regexp_extract_all("t", F.lit(M.near_word_pattern(keywords, bounds, "\\n")), F.lit(1))).first()[0]
    assert {"licence", "thin", "nations"} <= set(found) <= set(lines) and "zebra" not in found
    texts = ["the\nand the\nand Licence lICENCE licence", "the\nand licence licence nations THING", "thin\x85nation thin\r\nthink ΘΣ"]
    texts += [t.lower() for t in texts]
    rows = M.fuzzy_hits(spark.createDataFrame(list(enumerate(texts)), "doc_id int, t string"), ["doc_id"], "t", keywords).collect()
    want = {(d, k): pyref.fuzzy(t, k) for d, t in enumerate(texts) for k in keywords}
    assert {(r.doc_id, r.keyword): (r.n, r.words) for r in rows} == {k: (n, sorted(set(w))) for k, (n, w) in want.items() if n}
