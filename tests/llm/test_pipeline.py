import re
from collections import Counter, defaultdict

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as cp
from dossier.llm.common import Scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def shingle_set(t):
    w = (t or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def test_each_stage_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = spark.createDataFrame([(90001, None, "en", "src0", 0), (90002, "", "en", None, 0), (90003, "12 !! 3", "de", "src1", 7),
                                   (90004, "lone word", None, None, 9)], docs.schema)
    near = [(91000 + r["doc_id"], r["text"] + " one more", r["lang"], r["source"], 0)
            for r in docs.filter("n_chars > 800").orderBy("doc_id").limit(9).collect()]
    docs = docs.unionByName(extra).unionByName(spark.createDataFrame(near, docs.schema))
    scratch = Scratch(spark, "test-pipeline")
    tables, now = [docs], docs
    for name, stage in cp.STAGES:
        now = scratch.save(stage(spark, now, "/root/testdata/sf0.001"), name)
        tables.append(now)
    for t in tables[:-1]:
        assert t.columns == COLUMNS
    rows = [[(r["doc_id"], r["text"], r["source"]) for r in t.collect()] for t in tables[:-1]]

    assert sorted(rows[1]) == sorted(r for r in rows[0] if r[1] and any(c.isalpha() for c in r[1]))

    last = {}
    for i, t, s in rows[1]:
        last[t] = max(last.get(t, i), i)
    assert sorted(map(str, rows[2])) == sorted(str(r) for r in rows[1] if last[r[1]] == r[0])

    sets = {i: shingle_set(t) for i, t, _ in rows[2]}
    owners, near = defaultdict(list), defaultdict(Counter)
    for i, s in sets.items():
        for x in s:
            for j in owners[x]:
                near[i][j] += 1
            owners[x].append(i)
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, others in near.items():
        for j, n in others.items():
            if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    assert sorted(r[0] for r in rows[3]) == sorted(i for i in sets if root(i) == i)
    assert len(rows[3]) < len(rows[2]) < len(rows[1]) < len(rows[0])

    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    before, after, times = Counter(), Counter(), Counter(r[0] for r in rows[4])
    for i, t, s in rows[3]:
        before[s] += size(t)
    for i, t, s in rows[4]:
        after[s] += size(t)
    assert set(rows[4]) <= set(rows[3]) and max(times.values()) <= 2
    assert abs(sum(after.values()) - 1.5 * sum(before.values())) <= 0.01 * sum(before.values())
    assert all(after[s] <= 2 * before[s] for s in before)

    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for i, t, _ in rows[4]:
        want[i] += len(plain.encode(t, add_special_tokens=False).ids) + 1
    got, sequences = Counter(), Counter()
    for r in tables[-1].collect():
        got[r["doc_id"]] += r["length"]
        sequences[r["sequence_id"]] += r["length"]
    assert got == want and max(sequences.values()) <= 4096


def test_odd_tables(spark):
    schema = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").schema
    empty = spark.createDataFrame([], schema)
    for _, stage in cp.STAGES:
        assert stage(spark, empty, "").count() == 0
    odd = spark.createDataFrame([(1, "same text", "en", "s", 1), (1, "same text", "en", "s", 1), (None, "same text", None, None, 1),
                                 (None, "other", None, None, 1), (1, "third", "en", None, None)], schema)
    assert cp.without_copies(spark, odd, "").count() == 3
    assert cp.by_language(spark, odd, "").count() == 5
    assert 0 < cp.mixed(spark, odd, "").count() <= 10


def test_clashing_column_names(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = ["_copies", "_turn", "_sha", "count", "kept", "_size"]
    more = docs.selectExpr("*", *[f"doc_id AS {c}" for c in extra])
    more = more.unionByName(more.limit(3))  # repeated ids as well
    for name, stage in cp.STAGES[:-1]:
        got = stage(spark, more, "")
        assert got.columns == more.columns, name
        assert got.filter(" OR ".join(f"{c} <> doc_id" for c in extra)).count() == 0
    assert cp.packed(spark, more, "").count() > 0


def test_near_stage_links_from_0_80(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("text is not null and text <> ''").dropDuplicates(["doc_id"])
    pairs = [(92020, [f"v{k}" for k in range(84)]), (92021, [f"v{k}" for k in range(104)]),  # 80 of 100 shingles: 0.80
             (92030, [f"u{k}" for k in range(83)]), (92031, [f"u{k}" for k in range(103)])]  # 79 of 99: under 0.80
    docs = docs.unionByName(spark.createDataFrame([(i, " ".join(w), "en", "s", 0) for i, w in pairs], docs.schema))
    sets = {r["doc_id"]: shingle_set(r["text"]) for r in docs.collect()}
    ids, up, between = sorted(sets), {i: i for i in sets}, 0

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for k, i in enumerate(ids):
        for j in ids[:k]:
            n = len(sets[i] & sets[j])
            if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                between += 100 * n < 85 * (len(sets[i]) + len(sets[j]) - n)
                a, b = sorted((root(i), root(j)))
                up[b] = a
    assert between >= 3 and root(92021) == 92020 and root(92031) == 92031
    got = cp.without_near_copies(spark, docs, "")
    assert sorted(r["doc_id"] for r in got.collect()) == [i for i in ids if root(i) == i]


def test_language_stage_without_labels(spark):
    schema = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").schema
    texts = ["some words", "a", "12 !! 3", "", None, "数", "_ ²½ Ⅷ", "1a"]
    for lang in (None, "und"):
        docs = spark.createDataFrame([(k, t, lang, "s", 1) for k, t in enumerate(texts * 5)], schema)
        got = cp.by_language(spark, docs, "").collect()
        assert sorted(r["doc_id"] for r in got) == [k for k, t in enumerate(texts * 5) if t and any(c.isalpha() for c in t)]
