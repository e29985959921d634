import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dossier.llm import langid
from dossier.llm.langid import Profiles, grams, identify, learn, ranked

SCHEMA = "doc_id long, text string, lang string, score string, held_out int"


def plain_grams(text):
    words = "".join(c if c.isalnum() and not c.isdecimal() else " " for c in text.lower()).split()
    found = Counter()
    for w in words:
        w = f" {w} "
        for n in (1, 2, 3):
            found.update(w[i:i + n] for i in range(len(w) - n + 1) if w[i:i + n].strip())
    return found


def test_grams_equal_a_plain_count():
    for text in ("Ab, ab c! é", "x", "don't stop 12 now\n\tñandú", "a b a b"):
        found, counts = grams(text)
        want = plain_grams(text)
        got = {}
        for g, n in zip(found.tolist(), counts.tolist()):
            s = ""
            while g:
                s, g = chr(g & 0x1FFFFF) + s, g >> 21
            got[s] = n
        # a blank between two words is shared there, and counted once for each here
        assert {k: v for k, v in want.items() if k.strip()} == got


def test_distance():
    a, b = grams("aaab"), grams("zzzy")
    p = Profiles({"a": ranked(*a, 5).tolist(), "b": ranked(*b, 5).tolist()}, 5)
    assert p.predict("aaab") == ("a", 1.0)
    assert p.predict("zzzy") == ("b", 1.0)
    assert p.predict("qqq")[0] == "a" and p.predict("qqq")[1] == 0.0


def test_odd_rows(spark):
    rows = [(i, "the cat and the dog " * 3, "en", "x", 1) for i in range(9)] + \
           [(i, "der hund und die katze " * 3, "de", "x", 1) for i in range(9, 20)] + \
           [(30, None, "en", "x", 1), (31, "", "en", "x", 1), (32, "12 ²½ !!", "de", "x", 1), (33, "hund " * 9999, None, "x", 1),
            (None, "the cat", "en", "x", 1), (1, "the cat", "en", "x", 1)]
    got = identify(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert [by[i]["lang_pred"] for i in (30, 31, 32, 33, 2, 12)] == ["und", "und", "und", "de", "en", "de"]
    assert all(0 <= r["score"] <= 1 for r in got)
    for r in got:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
    assert identify(spark.createDataFrame([], SCHEMA)).count() == 0
    assert identify(spark.createDataFrame([(1, "a", None, "", 0)], SCHEMA)).first()["lang_pred"] == "und"


def brute_ranks(texts, size):
    """The most frequent n-grams of the texts, most frequent first; ties by length, then code points."""
    found = Counter()
    for text in texts:
        words = "".join(c if c.isalnum() and not c.isdecimal() else " " for c in text.lower()).split()
        if any(c.isalpha() for w in words for c in w):
            line = f" {' '.join(words)} "
            for n in (1, 2, 3):
                for i in range(len(line) - n + 1):
                    g = line[i:i + n]
                    if g != " " and not (n == 3 and g[1] == " "):
                        found[g] += 1
    return sorted(found, key=lambda g: (-found[g], len(g), g))[:size]


def test_equals_brute_force(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").collect()
    learned, size = {}, 60  # few n-grams, so that some documents are near two languages
    for r in rows:
        if r["text"] is not None and r["lang"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1:
            learned.setdefault(r["lang"], []).append(r["text"])
    profiles = {lang: {g: i for i, g in enumerate(brute_ranks(texts, size))} for lang, texts in learned.items()}
    want = {}
    for r in rows:
        own = brute_ranks([r["text"] or ""], size)
        away = {lang: sum(abs(i - p[g]) if g in p else size for i, g in enumerate(own)) for lang, p in profiles.items()}
        best = min(away, key=lambda x: (away[x], x))
        want[r["doc_id"]] = (best, round(1 - away[best] / (len(own) * size), 9)) if own else ("und", 0.0)
    got = identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), profile_size=size).collect()
    assert len(got) == len(rows) and len(profiles) > 2
    assert {r["doc_id"]: (r["lang_pred"], round(r["score"], 9)) for r in got} == want


def learned(profiles):
    """Languages, n-grams and ranks of some profiles."""
    return profiles.langs, profiles.known.tolist(), profiles.rank.tolist()


def test_a_repeated_id_is_learned_once(spark):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows = [(i, "the cat" + " and the dog" * k, "en", "x", 1) for k, i in enumerate(ids[:10])] + [(ids[10], "der hund", "de", "x", 1)]
    french = [(ids[0], "la chatte et le chien " * k, "fr", "x", 1) for k in (1, 2)]
    copies = [rows[0]] * 500 + [french[0]] * 3
    once = learn(spark.createDataFrame(rows + french, SCHEMA))
    again = learn(spark.createDataFrame(rows + french + copies, SCHEMA), sample_docs=1000)
    assert once.langs == ["de", "en", "fr"] and learned(once) == learned(again)


def test_too_many_languages_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(langid, "MOST_LANGS", 3)
    texts = [(i, "abc", f"l{i}", "x", 1) for i in range(20)]
    with pytest.raises(ValueError, match="languages"):
        learn(spark.createDataFrame(texts, SCHEMA))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = identify(docs).join(docs, "doc_id").filter("held_out and lang is not null")
    right, n = got.agg(F.count_if(F.col("lang_pred") == F.col("lang")), F.count(F.lit(1))).first()
    assert n > 30 and right / n > 0.9
