import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from dossier.llm.common import Scratch
from dossier.llm.prefix_trie import prefix_trie, shared_heads, turn_lists

FIELDS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def ordered(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            r, x = role or "", text or ""
            tie = hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).digest()[:16]
            own[c].append((turn is not None, turn or 0, tie, (r, x)))
    return {c: [t[-1] for t in sorted(ts)] for c, ts in own.items()}


def rebuilt(own):
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + ts[h:]
    return out


def nodes(convs):
    members = defaultdict(list)
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    out = []
    for p, who in members.items():
        below, leaves, saved = [p], 0, 0
        while below:
            q = below.pop()
            leaves += not kids[q]
            saved += (len(members[q]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) if q else 0
            below += kids[q]
        ends = ",".join(str(c) for c in sorted(who) if len(convs[c]) == len(p))
        out.append((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), len(kids[p]), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return out


def told(df):
    return sorted(map(repr, (tuple(r[c] for c in FIELDS) for r in df.collect())))


def check(spark, rows, cells, schema=SCHEMA):
    got = prefix_trie(shared_heads(spark.createDataFrame(rows, schema), Scratch(spark, "test-trie")), cells)
    assert told(got) == sorted(map(repr, nodes(rebuilt(ordered(rows)))))


def made(seed, convs, copies):
    rng, rows = random.Random(seed), []
    for c in range(convs):
        for t in range(rng.choice([0, 1, 2, 3, 3, 5, 9])):
            rows.append((c, t, rng.choice(["user", "user", "assistant", None]), rng.choice(["a b", "", "c", None, "d  e\tf g"])))
    for k in range(copies):  # one conversation many times, longer than any head
        rows += [(1000 + k, t, "user", f"same {t}") for t in range(6)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("cells", [1, 40, 1 << 21])
def test_against_brute_force(spark, cells):
    check(spark, made(3, 150, 200), cells)


def test_borders_of_any_kind(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        check(spark, made(4, 60, 90), 25)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_lists_as_they_are(spark):
    rows = made(5, 80, 20)
    got = prefix_trie(turn_lists(spark.createDataFrame(rows, SCHEMA)), 60)
    assert told(got) == sorted(map(repr, nodes(ordered(rows))))


def test_odd_rows(spark):
    rows = [(None, 0, "user", "no id"), (20, None, None, None), (20, 0, "user", "x"), (20, 0, "user", "x"), (20, 0, "assistant", "y"),
            (21, 5, "", ""), (22, None, "user", "long " * 200_000), (45, 1, "user", "base is absent"),
            *[(60, t, "user", str(t)) for t in range(120)], *[(61, t, "user", str(t)) for t in range(119)]]
    check(spark, rows, 200)


def test_empty_and_clashing_columns(spark):
    assert prefix_trie(shared_heads(spark.createDataFrame([], SCHEMA), Scratch(spark, "test-trie"))).count() == 0
    rows = made(6, 40, 5)
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("turns", "known", "id", "words", "key", "shard", "depth", "base", "head", "first"):
        df = df.withColumn(c, F.lit("x"))
    got = prefix_trie(shared_heads(df, Scratch(spark, "test-trie")))
    assert told(got) == sorted(map(repr, nodes(rebuilt(ordered(rows)))))
