import hashlib
import random

import pytest

from dossier.llm.exact_dedup import exact_dedup

SCHEMA = "doc_id long, text string, row string, bucket int, keep string"


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    return sorted((i, max(groups[t or ""]), len(groups[t or ""]), i == max(groups[t or ""]),
                   hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)


@pytest.mark.parametrize("bits", [64, 2])
def test_equals_brute_force(spark, bits):
    rng = random.Random(1)
    texts = [None, "", "a", "é" * 37, "x\ny" * 50] + ["".join(rng.choice("ab\n") for _ in range(rng.randrange(1, 60)))
                                                       for _ in range(60)]
    rows = [(i, rng.choice(texts)) for i in range(400)]
    df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA)
    got = sorted(tuple(r) for r in exact_dedup(df, block_chars=4, bucket_bits=bits).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())
    assert got == brute(rows)


def test_repeated_rows_and_null_ids_keep_one(spark):
    df = spark.createDataFrame([(1, "t"), (1, "t"), (None, "t"), (None, "u"), (7, "v")], "doc_id long, text string")
    got = exact_dedup(df).collect()
    assert sum(r["kept"] for r in got) == 3
    assert {(r["keep_id"], r["group_size"]) for r in got} == {(1, 3), (None, 1), (7, 1)}


def test_empty_table(spark):
    assert exact_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
