import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from dossier.llm.suffix_dedup import RunLengthIndex, keys_of, pieces_of, suffix_dedup

SCHEMA = "doc_id long, text string, c1 string, copies int, key string"


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), int(gone.sum()), int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(b) else 0,
                    hashlib.sha256(kept).hexdigest(), kept))
    return out


def corpus(rng, unit):
    letters = "abcdefghij é"
    noise = lambda n: "".join(rng.choice(letters) for _ in range(n))
    shared = [noise(unit * rng.choice([1, 2, 3]) + rng.randrange(-2, 6)) for _ in range(5)]
    texts = [None, "", "x", "ab" * unit, "a" * unit * 4, "é" * unit, noise(unit), noise(unit) * 3]
    for _ in range(60):
        t = noise(rng.randrange(unit * 3))
        for _ in range(rng.randrange(3)):
            s = rng.choice(shared)
            t += s[rng.randrange(3):len(s) - rng.randrange(3)] + noise(rng.randrange(unit))
        texts.append(t)
    base = noise(unit * 12)
    for _ in range(15):
        i = rng.randrange(len(base))
        texts.append(base[:i] + rng.choice(letters) + base[i + 1:])
    return texts + rng.choices(texts, k=12)


@pytest.mark.parametrize("most, block", [(4096, 1 << 20), (3, 500)])
def test_equals_brute_force(spark, most, block):
    texts = corpus(random.Random(14), 24)
    rows = [(i, t, "c", 1, "k") for i, t in enumerate(texts)]
    got = suffix_dedup(spark.createDataFrame(rows, SCHEMA).repartition(3), length=24, gram=8, most_pieces=most,
                       block_bytes=block, with_kept=True).collect()
    want = brute(texts, 24)
    assert len(got) == len(texts)
    for r in got:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], bytes(r["kept"])) == want[r["doc_id"]]
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]


def test_full_length(spark):
    texts = corpus(random.Random(15), 200)
    rows = [(i, t, "c", 1, "k") for i, t in enumerate(texts)]
    got = suffix_dedup(spark.createDataFrame(rows, SCHEMA)).collect()
    want = brute(texts, 200)
    for r in got:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]][:4]


def test_index_equals_plain_statistics():
    rng = random.Random(16)
    for _ in range(150):
        pieces = ["".join(rng.choice("ab") for _ in range(rng.randrange(0, 30))).encode() for _ in range(rng.randrange(1, 6))]
        index = RunLengthIndex(pieces)
        ms = index.matching_statistics()
        every = [(p, i) for p in range(len(pieces)) for i in range(len(pieces[p]))]
        for p, i in every:
            best = 0
            for q, j in every:
                if (p, i) != (q, j):
                    n = 0
                    while pieces[p][i + n:i + n + 1] == pieces[q][j + n:j + n + 1] != b"":
                        n += 1
                    best = max(best, n)
            assert ms[index.starts[p] + i] == best
        assert index.lengths.sum() == len(index.text)


def test_every_window_has_a_key():
    rng = random.Random(17)
    for _ in range(50):
        text = "".join(rng.choice("ab") for _ in range(rng.randrange(24, 300))).encode()
        once, often = keys_of(text, 24, 8)
        keys, first, last = pieces_of(text, 24, 8)
        assert set(keys.tolist()) == set(once.tolist()) | set(often.tolist())
        assert first[0] == 0 and last[-1] == len(text) - 24 and (first[1:] == last[:-1] + 1).all()


def test_empty_and_repeated(spark):
    assert suffix_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
    t = "".join(random.Random(18).choice("abcdef ") for _ in range(300))
    rows = [(1, t, "", 0, ""), (1, t, "", 0, ""), (None, t[:150], "", 0, ""), (2, None, "", 0, "")]
    got = suffix_dedup(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["n_bytes"], r["n_removed"]) for r in got) == [(0, 0), (150, 0), (300, 300), (300, 300)]


def test_copies_are_counted_in_the_index():
    rng = random.Random(19)
    for _ in range(100):
        pieces = list({"".join(rng.choice("ab") for _ in range(rng.randrange(1, 20))).encode() for _ in range(5)})
        counts = [rng.randrange(1, 4) for _ in pieces]
        index = RunLengthIndex(pieces, counts)
        plain = RunLengthIndex([p for p, n in zip(pieces, counts) for _ in range(n)])
        assert index.lengths.sum() == len(plain.text)
        ms, want, at = index.matching_statistics(), plain.matching_statistics(), 0
        for i, (p, n) in enumerate(zip(pieces, counts)):
            a, b = index.starts[i], plain.starts[at]
            assert ms[a:a + len(p)].tolist() == want[b:b + len(p)].tolist()
            at += n


def test_long_texts_are_read_in_parts(monkeypatch):
    from dossier.llm import suffix_dedup as module
    rng = random.Random(20)
    text = "".join(rng.choice("ab ") for _ in range(1000)).encode() + b"ab" * 700
    once, often = keys_of(text, 24, 8)
    monkeypatch.setattr(module, "CHUNK", 100)
    monkeypatch.setattr(module, "MOST_WINDOWS", 30)
    some, more = keys_of(text, 24, 8)
    keys, first, last = pieces_of(text, 24, 8)
    assert set(often.tolist()) <= set(more.tolist())
    assert set(some.tolist()) | set(more.tolist()) == set(once.tolist()) | set(often.tolist()) == set(keys.tolist())
    assert first[0] == 0 and last[-1] == len(text) - 24 and (first[1:] == last[:-1] + 1).all()
    assert (last - first).max() < 30


def test_crowded_keys_get_longer_ones(spark):
    rng = random.Random(21)
    noise = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    short, long = noise(23), noise(40)  # one byte less than a repeat; a repeat
    texts = [noise(30) + short + noise(30) for _ in range(40)] + [noise(30) + long + noise(30) for _ in range(40)]
    texts += ["ab" * 900, "ab" * 400 + "c", noise(10) + "xyz" * 500]
    rows = [(i, t, "c", 1, "k") for i, t in enumerate(texts)]
    got = suffix_dedup(spark.createDataFrame(rows, SCHEMA).repartition(5), length=24, gram=8, most_pieces=5).collect()
    want = brute(texts, 24)
    for r in got:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]][:4]


def test_a_very_long_text():
    text = ("ab" * 2_500_000 + "c" * 3_000_000).encode()
    keys, first, last = pieces_of(text)
    distinct = {(k, text[a:e + 200]) for k, a, e in zip(keys.tolist(), first.tolist(), last.tolist())}
    assert len(keys) > 10_000 and len(distinct) < 1000
