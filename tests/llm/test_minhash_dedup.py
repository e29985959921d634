import random

import numpy as np

from dossier.llm.minhash_dedup import near_dedup, overlapping, shingles, signature

SCHEMA = "doc_id long, text string, n int, rep string, key string"


def words_of(text):
    return (text or "").encode().lower().split()


def set_of(text, k=5):
    w = words_of(text)
    return {tuple(w[i:i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set()


def brute(rows):
    sets = [set_of(t) for _, t, *_ in rows]
    comp = list(range(len(rows)))

    def root(a):
        while comp[a] != a:
            a = comp[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                comp[root(a)] = root(b)
    least = {}
    for a in range(len(rows)):
        least[root(a)] = min(least.get(root(a), rows[a][0]), rows[a][0])
    return sorted((rows[a][0], len(sets[a]), least[root(a)], rows[a][0] == least[root(a)]) for a in range(len(rows)))


def corpus(rng):
    vocab = [f"w{i}" for i in range(400)] + ["É", "b-c", "x\x1cy"]
    rows = []

    def add(words):
        rows.append((len(rows), rng.choice([" ", "\n", "\t "]).join(words), 1, "r", "k"))

    for _ in range(12):
        base = [rng.choice(vocab) for _ in range(rng.choice([8, 40, 150, 400]))]
        for _ in range(rng.choice([1, 3, 25])):
            own = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 40))):
                own[rng.randrange(len(own))] = rng.choice(vocab)
            add(own)
            if rng.random() < 0.3:
                base = own  # chains
    for t in (None, "", "  \n", "one", "ONE", "one two three four", "One two\nthree four", "a b c d e", "A b c d e"):
        rows.append((len(rows), t, 1, "r", "k"))
    rng.shuffle(rows)
    return rows


def test_equals_brute_force(spark):
    for seed in (10, 11):
        rows = corpus(random.Random(seed))
        got = near_dedup(spark.createDataFrame(rows, SCHEMA), block_rows=(1024, 5)[seed - 10])
        assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_set_sizes():
    for t in ("a b c d e f", "a a a a a a a a", "É é", "x\x1cy\x85z"):
        assert len(shingles(t)) == len(set_of(t))


def test_signature_estimates_overlap():
    rng = np.random.default_rng(12)
    a = rng.integers(0, 2 ** 63, 600).astype(np.uint64)
    est = []
    for share in (0.9, 0.5, 0.0):
        k = round(600 * 2 * share / (1 + share))
        b = np.concatenate([a[:k], rng.integers(0, 2 ** 63, 600 - k).astype(np.uint64)])
        est.append(float((signature(a, 144) == signature(b, 144)).mean()) - share)
    assert max(map(abs, est)) < 0.15
    assert (signature(a, 144, chunk=50) == signature(a, 144)).all()
    one = signature(a[:1], 144)  # a permutation: every step once
    assert sorted((one >> np.uint64(48)).tolist()) == list(range(144))


def test_overlapping_blocks():
    rng = np.random.default_rng(13)
    for _ in range(40):
        base = rng.integers(0, 2 ** 40, 5000).astype(np.uint64)
        sets = [np.unique(np.concatenate([base[:k], rng.integers(0, 2 ** 40, rng.integers(1, 30)).astype(np.uint64)]))
                for k in rng.integers(0, rng.choice([20, 5000]), 14)]
        for first in (0, 5):
            parent, up = overlapping(sets, first), list(range(14))
            for a in range(14):
                for b in range(a):
                    n = len(np.intersect1d(sets[a], sets[b]))
                    if (not first or b < first <= a) and 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
                        x, y = sorted((up[a], up[b]))
                        up = [x if u == y else u for u in up]
            assert parent.tolist() == up


def test_empty_and_repeated(spark):
    assert near_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
    text = " ".join(f"v{i}" for i in range(30))
    other = " ".join(f"u{i}" for i in range(40))
    nulls = [(None, other, 1, "", ""), (None, other + " x", 1, "", ""), (77, other + " x y", 1, "", "")]
    got = near_dedup(spark.createDataFrame(nulls, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(77, 38, 77, True), (None, 36, 77, False), (None, 37, 77, False)], key=str)
    rows = [(4, text, 1, "", ""), (4, text, 1, "", ""), (9, text + " more", 1, "", ""), (None, text, 1, "", ""),
            (4, "another", 1, "", ""), (None, None, 1, "", "")]
    got = near_dedup(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(4, 26, 4, True)] * 2 + [(9, 27, 4, False), (None, 26, 4, False), (4, 1, 4, True), (None, 0, None, True)], key=str)
