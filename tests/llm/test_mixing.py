import random
import re
from collections import defaultdict
from fractions import Fraction

from dossier.llm.mixing import fit, mix


def brute_targets(sizes):
    keys = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {k: (3, 1, 2)[i % 3] for i, k in enumerate(keys)}
    target, total = {}, Fraction(3, 2) * sum(sizes.values())
    live = set(keys)
    while live:
        share = (total - sum(target.values())) / sum(weight[k] for k in live)
        above = {k for k in live if share * weight[k] >= 2 * sizes[k]}
        if not above:
            target |= {k: share * weight[k] for k in live}
            break
        target |= {k: Fraction(2 * sizes[k]) for k in above}
        live -= above
    return target


def test_fit_meets_the_budget():
    rng = random.Random(6)
    for _ in range(300):
        lengths = rng.sample(range(1, 60), rng.randrange(1, 12))
        counts = [rng.randrange(1, 9) for _ in lengths]
        budget = rng.randrange(0, sum(n * c for n, c in zip(lengths, counts)) + 5)
        take = fit(lengths, counts, budget, dp_words=rng.choice([64, 1 << 17]))
        got = sum(n * t for n, t in zip(lengths, take))
        assert all(0 <= t <= c for t, c in zip(take, counts)) and got <= budget
        assert budget - got < max(lengths) or got == sum(n * c for n, c in zip(lengths, counts))
    assert sum(n * t for n, t in zip([3, 5, 7], fit([3, 5, 7], [50, 50, 50], 331))) == 331


def test_mix_meets_its_targets(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice(["a"] * 9 + ["b", "c", "ü", "Z", None]), " ".join("w" * rng.randrange(1, 90)), 1.0, 2)
            for i in range(900)]
    rows += [(2000, "empty", None, 1.0, 2), (2001, "empty", " \n", 1.0, 2), (2002, "b", "x\x1cy z", 1.0, 2), (5, "b", "again", 1.0, 2),
             (5, "b", "again", 1.0, 2), (None, None, "no id", 1.0, 2)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, target double, size int")
    got = mix(df).collect()
    assert len(got) == len(rows)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for _, s, t, *_ in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    for r in got:
        assert r["taken"] in (0, r["size"], 2 * r["size"]) and r["source_size"] == sizes[r["source"]]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    want = brute_targets(sizes)
    for s in sizes:
        assert abs(target[s] - float(want[s])) < 1e-6
        assert abs(taken[s] - target[s]) <= 2, (s, taken[s], target[s])
    again = mix(df.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mix(df.limit(0)).count() == 0


def test_fit_finds_the_nearest_sum():
    rng = random.Random(9)
    for _ in range(200):
        lengths = rng.sample(range(1, 40), rng.randrange(1, 7))
        counts = [rng.randrange(1, 5) for _ in lengths]
        budget = rng.randrange(0, sum(n * c for n, c in zip(lengths, counts)) + 3)
        sums = {0}
        for n, c in zip(lengths, counts):
            sums = {s + n * k for s in sums for k in range(c + 1)}
        take = fit(lengths, counts, budget)
        assert sum(n * t for n, t in zip(lengths, take)) == max(s for s in sums if s <= budget), (lengths, counts, budget)


def test_fit_in_bounded_memory():
    import tracemalloc
    lengths = list(range(2, 20_002, 2))
    tracemalloc.start()
    take = fit(lengths, [1000] * len(lengths), 50_000_001)  # odd: never reached
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(n * t for n, t in zip(lengths, take)) == 50_000_000 and most < 200e6, most
