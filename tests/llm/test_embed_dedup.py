import numpy as np
import pytest

from dossier.llm.embed_dedup import embedding_dedup, needed

SCHEMA = "vec_id long, embedding array<float>, label int, n string, c0 int"


def brute(rows, t=0.98):
    ids = [r[0] for r in rows]
    ok = [v is not None and lab is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
          for _, v, lab, *_ in rows]
    adj = {k: set() for k in range(len(rows))}
    for a in range(len(rows)):
        for b in range(a):
            if ok[a] and ok[b] and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], "f4").astype(float), np.array(rows[b][1], "f4").astype(float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= t:
                    adj[a].add(b)
                    adj[b].add(a)
    out, seen = [], {}
    for a in adj:
        if a not in seen:
            todo, own = [a], {a}
            while todo:
                for b in adj[todo.pop()] - own:
                    own.add(b)
                    todo.append(b)
            seen |= dict.fromkeys(own, min(ids[k] for k in own))
    for a in adj:
        out.append((ids[a], len(adj[a]), seen[a], ids[a] == seen[a]))
    return sorted(out)


def planted(rng, n=500, dim=16):
    base = rng.standard_normal((n, dim))
    rows = [(i, base[i].tolist(), int(rng.integers(3)), "x", 0) for i in range(n)]
    for k in range(6):  # groups from chains to dense ones
        at = base[k]
        for _ in range(40):
            at = at + rng.standard_normal(dim) * [0.02, 0.1, 0.2, 0.25, 0.3, 0.4][k] * np.linalg.norm(at) / np.sqrt(dim)
            rows.append((len(rows), at.tolist(), rows[k][2], "x", 0))
    for k in range(30):
        rows.append((len(rows), rows[k][1] if k % 2 else [3 * x for x in rows[k][1]], rows[k][2], "x", 0))
    return rows


@pytest.mark.parametrize("block", [4096, 40])
def test_equals_brute_force(spark, block):
    rows = planted(np.random.default_rng(9))
    rows += [(5000, None, 1, "x", 0), (5001, [0.0] * 16, 1, "x", 0), (5002, [None] + [1.0] * 15, 1, "x", 0),
             (5003, [float("nan")] * 16, 1, "x", 0), (5004, rows[0][1], None, "x", 0), (5005, [], 1, "x", 0),
             (5006, rows[0][1][:5], rows[0][2], "x", 0), (5007, [1.0], 1, "x", 0), (5008, [2.0], 1, "x", 0),
             (5009, [-1.0], 1, "x", 0), (5010, [1.0, 0.0], 1, "x", 0), (5011, [1.0, 0.1], 1, "x", 0),
             (5012, [float("inf")] + [1.0] * 15, 1, "x", 0)]
    got = embedding_dedup(spark.createDataFrame(rows, SCHEMA), block=block)
    assert sorted(tuple(r) for r in got.select("vec_id", "n_links", "component_id", "kept").collect()) == brute(rows)


def test_needed():
    assert 20 < needed() < 32 and needed(10, 100.0, 0.99) == 10


def test_empty_and_repeated(spark):
    assert embedding_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, [1.0, 2.0], 0, "", 0), (1, [1.0, 2.0], 0, "", 0), (2, [1.0, 2.01], 0, "", 0)]
    got = embedding_dedup(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(tuple(r) for r in got) == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False)]


@pytest.mark.parametrize("block", [4096, 7])
def test_rows_without_id_link(spark, block):
    rows = planted(np.random.default_rng(11), n=120)
    named = [(None if k % 5 == 0 else r[0], *r[1:]) for k, r in enumerate(rows)]
    named += [(None, [5.0] * 16, 7, "x", 0), (None, [5.0] * 16, 7, "x", 0), (None, [5.0] * 15 + [5.1], 7, "x", 0),
              (None, None, 1, "x", 0), (None, rows[0][1], None, "x", 0)]
    got = embedding_dedup(spark.createDataFrame(named, SCHEMA), block=block).select("vec_id", "n_links", "component_id").collect()
    want = brute([(k if r[0] is not None else 10_000 + k, *r[1:]) for k, r in enumerate(named)])  # nulls last
    want = [(i if i < 10_000 else None, n, c if c < 10_000 else None) for i, n, c, _ in want]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert sum(i is None and n > 0 and c is not None for i, n, c in want) > 20


def test_repeated_ids_share_a_component(spark):
    rows = [(7, [1.0, 0.0], 0, "", 0), (7, [0.0, 1.0], 0, "", 0), (3, [1.0, 0.01], 0, "", 0), (7, None, 0, "", 0)]
    got = embedding_dedup(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(tuple(r) for r in got) == [(3, 1, 3, True), (7, 0, 3, False), (7, 0, 3, False), (7, 1, 3, False)]
