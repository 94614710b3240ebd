import math
import random

import numpy as np

from tiergrain.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, shard int"


def brute(rows, every=50, moved=7):
    best = {}
    for i, v, lab, _ in rows:
        if i is None or lab is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [math.floor(256 * float(np.float32(x))) for x in v]
        if i not in best or (lab, v) < best[i]:
            best[i] = (lab, v)
    table = {i: ((lab + 1) % 10 if i % moved == 0 else lab, v) for i, (lab, v) in best.items()}
    out = set()
    for a, (la, va) in table.items():
        if a % every:
            continue
        score = {i: sum(x * y for x, y in zip(va, v)) for i, (_, v) in table.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if table[i][0] == la][:5]:
            hard = [i for i in order if table[i][0] != la and 50 * score[p] <= 100 * score[i] <= 95 * score[p]][:3]
            out |= {(a, p, k, i, score[p], score[i]) for k, i in enumerate(hard, 1)}
    return out


def got(spark, rows, **kw):
    found = H.mine_hard_negatives(spark.createDataFrame(rows, SCHEMA), **kw).collect()
    out = {tuple(r) for r in found}
    assert len(out) == len(found)
    return out


def clustered(seed, n, width=12, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels * 3, width))
    rows = []
    for i in range(n):
        c = rng.integers(len(centres))
        rows.append((int(i), [float(x) for x in centres[c] + 0.2 * rng.normal(size=width)], int(c % labels), 9))
    return rows


def test_windows_equal_brute_force(spark):
    rows = clustered(1, 600)
    want = brute(rows)
    assert len(want) > 50
    assert got(spark, rows) == want
    assert got(spark, rows, codewords=6, shard_rows=70, sample_rows=100) == want      # many shards, split cells


def test_search_stops_early_and_is_certain(monkeypatch):
    rows = clustered(2, 3000)
    x = np.floor(256 * np.array([r[1] for r in rows]))
    index = H.MultiIndex([], x.shape[1])
    index.books = [H.fit_codebook(p, 16) for p in index.halves(x)]
    words, far = index.cells(x)
    index.radii = [np.array([f[w == k].max(initial=0) for k in range(len(b))])
                   for w, f, b in zip(words, far, index.books)]
    monkeypatch.setattr(H, "STEP_ROWS", 64)
    ids, labels = np.arange(len(x)), np.array([r[2] for r in rows])
    shard = H._Shard(index, ids, labels, x, *words)
    seen = []
    whole = shard.scores
    shard.scores = lambda a, r: (seen.append(len(r)), whole(a, r))[1]
    bounds = index.half_bounds(x)
    for a in range(0, 3000, 300):
        score = (x @ x[a]).astype(int)
        same = sorted((-int(score[i]), int(i)) for i in ids if labels[i] == labels[a] and i != a)[:5]
        found = H.find_positives(shard, x[a], a, labels[a], -(1 << 63), [h[a] for h in bounds])
        assert found == [(-s, i) for s, i in same]
        for i in range(0, 3000, 7):
            assert score[i] <= bounds[0][a][words[0][i]] + bounds[1][a][words[1][i]]
    assert sum(seen) < 0.5 * 10 * len(x) / 4


def test_cells_come_by_falling_bound():
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=9), rng.normal(size=7)
    a[3] = a[4]
    found = list(H.multi_sequence(a, b))
    assert len({(i, j) for _, i, j in found}) == 63
    assert [s for s, _, _ in found] == sorted((s for s, _, _ in found), reverse=True)
    assert all(abs(s - a[i] - b[j]) < 1e-12 for s, i, j in found)


def test_ties_repeats_nulls_and_short_vectors(spark):
    rng = random.Random(4)
    same = [1.0, 0.5, -0.25, 0.125]
    rows = [(i, same, i % 3, None) for i in range(200)]                    # a cell that holds nearly all rows
    rows += [(1000 + i, [rng.gauss(0, 1) for _ in range(rng.randint(0, 5))], rng.randrange(3), i) for i in range(150)]
    rows += rng.choices(rows, k=60) + [(50, [9.0], 0, 1), (100, None, 1, 1), (150, same, None, 1), (None, same, 0, 1),
                                       (300, [float("nan")], 0, 1), (350, [float("inf"), 1.0], 0, 1), (400, [None], 1, 1),
                                       (450, [], 0, 1), (-50, same, 2, 1), (500, [3e5, 2e5], 0, 1), (501, [-2e5, 3e5], 0, 1),
                                       (502, [3e5, 1.5e5], 1, 1)]
    for kw in ({}, {"codewords": 3, "shard_rows": 40}):
        assert got(spark, rows, **kw) == brute(rows)


def test_empty_and_tiny_tables(spark):
    assert got(spark, []) == set()
    assert got(spark, [(50, [1.0], 0, 0)]) == set()
    rows = [(50, [1.0], 0, 0), (51, [1.0], 0, 0), (52, [0.75], 1, 0)]
    assert got(spark, rows) == brute(rows) != set()
