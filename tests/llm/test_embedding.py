import math

import numpy as np

from framelake.llm import embedding


def plain(rows, threshold):
    unit, ok = {}, {}
    for k, (_, v, g) in enumerate(rows):
        ok[k] = g is not None and bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
        if ok[k]:
            x = np.array(v, float)
            unit[k] = x / np.linalg.norm(x)
    links, root = [0] * len(rows), list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in unit:
        for b in unit:
            if a < b and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                links[a] += 1
                links[b] += 1
                root[top(a)] = top(b)
    low = {}
    for k, (i, _, _) in enumerate(rows):
        t = top(k)
        if i is not None and (t not in low or i < low[t]):
            low[t] = i
    return sorted(((i, links[k], low.get(top(k)), i is not None and i == low.get(top(k))) for k, (i, _, _) in enumerate(rows)), key=str)


def test_against_brute_force(spark):
    r = np.random.default_rng(8)
    rows, n = [], 0
    for g in (1, 2):
        for _ in range(60):
            base = r.normal(size=12)
            for _ in range(int(r.integers(1, 5))):
                rows.append((n, (base + r.normal(size=12) * r.choice([0, 0.02, 0.12])).astype(np.float32).tolist(), g))
                n += 1
    dense = r.normal(size=12)
    rows += [(n + k, (dense + r.normal(size=12) * 0.03).astype(np.float32).tolist(), 1) for k in range(150)]
    copy = rows[3][1]
    rows += [(9000 + k, copy, 1) for k in range(40)] + [(9100, [2 * x for x in copy], 1), (9101, copy, 2), (9102, copy, None)]
    rows += [(9200, None, 1), (9201, [], 1), (9202, [0.0] * 12, 1), (9203, [float("nan")] * 12, 1), (9204, [None, 1.0], 1), (9205, [float("inf"), 1.0], 1)]
    rows += [(9206, [1.0, 0.0], 1), (9207, [1.0, -0.0], 1), (9208, [1e30, 1e28], 1), (None, copy, 1), (3, copy, 1), (9300, [-x for x in copy], 1)]
    df = spark.createDataFrame([(*x, "n") for x in rows], "vec_id long, embedding array<float>, label int, rep string")
    for threshold, tile in ((0.98, 64), (0.9, 1024)):
        got = [tuple(x) for x in embedding.near_duplicates(df, threshold=threshold, tile=tile).collect()]
        assert sorted(got, key=str) == plain(rows, threshold)


def test_empty(spark):
    df = spark.createDataFrame([(1, None, 1)], "vec_id long, embedding array<float>, label int")
    assert [tuple(x) for x in embedding.near_duplicates(df).collect()] == [(1, 0, 1, True)]
    assert embedding.near_duplicates(df.limit(0)).count() == 0


def test_wide_vectors(spark):
    # axes come from a bounded sample, so that wide vectors cost no table of d x d rows
    r = np.random.default_rng(9)
    for d in (1536, 2500):
        base = r.normal(size=(20, d))
        rows = [(k, (base[k % 20] + (k >= 20) * 0.05 * r.normal(size=d)).astype(np.float32).tolist(), 1) for k in range(60)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
        got = [tuple(x) for x in embedding.near_duplicates(df).collect()]
        assert sorted(got, key=str) == plain(rows, 0.98)
