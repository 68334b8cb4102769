import math

import numpy as np

from framelake.llm import whitening

NAN, INF = float("nan"), float("inf")


def plain(vectors, components=8, scale=1024, offset=100_000):
    """Brute force in numpy with Python integers: n, deviations, whitened up to sign, shares."""
    x = [[math.floor(scale * c) + offset for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviations = [sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    centred = np.array([[(n * a - s) / n for a, s in zip(row, sums, strict=True)] for row in x])
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    k = int((e[:components] > e[0] * 1e-11).sum())
    return n, deviations, centred @ v[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def held(got, vectors, ids, **options):
    n, deviations, w, shares = plain(vectors, **options)
    assert len(got) == n * w.shape[1]
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
    own = np.array([[by[i][c + 1]["whitened"] for c in range(w.shape[1])] for i in ids])
    sign = np.sign((own * w).sum(axis=0))
    assert np.abs(own * sign - w).max() < 1e-8
    for i, dev in zip(ids, deviations, strict=True):
        assert set(by[i]) == set(range(1, w.shape[1] + 1))
        for c, r in by[i].items():
            assert (r["n"], int(r["deviation"])) == (n, dev)
            assert abs(r["explained"] / shares[c - 1] - 1) < 1e-9 and r["identity_error"] < 1e-8


def test_against_brute_force(spark):
    r = np.random.default_rng(4)
    x = (r.normal(size=(300, 12)) @ r.normal(size=(12, 12)) * 0.2 + r.normal(size=12)).astype(np.float32).tolist()
    rows = [(i, v, "d", "n") for i, v in enumerate(x)] + [(900, x[0], "d", "n"), (901, x[0], None, None)]  # repeated vectors count
    bad = [None, [], [NAN] * 12, [INF] + x[0][1:], [None] + x[0][1:]]
    df = spark.createDataFrame(rows + [(1000 + k, v, "d", "n") for k, v in enumerate(bad)], "vec_id long, embedding array<float>, d string, whitened string")
    held(whitening.whitened(df).collect(), [v for _, v, _, _ in rows], [i for i, *_ in rows])
    held(whitening.whitened(df, components=3, scale=64, offset=0).collect(), [v for _, v, _, _ in rows], [i for i, *_ in rows], components=3, scale=64, offset=0)


def test_far_from_zero_and_beyond_64_bits(spark):
    # numbers far from zero keep all their digits; deviations beyond 64 bits stay exact
    r = np.random.default_rng(5)
    x = (r.normal(size=(40, 3)) * [1e6, 1e5, 1e4] + 1e9).tolist()
    df = spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>")
    got = whitening.whitened(df).collect()
    held(got, x, range(40))
    assert max(int(g["deviation"]) for g in got) > 2**63


def test_widths_rank_and_edges(spark):
    line = [(k, [float(k), 2.0 * k, 1.0]) for k in range(6)]  # one direction only
    wide = [(10 + k, [float(k % 2), float(k // 2)]) for k in range(4)]
    df = spark.createDataFrame([*line, *wide, (None, [7.0]), (30, [1e300] * 3)], "vec_id long, embedding array<double>")
    got = whitening.whitened(df).collect()
    assert {(g["vec_id"], g["component"]) for g in got} == {(k, 1) for k in range(6)} | {(10 + k, c) for k in range(4) for c in (1, 2)}
    assert all(abs(g["explained"] - (1 if g["vec_id"] < 10 else 0.5)) < 1e-12 for g in got)
    assert {g["n"] for g in got} == {6, 4}
    assert whitening.whitened(df.limit(0)).count() == 0
    assert whitening.whitened(df.where("vec_id IS NULL")).count() == 0  # a single row has no variance
    assert whitening.whitened(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).count() == 0
