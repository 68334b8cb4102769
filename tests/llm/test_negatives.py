import math

import numpy as np
import pytest

from framelake.llm import negatives

NAN = float("nan")


def plain(rows, every=50, positives=5, low=50, high=95, most=3):
    """Every anchor against every row, with Python integers."""
    good = [(i, [math.floor(256 * c) for c in v], g) for i, v, g in rows if i is not None and g is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for i, x, g in good:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), j, h) for j, y, h in good if j != i and len(y) == len(x))
        for s, j, _ in [r for r in scored if r[2] == g][:positives]:
            hits = [r for r in scored if r[2] != g and low * -s <= 100 * -r[0] <= high * -s][:most]
            out += [(i, j, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(hits)]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    if small:  # many blocks, rounds and bands
        for name, v in {"ANCHOR_NUMBERS": 96, "LEAST_ROWS": 150, "COPIES": 2, "SIDE": 3, "BANDS": (4, 16)}.items():
            monkeypatch.setattr(negatives, name, v)
    r = np.random.default_rng(6)
    centres = r.normal(size=(6, 16))
    rows = [(k, (centres[k % 6] * 0.4 + r.normal(size=16) * 0.5).astype(np.float32).tolist(), f"g{(k * 7) % 4}") for k in range(400)]
    rows += [(1000 + 10 * k, rows[50][1], "g1") for k in range(8)]  # ties, of which the smaller ids come first
    rows += [(2000 + k, rows[100][1], "hot") for k in range(60)]
    rows += [(50_000, [0.0] * 16, "g1"), (50_050, (-np.array(rows[0][1])).tolist(), "g0"), (50_100, [1.0] * 16, "alone")]
    rows += [(3000, None, "g1"), (3050, [NAN] * 16, "g1"), (3100, [None] + [1.0] * 15, "g2"), (3150, [], "g1"), (3200, rows[3][1], None), (None, rows[3][1], "g1")]
    rows += [(4000 + 25 * k, [0.5 * k, 1.0, 2.0], f"g{k % 2}") for k in range(6)]  # another width
    rows += [(400, rows[5][1], "g2")]
    df = spark.createDataFrame([(*x, "n", 1) for x in rows], "vec_id long, embedding array<float>, label string, rank string, g int")
    if small:
        import framelake.llm.common as common

        monkeypatch.setattr(common, "LEAST_HOT", 5)
    assert sorted(tuple(x) for x in negatives.hard_negatives(df).collect()) == plain(rows)
    assert sorted(tuple(x) for x in negatives.hard_negatives(df, positives=2, negatives=7, low=10, high=80).collect()) == plain(rows, positives=2, most=7, low=10, high=80)


def test_large_components_and_empty(spark):
    most = math.sqrt(2.0**55 / 4) / 256
    rows = [(0, [most * 0.9] * 4, 1), (1, [most * 0.8] * 4, 1), (2, [most * 0.7] * 4, 2), (3, [most * 1.1] * 4, 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert [tuple(x) for x in negatives.hard_negatives(df).collect()] == plain(rows[:3])
    for some in (df.limit(0), df.where("vec_id = 3"), df.where("vec_id = 1"), df.where("vec_id = 0")):
        assert negatives.hard_negatives(some).count() == 0


def test_zero_vectors(spark):
    rows = [(50 * k, [0.0, 0.0], k % 2) for k in range(6)]  # every score is 0, and 0 lies between 0 and 0
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert sorted(tuple(x) for x in negatives.hard_negatives(df).collect()) == plain(rows)
