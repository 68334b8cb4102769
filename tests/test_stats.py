"""Statistics of many small episodes: work by batch, and the numbers of a plain fold, however rows fall into batches."""

import math

import numpy as np
import pyarrow as pa
import pytest

from framelake.operators import stats


def table(r, groups):
    rows = []
    for g in range(groups):
        for f in range(int(r.integers(1, 6))):
            width = int(r.integers(0, 4))
            v = [None if r.random() < 0.1 else math.nan if r.random() < 0.1 else float(np.float32(1e6 + r.normal())) for _ in range(width)]
            rows.append((g if g else None, None if r.random() < 0.1 else f, None if r.random() < 0.1 else v))
    return rows


def found(rows, cuts, feature_names=("v",)):
    kinds = pa.schema([("e", pa.int64()), ("o", pa.int64()), ("v0", pa.list_(pa.float64()))])
    batches = [pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*own, strict=True), kinds, strict=True)], schema=kinds) for a, b in zip(cuts, cuts[1:]) if (own := rows[a:b])]
    parts = pa.Table.from_batches(list(stats._partials(["e"], 1)(iter(batches)))).sort_by([("e", "ascending"), ("feature", "ascending")]).combine_chunks()
    out = list(stats._finished(["e"], list(feature_names))(iter(parts.to_batches(max_chunksize=7))))
    return {(r["e"], r["dim"]): (r["n_rows"], r["min"], r["max"], r["mean"], r["std"]) for b in out for r in b.to_pylist()}


def plain(rows):
    want = {}
    for g in {r[0] for r in rows}:
        own = [(o, v) for e, o, v in rows if e == g and v is not None]
        if not own:
            continue
        width = len(min(own, key=lambda x: (x[0] is not None, x[0] or 0, len(x[1])))[1])
        for d in range(width):
            x = [v[d] for _, v in own if d < len(v) and v[d] is not None]
            full = np.array(x + [0.0] * (len(own) - len(x)))
            numbers = [y for y in x if not math.isnan(y)]
            low = min(numbers) if numbers else math.nan if x else None
            high = (math.nan if len(numbers) < len(x) else max(x)) if x else None
            want[g, d] = (len(own), low, high, full.mean(), full.std())
    return want


def test_any_batches_give_a_plain_fold(monkeypatch):
    calls = []
    own = stats._moments
    monkeypatch.setattr(stats, "_moments", lambda *a: calls.append(1) or own(*a))
    for seed in range(6):
        r = np.random.default_rng(seed)
        rows = table(r, 300)
        if seed % 2:
            rows = [rows[k] for k in r.permutation(len(rows))]
        cuts = [0, *sorted(r.integers(0, len(rows), 5).tolist()), len(rows)]
        calls.clear()
        got, want = found(rows, cuts), plain(rows)
        assert len(calls) <= 6  # once a batch, not once an episode
        assert set(got) == set(want)
        for key, w in want.items():
            assert got[key][:3] == pytest.approx(w[:3], nan_ok=True) if None not in w[:3] else got[key][:3] == w[:3]
            assert got[key][3:] == pytest.approx(w[3:], nan_ok=True, rel=1e-9, abs=1e-6)
