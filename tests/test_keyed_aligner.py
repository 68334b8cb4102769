"""The aligner on keyed state against a plain one, with late rows, ends of sources and restarts."""

import numpy as np
from pyspark.sql import functions as F

from framelake.shared import shared_path
from framelake.sources import lake
from framelake.streaming import arrivals, keyed

SCHEMA = "source long, feature string, seq long, log_time_ns long, data array<float>"
STEP = 10


def plain(parts, required, window):
    """Batch by batch in Python dictionaries."""
    frames, late, latest, cells, gone = [], [], {}, {}, set()
    for part in parts:
        before, then_gone = dict(latest), set(gone)
        ended = {r[0] for r in part if r[1] is None}
        for source, feature, seq, ns, data in sorted((r for r in part if r[1] is not None), key=lambda r: r[2]):
            b = ns // STEP * STEP
            if (source, b) in then_gone or (source in before and b + window <= before[source]):
                late.append((source, b, feature, seq, ns))
            else:
                own = cells.setdefault((source, b), {})
                own[feature] = (seq, data, own.get(feature, (0, 0, 0))[2] + 1) if feature not in own or seq >= own[feature][0] else (*own[feature][:2], own[feature][2] + 1)
            latest[source] = max(ns, latest.get(source, ns))
        for (source, b), own in cells.items():
            if source in {r[0] for r in part} and (source, b) not in gone:
                complete = set(required) <= set(own)
                if complete or source in ended or b + window <= latest[source]:
                    gone.add((source, b))
                    frames.append((source, b, sorted(own), [own[f][1] for f in sorted(own)], sum(x[2] for x in own.values()), complete))
    return sorted(frames), sorted(late)


def run(spark, parts, required, window_frames):
    root = shared_path(spark, "keyed")
    start = lambda stream, notes: keyed.with_state(
        lake.stream_into(keyed.aligned(stream, 0, required, window_frames, interval=STEP), root, notes).trigger(availableNow=True)
    )
    arrivals.run_in_parts([spark.createDataFrame(p, SCHEMA) for p in parts], start)
    rows = lake.load(spark, root).collect()
    frames = sorted((r["source"], r["bucket_ns"], r["features"], r["data"], r["n_messages"], r["complete"]) for r in rows if r["kind"] == "frame")
    return frames, sorted((r["source"], r["bucket_ns"], r["features"][0], r["seq"], r["log_time_ns"]) for r in rows if r["kind"] == "late")


def test_against_a_plain_aligner(spark):
    r = np.random.default_rng(2)
    rows = []
    for k in range(400):
        at = k + int(r.integers(-60, 1))  # out of order by up to six buckets
        rows.append((int(r.integers(0, 3)), "abc"[int(r.integers(0, 3))], k, 1000 + at, [float(k)]))
    parts = [rows[:150], rows[150:160], rows[160:300], rows[300:]]
    parts.append([(s, None, -1, 0, None) for s in range(3)])
    for required, window in ((["a", "b"], 3), (["none such"], 2), ([], 1)):
        got, want = run(spark, parts, required, window), plain(parts, required, window * STEP)
        assert got == want
        assert sum(f[4] for f in got[0]) + len(got[1]) == 400  # frames and late rows hold every message
        assert got[1]


def test_ends(spark):
    df = spark.createDataFrame([(1, "a", 1, 5, [1.0]), (1, "b", 2, 6, [1.0]), (4, "a", 3, 7, [])], SCHEMA)
    assert sorted(tuple(r) for r in keyed.ends(df).collect()) == [(1, None, -1, 0, None), (4, None, -1, 0, None)]
    assert keyed.ends(df.where(F.lit(False))).count() == 0


def test_a_batch_exchanges_open_buckets_with_the_store():
    """Calls to the store follow the buckets that stay open, not messages or cells."""
    import pandas as pd

    calls = []

    class State(dict):
        def __getattr__(self, name):
            def call(*args):
                calls.append(name)
                if name in ("get", "exists"):
                    return self.v if "v" in self.__dict__ else None
                if name == "iterator":
                    return iter(list(self.items()))
                if name == "update":
                    self.__dict__["v"] = args[0]
                elif name == "updateValue":
                    self[args[0]] = args[1]
                elif name == "removeKey":
                    del self[args[0]]
                else:
                    raise AssertionError(name)

            return call

        get = property(lambda self: self.__getattr__("get"))
        update = property(lambda self: self.__getattr__("update"))

    class Handle:
        def getValueState(self, *a):
            return State()

        def getMapState(self, *a):
            return State()

    own = keyed.Aligner(["no such"], 3 * STEP, None, None)
    own.init(Handle())
    rows = pd.DataFrame([(k // STEP * STEP, "abc"[k % 3], k, k, [float(k)]) for k in range(1000)], columns=["bucket_ns", "feature", "seq", "log_time_ns", "data"])
    frames = [f for at in (0, 500) for out in own.handleInputRows((7,), iter([rows[at : at + 500]]), None) for f in out.itertuples()]
    assert len(frames) == 97 and sum(f.n_messages for f in frames) == 970
    assert len(calls) <= 2 * (3 + 2 * 3)
    assert len([f for out in own.handleInputRows((7,), iter([pd.DataFrame([(0, None, -1, 0, None)], columns=rows.columns)]), None) for f in out.itertuples()]) == 3
