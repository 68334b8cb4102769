import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from framelake.operators import align, episodes, frames, mapping, stats, validate
from framelake.sources import tables
from framelake.sources.config import Config, Mapping, from_toml, should_flush

VECTORS = "episode_index long, frame_index long, state array<float>, action array<float>"


def test_last_wins_and_per_message(spark):
    rows = [(0, "/a", 5, 0, [1.0]), (0, "/a", 7, 1, [2.0]), (0, "/action", 8, 2, [3.0]), (0, "/a", 25, 3, [4.0]), (1, "/a", 1, 4, [5.0])]
    m = mapping.with_role(mapping.renamed(spark.createDataFrame(rows, "source long, topic string, log_time_ns long, seq long, data array<float>"), mapping.mapping_table(spark, [])))
    cut = align.bucketed(m, interval=10)
    got = [r.asDict() for r in align.frames(cut, ["source"]).orderBy("source", "frame_index").collect()]
    assert [(g["source"], g["frame_index"], g["timestamp_ns"], g["states"], g["actions"]) for g in got] == [
        (0, 0, 0, {"a": [2.0]}, {"action": [3.0]}), (0, 1, 20, {"a": [4.0]}, {}), (1, 0, 0, {"a": [5.0]}, {}),
    ]
    assert got[0]["timestamps"] == {"a": 7, "action": 8}
    each = align.frames(cut, ["source"], emit="per_message").orderBy("source", "frame_index").collect()
    assert [(r["source"], r["frame_index"], r["timestamp_ns"]) for r in each] == [(0, 0, 0), (0, 1, 0), (0, 2, 0), (0, 3, 20), (1, 0, 0)]
    with pytest.raises(ValueError):
        align.bucketed(m, interval=10, mode="ceil")


def test_gap_compares_with_the_message_before(spark):
    times = [0, 5, 16, 15, 27, 37]
    df = spark.createDataFrame([(0, k, t) for k, t in enumerate(times)], "source long, seq long, log_time_ns long")
    got = [r["episode"] for r in episodes.by_gap(df, 10, ["source"], ["seq"]).orderBy("seq").collect()]
    assert got == [0, 0, 1, 1, 2, 2]  # a gap equal to the threshold starts nothing


def test_frame_count_counts_images(spark):
    df = spark.createDataFrame([(0, k, k % 2 == 0) for k in range(9)], "source long, frame_index long, image boolean")
    got = [r["episode"] for r in episodes.by_frame_count(df, 2, ["source"], ["frame_index"], F.col("image")).orderBy("frame_index").collect()]
    assert got == [0, 0, 0, 1, 1, 1, 1, 2, 2]


def test_dense_numbers_and_reindex(spark):
    keys = spark.createDataFrame([(k % 50 * 7,) for k in range(200)], "e long").repartition(5)
    got = sorted((r["e"], r["episode_index"]) for r in episodes.dense_numbers(keys, ["e"]).collect())
    assert got == [(k * 7, k) for k in range(50)]
    rows = spark.createDataFrame([(e, f) for e in (9, 2, 5) for f in range(e)], "ep long, f long")
    out = episodes.reindexed(rows, "ep", ["f"]).orderBy("index").collect()
    assert [(r["ep"], r["episode_index"], r["index"], r["frame_in_episode"]) for r in out] == [
        (e, k, i, f) for i, (k, e, f) in enumerate((k, e, f) for k, e in enumerate((2, 5, 9)) for f in range(e))
    ]


def filled_by_hand(rows):
    """[(state, action)] of one episode, as the writer fills it; None if no frame has a state."""
    dim = next((len(s) for s, _ in rows if s is not None), None)
    if dim is None:
        return None
    last_s = last_a = None
    out = []
    for s, a in rows:
        last_s, last_a = s or last_s, a or last_a
        out.append((last_s or [], last_a or [0.0] * dim))
    wide = len(out[0][1]) or 14  # an action's own width, which the first one sets
    fit = lambda v, n: ([*v, *[0.0] * n])[:n]
    return [(fit(s, dim), fit(a, wide)) for s, a in out]


vectors = st.one_of(st.none(), st.lists(st.integers(-5, 5).map(float), min_size=0, max_size=4))


@given(st.lists(st.lists(st.tuples(vectors, vectors), min_size=1, max_size=7), min_size=1, max_size=4))
@settings(max_examples=12, deadline=None)
def test_fill(spark, eps):
    df = spark.createDataFrame([(e, f, s, a) for e, rows in enumerate(eps) for f, (s, a) in enumerate(rows)], VECTORS)
    got = {}
    for r in frames.filled(df, ["episode_index"]).orderBy("frame_index").collect():
        got.setdefault(r["episode_index"], []).append((r["state"], r["action"]))
    want = {e: w for e, rows in enumerate(eps) if (w := filled_by_hand(rows)) and any(s is not None for s, _ in rows)}
    empty = {e for e, rows in enumerate(eps) if next((len(s) for s, _ in rows if s is not None), 1) == 0}
    assert {k: v for k, v in got.items() if k not in empty} == {k: v for k, v in want.items() if k not in empty}


def test_pivot_names(spark):
    df = spark.createDataFrame([(0, 0, [1.0, 2.0, 3.0], [4.0])], VECTORS)
    out = frames.pivoted(df, {"state": ("observation.state", 2), "action": ("action", 2)})
    assert out.columns == ["episode_index", "frame_index", "observation.state.0", "observation.state.1", "action.0", "action.1"]
    assert tuple(out.head()) == (0, 0, 1.0, 2.0, 4.0, 0.0)


@given(st.lists(st.lists(st.lists(st.floats(-100, 100, width=32), min_size=3, max_size=3), min_size=1, max_size=6), min_size=1, max_size=4), st.integers(1, 5))
@settings(max_examples=8, deadline=None)
def test_partial_statistics_equal_direct_ones(spark, eps, parts):
    rows = [(e, f, v) for e, own in enumerate(eps) for f, v in enumerate(own)]
    df = spark.createDataFrame(rows, "episode_index long, frame_index long, v array<float>").repartition(parts)
    exact = stats.merged(stats.vector_stats(df, ["episode_index"], "v", "frame_index"), ["dim"], exact=True).orderBy("dim").collect()
    x = np.array([v for _, _, v in rows], np.float64)
    for r in exact:
        own = x[:, r["dim"]]
        assert r["n_rows"] == len(own) and r["min"] == own.min() and r["max"] == own.max()
        assert r["mean"] == pytest.approx(own.mean(), abs=1e-6) and r["std"] == pytest.approx(own.std(), abs=1e-3)
        assert r["min"] - 1e-6 <= r["mean"] <= r["max"] + 1e-6 and r["std"] >= 0


def test_short_rows_count_in_n(spark):
    df = spark.createDataFrame([(0, 0, [2.0, 4.0]), (0, 1, [4.0]), (0, 2, None)], "e long, f long, v array<float>")
    got = [tuple(r) for r in stats.vector_stats(df, ["e"], "v", "f").orderBy("dim").collect()]
    assert got[0][:6] == (0, 0, 2, 2.0, 4.0, 3.0) and got[1][:6] == (0, 1, 2, 4.0, 4.0, 2.0)
    single = stats.merged(spark.createDataFrame([("a", 1, 1.0, 1.0, 1.0, 0.0)], "k string, n_rows long, min double, max double, mean double, std double"), ["k"])
    assert single.head()["std"] == 0.0


def test_validation(spark):
    have = spark.createDataFrame([(0,), (3,), (3,)], "episode_index long")
    assert sorted(r[0] for r in validate.missing_episodes(have).collect()) == [1, 2]
    assert validate.missing_episodes(have.limit(0)).count() == 0
    rows = spark.createDataFrame([(0, 0, 1.0), (0, 1, 0.5), (1, 0, 0.0), (1, 2, 1.0), (2, 0, 1.0), (2, 1, 2.0)], "episode_index long, frame_index long, timestamp double")
    assert sorted(map(tuple, validate.frame_invariants(rows).collect())) == [(0, "timestamp"), (1, "frame_index")]


def test_config():
    c = from_toml('[dataset]\nname="x"\nfps=10\n[[mappings]]\ntopic="/a"\nfeature="observation.state"\nmapping_type="state"\n[video]\nprofile="quality"')
    assert c.fps == 10 and c.mappings == (Mapping("/a", "observation.state", "state"),) and c.encoder() == ("slow", 18)
    for bad in ({"name": ""}, {"fps": 0}, {"crf": 52}, {"ring_buffer": 0}, {"part_bytes": 1}, {"mappings": (Mapping("/a", "b"), Mapping("/a", "c"))}, {"profile": "no"}):
        with pytest.raises(ValueError):
            Config(**{"name": "x", **bad})
    assert should_flush(1000, 0) and should_flush(0, 2 << 30) and not should_flush(999, 0) and not should_flush(10**6, 1, most_images=0)


def test_generators(spark):
    assert tables.counted(spark, 3).count() == 3 and tables.counted(spark, 3).agg(F.max("log_time_ns")).head()[0] == 2 * 10**9
    assert tables.vectors(spark, 2, 3).orderBy("seq").collect()[1]["data"] == [3.0, 4.0, 5.0]
    assert tables.multi_topic(spark, 4).count() == 8
