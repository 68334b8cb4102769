import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from framelake.operators import intervals
from framelake.operators.intervals import interval_join


def plain(points, spans):
    return sorted((k, at, s, e, n) for k, at in points for j, s, e, n in spans if k is not None and k == j and None not in (at, s, e) and s <= at < e)


def joined(spark, points, spans):
    p = spark.createDataFrame(points, "k string, at long")
    i = spark.createDataFrame(spans, "k string, start long, `end` long, label int")
    return sorted((r["k"], r["at"], r["start"], r["end"], r["label"]) for r in interval_join(p, i, "at", ["k"]).collect())


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.data())
def test_against_all_pairs(spark, data):
    at = st.one_of(st.none(), st.integers(-5000, 5000), st.integers(-(10**15), 10**15))
    key = st.sampled_from(["a", "b", None])
    points = data.draw(st.lists(st.tuples(key, at), max_size=30))
    spans = [(k, s, None if s is None or d is None else s + d, n) for n, (k, s, d) in enumerate(data.draw(st.lists(st.tuples(key, at, st.one_of(st.none(), st.integers(-3, 4000), st.integers(0, 10**15))), max_size=20)))]
    assert joined(spark, points, spans) == plain(points, spans)


@pytest.mark.parametrize("few", [True, False])
def test_many_overlapping_intervals_yield_hits_only(spark, monkeypatch, few):
    # thousands of overlapping segments of a hot source: the join's rows are hits, but for edges of first and last cells
    if not few:
        monkeypatch.setattr(intervals, "BROADCAST_NODES", 0)
    points = spark.range(20_000).select(F.lit("hot").alias("k"), (F.col("id") * 50).alias("at"))
    spans = spark.range(3000).select(F.lit("hot").alias("k"), (F.col("id") * 331).alias("start"), (F.col("id") * 331 + 100 + (F.col("id") % 7) * 900).alias("end"), F.col("id").alias("label"))
    width, levels = intervals.grid(spans)
    assert levels > 1
    hits = sum(1 for k in range(3000) for s in [331 * k] for _ in range(-(-s // 50), -(-(s + 100 + k % 7 * 900) // 50)) if _ < 20_000)
    found = interval_join(points, spans, "at", ["k"])
    assert found.count() == hits
    cut = intervals.nodes(spans, width, levels).groupBy("__level", "__node").agg(F.count("*").alias("n"))
    assert cut.agg(F.sum("n")).head()[0] < 3000 * 2 * levels * intervals.FAN
    ladder = [points.select(F.lit(k).alias("__level"), F.floor(F.col("at") / (width * intervals.FAN**k)).alias("__node")) for k in range(levels)]
    met = sum(x.join(cut, ["__level", "__node"]).agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0] for x in ladder)
    assert hits <= met <= hits * 1.3  # edges of short ones
