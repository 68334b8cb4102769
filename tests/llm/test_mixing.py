import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from framelake.llm import mixing


def test_targets():
    assert mixing.targets([100, 100, 100]) == pytest.approx([200, 166.6666667, 83.3333333])
    assert mixing.targets([0, 0]) == [0, 0] and mixing.targets([]) == [] and mixing.targets([8]) == [12]
    for sizes in ([5, 900, 20, 1, 0, 300], [1000, 1, 1]):
        t = mixing.targets(sizes)
        assert sum(t) == pytest.approx(1.5 * sum(sizes)) and all(x <= 2 * n + 1e-9 for x, n in zip(t, sizes, strict=True))


def docs(spark, n=400):
    r = np.random.default_rng(5)
    rows = [(k, "ab \t" * int(r.integers(0, 60)), ["s1", "s0", None, "é"][int(r.choice(4, p=[0.6, 0.2, 0.1, 0.1]))], "x") for k in range(n)]
    rows += [rows[5], rows[5], (None, "q w", "s0", "y"), (n, None, "s0", "z"), (n + 1, "w " * 9000, "s1", "z"), (n + 2, "", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size string"), rows


def test_mix(spark):
    df, rows = docs(spark)
    m = mixing.mix(df, block=16, shard_slots=50)
    got = mixing.taken(m).select("doc_id", "source", "__size", "__source_size", "__target", "__taken").collect()
    assert len(got) == len(rows)
    size, took, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        assert 0 <= r["__taken"] <= 2 * r["__size"]
        size[r["source"]] += r["__size"]
        took[r["source"]] += r["__taken"]
        target[r["source"]] = r["__target"]
    want = defaultdict(int)
    for _, t, s, _ in rows:
        want[s] += len(re.findall(mixing.WORD, t or ""))
    assert size == want and {r["source"]: r["__source_size"] for r in got} == want
    order = sorted(want, key=lambda s: (s is None, s or ""))
    assert [target[s] for s in order] == pytest.approx(mixing.targets([want[s] for s in order]))
    assert all(abs(took[s] - target[s]) <= 32 for s in order)
    again = mixing.taken(mixing.mix(df.repartition(7), block=16, shard_slots=50))
    assert sorted(map(str, again.select("doc_id", "__taken").collect())) == sorted(str(r) for r in mixing.taken(m).select("doc_id", "__taken").collect())
    # a pass takes each block of a source at most once; no shard holds more slots than it has
    assert m.slots.groupBy("sid", "pass", "block").count().where("count > 1").count() == 0
    assert m.slots.groupBy("shard").count().where(F.col("count") > 50).count() == 0


def test_empty(spark):
    df, _ = docs(spark, 10)
    assert mixing.taken(mixing.mix(df.limit(0))).count() == 0
    assert [r["__taken"] for r in mixing.taken(mixing.mix(df.where("text IS NULL OR text = ''"))).collect()] == [0, 0]


def test_mixed_documents_are_the_mix(spark):
    df, rows = docs(spark)
    m = mixing.mix(df, block=16, shard_slots=50)
    took = {}
    for r in mixing.taken(m).collect():
        took[r["doc_id"]] = took.get(r["doc_id"], 0) + r["__taken"]
    got = {}
    for r in mixing.mixed_documents(df, block=16, shard_slots=50).collect():
        assert r.asDict().keys() == dict.fromkeys(df.columns).keys()
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(re.findall(mixing.WORD, r["text"]))
    assert got == {k: n for k, n in took.items() if n}


def test_draws_are_multinomial(spark):
    """Source counts per output shard, against their expected shares, by chi-square; runs of shards in more than one window."""
    keep, mixing.RUN = mixing.RUN, 7
    try:
        listed = [(0, "a", 64 * 5000, 0.0, 5000, 5000), (1, "b", 64 * 3000, 0.0, 3000, 3000), (2, None, 64 * 2000, 0.0, 2000, 2000)]
        sources = spark.createDataFrame(listed, "__sid int, __source string, __source_size long, __target double, __n long, __quota long")
        slots = mixing._slots(spark, sources, listed, 100, 11)
        got = slots.groupBy("shard", "sid").count().collect()
    finally:
        mixing.RUN = keep
    counts = {}
    for r in got:
        counts.setdefault(r["shard"], {})[r["sid"]] = r["count"]
    assert len(counts) == 100 and all(sum(c.values()) == 100 for c in counts.values())
    share = [0.5, 0.3, 0.2]
    chi = sum((c.get(s, 0) - 100 * p) ** 2 / (100 * p) for c in counts.values() for s, p in enumerate(share))
    assert 140 < chi < 265  # 200 degrees of freedom
    assert [sum(c.get(s, 0) for c in counts.values()) for s in range(3)] == [5000, 3000, 2000]
    each = slots.groupBy("sid", "pass", "block").count()
    assert each.where("count > 1").count() == 0


def test_taken_by_a_plain_mix(spark):
    """Every slot's block read word by word from its source's stream, laid out in Python; quotas by their definition."""
    df, rows = docs(spark)
    m = mixing.mix(df, block=16, shard_slots=50)
    streams, sizes = defaultdict(list), defaultdict(int)
    for r in mixing._hashed(df, 11).collect():
        n = len(re.findall(mixing.WORD, r["text"] or ""))
        streams[r["source"]].append((r["__h"] % 1024, r["__h"], r["__h2"], r["doc_id"], n))
        sizes[r["source"]] += n
    order = sorted(streams, key=lambda s: (s is None, s or ""))
    owners = [[(k, row[3]) for k, row in enumerate(sorted(streams[s], key=lambda x: x[:3])) for _ in range(row[4])] for s in order]
    took, used = defaultdict(int), defaultdict(int)
    for s in m.slots.collect():
        used[s["sid"]] += 1
        for owner in owners[s["sid"]][16 * s["block"] : 16 * s["block"] + 16]:
            took[(s["sid"], *owner)] += 1
    for k, (s, target) in enumerate(zip(order, mixing.targets([sizes[s] for s in order]), strict=True)):
        blocks = -(-sizes[s] // 16)
        assert used[k] == (min(2 * blocks, round(target * blocks / sizes[s])) if sizes[s] else 0)
    want = sorted(str((order[sid], doc, n)) for (sid, _, doc), n in took.items())
    assert sorted(str((r["source"], r["doc_id"], r["__taken"])) for r in mixing.taken(m).where("__taken > 0").select("source", "doc_id", "__taken").collect()) == want
