import pytest
from pyspark.sql import functions as F

from framelake.llm.sharding import Conflict, Store


def arrivals(spark, k, n=2000):
    return spark.range(k * n, (k + 1) * n, 1, 3).select("id", F.sha2(F.col("id").cast("string"), 512).alias("text"), F.lit(None).cast("string").alias("file"))


def test_compaction(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s", target=900_000, smallest=60_000, fan_in=3)
    with pytest.raises(ValueError):
        store.read()
    want = 0
    for k in range(7):
        before = store.append(arrivals(spark, k))
        want += 2000
        after = store.compact()
        assert len(after["shards"]) <= len(before["shards"])
        assert store.read().count() == want and store.read(before["version"]).count() == want
    assert store.read().select(F.sum("id"), F.count_distinct("text")).head() == (sum(range(want)), want)
    sizes = [s["bytes"] for s in store.manifest()["shards"]]
    assert not store.plan(store.manifest()["shards"]) and max(sizes) < 1_000_000 and len(sizes) < 12
    store.vacuum()
    assert store.read().count() == want and len(store.versions()) == 1
    assert len([p for p in (tmp_path / "s/data").rglob("part-*")]) == len(sizes)


def test_conflicts_and_schemas(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    store.append(arrivals(spark, 0).limit(0))
    assert store.read().count() == 0
    base = store.manifest()
    store.append(arrivals(spark, 1))
    with pytest.raises(Conflict):
        store.commit(base, base["schema"], [])
    assert store.read().count() == 2000 and store.read(1).count() == 0
    assert not list((tmp_path / "s/manifests").glob(".draft*.json"))
    with pytest.raises(ValueError):
        store.append(spark.range(3))
    store.append(arrivals(spark, 1))
    assert store.read().count() == 4000


def test_odd_rows(spark, tmp_path):
    """Nulls in every column, empty and very long texts, repeated rows and ties stay as they are; so do odd names."""
    rows = [(None, None, None), (1, "", None), (1, "", None), (2, "x" * 200_000, "a"), (2, "y", "a")]
    df = spark.createDataFrame(rows, "id long, `file name` string, bytes string")
    store = Store(spark, f"file://{tmp_path}/s", target=10**6, smallest=1000, fan_in=2)
    for _ in range(3):
        store.append(df)
        store.compact()
    assert sorted(map(str, store.read().collect())) == sorted(map(str, df.collect() * 3))
    assert store.vacuum(grace=3600) == 0 and store.vacuum() > 0
    assert store.read().count() == 15


def played(shards, target, smallest, fan_in):
    """The merges of one round, by the rule as stated: of each tier that is full, runs of up to target bytes, in order."""
    tiers, groups = {}, []
    for name, size in shards:
        if size * 2 <= target:
            t, edge = 0, smallest
            while size > edge:
                t, edge = t + 1, edge * fan_in
            tiers.setdefault(t, []).append((name, size))
    for t in sorted(tiers):
        if len(tiers[t]) >= fan_in:
            run, held = [], 0
            for name, size in tiers[t]:
                if run and held + size > target:
                    groups.append(run)
                    run, held = [], 0
                run.append(name)
                held += size
            groups.append(run)
    return [g for g in groups if len(g) > 1]


def test_every_version_is_what_the_rule_makes_of_the_one_before(spark, tmp_path):
    """Rows of each shard of each version: an append adds shards, a merge replaces groups by their union, nothing else moves."""
    store = Store(spark, f"file://{tmp_path}/s", target=700_000, smallest=50_000, fan_in=3)
    rows = {}

    def ids(shard):
        if shard["file"] not in rows:
            rows[shard["file"]] = frozenset(r["id"] for r in spark.read.parquet(f"{store.root}/{shard['file']}").select("id").collect())
        return rows[shard["file"]]

    merges = 0
    for k in range(5):
        store.append(arrivals(spark, k, 1200 if k % 2 else 2500))
        store.compact()
    for v in store.versions():
        before, now = store.manifest(v - 1)["shards"] if v > 1 else [], store.manifest(v)["shards"]
        old, new = {s["file"] for s in before}, {s["file"] for s in now}
        if old <= new:
            continue  # an append
        merges += 1
        groups = played([(s["file"], s["bytes"]) for s in before], store.target, store.smallest, store.fan_in)
        gone = {f for g in groups for f in g}
        assert old - new == gone and [s for s in now if s["file"] in old] == [s for s in before if s["file"] not in gone]
        known = {s["file"]: ids(s) for s in before}
        assert sorted(map(sorted, (ids(s) for s in now if s["file"] not in old))) == sorted(sorted(frozenset().union(*(known[f] for f in g))) for g in groups)
        assert all(s["bytes"] == (tmp_path / "s" / s["file"]).stat().st_size for s in now)
    assert merges >= 3
