"""The committed table: appends, failures, episodes, streams that are run again."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from framelake.shared import shared_path
from framelake.sources import lake
from framelake.sources.store import KeyedTable


def local(root):
    return Path(root.removeprefix("file://"))


def there(root):
    return sorted(str(p.relative_to(local(root))) for p in local(root).glob("data/**/*.parquet"))


def test_appends_and_replace(spark):
    root = shared_path(spark, "lake")
    rows = spark.range(1000).select("id", F.array(F.col("id").cast("float")).alias("v"), F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("s"), F.timestamp_millis("id").alias("t"))
    lake.append(rows.where("id < 400"), root)
    lake.append(rows.where("id >= 400"), root)
    lake.append(rows.limit(0), root)
    for found in (lake.load(spark, root), spark.read.format("framelake").load(root)):
        assert [(f.name, f.dataType.simpleString()) for f in found.schema] == [(f.name, f.dataType.simpleString()) for f in rows.schema]
        assert sorted(found.collect()) == sorted(rows.collect())
    assert lake.files(spark, root).agg(F.sum("rows")).head()[0] == 1000
    lake.append(rows.where("id = 7").select("id", F.lit(1.5).alias("more")), root)  # a column is new, others are gone
    assert [r["more"] for r in lake.load(spark, root).where("id = 7").orderBy("more").collect()] == [None, 1.5]
    lake.append(rows.where("id < 3"), root, replace=True)
    assert [r["id"] for r in lake.load(spark, root).orderBy("id").collect()] == [0, 1, 2]
    assert lake.orphans(spark, root).count() > 0 and lake.vacuum(spark, root, hours=0) > 0 and lake.orphans(spark, root).count() == 0
    assert lake.load(spark, root).count() == 3


def test_push_down(spark):
    root = shared_path(spark, "lake")
    lake.append(spark.range(20_000).withColumn("k", F.col("id") % 10), root)
    before = spark.conf.get("spark.sql.python.filterPushdown.enabled")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        found = spark.read.format("framelake").option("pushdown", "true").load(root)
        assert found.where("id >= 19990 AND k < 5").count() == 5
        assert found.where("id IN (3, 5, 70000)").count() == 2 and found.where("k = 3 AND id IS NOT NULL").count() == 2000
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", before)


def test_a_failed_write_leaves_nothing(spark):
    root = shared_path(spark, "lake")
    rows = spark.range(0, 1000, 1, 4)
    lake.append(rows, root)
    before = there(root)
    wrong = F.when(F.col("id") == 999, F.raise_error(F.lit("stop"))).otherwise(F.col("id"))
    with pytest.raises(Exception, match="stop"):
        lake.append(rows.select(wrong.cast("long").alias("id")), root)
    assert lake.load(spark, root).count() == 1000
    lake.vacuum(spark, root, hours=0)  # tasks that were cut off as the write ended may leave files, which no commit names
    assert there(root) == before
    with pytest.raises(FileNotFoundError):
        lake.LakeSource({"path": shared_path(spark, "nothing")}).schema()


def test_episodes(spark):
    root = shared_path(spark, "lake")
    frames = spark.range(600).select((F.col("id") % 6 * 300).alias("episode_index"), F.floor(F.col("id") / 6).alias("frame_index"), F.rand(1).alias("x"))
    lake.append_episodes(frames, root)
    found = lake.files(spark, root).orderBy("episode").collect()
    assert [(f["episode"], f["rows"]) for f in found] == [(300 * k, 100) for k in range(6)]
    assert all(f"/chunk-{f['episode'] // 500:03d}/episode_{f['episode']:06d}-" in f["name"] for f in found)
    own = spark.read.parquet(f"{root}/{found[1]['name']}")
    assert [r["frame_index"] for r in own.collect()] == list(range(100))
    before = there(root)
    for again in (frames.where("episode_index = 300"), frames.withColumn("episode_index", F.lit(None).cast("long"))):
        with pytest.raises(Exception, match="was written before|has no episode_index"):
            lake.append_episodes(again, root)
    with pytest.raises(Exception, match="is in .* files"):  # rows of an episode in several tasks
        lake.append(frames.withColumn("episode_index", F.col("episode_index") + 1).repartition(4), root, episode="episode_index")
    assert there(root) == before and lake.load(spark, root).count() == 600


def test_a_batch_that_is_run_again_writes_nothing_twice(spark, tmp_path):
    root, source, notes = shared_path(spark, "lake"), str(tmp_path / "in"), tmp_path / "notes"
    lake.append(spark.createDataFrame([(-1,)], "id long"), root)  # batch and stream share a table

    def run():
        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(source)
        lake.stream_into(stream, root, str(notes)).trigger(availableNow=True).start().awaitTermination()

    for k in range(3):
        spark.range(10 * k, 10 * k + 10).coalesce(1).write.mode("append").parquet(source)
    run()
    committed = sorted(p.name for p in (local(root) / "_commits").glob("stream-*.json"))
    assert len(committed) == 3
    for p in (notes / "commits").iterdir():  # as if the last batch had been cut off behind its write
        if p.name.lstrip(".").split(".")[0] == "2":
            p.unlink()
    before = there(root)
    run()
    assert sorted(r["id"] for r in lake.load(spark, root).collect()) == list(range(-1, 30))
    assert there(root) == before and sorted(p.name for p in (local(root) / "_commits").glob("stream-*.json")) == committed
    spark.range(30, 40).coalesce(1).write.mode("append").parquet(source)
    run()
    assert sorted(r["id"] for r in lake.load(spark, root).collect()) == list(range(-1, 40))
    assert all(json.loads(p.read_text())["files"] for p in (local(root) / "_commits").glob("stream-*.json"))


def test_keyed_table_with_null_keys(spark):
    own = KeyedTable(spark, shared_path(spark, "keyed"), "a string, b int, v int", ("a", "b"))
    assert own.rows().count() == 0
    own.put(spark.createDataFrame([("x", None, 1), ("y", 2, 3), (None, None, 5)], "a string, b int, v int"))
    key = lambda rows: sorted((tuple(r) for r in rows.collect()), key=str)
    assert key(own.rows()) == sorted([("x", None, 1), ("y", 2, 3), (None, None, 5)], key=str)
    own.put(spark.createDataFrame([("x", None, 7), ("x", None, 7), (None, 1, 9)], "a string, b int, v int"))
    own.delete(spark.createDataFrame([(None, None)], "a string, b int"))
    assert key(own.rows()) == sorted([("x", None, 7), ("y", 2, 3), (None, 1, 9)], key=str)
    assert key(own.get(spark.createDataFrame([("x", None), (None, 1), ("z", 1)], "a string, b int"))) == sorted([("x", None, 7), (None, 1, 9)], key=str)
