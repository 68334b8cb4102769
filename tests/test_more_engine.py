import json
import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from framelake.__main__ import show
from framelake.functions import names
from framelake.operators import control, process, video
from framelake.sources import sidecars, store
from framelake.sources.recordings import UnsupportedFormat
from framelake.streaming.progress import ProgressLog


def test_processors(spark):
    df = spark.range(10).withColumnRenamed("id", "frame_index")
    out = process.processed(df, lambda b: b.assign(task=b.frame_index % 2, should_write=b.frame_index < 7), "task long")
    assert tuple(process.processor_stats(out).head()) == (10, 7, 3, 0.7)
    assert process.processed(df, process.passthrough, "should_write boolean").where("should_write").count() == 10
    assert [bytes(r["bytes"]) for r in process.transformed(df, lambda b: [bytes([k]) for k in b.frame_index]).orderBy("frame_index").collect()] == [bytes([k]) for k in range(10)]
    assert tuple(process.processor_stats(out.limit(0)).head()) == (0, 0, 0, 1.0)


def test_images(spark):
    rows = [(0, "c", 0, 0, 0, 1), (0, "c", 1, 4, 2, 2), (0, "c", 2, 2, 4, 3), (0, "c", 3, 4, 2, 4), (1, "c", 0, None, 2, 5)]
    df = spark.createDataFrame(rows, "episode_index long, camera string, frame_index long, width long, height long, timestamp_ns long")
    out = video.sized(df, ["episode_index", "camera"])
    assert [r["fits"] for r in out.orderBy("episode_index", "frame_index").collect()] == [False, True, False, True, False]
    m = video.manifest(out).head()
    assert (m["path"], m["frames"], m["start_ns"], m["end_ns"]) == ("videos/chunk-000/c/episode_000000.mp4", 2, 2, 4)
    with pytest.raises(UnsupportedFormat):
        video.encode(df)


def test_sidecars(spark, tmp_path):
    mark = {"taskId": "1", "startPosition": 0.5, "endPosition": 2.0, "skillAtomic": "pick", "enSkillDetail": "take it", "extra": 1}
    (tmp_path / "a.json").write_text(json.dumps({"id": "x", "deviceSn": "7", "marks": [mark, {**mark, "enSkillDetail": None}]}, indent=1))
    a = sidecars.read_annotations(spark, f"file://{tmp_path}/a.json")
    assert [tuple(r)[1:] for r in sidecars.segments(a).collect()] == [(0.5, 2.0, "pick: take it"), (0.5, 2.0, "pick")]
    assert a.select(names.robot_type("arm_", F.col("deviceSn"))).head()[0] == "arm_7"
    (tmp_path / "jobs.json").write_text(json.dumps([{"name": "n", "sources": ["s3://a/b"], "output": "file:///o"}, {"name": "m", "namespace": "z", "sources": []}]))
    assert [(r["name"], r["namespace"], r["sources"]) for r in sidecars.read_manifest(spark, f"file://{tmp_path}/jobs.json").collect()] == [("n", "default", ["s3://a/b"]), ("m", "z", [])]
    (tmp_path / "x.mcap").write_bytes(b"12345")
    found = sidecars.list_files(spark, f"file://{tmp_path}").collect()
    assert [(r["size"], len(r["id"])) for r in found] == [(5, 16)]


def test_keyed_tables(spark, tmp_path):
    t = store.KeyedTable(spark, f"file://{tmp_path}/t", store.SEGMENTS, ("segment",))
    assert t.rows().count() == 0
    rows = spark.createDataFrame([("a", "h", 1, 2), ("b", "h", 3, 4)], store.SEGMENTS)
    t.put(rows)
    t.put(rows.where("segment = 'a'").withColumn("start", F.lit(9).cast("long")))
    t.delete(rows.where("segment = 'b'"))
    assert [tuple(r) for r in t.rows().select("segment", "start").collect()] == [("a", 9)]
    t.put(rows)
    assert t.get(rows.limit(1).select("segment")).count() == 1 and store.first_by_config(t.rows(), "h").head()["segment"] == "a"
    assert store.config_hash({"a": 1, "b": 2}) == store.config_hash({"b": 2, "a": 1})


def test_control_rules(spark):
    df = spark.createDataFrame([("Suspended", 100, 2.0), ("Merging", 1, 9.0), ("Complete", 1, 1.0)], "phase string, frames int, seconds double")
    got = df.select(control.after_cancel(F.col("phase")), control.checkpoint_due(F.col("frames"), F.col("seconds"), 100, 5)).collect()
    assert [tuple(r) for r in got] == [("Suspended", True), ("Cancelled", True), ("Complete", False)]
    assert control.merge_ready(spark.createDataFrame([("Pending", 2, 2), ("Pending", 1, 2), ("Merging", 2, 2)], "status string, completed int, expected int")).count() == 1
    entries = spark.createDataFrame([("x", 5, 1, 3), ("y", 2, 9, 1), ("z", 3, 4, 2)], "path string, last_accessed int, access_count int, created_at int")
    assert [control.eviction_candidate(entries, p).head()[0] for p in ("lru", "lfu", "fifo")] == ["y", "x", "y"]


def test_progress_log(spark, tmp_path):
    log = ProgressLog(most=3)
    for k in range(5):
        log._add("progress", "q", k, 1, k, 10 - k)
    assert [e[2] for e in log.events] == [2, 3, 4] and log.peak_state() == 8 and log.late() == 9


def test_output(spark, capsys):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    show(df, "json")
    show(df, "csv")
    assert capsys.readouterr().out.split() == ['{"n":', "1,", '"s":', '"a"}', "n,s", "1,a"]


def test_entry_without_the_training_subpackage(tmp_path):
    """The rest imports, and lists its queries, when the optional folders and the pipeline are gone, or can't be imported."""
    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "framelake", tmp_path / "framelake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copytree(root / "tests", tmp_path / "tests", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and set(e.oracle_sql()) <= set(q), len(q); assert not any(n.startswith('op') or n == 'pipeline' for n in q)"
    run = lambda where, code: subprocess.run([sys.executable, "-B", "-c", code], check=True, cwd=where, env={**os.environ, "PYTHONPATH": str(where)}, timeout=240)
    run(tmp_path, code)
    if (root / "framelake/llm").exists() and (root / "corpus_pipeline.py").exists():
        shutil.copy(root / "corpus_pipeline.py", tmp_path)
        run(tmp_path, code)  # a pipeline without its subpackage
        run(root, "import sys; sys.modules['xxhash'] = None\n" + code)  # a subpackage that lacks a module
