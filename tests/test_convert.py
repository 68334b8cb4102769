import json
import struct

import pytest

from framelake.operators import merge, validate
from framelake.plans.convert import convert, messages_of
from framelake.sources import tables
from framelake.sources.config import Config, Mapping
from framelake.sources.generate import Out, mcap_bytes, pictures
from framelake.sources.recordings import UnsupportedFormat, read_messages
from framelake.sources.writer import write_cameras, write_episodes, writer_for


def test_dataset_directory(spark, tmp_path):
    messages = tables.multi_topic(spark, 40, 3)
    for k in (1, 2):
        messages = messages.unionByName(tables.multi_topic(spark, 10 * k, 3).withColumn("source", tables.F.lit(k).cast("long")))
    report = convert(spark, messages, f"file://{tmp_path}/d", Config("demo", fps=30, per_chunk=2), ["source"], task="pick")
    assert report == {"total_episodes": 3, "total_frames": 70, "files": 3, "without_state": 0}
    info = json.loads((tmp_path / "d/meta/info.json").read_text())
    assert info["total_frames"] == 70 and info["codebase_version"] == "v2.1" and info["robot_type"] == "unknown" and info["features"]["observation.state"]["shape"] == [3]
    lines = [json.loads(x) for x in (tmp_path / "d/meta/episodes.jsonl").read_text().splitlines()]
    assert lines == [{"episode_index": k, "length": n, "tasks": [0]} for k, n in enumerate((40, 10, 20))]
    stats = [json.loads(x) for x in (tmp_path / "d/meta/episodes_stats.jsonl").read_text().splitlines()]
    assert stats[1]["stats"]["observation.state"]["max"] == [27.0, 28.0, 29.0] and len(stats) == 3
    assert (tmp_path / "d/meta/tasks.jsonl").read_text() == '{"task_index":0,"task":"pick"}\n'
    files = sorted(str(p.relative_to(tmp_path / "d")) for p in (tmp_path / "d/data").rglob("episode*.parquet"))
    assert files == ["data/chunk-000/episode_000000.parquet", "data/chunk-000/episode_000001.parquet", "data/chunk-001/episode_000002.parquet"]
    one = spark.read.parquet(str(tmp_path / "d" / files[1]))
    assert one.count() == 10 and "observation.state.2" in one.columns and [r["frame_index"] for r in one.collect()] == list(range(10))
    back = merge.merged(merge.staged(spark, f"file://{tmp_path}/d/data"), ["frame_index"])
    assert back.agg({"index": "max", "episode_index": "max"}).head().asDict() == {"max(index)": 69, "max(episode_index)": 2}


def test_errors_and_extras(spark, tmp_path):
    with pytest.raises(ValueError, match="no frame"):
        convert(spark, tables.counted(spark, 3), f"file://{tmp_path}/x", Config("e"), ["source"])
    for name in ("hdf5", "rlds", "zarr"):
        with pytest.raises(UnsupportedFormat):
            writer_for(name)()
    with pytest.raises(UnsupportedFormat):
        writer_for("none")
    write_cameras(spark, f"file://{tmp_path}/c", {"left": {"intrinsic": {"fx": 1.0}, "extrinsic": None}})
    assert json.loads((tmp_path / "c/parameters/left_intrinsic.json").read_text()) == {"fx": 1.0}
    rows = spark.createDataFrame([(e, f) for e in range(5) for f in range(2)], "episode_index long, frame_index long")
    assert write_episodes(rows, f"file://{tmp_path}/p", per_chunk=2, episode_files=False) == 3
    assert spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/p/data").count() == 10


def test_no_row_is_lost(spark, tmp_path):
    """A limit of rows in a file cuts no episode, and what a failed run left behind is in nobody's way."""
    rows = spark.createDataFrame([(e, f) for e in range(3) for f in range(20)], "episode_index long, frame_index long")
    (tmp_path / "d/.staging").mkdir(parents=True)
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "3")
    try:
        assert write_episodes(rows, f"file://{tmp_path}/d") == 3
        assert write_episodes(rows, f"file://{tmp_path}/p", episode_files=False) >= 7
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    for name in ("d", "p"):
        found = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/{name}/data")
        assert found.count() == 60 and found.distinct().count() == 60
        assert [p.name for p in (tmp_path / name).iterdir() if p.name.startswith(".staging-")] == []
    assert spark.read.parquet(f"{tmp_path}/d/data/chunk-000/episode_000001.parquet").count() == 20


def test_actions_wider_than_states(spark, tmp_path):
    rows = [(0, "/observation/state", k * 2, k * 33_333_333, [1.0, 2.0]) for k in range(4)] + [(0, "/action", k * 2 + 1, k * 33_333_333, [9.0, 8.0, 7.0]) for k in range(4)]
    messages = spark.createDataFrame(rows, "source long, topic string, seq long, log_time_ns long, data array<float>")
    convert(spark, messages, f"file://{tmp_path}/d", Config("wide", fps=30), ["source"])
    info = json.loads((tmp_path / "d/meta/info.json").read_text())
    assert info["features"]["action"]["shape"] == [3] and info["features"]["observation.state"]["shape"] == [2]
    out = spark.read.parquet(f"{tmp_path}/d/data/chunk-000/episode_000000.parquet")
    assert [r["action.2"] for r in out.collect()] == [7.0] * 4


def test_episodes_by_pictures(spark, tmp_path):
    """Four pictures fill an episode; frames begin at 0 in each, and no invariant is broken."""
    n = 10
    vectors = tables.multi_topic(spark, n, 2).withColumn("image", tables.F.lit(None).cast(pictures(spark, 1).schema["image"].dataType))
    convert(spark, vectors.unionByName(pictures(spark, n)), f"file://{tmp_path}/d", Config("cam", frames_per_episode=4), ["source"])
    back = merge.staged(spark, f"file://{tmp_path}/d/data")
    assert sorted((r["episode_index"], r["frame_index"]) for r in back.collect()) == [(k // 4, k % 4) for k in range(n)]
    assert validate.frame_invariants(back).count() == 0
    assert back.select("camera_path").distinct().count() == 3 and "camera_timestamp" in back.columns
    info = json.loads((tmp_path / "d/meta/info.json").read_text())
    assert info["features"]["camera"] == {"dtype": "video", "shape": [48, 64, 3], "names": ["height", "width", "channels"]}
    videos = [json.loads(x) for x in (tmp_path / "d/meta/videos.jsonl").read_text().splitlines()]
    assert [(v["path"], v["frames"]) for v in videos] == [(f"videos/chunk-000/camera/episode_{k:06d}.mp4", f) for k, f in ((0, 4), (1, 4), (2, 2))]


def test_recording_to_dataset(spark, tmp_path):
    """From an MCAP file to a dataset directory: vectors of counting types only, pictures, calibration, a limit of frames."""
    step, out = 33_333_333, []
    for k in range(12):
        out.append(Out("/joints", "ros1", k * step, joint(k), "sensor/Joint", JOINT))
        out.append(Out("/camera", "json", k * step + 1, json.dumps({"width": 2, "height": 2, "data": [k] * 12}).encode()))
        out.append(Out("/info", "json", k * step + 2, json.dumps({"K": [1.0 + k, 0, 0, 0, 1, 0, 0, 0, 1], "D": [], "P": [0.0] * 12}).encode()))
    (tmp_path / "one.mcap").write_bytes(mcap_bytes(out, "zstd", 5))
    maps = (Mapping("/joints", "observation.state"), Mapping("/camera", "cam", "image"), Mapping("/info", "cam", "camerainfo"))
    rows, infos = messages_of(read_messages(spark, f"file://{tmp_path}/one.mcap"))
    report = convert(spark, rows, f"file://{tmp_path}/d", Config("all", mappings=maps, max_frames=8), ["source"], infos=infos)
    assert report["total_frames"] == 8
    got = spark.read.parquet(f"{tmp_path}/d/data/chunk-000/episode_000000.parquet").orderBy("frame_index").collect()
    assert [(r["observation.state.0"], r["observation.state.1"]) for r in got] == [(0.5, float(k)) for k in range(8)]
    assert json.loads((tmp_path / "d/parameters/cam_intrinsic.json").read_text())["fx"] == 1.0
    assert json.loads((tmp_path / "d/meta/info.json").read_text())["features"]["cam"]["shape"] == [2, 2, 3]


JOINT = "float64[] position\nint8[] small"


def joint(k):
    return struct.pack("<Idd", 2, 0.5, k) + struct.pack("<I", 3) + b"abc"
