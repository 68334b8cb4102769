"""Recordings by splits: what is read of a file, damage, and a prefix that grows."""

import io
import json

from framelake.shared import shared_path
from framelake.sources import recordings, splits
from framelake.sources.generate import Out, bag_bytes, mcap_bytes


class Counting(io.BytesIO):
    """A file that counts the bytes read of it."""

    taken = 0

    def read(self, n=-1):
        out = super().read(n)
        self.taken += len(out)
        return out


def sample(n=3000):
    """A rare topic in a few chunks among a frequent one with large payloads."""
    return [Out("/rare" if k % 1000 < 3 else "/often", "json", 1000 + k, json.dumps({"k": k, "pad": "x" * 400}).encode()) for k in range(n)]


def read(data, topics=None, start=None, end=None, most=1 << 20):
    f = Counting(data)
    parts = list(splits.splits_of(f, len(data), "mcap", topics, start, end, most))
    return f, parts, [(n, m.log_time_ns) for c, _ in parts for n, m in splits.messages_of_split(f, len(data), "mcap", c, topics, start, end, None)]


def test_only_wanted_chunks_are_read():
    data = mcap_bytes(sample(), "", 100)
    f, parts, all_ = read(data)
    assert [t for _, t in all_] == list(range(1000, 4000)) and [n for n, _ in all_] == sorted(n for n, _ in all_)
    f, parts, some = read(data, {"/rare"})
    assert [t for _, t in some] == [1000 + k for k in range(3000) if k % 1000 < 3] and f.taken < len(data) * 0.12
    f, parts, some = read(data, None, 1500, 1700)
    assert [t for _, t in some] == list(range(1500, 1700)) and f.taken < len(data) * 0.12
    f, parts, some = read(data, {"none"})
    assert not some and not parts and f.taken < 10_000
    assert len(read(data, most=1 << 16)[1]) > 10
    assert read(mcap_bytes(sample(), "", 100, summary=False))[1][0][0] is None  # no summary: one split, read record by record


def test_as_the_whole_file_reader(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.mcap").write_bytes(mcap_bytes(sample(700), "zstd", 50, summary=k > 0))
    (tmp_path / "b.bag").write_bytes(bag_bytes([Out("/chatter", "ros1", 10 * k, b"\x02\x00\x00\x00ab", "std_msgs/String", "string data") for k in range(20)]))
    (tmp_path / "torn.mcap").write_bytes(mcap_bytes(sample(300), "zstd", 50)[:-4000])
    (tmp_path / "note.txt").write_text("no recording")
    path = f"file://{tmp_path}"
    key = lambda df: sorted((r["source_file"].rsplit("/", 1)[1], r["topic"], r["log_time_ns"], str(r["data"])) for r in df.collect())
    assert key(splits.read_splits(spark, path, report=True, split_bytes=2000)) == key(recordings.read_recordings(spark, path, report=True))
    assert key(splits.read_splits(spark, path, ["/rare"])) == key(recordings.read_recordings(spark, path, ["/rare"]))
    typed, want = (df.select("topic", "keys", "numbers", "log_time_ns").where("topic = '/rare'") for df in (splits.read_splits(spark, path, typed=True), recordings.read_messages(spark, path)))
    assert sorted(typed.collect(), key=str) == sorted(want.collect(), key=str)


def test_a_prefix_that_grows(spark, tmp_path):
    splits.register(spark)
    out, notes = shared_path(spark, "out"), shared_path(spark, "notes")

    def run():
        stream = spark.readStream.format("recordings").option("path", f"file://{tmp_path}").option("topics", "/rare").load()
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", notes).trigger(availableNow=True).start().awaitTermination()
        return spark.read.schema(recordings.SCHEMA).parquet(out).count()

    (tmp_path / "a.mcap").write_bytes(mcap_bytes(sample(1500), "zstd", 50))
    assert run() == 6 and run() == 6
    (tmp_path / "b.mcap").write_bytes(mcap_bytes(sample(3000), "zstd", 50))
    (tmp_path / "c.mcap").write_bytes(mcap_bytes([], "zstd", 50))
    assert run() == 15 and run() == 15


def test_small_files_share_tasks(tmp_path):
    """A task for many small recordings, none of them opened when the stream is planned; offsets of earlier checkpoints hold."""
    for k in range(600):
        (tmp_path / f"{k:03d}.mcap").write_bytes(mcap_bytes(sample(2), "zstd", 50, summary=k > 0))
    for cls in (splits._Stream, recordings._Reader):
        reader = cls({"path": f"file://{tmp_path}"}, "mcap")
        parts = reader.partitions({}, reader.latestOffset()) if cls is splits._Stream else reader.partitions()
        assert 1 < len(parts) <= 4 and sorted(p for part in parts for p, _, _ in part.files) == sorted(str(p) for p in tmp_path.iterdir())
        assert sum(b.num_rows for part in parts for b in reader.read(part)) == 1200
    stream = splits._Stream({"path": f"file://{tmp_path}"}, "mcap")
    assert all(chunks is None for part in stream.partitions({}, stream.latestOffset()) for _, _, chunks in part.files)
    taken = {f"{tmp_path}/{k:03d}.mcap": 1 for k in range(599)}
    assert [p for part in stream.partitions(taken, stream.latestOffset()) for p, _, _ in part.files] == [f"{tmp_path}/599.mcap"]
    (one,) = splits._Stream({"path": f"{tmp_path}/599.mcap"}, "mcap").partitions({}, splits._Stream({"path": f"{tmp_path}/599.mcap"}, "mcap").latestOffset())
    assert [p for p, _, _ in one.files] == [f"{tmp_path}/599.mcap"]
