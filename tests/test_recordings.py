import bz2
import io
import json
import struct

import pytest
from pyspark.errors import PythonException

from framelake.plans.convert import messages_of
from framelake.sources.decoding import BadRecording, decode, mcap_summary, read_bag, read_mcap
from framelake.sources.generate import Out, mcap_bytes
from framelake.sources.recordings import UnsupportedFormat, _Reader, kind_of, read_messages, read_recordings, register_sources

JOINT = "std_msgs/Header header\nstring[] name\nfloat64[] position\nuint8[] blob\nfloat32[2] pair\nint8 K=3\n===\nMSG: std_msgs/Header\nuint32 seq\ntime stamp\nstring frame_id"
JOINT2 = JOINT.replace("uint32 seq\n", "").replace("time stamp", "builtin_interfaces/Time stamp") + "\n===\nMSG: builtin_interfaces/Time\nint32 sec\nuint32 nanosec"


def text(s):
    return struct.pack("<I", len(s)) + s.encode()


def record(op, body):
    return bytes([op]) + struct.pack("<Q", len(body)) + body


def mcap(messages, kind="none"):
    """messages: (topic, encoding, time, payload, type, definition)"""
    out, inner, seen = b"\x89MCAP0\r\n" + record(1, text("") + text("")), b"", {}
    for n, (topic, encoding, t, payload, name, definition) in enumerate(messages):
        if topic not in seen:
            seen[topic] = len(seen) + 1
            k = seen[topic]
            inner += record(3, struct.pack("<H", k) + text(name) + text("") + struct.pack("<I", len(definition)) + definition.encode())
            inner += record(4, struct.pack("<HH", k, k) + text(topic) + text(encoding) + struct.pack("<I", 0))
        inner += record(5, struct.pack("<HIQQ", seen[topic], n, t, t + 1) + payload)
    if kind == "none":
        body = inner
    elif kind == "zstd":
        import zstandard

        body = zstandard.ZstdCompressor().compress(inner)
    else:
        import pyarrow as pa

        sink = pa.BufferOutputStream()
        with pa.CompressedOutputStream(sink, "lz4") as f:
            f.write(inner)
        body = sink.getvalue().to_pybytes()
    out += record(6, struct.pack("<QQQI", 0, 9, len(inner), 0) + text(kind) + struct.pack("<Q", len(body)) + body)
    return out + record(0x0F, struct.pack("<I", 0)) + record(2, bytes(20)) + b"\x89MCAP0\r\n"


def ros1(n):
    return struct.pack("<III", n, 7, 8) + text("base") + struct.pack("<I", 1) + text("j") + struct.pack("<Idd", 2, 0.5, n) + struct.pack("<I", 3) + b"abc" + struct.pack("<ff", 1.0, 2.0)


def cdr(n):
    out = b"\0\1\0\0" + struct.pack("<iI", 7, 8) + struct.pack("<I", 5) + b"base\0"
    pad = lambda b, k: b + bytes(-(len(b) - 4) % k)
    out = pad(out, 4) + struct.pack("<I", 1) + struct.pack("<I", 2) + b"j\0"
    out = pad(pad(out, 4) + struct.pack("<I", 2), 8) + struct.pack("<dd", 0.5, n) + struct.pack("<I", 3) + b"abc"
    return pad(out, 4) + struct.pack("<ff", 1.0, 2.0)


def bag(n, kind="none"):
    head = lambda **f: b"".join(struct.pack("<I", len(k) + 1 + len(v)) + k.encode() + b"=" + v for k, v in f.items())
    rec = lambda h, d: struct.pack("<I", len(h)) + h + struct.pack("<I", len(d)) + d
    inner = rec(head(op=b"\x07", conn=struct.pack("<I", 0), topic=b"/joints"), head(topic=b"/joints", type=b"sensor/Joint", message_definition=JOINT.encode()))
    for k in range(n):
        inner += rec(head(op=b"\x02", conn=struct.pack("<I", 0), time=struct.pack("<II", 10, k)), ros1(k))
    body = bz2.compress(inner) if kind == "bz2" else inner
    return b"#ROSBAG V2.0\n" + rec(head(op=b"\x03", index_pos=bytes(8)), b" " * 20) + rec(head(op=b"\x05", compression=kind.encode(), size=struct.pack("<I", len(inner))), body)


def test_payloads():
    for reader, data in ((read_bag, bag(3)), (read_bag, bag(3, "bz2")), (read_mcap, mcap([("/j", "ros1", k, ros1(k), "sensor/Joint", JOINT) for k in range(3)], "zstd")),
                         (read_mcap, mcap([("/j", "cdr", k, cdr(k), "sensor/msg/Joint", JOINT2) for k in range(3)], "lz4"))):
        found = [decode(m) for m in reader(data)]
        assert len(found) == 3
        for k, f in enumerate(found):
            assert f["name"] == ["j"] and f["position"] == [0.5, k] and f["blob"] == b"abc" and f["pair"] == [1.0, 2.0] and "K" not in f
            assert f["header"]["frame_id"] == "base" and f["header"]["stamp"] == {"sec": 7, "nanosec": 8}
    with pytest.raises(BadRecording):
        list(read_mcap(b"nothing of it"))


def test_scan(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    good = [("/a", "json", k * 10, json.dumps({"x": [k]}).encode(), "", "") for k in range(4)] + [("/b", "protobuf", 50, b"zz", "", ""), ("/a", "json", 60, b"{", "", "")]
    (tmp_path / "one.mcap").write_bytes(mcap(good))
    (tmp_path / "sub/two.BAG").write_bytes(bag(5, "bz2"))
    (tmp_path / "sub/three.mcap").write_bytes(mcap(good)[:150])
    (tmp_path / "notes.txt").write_text("x")
    df = read_recordings(spark, f"file://{tmp_path}").cache()
    assert df.where("topic = '/a'").count() == 4 and df.where("topic = '/joints'").count() == 5 and df.where("topic = '/b'").count() == 0
    assert [json.loads(r["data"]) for r in df.where("topic = '/a'").orderBy("seq").collect()] == [{"x": [k]} for k in range(4)]
    assert df.where("topic = '/joints'").agg({"log_time_ns": "max"}).head()[0] == 10_000_000_004
    assert read_recordings(spark, f"file://{tmp_path}", topics=["/joints"]).count() == 5
    with pytest.raises(PythonException):
        read_recordings(spark, f"file://{tmp_path}/one.mcap", strict=True).count()
    assert register_sources(spark) == ["mcap", "rosbag", "rrd"]
    assert spark.read.format("mcap").option("topics", "/a").load(str(tmp_path / "one.mcap")).count() == 4
    assert spark.read.format("rosbag").load(str(tmp_path / "sub/two.BAG")).count() == 5


def test_kinds(spark, tmp_path):
    assert [kind_of(u) for u in ("a.MCAP", "s3://b/x.bag?region=r", "s3://b/prefix/", "plain", "file:///d/x.rrd")] == ["mcap", "bag", "prefix", "mcap", "rrd"]
    (tmp_path / "x.rrd").write_bytes(b"rr")
    with pytest.raises(PythonException, match="rrd"):
        read_recordings(spark, f"file://{tmp_path}").count()
    assert issubclass(UnsupportedFormat, ValueError)


def test_chunks_and_summaries(spark, tmp_path):
    """A file with a summary is cut at its chunks; topics and times keep chunks from being read; without one it is read through."""
    out = [Out("/a" if k < 50 else "/b", "json", k, json.dumps([k]).encode()) for k in range(100)]
    whole = mcap_bytes(out, "zstd", 10)
    (tmp_path / "s.mcap").write_bytes(whole)
    (tmp_path / "n.mcap").write_bytes(mcap_bytes(out, "lz4", 10, summary=False))
    register_sources(spark)
    chunks, reader = mcap_summary(io.BytesIO(whole), len(whole))
    assert len(chunks) == 10 and {c.topic for c in reader.channels.values()} == {"/a", "/b"}
    parts = lambda **o: [p for p in _Reader({"path": str(tmp_path / "s.mcap"), **o}, "mcap").partitions()]
    assert sum(len(p.chunks) for p in parts()) == 10
    assert sum(len(p.chunks) for p in parts(topics="/b")) == 5 and sum(len(p.chunks) for p in parts(start_ns="25", end_ns="41")) == 3
    for name in ("s", "n"):
        got = spark.read.format("mcap").option("typed", "true").option("start_ns", 25).option("end_ns", 41).load(str(tmp_path / f"{name}.mcap"))
        assert [r["numbers"] for r in got.orderBy("seq").collect()] == [[float(k)] for k in range(25, 41)]
        assert spark.read.format("mcap").option("topics", "/b").load(f"file://{tmp_path}/{name}.mcap").count() == 50


def test_reading_goes_on_behind_damage(spark, tmp_path):
    out = [Out("/a", "json", k, b"{" if k == 33 else json.dumps([k]).encode()) for k in range(100)]
    data = bytearray(mcap_bytes(out, "zstd", 10))
    at = mcap_summary(io.BytesIO(bytes(data)), len(data))[0][4].offset
    data[at + 60 : at + 90] = bytes(30)  # inside the fifth chunk
    (tmp_path / "x.mcap").write_bytes(bytes(data))
    rows = read_recordings(spark, f"file://{tmp_path}", report=True)
    assert rows.where("seq >= 0").count() == 89
    assert [json.loads(r["data"]) for r in rows.where("seq < 0").collect()] == [{"blocks": 1, "messages": 1}]
    with pytest.raises(PythonException):
        read_recordings(spark, f"file://{tmp_path}", strict=True).count()
    register_sources(spark)
    assert spark.read.format("mcap").load(str(tmp_path / "x.mcap")).count() == 89


def test_numbers_that_count(spark, tmp_path):
    """8-bit joint positions are dropped; a picture's bytes may be an array; what is neither contributes nothing."""
    small = "int8[] position"
    out = [Out("/s", "ros1", 1, struct.pack("<I", 2) + b"ab", "x/Joint", small), Out("/v", "json", 2, b"[1, 2.5]"), Out("/t", "json", 3, b'"text"'), Out("/p", "json", 4, b'{"width": 1, "height": 1, "data": [[], [1, 2, 3]]}')]
    (tmp_path / "x.mcap").write_bytes(mcap_bytes(out))
    rows, infos = messages_of(read_messages(spark, f"file://{tmp_path}"))
    got = {r["topic"]: r for r in rows.collect()}
    assert set(got) == {"/v", "/p"} and got["/v"]["data"] == [1.0, 2.5] and got["/p"]["image"]["kind"] == "rgb" and infos.count() == 0
