"""Recordings made up for tests and demonstrations: MCAP and bag files, and tables of messages of fixed patterns."""

from __future__ import annotations

import bz2
import struct
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.functions.clock import NS
from framelake.sources.decoding import BAG_MAGIC, MCAP_MAGIC


@dataclass(frozen=True)
class Out:
    """A message to write."""

    topic: str
    encoding: str
    time_ns: int
    payload: bytes
    type: str = ""
    definition: str = ""


def _text(s: str) -> bytes:
    return struct.pack("<I", len(s.encode())) + s.encode()


def _record(op: int, body: bytes) -> bytes:
    return bytes([op]) + struct.pack("<Q", len(body)) + body


def _packed(kind: str, data: bytes) -> bytes:
    if kind == "zstd":
        import zstandard

        return zstandard.ZstdCompressor().compress(data)
    if kind == "lz4":
        import pyarrow as pa

        sink = pa.BufferOutputStream()
        with pa.CompressedOutputStream(sink, "lz4") as f:
            f.write(data)
        return sink.getvalue().to_pybytes()
    return data


def mcap_bytes(messages: list[Out], kind: str = "", chunk: int = 100, summary: bool = True) -> bytes:
    """An MCAP file of chunks of `chunk` messages, with a summary of channels and chunks or without."""
    out = bytearray(MCAP_MAGIC + _record(1, _text("") + _text("")))
    known: dict[str, tuple[int, bytes]] = {}
    index = b""
    for start in range(0, len(messages), chunk):
        inner, used, times = b"", set(), []
        for n, m in enumerate(messages[start : start + chunk], start):
            if m.topic not in known:
                k = len(known) + 1
                schema = _record(3, struct.pack("<H", k) + _text(m.type) + _text("") + struct.pack("<I", len(m.definition.encode())) + m.definition.encode())
                known[m.topic] = k, schema + _record(4, struct.pack("<HH", k, k) + _text(m.topic) + _text(m.encoding) + struct.pack("<I", 0))
                inner += known[m.topic][1]
            k = known[m.topic][0]
            used.add(k)
            times.append(m.time_ns)
            inner += _record(5, struct.pack("<HIQQ", k, n, m.time_ns, m.time_ns) + m.payload)
        body = _packed(kind, inner)
        record = _record(6, struct.pack("<QQQI", min(times), max(times), len(inner), 0) + _text(kind) + struct.pack("<Q", len(body)) + body)
        offsets = b"".join(struct.pack("<HQ", k, 0) for k in sorted(used))
        about = struct.pack("<QQQQI", min(times), max(times), len(out), len(record), len(offsets)) + offsets
        index += _record(8, about + struct.pack("<Q", 0) + _text(kind) + struct.pack("<QQ", len(body), len(inner)))
        out += record
    out += _record(0x0F, struct.pack("<I", 0))
    at = len(out) if summary and messages else 0
    if at:
        out += b"".join(b for _, b in known.values()) + index
    return bytes(out + _record(2, struct.pack("<QQI", at, 0, 0)) + MCAP_MAGIC)


def bag_bytes(messages: list[Out], kind: str = "none", chunk: int = 100) -> bytes:
    """A ROS 1 bag of chunks of `chunk` messages."""
    head = lambda **f: b"".join(struct.pack("<I", len(k) + 1 + len(v)) + k.encode() + b"=" + v for k, v in f.items())
    rec = lambda h, d: struct.pack("<I", len(h)) + h + struct.pack("<I", len(d)) + d
    out, known = BAG_MAGIC + rec(head(op=b"\x03", index_pos=bytes(8)), b" " * 20), {}
    for start in range(0, len(messages), chunk):
        inner = b""
        for m in messages[start : start + chunk]:
            if m.topic not in known:
                known[m.topic] = struct.pack("<I", len(known))
                inner += rec(head(op=b"\x07", conn=known[m.topic], topic=m.topic.encode()), head(topic=m.topic.encode(), type=m.type.encode(), message_definition=m.definition.encode()))
            inner += rec(head(op=b"\x02", conn=known[m.topic], time=struct.pack("<II", *divmod(m.time_ns, NS))), m.payload)
        body = bz2.compress(inner) if kind == "bz2" else inner
        out += rec(head(op=b"\x05", compression=kind.encode(), size=struct.pack("<I", len(inner))), body)
    return out


def with_gap(messages: DataFrame, at: int, gap_ns: int) -> DataFrame:
    """The same messages, those from number `at` on later by gap_ns."""
    return messages.withColumn("log_time_ns", F.col("log_time_ns") + F.when(F.col("seq") >= at, F.lit(gap_ns)).otherwise(F.lit(0)))


def failing(messages: DataFrame, at: int) -> DataFrame:
    """The same messages, with an error when number `at` is read."""
    fault = F.when(F.col("seq") == at, F.raise_error(F.concat(F.lit("message "), "seq")).cast("bigint")).otherwise(F.col("seq"))
    return messages.withColumn("seq", fault)


def pictures(spark: SparkSession, n: int, width: int = 64, height: int = 48, fps: int = 30, topic: str = "/camera") -> DataFrame:
    """n raw pictures by their size, one a frame, without bytes."""
    image = F.struct(F.lit(width).cast("long").alias("width"), F.lit(height).cast("long").alias("height"), F.lit("rgb").alias("kind"), F.lit(width * height * 3).cast("long").alias("size"), F.lit("mock").alias("file"), F.col("id").alias("seq"))
    return spark.range(n).select(
        F.lit(0).cast("long").alias("source"), F.lit(topic).alias("topic"), (F.col("id") * (NS // fps)).alias("log_time_ns"), F.col("id").alias("seq"), F.lit(None).cast("array<float>").alias("data"), image.alias("image")
    )
