"""Bytes of recordings to messages: container records, and ROS 1, CDR and JSON payloads. No Spark in here."""

from __future__ import annotations

import base64
import bz2
import io
import json
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

MCAP_MAGIC = b"\x89MCAP0\r\n"
BAG_MAGIC = b"#ROSBAG V2.0\n"


class BadRecording(ValueError):
    """A container that can't be read on."""


@dataclass(frozen=True)
class Channel:
    topic: str
    encoding: str
    type: str
    definition: str


@dataclass(frozen=True)
class Raw:
    channel: Channel
    sequence: int
    log_time_ns: int
    publish_time_ns: int
    data: bytes


class Cursor:
    """Little-endian reads from bytes; with align, CDR's alignment from an origin."""

    def __init__(self, data: bytes, at: int = 0, origin: int | None = None, order: str = "<"):
        self.data, self.at, self.origin, self.order = data, at, origin, order

    def take(self, n: int) -> bytes:
        if n < 0 or self.at + n > len(self.data):
            raise BadRecording("cut short")
        self.at += n
        return self.data[self.at - n : self.at]

    def number(self, code: str):
        n = struct.calcsize("<" + code)
        if self.origin is not None:
            self.at += -(self.at - self.origin) % n
        return struct.unpack(self.order + code, self.take(n))[0]

    def text(self) -> str:
        return self.take(self.number("I")).decode("utf-8", "replace")


def _unpacked(kind: str, data: bytes) -> bytes:
    if kind in ("", "none"):
        return data
    if kind == "bz2":
        return bz2.decompress(data)
    if kind == "zstd":
        import zstandard

        return zstandard.ZstdDecompressor().decompressobj().decompress(data)
    if kind == "lz4":
        import pyarrow as pa

        with pa.CompressedInputStream(pa.BufferReader(data), "lz4") as stream:
            return stream.read()
    raise BadRecording(f"compression {kind}")


@dataclass
class Faults:
    """What a reader passed over."""

    blocks: int = 0  # chunks and ends of files that can't be read
    messages: int = 0


class Mcap:
    """Messages of an MCAP file, chunk by chunk from a file object: memory follows the largest record."""

    def __init__(self, file, topics: set[str] | None = None, start_ns: int | None = None, end_ns: int | None = None, faults: Faults | None = None):
        self.file, self.topics, self.start, self.end = file, topics, start_ns, end_ns
        self.faults, self.strict = faults or Faults(), faults is None
        self.schemas: dict[int, tuple[str, str]] = {}
        self.channels: dict[int, Channel] = {}

    def _record(self) -> tuple[int, bytes] | None:
        head = self.file.read(9)
        if len(head) < 9:
            return None
        op, size = head[0], struct.unpack_from("<Q", head, 1)[0]
        body = self.file.read(size)
        if len(body) < size:
            raise BadRecording("cut short")
        return op, body

    def _known(self, op: int, body: bytes) -> None:
        c = Cursor(body)
        if op == 0x03:
            ident, name, _ = c.number("H"), c.text(), c.text()
            self.schemas[ident] = (name, c.take(c.number("I")).decode("utf-8", "replace"))
        elif op == 0x04:
            ident, schema, topic, encoding = c.number("H"), c.number("H"), c.text(), c.text()
            self.channels[ident] = Channel(topic, encoding, *self.schemas.get(schema, ("", "")))

    def _message(self, body: bytes) -> Raw | None:
        c = Cursor(body)
        ident, sequence, log, publish = c.number("H"), c.number("I"), c.number("Q"), c.number("Q")
        channel = self.channels.get(ident)
        if not channel or (self.topics is not None and channel.topic not in self.topics):
            return None
        if (self.start is not None and log < self.start) or (self.end is not None and log >= self.end):
            return None
        return Raw(channel, sequence, log, publish, body[c.at :])

    def _block(self, block: bytes) -> Iterator[Raw]:
        at = 0
        while at + 9 <= len(block):
            op, size = block[at], struct.unpack_from("<Q", block, at + 1)[0]
            body = block[at + 9 : at + 9 + size]
            if len(body) < size:
                raise BadRecording("cut short")
            at += 9 + size
            if op == 0x05:
                if m := self._message(body):
                    yield m
            else:
                self._known(op, body)

    def chunk(self, body: bytes) -> Iterator[Raw]:
        """Messages of a chunk record; one that can't be unpacked is a fault, and what follows it is read on."""
        try:
            c = Cursor(body, 28)
            kind = c.text()
            block = _unpacked(kind, c.take(c.number("Q")))
        except Exception as e:
            if self.strict:
                raise e if isinstance(e, BadRecording) else BadRecording(str(e)) from e
            self.faults.blocks += 1
            return
        yield from self._whole(self._block(block))

    def _whole(self, messages: Iterator[Raw]) -> Iterator[Raw]:
        try:
            yield from messages
        except (BadRecording, struct.error):
            if self.strict:
                raise
            self.faults.blocks += 1

    def messages(self) -> Iterator[Raw]:
        """All messages in file order."""
        if self.file.read(8) != MCAP_MAGIC:
            raise BadRecording("not an MCAP file")
        while True:
            try:
                found = self._record()
            except BadRecording:
                if self.strict:
                    raise
                self.faults.blocks += 1
                return
            if found is None or found[0] in (0x02, 0x0F):
                return
            op, body = found
            if op == 0x06:
                yield from self.chunk(body)
            elif op == 0x05:
                if m := self._message(body):
                    yield m
            else:
                self._known(op, body)

    def at(self, offset: int) -> Iterator[Raw]:
        """Messages of the chunk record at a place of the file; its channels must be known from the summary."""
        self.file.seek(offset)
        op, body = self._record()
        if op != 0x06:
            raise BadRecording("no chunk there")
        yield from self.chunk(body)


@dataclass(frozen=True)
class Chunk:
    offset: int
    size: int
    start_ns: int
    end_ns: int
    channels: tuple[int, ...]


def mcap_summary(file, size: int) -> tuple[list[Chunk], Mcap] | None:
    """Chunks that the file's summary lists, and a reader that knows its channels; None without a usable summary."""
    if size < 8 + 29 + 8:
        return None
    file.seek(size - 37)
    tail = file.read(37)
    if tail[29:] != MCAP_MAGIC or tail[0] != 0x02:
        return None
    start = struct.unpack_from("<Q", tail, 9)[0]
    if not 8 <= start < size - 37:
        return None
    file.seek(start)
    block, at, chunks, reader = file.read(size - 37 - start), 0, [], Mcap(file)
    while at + 9 <= len(block):
        op, n = block[at], struct.unpack_from("<Q", block, at + 1)[0]
        body = block[at + 9 : at + 9 + n]
        at += 9 + n
        if op in (0x03, 0x04):
            reader._known(op, body)
        elif op == 0x08:
            first, last, offset, length, listed = struct.unpack_from("<QQQQI", body)
            channels = tuple(struct.unpack_from("<H", body, 36 + k)[0] for k in range(0, listed, 10))
            chunks.append(Chunk(offset, length, first, last, channels))
    return (sorted(chunks, key=lambda c: c.offset), reader) if chunks and reader.channels else None


def read_mcap(data: bytes, topics: set[str] | None = None, faults: Faults | None = None) -> Iterator[Raw]:
    """Messages in file order. Without faults, what can't be read raises BadRecording; with, it is counted there."""
    return Mcap(io.BytesIO(data), topics, faults=faults).messages()


def _fields(block: bytes) -> dict[str, bytes]:
    c, out = Cursor(block), {}
    while c.at < len(block):
        name, _, value = c.take(c.number("I")).partition(b"=")
        out[name.decode()] = value
    return out


def read_bag(data: bytes, topics: set[str] | None = None, faults: Faults | None = None) -> Iterator[Raw]:
    """Messages of a ROS 1 bag in memory, as read_mcap."""
    return bag_messages(io.BytesIO(data), topics, faults=faults)


def bag_messages(file, topics: set[str] | None = None, start_ns: int | None = None, end_ns: int | None = None, faults: Faults | None = None) -> Iterator[Raw]:
    """Messages of a ROS 1 bag (format 2.0) in file order, record by record from a file object."""
    strict, faults = faults is None, faults or Faults()
    if file.read(len(BAG_MAGIC)) != BAG_MAGIC:
        raise BadRecording("not a ROS bag")
    channels: dict[int, Channel] = {}
    place = 0

    def part(f) -> bytes | None:
        head = f.read(4)
        if len(head) < 4:
            return None
        n = struct.unpack("<I", head)[0]
        body = f.read(n)
        if len(body) < n:
            raise BadRecording("cut short")
        return body

    def records(f) -> Iterator[Raw]:
        nonlocal place
        while (head := part(f)) is not None:
            head, body = _fields(head), part(f) or b""
            op = head.get("op", b"\0")[0]
            if op == 0x07:
                own = _fields(body)
                topic = head.get("topic", own.get("topic", b"")).decode()
                channels[struct.unpack("<I", head["conn"])[0]] = Channel(topic, "ros1", own.get("type", b"").decode(), own.get("message_definition", b"").decode("utf-8", "replace"))
            elif op == 0x05:
                try:
                    block = _unpacked(head.get("compression", b"none").decode(), body)
                except Exception as e:
                    if strict:
                        raise BadRecording(str(e)) from e
                    faults.blocks += 1
                    continue
                yield from records(io.BytesIO(block))
            elif op == 0x02:
                channel = channels.get(struct.unpack("<I", head["conn"])[0])
                seconds, nanos = struct.unpack("<II", head["time"])
                t, place = seconds * 1_000_000_000 + nanos, place + 1
                inside = (start_ns is None or t >= start_ns) and (end_ns is None or t < end_ns)
                if channel and inside and (topics is None or channel.topic in topics):
                    yield Raw(channel, place - 1, t, t, body)

    try:
        yield from records(file)
    except (BadRecording, KeyError, struct.error) as e:
        if strict:
            raise e if isinstance(e, BadRecording) else BadRecording(str(e)) from e
        faults.blocks += 1


#: ROS primitive types by struct code.
PRIMITIVES = {
    "bool": "?", "int8": "b", "uint8": "B", "byte": "b", "char": "B", "int16": "h", "uint16": "H", "int32": "i", "uint32": "I",
    "int64": "q", "uint64": "Q", "float32": "f", "float64": "d",
}
FIELD = re.compile(r"^([\w/]+)(?:<=\d+)?(\[(?:<=)?(\d*)\])?\s+(\w+)\s*(=.*)?")


@lru_cache(maxsize=256)
def parse_definition(name: str, definition: str) -> tuple[str, dict[str, list[tuple]]]:
    """(root type, {type: [(field, type, array length or None, is array)]}) of a message definition with its parts."""
    types: dict[str, list[tuple]] = {}
    root = current = _short(name)
    types[current] = []
    for line in definition.splitlines():
        line = line.split("#", 1)[0].strip()
        if line.startswith("MSG:"):
            current = _short(line[4:].strip())
            types[current] = []
        elif line and not line.startswith("=") and (m := FIELD.match(line)) and not m[5]:
            kind, bounded = m[1], bool(m[2]) and "<=" in m[2]
            length = int(m[3]) if m[3] and not bounded else None
            types[current].append((m[4], kind, length, bool(m[2])))
    return root, types


def _short(name: str) -> str:
    return name.replace("/msg/", "/")


def _find(types: dict, kind: str, inside: str) -> str:
    kind = _short(kind)
    if kind in types:
        return kind
    own = f"{inside.split('/')[0]}/{kind}"
    if own in types:
        return own
    found = [t for t in types if t.endswith(f"/{kind}")] if kind != "Header" else [t for t in types if t == "std_msgs/Header"]
    if not found:
        raise BadRecording(f"no definition of {kind}")
    return found[0]


def decode_ros(raw: bytes, name: str, definition: str, cdr: bool) -> dict:
    """Fields of a ROS 1 or CDR message; byte arrays stay bytes."""
    root, types = parse_definition(name, definition)
    if cdr:
        if len(raw) < 4:
            raise BadRecording("no CDR header")
        c = Cursor(raw, 4, 4, "<" if raw[1] & 1 else ">")
    else:
        c = Cursor(raw)

    def one(kind: str, inside: str):
        if kind in PRIMITIVES:
            return c.number(PRIMITIVES[kind])
        if kind in ("string", "wstring"):
            return c.text().rstrip("\0") if cdr else c.text()
        if kind in ("time", "duration"):
            code = "I" if kind == "time" else "i"
            return {"sec": c.number(code), "nanosec": c.number("I" if cdr else code)}
        return fields(_find(types, kind, inside))

    def fields(kind: str) -> dict:
        out = {}
        for field, own, length, array in types[kind]:
            if not array:
                out[field] = one(own, kind)
                continue
            n = c.number("I") if length is None else length
            code = PRIMITIVES.get(own)
            if code in ("B", "b"):
                out[field] = c.take(n)
            elif code and n:
                size = struct.calcsize(code)
                if cdr:
                    c.at += -(c.at - 4) % size
                out[field] = list(struct.unpack(f"{c.order}{n}{code}", c.take(n * size)))
            else:
                out[field] = [one(own, kind) for _ in range(n)]
        return out

    if cdr and not types[root]:
        return {}
    return fields(root)


def number_types(name: str, definition: str) -> dict[str, str]:
    """Element type of each top-level field, which tells numbers that count from those that don't."""
    root, types = parse_definition(name, definition)
    return {field: kind for field, kind, _, _ in types[root]}


def decode(m: Raw) -> dict | list:
    kind = m.channel.encoding
    if kind == "json":
        return json.loads(m.data)
    if kind in ("ros1", "cdr"):
        return decode_ros(m.data, m.channel.type, m.channel.definition, kind == "cdr")
    raise BadRecording(f"encoding {kind}")


def as_json(value) -> str:
    """Compact JSON; bytes in base64."""
    return json.dumps(value, default=lambda x: base64.b64encode(x).decode(), separators=(",", ":"))


def _bytes_in(value) -> bytes | None:
    """Bytes, or an array's elements that fit a byte, or those of the first nested array that isn't empty."""
    if isinstance(value, (bytes, bytearray)):
        return bytes(value) or None
    if isinstance(value, list):
        own = [x for x in value if isinstance(x, int) and not isinstance(x, bool) and 0 <= x <= 255]
        if own:
            return bytes(own)
        return _bytes_in(next((x for x in value if isinstance(x, list) and x), None))
    return None


def _kind_in(values: list, declared: str | None) -> str | None:
    """Number type of an array: the definition's, else by its values, as JSON has only whole numbers and doubles."""
    if declared:
        return declared
    return "int64" if all(isinstance(x, int) for x in values) else "float64"


def parts_of(m: Raw, value) -> dict:
    """Typed parts of a decoded message: field names, numbers and their type, picture fields, calibration."""
    out: dict = {"keys": None, "numbers": None, "number_type": None, "format": None, "width": None, "height": None, "bytes": None, "camera": None}
    numbers, declared = value if isinstance(value, list) else None, None
    if isinstance(value, dict):
        out["keys"] = list(value)
        types = number_types(m.channel.type, m.channel.definition) if m.channel.definition else {}
        if isinstance(value.get("position"), list):
            numbers, declared = value["position"], types.get("position")
        out["format"] = value["format"] if isinstance(value.get("format"), str) else None
        for side in ("width", "height"):
            x = value.get(side)
            out[side] = x if isinstance(x, int) and not isinstance(x, bool) and 0 <= x < 1 << 32 else None
        if "data" in value:
            out["bytes"] = _bytes_in(value["data"])
        if "K" in value and "D" in value:
            array = lambda x: [float(v) for v in x] if isinstance(x, list) else None
            out["camera"] = {k: array(value.get(k)) for k in ("K", "D", "P")}
    if numbers is not None:
        kept = [x for x in numbers if isinstance(x, (int, float)) and not isinstance(x, bool)]
        out["numbers"], out["number_type"] = [float(x) for x in kept], _kind_in(kept, declared)
    return out
