"""Recordings as tables of messages, one row a message: bag, MCAP, and whole prefixes of them.

Two readers. read_recordings and read_messages go through Spark's own file reader, so any store that Spark reads will do,
and a file of up to 2 GB is a task's work. spark.read.format("mcap") and "rosbag" open files through pyarrow's file
systems (local, HDFS, S3, GCS) by byte ranges, whatever their size: an MCAP file with a summary is cut at its chunks, and
chunks without the wanted topics or times aren't read; others are read record by record.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from framelake.shipping import ship
from framelake.sources.decoding import BadRecording, Faults, Mcap, Raw, as_json, bag_messages, decode, mcap_summary, parts_of, read_bag, read_mcap

HEAD = "source_file string, topic string, type string, encoding string, seq long, log_time_ns long, publish_time_ns long"
SCHEMA = f"{HEAD}, data string"
#: What is known of a picture in a frame: its bytes stay in the recording.
IMAGE = "struct<width:bigint,height:bigint,kind:string,size:bigint,file:string,seq:bigint>"
CAMERA = "struct<K:array<double>,D:array<double>,P:array<double>>"
TYPED = f"{HEAD}, keys array<string>, numbers array<double>, number_type string, format string, width long, height long, bytes binary, camera {CAMERA}"
READERS = {"mcap": read_mcap, "bag": read_bag}
EXTENSIONS = ("mcap", "bag", "rrd")
#: Topic of the row that counts what was passed over in a recording, if that is asked for.
FAULTS = "__faults"
#: Bytes of chunks that one task reads.
SPLIT_BYTES = 64 << 20
#: What opening a file costs, as bytes: small files share a task.
OPEN_BYTES = 256 << 10


class UnsupportedFormat(ValueError):
    """A format that is known by name and can't be read or written."""


def kind_of(url: str) -> str:
    """mcap, bag or rrd by extension; a remote prefix without one is `prefix`; anything else is mcap."""
    path = urlsplit(url).path if "://" in url else url
    found = re.search(r"\.(\w+)$", path.rstrip("/"))
    if found and found[1].lower() in EXTENSIONS:
        return found[1].lower()
    return "prefix" if "://" in url and not url.startswith("file://") and not found else "mcap"


def _row(name: str, seq: int, m: Raw, typed: bool) -> tuple:
    value = decode(m)
    head = (name, m.channel.topic, m.channel.type, m.channel.encoding, seq, m.log_time_ns, m.publish_time_ns)
    return (*head, *parts_of(m, value).values()) if typed else (*head, as_json(value))


def _rows(name: str, messages: Iterator[Raw], faults: Faults | None, typed: bool, first: int = 0) -> Iterator[tuple]:
    """A message that can't be decoded raises without faults, and is counted there with."""
    for seq, m in enumerate(messages, first):
        try:
            yield _row(name, seq, m, typed)
        except (BadRecording, ValueError, KeyError, IndexError):
            if faults is None:
                raise
            faults.messages += 1


def _fault_row(name: str, faults: Faults, typed: bool) -> tuple:
    head = (name, FAULTS, "", "", -1, 0, 0)
    return (*head, None, [float(faults.blocks), float(faults.messages)], "int64", *[None] * 5) if typed else (*head, json.dumps(vars(faults)))


def rows_of(name: str, data: bytes, topics: set[str] | None = None, strict: bool = False, typed: bool = False, report: bool = False) -> Iterator[tuple]:
    """Rows of one recording.

    A message or chunk that can't be read is passed over, and reading goes on behind it; strict raises instead. With
    report, a last row of topic FAULTS tells how many blocks and messages were passed over.
    """
    extension = name.rsplit(".", 1)[-1].lower()
    if extension == "rrd":
        raise UnsupportedFormat("rrd recordings can't be read")
    faults = None if strict else Faults()
    try:
        yield from _rows(name, READERS["bag" if extension == "bag" else "mcap"](data, topics, faults), faults, typed)
    except (BadRecording, ValueError, KeyError):
        if strict:
            raise
        faults.blocks += 1
    if report and faults and (faults.blocks or faults.messages):
        yield _fault_row(name, faults, typed)


_NUMBERS = pa.list_(pa.float64())
_ARROW_HEAD = [("source_file", pa.string()), ("topic", pa.string()), ("type", pa.string()), ("encoding", pa.string()), ("seq", pa.int64()), ("log_time_ns", pa.int64()), ("publish_time_ns", pa.int64())]
#: SCHEMA and TYPED as Arrow knows them: workers have no session that could parse the text.
ARROW = {
    False: pa.schema([*_ARROW_HEAD, ("data", pa.string())]),
    True: pa.schema([
        *_ARROW_HEAD, ("keys", pa.list_(pa.string())), ("numbers", _NUMBERS), ("number_type", pa.string()), ("format", pa.string()), ("width", pa.int64()), ("height", pa.int64()),
        ("bytes", pa.binary()), ("camera", pa.struct([("K", _NUMBERS), ("D", _NUMBERS), ("P", _NUMBERS)])),
    ]),
}


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 2000, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, (str, bytes)))
        if len(held) == most or size > most_bytes:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _read(spark: SparkSession, path: str | list[str], topics: list[str] | None, strict: bool, typed: bool, report: bool) -> DataFrame:
    ship(spark)
    wanted, schema = set(topics) if topics else None, TYPED if typed else SCHEMA
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    files = files.where(F.lower("path").rlike(r"\.(mcap|bag|rrd)$")).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = ARROW[typed]
        for batch in batches:
            for name, data in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                yield from _batches(rows_of(name, data.as_py(), wanted, strict, typed, report), kinds)

    return files.mapInArrow(run, schema)


def read_recordings(spark: SparkSession, path: str | list[str], topics: list[str] | None = None, strict: bool = False, report: bool = False) -> DataFrame:
    """Messages of a recording, of several, or of all below a prefix, on any file system that Spark reads, as JSON text.

    A file is a task's work. seq counts messages of a file, so (source_file, seq) is arrival order.
    """
    return _read(spark, path, topics, strict, False, report)


def read_messages(spark: SparkSession, path: str | list[str], topics: list[str] | None = None, strict: bool = False, report: bool = False) -> DataFrame:
    """The same with typed parts (TYPED) in place of JSON: numbers as doubles with their type, picture fields, calibration."""
    return _read(spark, path, topics, strict, True, report)


class _Part(InputPartition):
    """A task's work: (path, size, chunks by number and offset) of each file; None for all of a file, whose summary the task reads."""

    def __init__(self, files: list[tuple[str, int, list[tuple[int, int]] | None]]):
        super().__init__(files)
        self.files = files

    @property
    def chunks(self) -> list[tuple[int, int]]:
        return [c for _, _, chunks in self.files for c in chunks or ()]


def _open(path: str):
    """(file system, path in it) of a URL or a local path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


def splits_of(file, size: int, extension: str, topics: set[str] | None, start_ns: int | None, end_ns: int | None, most: int) -> Iterator[tuple[list[tuple[int, int]] | None, int]]:
    """(chunks as (number, offset), bytes) of each split of an open file; None for all of a file that can't be cut."""
    summary = mcap_summary(file, size) if extension == "mcap" else None
    if summary is None:
        yield None, size
        return
    chunks, reader = summary
    wanted = {k for k, c in reader.channels.items() if topics is None or c.topic in topics}
    held, total = [], 0
    for n, c in enumerate(chunks):
        outside = (end_ns is not None and c.start_ns >= end_ns) or (start_ns is not None and c.end_ns < start_ns)
        if outside or (c.channels and not wanted & set(c.channels)):
            continue
        if held and total + c.size > most:
            yield held, total
            held, total = [], 0
        held.append((n, c.offset))
        total += c.size
    if held:
        yield held, total


class _Reader(DataSourceReader):
    #: Files of more bytes are opened when a read is planned; tasks look at the others.
    opened_above = -1

    def __init__(self, options: dict, extension: str):
        self.extension, self.path = extension, options["path"]
        topics = options.get("topics")
        self.topics = set(topics.split(",")) if topics else None
        self.start, self.end = (int(options[k]) if k in options else None for k in ("start_ns", "end_ns"))
        self.strict, self.typed = options.get("mode", "").upper() == "FAILFAST", options.get("typed", "").lower() == "true"

    def _files(self) -> list[tuple[str, int]]:
        from pyarrow import fs

        store, path = _open(self.path)
        info = store.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = [info] if info.is_file else [f for f in store.get_file_info(fs.FileSelector(path, recursive=True)) if f.is_file and f.path.lower().endswith(f".{self.extension}")]
        return sorted((f.path, f.size) for f in found)

    def _parts(self, files: list[tuple[str, int]]) -> list[_Part]:
        """Files dealt to tasks, cut where one is more than a task's work; small ones share a task, many of them."""
        store, out, held, total = _open(self.path)[0], [], [], 0
        for path, size in files:
            if size <= self.opened_above:
                cut = [(None, size)]
            else:
                with store.open_input_file(path) as f:
                    cut = list(splits_of(f, size, self.extension, self.topics, self.start, self.end, SPLIT_BYTES))
            for chunks, n in cut:
                n = max(n, OPEN_BYTES)
                if held and total + n > SPLIT_BYTES:
                    out.append(_Part(held))
                    held, total = [], 0
                held.append((path, size, chunks))
                total += n
        return [*out, _Part(held)] if held or not out else out

    def partitions(self) -> list[_Part]:
        return self._parts(self._files())

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        store = _open(self.path)[0]

        def rows() -> Iterator[tuple]:
            for path, size, chunks in partition.files:
                with store.open_input_file(path) as f:
                    yield from self._messages(f, path, size, chunks, None if self.strict else Faults())

        yield from _batches(rows(), ARROW[self.typed])

    def _messages(self, f, path: str, size: int, chunks: list[tuple[int, int]] | None, faults: Faults | None) -> Iterator[tuple]:
        if chunks is None:
            own = [c for c, _ in splits_of(f, size, self.extension, self.topics, self.start, self.end, size)]
            if own == [None]:
                f.seek(0)
                args = (f, self.topics, self.start, self.end, faults)
                found = Mcap(*args).messages() if self.extension == "mcap" else bag_messages(*args)
                yield from _rows(path, found, faults, self.typed)
                return
            chunks = [c for part in own for c in part]
        known = mcap_summary(f, size)[1].channels
        reader = Mcap(f, self.topics, self.start, self.end, faults)
        reader.channels = known
        for n, offset in chunks:  # messages of later chunks have higher numbers
            yield from _rows(path, reader.at(offset), faults, self.typed, n << 32)


class McapSource(DataSource):
    """spark.read.format("mcap"), with options topics (by commas), start_ns, end_ns, typed and mode; seq is in arrival order."""

    @classmethod
    def name(cls) -> str:
        return "mcap"

    def schema(self) -> str:
        return TYPED if dict(self.options).get("typed", "").lower() == "true" else SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options), self.name() if self.name() == "mcap" else "bag")


class BagSource(McapSource):
    @classmethod
    def name(cls) -> str:
        return "rosbag"


class RrdSource(McapSource):
    @classmethod
    def name(cls) -> str:
        return "rrd"

    def reader(self, schema) -> DataSourceReader:
        raise UnsupportedFormat("rrd recordings can't be read")


SOURCES: dict[str, type[DataSource]] = {"mcap": McapSource, "rosbag": BagSource, "rrd": RrdSource}


def register_sources(spark: SparkSession, more: dict[str, type[DataSource]] | None = None) -> list[str]:
    """Make the formats known to spark.read; returns their names."""
    ship(spark)
    SOURCES.update(more or {})
    for cls in SOURCES.values():
        spark.dataSource.register(cls)
    return sorted(SOURCES)
