"""Recordings of any size as tables: files are listed by Spark, cut at their chunks in tasks, and read by byte ranges.

Three steps, each a table: the files below a path; their splits, runs of chunks that have one of the wanted topics in the
wanted time, which a task finds in a file's summary; and the messages of each split. Splits are dealt to tasks evenly, so a
long recording is many tasks' work, and what isn't wanted isn't read. A file without a summary, and a bag, is one split
that is read record by record; memory follows the largest record, not the file.

`recordings` is the same as a stream of a prefix that grows: offsets are the files taken. Only a file of more than a task's
work is opened on the driver; small ones share tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader

from framelake.shipping import ship
from framelake.sorted_groups import pieces
from framelake.sources import recordings
from framelake.sources.decoding import BadRecording, Faults, Mcap, bag_messages, mcap_summary
from framelake.sources.generate import Out, mcap_bytes
from framelake.sources.recordings import _open, splits_of

#: File systems that byte ranges are read from; others go through Spark's own reader.
RANGED = ("", "file", "hdfs", "s3", "gs", "gcs", "abfs", "abfss")
SPLITS = "path string, size long, chunks array<struct<n:long,at:long>>, bytes long"
SPLIT_ROWS = pa.schema([("path", pa.string()), ("size", pa.int64()), ("chunks", pa.list_(pa.struct([("n", pa.int64()), ("at", pa.int64())]))), ("bytes", pa.int64())])


def ranged(path: str) -> bool:
    return (path.split(":", 1)[0] if "://" in path else "") in RANGED


def messages_of_split(file, size: int, extension: str, chunks: list[tuple[int, int]] | None, topics, start_ns, end_ns, faults: Faults | None):
    """(number, message) of a split; numbers of later chunks are higher. What can't be read is a fault, or raises without faults."""
    args = (file, topics, start_ns, end_ns, faults)
    try:
        file.seek(0)
        if chunks is None:
            yield from enumerate(Mcap(*args).messages() if extension == "mcap" else bag_messages(*args))
            return
        known = mcap_summary(file, size)[1].channels
        reader = Mcap(*args)
        reader.channels = known
        for n, at in chunks:
            yield from enumerate(reader.at(at), n << 32)
    except (BadRecording, ValueError, KeyError):
        if faults is None:
            raise
        faults.blocks += 1


def read_splits(
    spark: SparkSession, path: str, topics: list[str] | None = None, start_ns: int | None = None, end_ns: int | None = None, typed: bool = False, strict: bool = False,
    report: bool = False, split_bytes: int = recordings.SPLIT_BYTES,
) -> DataFrame:
    """Messages of the recordings at or below path (SCHEMA, or TYPED), of the given topics and times; seq is in a file's arrival order.

    Damaged chunks and messages are passed over, and counted in a row of topic FAULTS with report; strict raises.
    """
    ship(spark)
    wanted = set(topics) if topics else None
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", F.col("length").alias("size"))  # no content is read
    files = files.where(F.lower("path").rlike(r"\.(mcap|bag|rrd)$"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name, size in zip(batch.column("path").to_pylist(), batch.column("size").to_pylist(), strict=True):
                extension = name.rsplit(".", 1)[-1].lower()
                if extension == "rrd":
                    raise recordings.UnsupportedFormat("rrd recordings can't be read")
                store, at = _open(name if "://" in name else name.removeprefix("file:"))
                with store.open_input_file(at) as f:
                    out += [(name, size, None if c is None else [{"n": n, "at": o} for n, o in c], b) for c, b in splits_of(f, size, extension, wanted, start_ns, end_ns, split_bytes)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), SPLIT_ROWS, strict=True)], schema=SPLIT_ROWS)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                name, faults = part["path"], None if strict else Faults()
                chunks = None if part["chunks"] is None else [(c["n"], c["at"]) for c in part["chunks"]]
                store, at = _open(name if "://" in name else name.removeprefix("file:"))
                with store.open_input_file(at) as f:
                    found = messages_of_split(f, part["size"], name.rsplit(".", 1)[-1].lower(), chunks, wanted, start_ns, end_ns, faults)
                    yield from recordings._batches(_rows(name, found, faults, typed), recordings.ARROW[typed])
                if report and faults and (faults.blocks or faults.messages):
                    yield from recordings._batches(iter([recordings._fault_row(name, faults, typed)]), recordings.ARROW[typed])

    parts = files.repartition(spark.sparkContext.defaultParallelism, "path").mapInArrow(cut, SPLITS)
    # a split is a task's work: splits go around by their place, not by their file's
    return parts.repartition(4 * spark.sparkContext.defaultParallelism, "path", F.col("chunks")[0]["n"]).mapInArrow(read, recordings.TYPED if typed else recordings.SCHEMA)


def _rows(name: str, found, faults: Faults | None, typed: bool) -> Iterator[tuple]:
    for seq, m in found:
        try:
            yield recordings._row(name, seq, m, typed)
        except (BadRecording, ValueError, KeyError, IndexError):
            if faults is None:
                raise
            faults.messages += 1


class _Stream(recordings._Reader, DataSourceStreamReader):
    """Offsets are {file below the path: its size}. A file is taken when it is first seen, so files have to appear whole, by a rename."""

    opened_above = recordings.SPLIT_BYTES

    def initialOffset(self) -> dict:
        return {}

    def _below(self, path: str) -> str:
        return path.removeprefix(f"{_open(self.path)[1].rstrip('/')}/")

    def latestOffset(self) -> dict:
        return {self._below(path): size for path, size in self._files()}

    def partitions(self, start: dict, end: dict) -> list:
        root = _open(self.path)[1].rstrip("/")
        taken = {self._below(path) for path in start}  # earlier checkpoints name files from the root of their store
        new = [(self._below(path), size) for path, size in end.items()]
        return self._parts([(path if path == root else f"{root}/{path}", size) for path, size in sorted(new) if path not in taken])

    def commit(self, end: dict) -> None:
        pass


class RecordingStream(DataSource):
    """spark.readStream.format("recordings"): the MCAP files of a prefix that grows, with options topics, start_ns, end_ns and typed."""

    @classmethod
    def name(cls) -> str:
        return "recordings"

    def schema(self) -> str:
        return recordings.TYPED if dict(self.options).get("typed", "").lower() == "true" else recordings.SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(dict(self.options), "mcap")


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(RecordingStream)


def write_recordings(messages: DataFrame, root: str, most: int = 20_000) -> DataFrame:
    """messages(source, topic, seq, log_time_ns, payload string) as MCAP files below root, by tasks; (path, messages), a row a file.

    A source is a file for each `most` of its messages, in order. A file appears whole, under a name of its source and
    place, so that a task that is run again writes the same ones.
    """
    ship(messages.sparkSession)

    def put(source, k: int, held: list[Out]) -> tuple[str, int]:
        store, folder = _open(root.rstrip("/"))
        path = f"{folder}/{source}-{k:05d}.mcap"
        store.create_dir(folder, recursive=True)
        with store.open_output_stream(f"{path}.part") as out:
            out.write(mcap_bytes(held, "zstd", 200))
        store.move(f"{path}.part", path)
        return path, len(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, held, k, now = [], [], 0, None
        for (source,), new, rows in pieces(batches, ["source"]):
            if new and held:
                done.append(put(now, k, held))
            if new:
                held, k, now = [], 0, source
            for topic, ns, payload in zip(*(rows.column(c).to_pylist() for c in ("topic", "log_time_ns", "payload")), strict=True):
                held.append(Out(topic, "json", ns, payload.encode()))
                if len(held) == most:
                    done.append(put(now, k, held))
                    held, k = [], k + 1
        if held:
            done.append(put(now, k, held))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done]), pa.array([n for _, n in done], pa.int64())], ["path", "messages"])

    own = messages.select("source", "topic", "seq", "log_time_ns", "payload")
    return own.repartition("source").sortWithinPartitions("source", "seq").mapInArrow(run, "path string, messages long")
