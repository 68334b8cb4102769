"""Dataset tables that grow by committed appends: a sink for batches and streams, and its readers.

`df.write.format("framelake")` runs in two phases. Each task writes Parquet files of its own, under names that nobody else
has, and returns what it wrote: file, rows, bytes, and the episode if files are cut by episode. When all tasks are
through, the driver publishes one commit, a small JSON file that names them, by one rename. Readers see the files that
commits name and no others: nothing of a write that is under way or failed, and all of one that is through. A task that
fails removes its files, and a write that fails all that its tasks wrote. What a lost executor leaves, or a task that is
cut off just then, is in nobody's way, and `vacuum` removes it.

A stream's commit carries the sink's name and the batch's number. A batch that is run again after a restart finds its
commit there, drops what it wrote, and changes nothing. Files are written through pyarrow's file systems (local, HDFS, S3,
GCS), and read by `load` through Spark's.

    data/<write>/<task>.parquet or data/<write>/chunk-NNN/episode_NNNNNN-<task>.parquet
    _commits/<time>-<name>.json, or <name of sink>-<batch>.json
"""

from __future__ import annotations

import json
import time
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull,
    IsNull, LessThan, LessThanOrEqual, WriterCommitMessage,
)
from pyspark.sql.types import StructType

from framelake.shipping import ship
from framelake.sources.recordings import _open

COMMITS, DATA = "_commits", "data"
FILE_BYTES = 256 << 20
PER_CHUNK = 500
COMMIT = "schema string, replaces boolean, at long, files array<struct<name:string,rows:long,bytes:long,episode:long,part:string>>"
#: The part of a table that its rows are in, and the one that tells what they were made from.
ROWS, INPUTS = "rows", "inputs"


@dataclass
class Written(WriterCommitMessage):
    """What a task wrote: (name under the table's root, rows, bytes, episode or None)."""

    files: list[tuple[str, int, int, int | None]] = field(default_factory=list)


class _Files:
    """A task's files: closed when full, and at each new episode if files are cut by it."""

    def __init__(self, root: str, job: str, episode: str | None, most: int):
        self.store, self.root = _open(root)
        self.job = job
        self.episode, self.most, self.name = episode, most, uuid.uuid4().hex
        self.out, self.rows, self.now, self.written, self.made = None, 0, None, Written(), []

    def _start(self, schema: pa.Schema, episode: int | None) -> None:
        n = len(self.made)
        name = f"{self.name}-{n:05d}.parquet" if episode is None else f"chunk-{episode // PER_CHUNK:03d}/episode_{episode:06d}-{self.name}-{n:05d}.parquet"
        name = f"{DATA}/{self.job}/{name}"
        folder = f"{self.root}/{name}".rsplit("/", 1)[0]
        self.store.create_dir(folder, recursive=True)
        self.made.append(name)
        self.stream = self.store.open_output_stream(f"{self.root}/{name}")
        self.out, self.rows, self.now = pq.ParquetWriter(self.stream, schema), 0, episode

    def close(self) -> None:
        if self.out:
            self.out.close()
            size = self.stream.tell()
            self.stream.close()
            self.written.files.append((self.made[-1], self.rows, size, self.now))
            self.out = None

    def _put(self, rows: pa.RecordBatch, episode: int | None) -> None:
        if self.out and (episode != self.now or (self.episode is None and self.stream.tell() > self.most)):
            self.close()
        if not self.out:
            self._start(rows.schema, episode)
        self.out.write_batch(rows)
        self.rows += rows.num_rows

    def add(self, batch: pa.RecordBatch) -> None:
        if self.episode is None:
            self._put(batch, None)
            return
        keys = batch.column(self.episode).to_pylist()
        at = 0
        for k in range(1, len(keys) + 1):
            if k == len(keys) or keys[k] != keys[at]:
                if keys[at] is None:
                    raise ValueError(f"a row has no {self.episode}")
                self._put(batch.slice(at, k - at), int(keys[at]))
                at = k

    def drop(self) -> None:
        """Remove all that was written, finished or not."""
        if self.out:
            self.stream.close()
            self.out = None
        _remove(self.store, self.root, self.made)


def _remove(store, root: str, names: list[str]) -> None:
    for name in names:
        try:
            store.delete_file(f"{root}/{name}")
        except FileNotFoundError:
            pass


class _Sink:
    """What the batch and the streaming writer share."""

    def __init__(self, options: dict, schema: StructType, overwrite: bool):
        self.root, self.schema, self.overwrite = options["path"].rstrip("/"), schema.json(), overwrite
        self.episode, self.most = options.get("episode"), int(options.get("file_bytes", FILE_BYTES))
        self.sink, self.job = options.get("sink", "stream"), uuid.uuid4().hex
        self.part, self.held = options.get("part", ROWS), options.get("held")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files = _Files(self.root, self.job, self.episode, self.most)
        try:
            for batch in iterator:
                if batch.num_rows:
                    files.add(batch)
            files.close()
        except BaseException:
            files.drop()
            raise
        return files.written

    def _whole_episodes(self, store, root: str, files: list) -> None:
        """An episode is one file, of one commit."""
        own = Counter(f[3] for f in files)
        if twice := next((k for k, n in own.items() if n > 1), None):
            raise ValueError(f"episode {twice} is in {own[twice]} files: cluster and sort rows by {self.episode}")
        if not self.overwrite:
            for commit in _commits(store, root):
                if again := own.keys() & {f["episode"] for f in commit["files"]}:
                    raise ValueError(f"episode {min(again)} was written before")

    def publish(self, messages: list, name: str) -> None:
        store, root = _open(self.root)
        files = [f for m in messages if m is not None for f in m.files]
        if self.episode is not None:
            self._whole_episodes(store, root, files)
        names = ("name", "rows", "bytes", "episode")
        listed = [dict(zip(names, f, strict=True)) | {"part": self.part} for f in files]
        commit = {"schema": self.schema, "replaces": self.overwrite, "at": time.time_ns(), "files": listed}
        _put(store, root, f".held-{self.held}" if self.held else name, commit)

    def drop(self, messages: list) -> None:
        store, root = _open(self.root)
        _remove(store, root, [f[0] for m in messages if m is not None for f in m.files])


def _put(store, root: str, name: str, commit: dict) -> None:
    """A commit file, there as a whole or not at all."""
    store.create_dir(f"{root}/{COMMITS}", recursive=True)
    hidden = f"{root}/{COMMITS}/.{uuid.uuid4().hex}"
    with store.open_output_stream(hidden) as out:
        out.write(json.dumps(commit).encode())
    store.move(hidden, f"{root}/{COMMITS}/{name}.json")


class _Batch(_Sink, DataSourceArrowWriter):
    def commit(self, messages: list) -> None:
        self.publish(messages, f"{time.time_ns():020d}-{uuid.uuid4().hex}")

    def abort(self, messages: list) -> None:
        """The job's folder goes: what tasks wrote that were cut off is there too."""
        from pyarrow import fs

        store, root = _open(self.root)
        folder = f"{root}/{DATA}/{self.job}"
        if store.get_file_info(folder).type != fs.FileType.NotFound:
            store.delete_dir(folder)


class _Stream(_Sink, DataSourceStreamArrowWriter):
    def commit(self, messages: list, batchId: int) -> None:
        from pyarrow import fs

        name = f"{self.sink}-{batchId:012d}"
        store, root = _open(self.root)
        if store.get_file_info(f"{root}/{COMMITS}/{name}.json").type != fs.FileType.NotFound:
            self.drop(messages)  # this batch has been committed: it is run again after a restart
        else:
            self.publish(messages, name)

    def abort(self, messages: list, batchId: int) -> None:
        self.drop(messages)


def _commits(store, root: str) -> Iterator[dict]:
    """Commits that count, in their order: those from the last that replaces all before it."""
    from pyarrow import fs

    if store.get_file_info(f"{root}/{COMMITS}").type == fs.FileType.NotFound:
        return
    found = []
    for info in store.get_file_info(fs.FileSelector(f"{root}/{COMMITS}")):
        if info.base_name.endswith(".json") and not info.base_name.startswith("."):
            with store.open_input_stream(info.path) as f:
                found.append(json.loads(f.read()))
    found.sort(key=lambda c: c["at"])
    last = max((k for k, c in enumerate(found) if c["replaces"]), default=0)
    yield from found[last:]


class _Part(InputPartition):
    def __init__(self, names: list[str]):
        super().__init__(names)
        self.names = names


class _Reader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.root, self.filters = options["path"].rstrip("/"), []
        self.most = int(options.get("file_bytes", FILE_BYTES))
        self.fields = [f.name for f in schema.fields]

    def partitions(self) -> list[_Part]:
        store, root = _open(self.root)
        out, held, size = [], [], 0
        for c in _commits(store, root):
            for f in (f for f in c["files"] if f["part"] == ROWS):
                if held and size + f["bytes"] > self.most:
                    out.append(_Part(held))
                    held, size = [], 0
                held.append(f["name"])
                size += f["bytes"]
        return [*out, _Part(held)] if held or not out else out

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        import pyarrow.dataset as ds

        store, root = _open(self.root)
        for name in partition.names:
            data = ds.dataset(f"{root}/{name}", filesystem=store, format="parquet")
            known = set(data.schema.names)
            keep = pq.filters_to_expression(own) if (own := [f for f in self.filters if f[0] in known]) else None
            for batch in data.to_batches(filter=keep, batch_size=8192):
                if batch.num_rows:
                    columns = [batch.column(n) if n in known else pa.nulls(batch.num_rows) for n in self.fields]
                    yield pa.RecordBatch.from_arrays(columns, self.fields)


class _Pushing(_Reader):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Comparisons of a column go to the Parquet reader, which passes over row groups; Spark looks at all of them again."""
        simple = {EqualTo: "==", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
        for f in filters:
            if type(f) in simple and len(f.attribute) == 1:
                self.filters.append((f.attribute[0], simple[type(f)], f.value))
            elif isinstance(f, In) and len(f.attribute) == 1:
                self.filters.append((f.attribute[0], "in", list(f.value)))
            elif isinstance(f, IsNotNull | IsNull):
                pass
            yield f


class LakeSource(DataSource):
    """format("framelake"): options path, episode (a column that files are cut by), file_bytes, sink, a stream's name in the
    table, and pushdown, for readers in sessions with spark.sql.python.filterPushdown.enabled."""

    @classmethod
    def name(cls) -> str:
        return "framelake"

    def schema(self) -> StructType:
        root = dict(self.options)["path"].rstrip("/")
        last = None
        for c in _commits(*_open(root)):
            last = c
        if last is None:
            raise FileNotFoundError(f"nothing has been committed to {root}")
        return StructType.fromJson(json.loads(last["schema"]))

    def reader(self, schema: StructType) -> DataSourceReader:
        options = dict(self.options)
        return (_Pushing if options.get("pushdown", "").lower() == "true" else _Reader)(options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Batch(dict(self.options), schema, overwrite)

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        return _Stream(dict(self.options), schema, False)


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(LakeSource)


def append(df: DataFrame, root: str, replace: bool = False, **options: str) -> None:
    """df as one commit; with replace, in place of all that the table holds."""
    register(df.sparkSession)
    df.write.format("framelake").mode("overwrite" if replace else "append").options(path=root, **options).save()


def append_with_inputs(rows: DataFrame, inputs: DataFrame, root: str) -> None:
    """rows, and the inputs that they were made from, as one commit: readers see both or neither."""
    token = uuid.uuid4().hex
    store, path = _open(root.rstrip("/"))
    names = [f".held-{token}-{part}" for part in (ROWS, INPUTS)]
    try:
        for part, df in ((ROWS, rows), (INPUTS, inputs)):
            append(df, root, part=part, held=f"{token}-{part}")
        held = []
        for name in names:
            with store.open_input_stream(f"{path}/{COMMITS}/{name}.json") as f:
                held.append(json.loads(f.read()))
        commit = {"schema": held[0]["schema"], "replaces": False, "at": time.time_ns(), "files": held[0]["files"] + held[1]["files"]}
        _put(store, path, f"{time.time_ns():020d}-{token}", commit)
    finally:
        _remove(store, f"{path}/{COMMITS}", [f"{n}.json" for n in names])


def append_episodes(frames: DataFrame, root: str, episode: str = "episode_index", frame: str = "frame_index") -> None:
    """Frames as one commit, a file an episode, frames in order. An episode that the table holds already is an error."""
    append(frames.repartition(episode).sortWithinPartitions(episode, frame), root, episode=episode)


def stream_into(stream: DataFrame, root: str, notes: str, sink: str = "stream"):
    """A writer of the stream to the table, with its checkpoint at notes; a sink's name belongs to one checkpoint."""
    register(stream.sparkSession)
    return stream.writeStream.format("framelake").outputMode("append").option("path", root).option("sink", sink).option("checkpointLocation", notes)


def files(spark: SparkSession, root: str) -> DataFrame:
    """(name, rows, bytes, episode, part) of the files that the table consists of, a row a file."""
    found = spark.read.schema(COMMIT).option("pathGlobFilter", "*.json").json(f"{root.rstrip('/')}/{COMMITS}")
    last = found.where("replaces").agg(F.coalesce(F.max("at"), F.lit(0)).alias("last"))
    return found.join(F.broadcast(last), F.col("at") >= F.col("last")).select(F.inline("files"))  # a row


def load(spark: SparkSession, root: str, schema: StructType | str | None = None, part: str = ROWS) -> DataFrame:
    """The table by Spark's own Parquet reader, with its pruning and push-down; columns that a file lacks are null.

    As with any file table, the list of files is on the driver. The schema of inputs has to be given.
    """
    register(spark)
    names = [r["name"] for r in files(spark, root).where(F.col("part") == part).select("name").collect()]
    schema = schema or spark.read.format("framelake").load(root).schema
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root.rstrip('/')}/{n}" for n in names])


def exists(spark: SparkSession, root: str) -> bool:
    """Whether anything has been committed."""
    store, path = _open(root.rstrip("/"))
    return next(_commits(store, path), None) is not None


def orphans(spark: SparkSession, root: str) -> DataFrame:
    """(path, modificationTime) of files below data that no commit names: of writes under way, and of lost executors."""
    there = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root.rstrip('/')}/{DATA}").select("path", "modificationTime")
    at = F.regexp_extract("path", rf".*?({DATA}/[0-9a-f]+/(?:chunk-\d+/)?[^/]+)$", 1)
    return there.withColumn("name", at).join(files(spark, root), "name", "left_anti").select("path", "modificationTime")


def vacuum(spark: SparkSession, root: str, hours: float = 24) -> int:
    """Remove orphans that are older than any write can last; how many there were. Tasks remove them."""
    old = orphans(spark, root).where(F.col("modificationTime") <= F.current_timestamp() - F.expr(f"INTERVAL {int(hours * 3600)} SECONDS"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, at = _open(path if "://" in path else path.removeprefix("file:"))
                _remove(store, at.rsplit("/", 1)[0], [at.rsplit("/", 1)[1]])
            yield batch.select(["path"])

    return old.mapInArrow(run, "path string").count()
