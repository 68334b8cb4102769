"""Writing a dataset directory: chunked Parquet, JSON metadata, camera parameters."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from framelake.operators import metadata
from framelake.sources.recordings import UnsupportedFormat


#: Characters of lines that go to a store at once.
BLOCK = 1 << 20


class Files:
    """Small files through Hadoop's file systems."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark._jvm, root.rstrip("/")
        self.fs = self.path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def write(self, name: str, text: str) -> None:
        stream = self.fs.create(self.path(name), True)
        try:
            stream.write(text.encode())
        finally:
            stream.close()

    def write_lines(self, name: str, lines: Iterable[str], end: bool = True) -> int:
        """Lines in blocks of BLOCK characters, so that a call to the store is made for each block and no more is in memory.

        Returns how many there were. No lines, no file. end: a line feed after the last, too.
        """
        stream, n, held, size = None, 0, [], 0
        try:
            for line in lines:
                stream = stream or self.fs.create(self.path(name), True)
                held.append(line + "\n" if end else "\n" * bool(n) + line)
                n, size = n + 1, size + len(line)
                if size >= BLOCK:
                    stream.write("".join(held).encode())
                    held, size = [], 0
            if held:
                stream.write("".join(held).encode())
        finally:
            if stream:
                stream.close()
        return n

    def parts(self, folder: str) -> dict[str, list[str]]:
        """Part files below a folder, {folder under it: [name]}, by one recursive listing."""
        found: dict[str, list[str]] = {}
        listing = self.fs.listFiles(self.path(folder), True)
        while listing.hasNext():
            p = listing.next().getPath()
            if p.getName().startswith("part-"):
                found.setdefault(p.getParent().getName(), []).append(p.getName())
        return {k: sorted(v) for k, v in sorted(found.items())}

    def names(self, folder: str) -> list[str]:
        return sorted(f.getPath().getName() for f in self.fs.listStatus(self.path(folder)))

    def move(self, old: str, new: str) -> None:
        self.fs.mkdirs(self.path(new).getParent())
        if not self.fs.rename(self.path(old), self.path(new)):
            raise OSError(f"{old} could not be renamed to {new}")

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


#: Renames that run side by side.
MOVERS = 16


def write_episodes(rows: DataFrame, root: str, per_chunk: int = 500, episode_files: bool = True) -> int:
    """rows to data/chunk-NNN/episode_NNNNNN.parquet; the number of files.

    Spark writes a folder an episode, or a chunk, in a staging area of this call's own; when all rows are there, renames
    give files their names, so nothing half-written is seen, and what a failed run left behind is in nobody's way. An
    episode is one file, whatever the session's limit of rows in a file is. Without episode_files, chunks hold Spark's
    own part files, which suits data sets of many short episodes.
    """
    files = Files(rows.sparkSession, checked_root(root))
    stage = f".staging-{uuid.uuid4().hex}"
    key = F.col("episode_index") if episode_files else F.floor(F.col("episode_index") / per_chunk).cast("long")
    seen = Observation()
    keyed = rows.withColumn("__key", key).observe(seen, F.count(F.lit(1)).alias("n"))
    out = keyed.repartition("__key").sortWithinPartitions("__key", "episode_index", "frame_index").write.partitionBy("__key")
    try:
        (out.option("maxRecordsPerFile", 0) if episode_files else out).parquet(f"{files.root}/{stage}")
        found, moves = files.parts(stage), []
        for folder, parts in found.items():
            k = int(folder.split("=")[1])
            if episode_files and len(parts) != 1:
                raise OSError(f"episode {k} is in {len(parts)} files")
            for n, part in enumerate(parts):
                name = f"chunk-{k // per_chunk:03d}/episode_{k:06d}.parquet" if episode_files else f"chunk-{k:03d}/part-{n:05d}.parquet"
                moves.append((f"{stage}/{folder}/{part}", f"data/{name}"))
        written = rows.sparkSession.read.parquet(f"{files.root}/{stage}").count() if moves else 0
        if written != seen.get["n"]:
            raise OSError(f"{seen.get['n']} rows went out and {written} are in files")
        with ThreadPoolExecutor(MOVERS) as pool:
            list(pool.map(lambda m: files.move(*m), moves))
    finally:
        files.delete(stage)
    return len(moves)


def write_metadata(spark: SparkSession, root: str, info: dict, episodes: DataFrame, tasks: DataFrame, stats: DataFrame) -> None:
    """meta/info.json, episodes.jsonl, episodes_stats.jsonl and, if there are tasks, tasks.jsonl.

    Lines come to the driver in turn and go out as they come; info and tasks are small.
    """
    files = Files(spark, root)
    files.write("meta/info.json", json.dumps(info, indent=2))
    lines = lambda df, key: (r["value"] for r in metadata.as_lines(df, key).toLocalIterator())
    files.write_lines("meta/episodes.jsonl", lines(episodes, "episode_index"))
    files.write_lines("meta/episodes_stats.jsonl", lines(metadata.stats_lines(stats), "episode_index"))
    files.write_lines("meta/tasks.jsonl", lines(tasks.select("task_index", "task"), "task_index"))


def assemble(spark: SparkSession, root: str, name: str, fps: int, episodes: DataFrame, tasks: DataFrame, features: DataFrame, stats: DataFrame, robot_type: str | None = None) -> dict:
    """Metadata of a whole dataset from the registered parts of many writers; info.json's content.

    episodes(episode_index, length, tasks ARRAY<STRING>), tasks(task, task_index), features(name, dtype, shape), stats as
    from episode_stats. robot_type may be null; files end without a line feed; no episode is an error.
    """
    totals = episodes.agg(F.count("*").alias("total_episodes"), F.coalesce(F.sum("length"), F.lit(0)).alias("total_frames")).head().asDict()
    if not totals["total_episodes"]:
        raise ValueError("there are no episodes")
    files = Files(spark, checked_root(root))
    found = metadata.info(totals, fps, metadata.feature_table(features), name) | {"robot_type": robot_type}
    files.write("meta/info.json", json.dumps(found, indent=2))
    lines = lambda df, key: (r["value"] for r in metadata.as_lines(df, key).toLocalIterator())
    files.write_lines("meta/episodes.jsonl", lines(metadata.assembled(episodes, tasks), "episode_index"), end=False)
    files.write_lines("meta/tasks.jsonl", lines(tasks.select("task_index", "task"), "task_index"), end=False)
    files.write_lines("meta/episodes_stats.jsonl", lines(metadata.stats_lines(stats), "episode_index"), end=False)
    return found


def write_cameras(spark: SparkSession, root: str, cameras: dict[str, dict]) -> None:
    """parameters/<camera>_{intrinsic,extrinsic}.json of {camera: {"intrinsic": ..., "extrinsic": ...}}."""
    files = Files(spark, root)
    for camera, found in cameras.items():
        for kind in ("intrinsic", "extrinsic"):
            if found.get(kind):
                files.write(f"parameters/{camera}_{kind}.json", json.dumps(found[kind]))


def write_calibrations(calibrations: DataFrame, root: str) -> int:
    """calibrations(camera, intrinsic, extrinsic), a row a camera, as parameter files; cameras without an extrinsic get none. Number of cameras."""
    found = calibrations.select("camera", F.to_json("intrinsic").alias("i"), F.to_json("extrinsic").alias("e")).collect()  # a row a camera
    cameras = {r["camera"]: {"intrinsic": json.loads(r["i"]) if r["i"] else None, "extrinsic": json.loads(r["e"]) if r["e"] else None} for r in found}
    write_cameras(calibrations.sparkSession, root, cameras)
    return len(cameras)


def write_merged(rows: DataFrame, root: str) -> None:
    """Merged rows as Parquet below data/chunk-000, as many files as there are partitions."""
    rows.write.mode("append").parquet(f"{root}/data/chunk-000")


def _unsupported(name: str):
    def write(*_, **__):
        raise UnsupportedFormat(f"{name} can't be written")

    return write


def checked_root(url: str) -> str:
    """The URL, if a writer can go there; a malformed one is an error before anything is written."""
    from framelake.functions.names import parse_url

    parse_url(url)
    return url.rstrip("/")


WRITERS = {"frames": write_episodes, "merged": write_merged, "hdf5": _unsupported("hdf5"), "rlds": _unsupported("rlds"), "zarr": _unsupported("zarr")}


def writer_for(name: str):
    if name not in WRITERS:
        raise UnsupportedFormat(f"no format {name}; known are {', '.join(sorted(WRITERS))}")
    return WRITERS[name]
