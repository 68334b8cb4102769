"""Sharding by size-tiered compaction, in DataFrame operations only.

A store is a folder of immutable Parquet shards and numbered manifests. append() writes arrivals as they come, as small
shards, and commits a manifest that lists them. compact() sorts shards into tiers by size, each `fan_in` times the one
before; a tier with fan_in shards is merged, in order, into shards of up to `target` bytes, each written by one task.
A commit is one rename of a finished file to the next version's name, which fails if that name is taken: readers see
all of a version or nothing of it, and of two writers one must try again. That holds where the file system's rename is
atomic and fails on a name that exists, as HDFS's does; on object stores, writers need a lock around commit. A lost executor's shard is written anew by
Spark's committer before any manifest names it. vacuum() deletes what no kept version names.

The driver holds a manifest: a line a shard, not a row of data.

Rows are stored as they come: nulls in any column, empty and very long texts, repeated rows and odd column names change
nothing, an empty table is a commit without rows, and ties in size keep the shards' order.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Merges that one Spark job holds.
WAVE = 64


class Conflict(RuntimeError):
    """Another writer committed this version first."""


@dataclass
class Store:
    spark: SparkSession
    root: str
    target: int = 128 * 1024 * 1024
    smallest: int = 1024 * 1024
    fan_in: int = 4

    def __post_init__(self) -> None:
        self.jvm = self.spark._jvm
        self.conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self._path("").getFileSystem(self.conf)
        for d in ("data", "manifests"):
            self.fs.mkdirs(self._path(d))

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def versions(self) -> list[int]:
        names = [f.getPath().getName() for f in self.fs.listStatus(self._path("manifests"))]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        """The latest manifest, or a version's; version 0 is the empty store."""
        found = self.versions()
        version = (found[-1] if found else 0) if version is None else version
        if version == 0:
            return {"version": 0, "schema": None, "shards": []}
        stream = self.fs.open(self._path(f"manifests/v{version:012d}.json"))
        try:
            return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, base: dict, schema: str | None, shards: list[dict]) -> dict:
        """Make shards the version after base; Conflict if that version exists."""
        new = {"version": base["version"] + 1, "schema": schema, "shards": shards}
        draft, final = self._path(f"manifests/.draft-{uuid.uuid4().hex}"), self._path(f"manifests/v{new['version']:012d}.json")
        stream = self.fs.create(draft, False)
        try:
            stream.write(json.dumps(new).encode())
        finally:
            stream.close()
        kinds = self.jvm.org.apache.hadoop.fs.Options.Rename
        never = self.spark.sparkContext._gateway.new_array(kinds, 1)
        never[0] = kinds.NONE
        try:
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self.conf).rename(draft, final, never)
        except Exception as e:
            self.fs.delete(draft, False)
            raise Conflict(f"version {new['version']} exists") from e
        return new

    def _written(self, df: DataFrame) -> list[dict]:
        folder = f"data/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{folder}")
        files = [f for f in self.fs.listStatus(self._path(folder)) if f.getPath().getName().startswith("part-")]
        return [{"file": f"{folder}/{f.getPath().getName()}", "bytes": f.getLen()} for f in sorted(files, key=lambda f: f.getPath().getName())]

    def append(self, df: DataFrame) -> dict:
        """Commit df's rows as shards, as many as df has partitions. Schemas of all arrivals must agree."""
        base, schema = self.manifest(), _nullable(df)
        if base["schema"] not in (None, schema):
            raise ValueError(f"the store holds {base['schema']}")
        shards = self._written(df)
        while True:
            try:
                return self.commit(base, schema, base["shards"] + shards)
            except Conflict:  # the shards stay as they are; only the list is new
                base = self.manifest()

    def tier(self, size: int) -> int:
        """0 up to `smallest` bytes, then a tier for each factor of fan_in; -1 for shards that need no merge."""
        if 2 * size > self.target:
            return -1
        return max(0, math.ceil(math.log(max(size, 1) / self.smallest, self.fan_in) - 1e-9))

    def plan(self, shards: list[dict]) -> list[list[dict]]:
        """Groups to merge: of each tier with fan_in shards or more, runs of up to `target` bytes."""
        tiers: dict[int, list[dict]] = {}
        for s in shards:
            tiers.setdefault(self.tier(s["bytes"]), []).append(s)
        groups = []
        for t, own in sorted(tiers.items()):
            if t < 0 or len(own) < self.fan_in:
                continue
            run: list[dict] = []
            for s in own:
                if run and sum(x["bytes"] for x in run) + s["bytes"] > self.target:
                    groups.append(run)
                    run = []
                run.append(s)
            groups.append(run)
        return [g for g in groups if len(g) > 1]

    def compact(self) -> dict:
        """Merge until no tier is full; each round is a commit of its own."""
        base = self.manifest()
        while groups := self.plan(base["shards"]):
            merged, gone = [], {s["file"] for g in groups for s in g}
            for k in range(0, len(groups), WAVE):
                parts = [self._read([s["file"] for s in g], base["schema"]).coalesce(1) for g in groups[k : k + WAVE]]
                whole = parts[0]
                for p in parts[1:]:
                    whole = whole.union(p)
                merged += self._written(whole)
            while True:
                kept = [s for s in base["shards"] if s["file"] not in gone]
                try:
                    base = self.commit(base, base["schema"], kept + merged)
                    break
                except Conflict:  # arrivals may have been added meanwhile; merged shards must still be there
                    base = self.manifest()
                    if not gone <= {s["file"] for s in base["shards"]}:
                        raise
        return base

    def _read(self, files: list[str], schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in files])

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version; an error if the store has no version yet."""
        m = self.manifest(version)
        if m["schema"] is None:
            raise ValueError("nothing has been appended")
        if not m["shards"]:
            return self.spark.createDataFrame([], m["schema"])
        return self._read([s["file"] for s in m["shards"]], m["schema"])

    def vacuum(self, keep: int = 1, grace: int = 0) -> int:
        """Delete manifests but the last `keep`, and shards that none of those names. Number of shards deleted.

        What is younger than `grace` seconds stays: running readers of an older version and appends, whose shards no
        manifest names yet, need a grace above their own time.
        """
        before = (time.time() - grace) * 1000
        found = self.versions()
        named = {s["file"] for v in found[-keep:] for s in self.manifest(v)["shards"]}
        for v in found[:-keep]:
            path = self._path(f"manifests/v{v:012d}.json")
            if self.fs.getFileStatus(path).getModificationTime() <= before:
                self.fs.delete(path, False)
            else:
                named |= {s["file"] for s in self.manifest(v)["shards"]}
        gone = 0
        for folder in self.fs.listStatus(self._path("data")):
            if folder.getModificationTime() > before:
                continue
            files = [f.getPath().getName() for f in self.fs.listStatus(folder.getPath())]
            here = [f"data/{folder.getPath().getName()}/{f}" for f in files if f.startswith("part-")]
            for f in here:
                if f not in named:
                    self.fs.delete(self._path(f), False)
                    gone += 1
            if not named & set(here):
                self.fs.delete(folder.getPath(), True)
        return gone


def _nullable(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
