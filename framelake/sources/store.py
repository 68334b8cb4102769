"""Catalogue tables by key: episodes, segments, upload states, configurations, statistics.

A table is a log of Parquet files: puts and deletes are appended with a version, and the last entry of a key counts. A
version is taken by making its mark, which fails if another writer was first. Appends go through the committed table of
`lake`, so readers see them whole.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.shared import made_new
from framelake.sources import lake


@dataclass
class KeyedTable:
    spark: SparkSession
    path: str
    schema: str
    keys: tuple[str, ...]

    def _log(self) -> DataFrame:
        full = f"{self.schema}, __version long, __gone boolean"
        if not lake.exists(self.spark, self.path):
            return self.spark.createDataFrame([], full)
        return lake.load(self.spark, self.path, full)

    def _take(self) -> int:
        """The next version, as this writer's own."""
        marks = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_versions")
        fs = marks.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(marks)
        names = [f.getPath().getName() for f in fs.listStatus(marks)]
        version = 1 + max((int(n) for n in names if n.isdigit()), default=0)
        while not made_new(self.spark, f"{self.path}/_versions/{version:012d}", ""):
            version += 1
        return version

    def _append(self, rows: DataFrame, gone: bool) -> None:
        version = self._take()
        lake.append(rows.withColumns({"__version": F.lit(version).cast("long"), "__gone": F.lit(gone)}), self.path)

    def put(self, rows: DataFrame) -> None:
        """Insert or replace; of rows with one key in one put, the one with the least hash is kept. Null keys are keys like others."""
        rows = self.spark.createDataFrame([], self.schema).unionByName(rows)
        own = [F.col(f"`{c}`") for c in rows.columns]
        first = rows.groupBy(*self.keys).agg(F.min_by(F.struct(*own), F.struct(F.xxhash64(*own), F.to_json(F.struct(*own)))).alias("__row"))
        self._append(first.select("__row.*"), False)

    def delete(self, keys: DataFrame) -> None:
        empty = self.spark.createDataFrame([], self.schema)
        self._append(empty.unionByName(keys.select(*self.keys).distinct(), allowMissingColumns=True), True)

    def rows(self) -> DataFrame:
        """The last version of each key that isn't deleted."""
        log = self._log()
        last = log.groupBy(*self.keys).agg(F.max_by(F.struct(*log.columns), "__version").alias("__last"))  # grouping holds nulls equal
        return last.select("__last.*").where("NOT __gone").drop("__version", "__gone")

    def get(self, keys: DataFrame) -> DataFrame:
        rows, wanted = self.rows(), keys.select(*[F.col(f"`{k}`").alias(f"__{k}") for k in self.keys])
        same = [rows[k].eqNullSafe(wanted[f"__{k}"]) for k in self.keys]
        return rows.join(wanted, reduce(and_, same), "left_semi")


EPISODES = "episode_id string, segment string, start long, `end` long, path string"
SEGMENTS = "segment string, config_hash string, start long, `end` long"
CONFIGS = "hash string, content string"
STATS = "batch string, frames long, bytes long, seconds double"
UPLOADS = "episode_id string, total long, uploaded long, failed long"


def first_by_config(segments: DataFrame, config_hash: str) -> DataFrame:
    """The first segment, by name, of a configuration."""
    return segments.where(F.col("config_hash") == config_hash).orderBy("segment").limit(1)


def config_hash(config: dict) -> str:
    """Name of a configuration by its content: key order doesn't matter."""
    return hashlib.sha256(json.dumps(config, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def put_config(table: KeyedTable, config: dict) -> str:
    """Store a configuration under its hash, once however often it is put; the hash."""
    name = config_hash(config)
    rows = table.spark.createDataFrame([(name, json.dumps(config, sort_keys=True))], CONFIGS)
    if table.get(rows.select("hash")).isEmpty():
        table.put(rows)
    return name


def get_config(table: KeyedTable, name: str) -> dict | None:
    found = table.get(table.spark.createDataFrame([(name,)], "hash string")).head()
    return json.loads(found["content"]) if found else None
