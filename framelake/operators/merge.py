"""Merging staged datasets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.functions.names import episode_in
from framelake.operators.episodes import reindexed


def diagonal_union(parts: list[DataFrame]) -> DataFrame:
    """Union by name; columns that a part lacks are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def staged(spark: SparkSession, root: str) -> DataFrame:
    """Rows of every Parquet file below root, with the episode number of the file's name (0 without one)."""
    rows = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").option("mergeSchema", "true").parquet(root)
    return rows.withColumn("file", F.col("_metadata.file_path")).withColumn("file_episode", episode_in(F.col("file")))


def merged(rows: DataFrame, order: list[str]) -> DataFrame:
    """Staged rows with numbers of the merged dataset; files with equal episode numbers follow by path."""
    keyed = rows.withColumn("__source", F.struct("file_episode", "file")).drop("episode_index", "index")
    return reindexed(keyed, "__source", order).drop("__source")
