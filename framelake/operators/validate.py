"""Checks of a dataset's episodes, features and tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_episodes(episodes: DataFrame, key: str = "episode_index") -> DataFrame:
    """Indices from 0 to the largest that no episode has."""
    top = episodes.agg(F.max(key).alias("top")).head()["top"]
    spark = episodes.sparkSession
    return spark.range(0, 0 if top is None else top + 1).select(F.col("id").alias(key)).join(episodes, key, "left_anti")


def mismatched_specs(specs: DataFrame) -> DataFrame:
    """Episodes whose spec of a feature differs from the first episode's."""
    first = specs.groupBy("feature").agg(F.min_by("spec", "episode_index").alias("expected"))
    return specs.join(first, "feature").where(~F.col("spec").eqNullSafe(F.col("expected")))


def conflicting_features(specs: DataFrame) -> DataFrame:
    """Features registered with more than one spec."""
    return specs.groupBy("feature").agg(F.count_distinct("spec").alias("n_specs")).where("n_specs > 1")


def sparse_features(present: DataFrame) -> DataFrame:
    """(feature, n_missing): features that some episodes lack. Counts stand in for the grid of episodes and features."""
    own = present.select("episode_index", "feature").distinct()
    n = own.select("episode_index").distinct().count()
    out = own.groupBy("feature").agg((F.lit(n) - F.count("*")).alias("n_missing"))
    return out.where("n_missing > 0")


def missing_stats(features: DataFrame, stats: DataFrame) -> DataFrame:
    """(episode, feature) pairs with a shape and no statistics."""
    keys = ["episode_index", "feature"]
    return features.select(*keys).distinct().join(stats.select(*keys).distinct(), keys, "left_anti")


def duplicate_tasks(tasks: DataFrame) -> DataFrame:
    """Tasks with more than one index."""
    return tasks.groupBy("task").agg(F.array_sort(F.collect_set("task_index")).alias("indices")).where("size(indices) > 1")


def summary(rows: DataFrame) -> DataFrame:
    """Episodes, frames, features, tasks and videos of rows(episode_index, length, feature, task, is_video), an episode's length in each of its rows."""
    names = rows.agg(
        F.count_distinct("feature").alias("features"), F.count_distinct("task").alias("tasks"),
        F.count_distinct(F.when(F.col("is_video"), F.struct("episode_index", "feature"))).alias("videos"),
    )
    own = rows.groupBy("episode_index").agg(F.max("length").alias("length"))
    sizes = own.agg(F.count("*").alias("episodes"), F.coalesce(F.sum("length"), F.lit(0)).alias("frames"))
    return sizes.crossJoin(names)  # a row each


def overview(episodes: DataFrame) -> DataFrame:
    """Episodes, frames, whole frames an episode on the average, and the range of indices of episodes(episode_index, length)."""
    found = episodes.agg(F.count("*").alias("episodes"), F.coalesce(F.sum("length"), F.lit(0)).alias("frames"), F.min("episode_index").alias("first"), F.max("episode_index").alias("last"))
    return found.withColumn("average", F.when(F.col("episodes") > 0, F.expr("frames div nullif(episodes, 0)")).otherwise(F.lit(0)))


def inspect(present: DataFrame) -> DataFrame:
    """(feature, n_episodes, share): in how many episodes a feature is present."""
    own = present.select("episode_index", "feature").distinct()
    n = own.select("episode_index").distinct().count()
    return own.groupBy("feature").agg(F.count("*").alias("n_episodes"), (F.count("*") / F.lit(max(n, 1))).alias("share"))


def frame_invariants(rows: DataFrame) -> DataFrame:
    """(episode_index, fault): frame numbers with holes, and times that fall."""
    from pyspark.sql.window import Window

    w = Window.partitionBy("episode_index").orderBy("frame_index")
    marked = rows.withColumn("__place", F.row_number().over(w) - 1).withColumn("__before", F.lag("timestamp").over(w))
    fault = F.when(F.col("frame_index") != F.col("__place"), F.lit("frame_index")).when(F.col("timestamp") < F.col("__before"), F.lit("timestamp"))
    return marked.select("episode_index", fault.alias("fault")).where("fault IS NOT NULL").distinct()
