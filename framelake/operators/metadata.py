"""Dataset metadata: tasks, features, episodes, and the JSON documents made of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.operators.episodes import numbered

VERSION = "v2.1"


def first_seen(tasks: DataFrame, task: str, order: list[str]) -> DataFrame:
    """(task, first): distinct texts with the place where each first appears."""
    return tasks.where(F.col(task).isNotNull()).groupBy(F.col(task).alias("task")).agg(F.min(F.struct(*order)).alias("first"))


def task_dictionary(tasks: DataFrame, task: str, order: list[str]) -> DataFrame:
    """(task, task_index): texts numbered as they first appear, by ranges of them; several first in one place go by text."""
    return numbered(first_seen(tasks, task, order), ["first", "task"], "task_index").select("task", "task_index")


def episode_lines(rows: DataFrame, tasks: DataFrame | None = None) -> DataFrame:
    """(episode_index, length, tasks): task indices in order, unknown tasks left out."""
    if tasks is not None:
        rows = rows.join(tasks, "task", "left")
    return rows.groupBy("episode_index").agg(F.count("*").alias("length"), F.array_sort(F.collect_set("task_index")).alias("tasks"))


def as_lines(df: DataFrame, order: str) -> DataFrame:
    return df.orderBy(order).select(F.to_json(F.struct(*df.columns)).alias("value"))


def stats_lines(stats: DataFrame) -> DataFrame:
    """(episode_index, stats): {feature: {min, max, mean, std}}, each an array by dimension."""
    names = ["min", "max", "mean", "std"]
    by_dim = stats.groupBy("episode_index", "feature").agg(F.array_sort(F.collect_list(F.struct("dim", *names))).alias("__s"))
    arrays = F.struct(*[F.col(f"__s.{n}").alias(n) for n in names])
    entry = F.struct(F.col("feature").alias("k"), arrays.alias("v"))
    return by_dim.groupBy("episode_index").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("stats"))


def feature_specs(widths: dict[str, int], cameras: dict[str, tuple[int, int]]) -> dict:
    """features of info.json; an image's shape is (height, width, 3)."""
    out = {name: {"dtype": "float32", "shape": [n], "names": None} for name, n in widths.items()}
    out |= {name: {"dtype": "video", "shape": [h, w, 3], "names": ["height", "width", "channels"]} for name, (w, h) in cameras.items()}
    return out | {n: {"dtype": "float64" if n == "timestamp" else "int64", "shape": [1], "names": None} for n in ("timestamp", "episode_index", "frame_index", "index", "task_index")}


def info(totals: dict, fps: int, features: dict, name: str = "dataset", robot_type: str | None = None) -> dict:
    return {
        "name": name, "codebase_version": VERSION, "robot_type": robot_type or "unknown", "total_episodes": totals["total_episodes"],
        "total_frames": totals["total_frames"], "fps": fps, "features": features,
    }


def assembled(episodes: DataFrame, tasks: DataFrame) -> DataFrame:
    """(episode_index, length, tasks) of episodes(episode_index, length, tasks ARRAY<STRING>): registered indices, in order; unknown names go."""
    named = episodes.select("episode_index", F.explode("tasks").alias("task")).join(tasks, "task")
    found = named.groupBy("episode_index").agg(F.array_sort(F.collect_set("task_index")).alias("tasks"))
    none = F.array().cast("array<bigint>")
    return episodes.select("episode_index", "length").join(found, "episode_index", "left").select("episode_index", "length", F.coalesce("tasks", none).alias("tasks"))


def feature_table(features: DataFrame) -> dict:
    """Registered features(name, dtype, shape), a row a feature, as the features of info.json, with the index columns added."""
    own = {r["name"]: {"dtype": r["dtype"], "shape": list(r["shape"]), "names": None} for r in features.orderBy("name").collect()}
    more = {n: v for n, v in feature_specs({}, {}).items() if n in ("timestamp", "episode_index", "index", "task_index")}
    return own | more


def segment_rollup(episodes: DataFrame) -> DataFrame:
    """(segment, start, end, episodes): the time range and ordered ids of a segment's episodes."""
    return episodes.groupBy("segment").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.array_sort(F.collect_set("episode_id")).alias("episodes"))


def topic_metadata(messages: DataFrame, by: list[str] = ("topic",)) -> DataFrame:
    """Count, time range, duration (not below 0) and frequency of each topic."""
    out = messages.groupBy(*by).agg(F.count("*").alias("message_count"), F.min("log_time_ns").alias("start_ns"), F.max("log_time_ns").alias("end_ns"))
    out = out.withColumn("duration_ns", F.greatest(F.lit(0), F.col("end_ns") - F.col("start_ns")))
    return out.withColumn("frequency_hz", F.when(F.col("duration_ns") > 0, F.col("message_count") * 1e9 / F.nullif(F.col("duration_ns"), F.lit(0))).otherwise(F.lit(0.0)))
