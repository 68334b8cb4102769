"""Messages to frames on a fixed-rate grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framelake.functions.clock import floor_bucket, interval_ns, round_bucket


def bucketed(messages: DataFrame, fps: int | None = None, interval: int | None = None, mode: str = "floor", ns: str = "log_time_ns") -> DataFrame:
    """Adds bucket_ns: floor to the grid, or round to the nearest point of it."""
    if mode not in ("floor", "round"):
        raise ValueError(f"no mode {mode}")
    step = interval or interval_ns(fps)
    f = floor_bucket if mode == "floor" else round_bucket
    return messages.withColumn("bucket_ns", f(F.col(ns), step))


def last_wins(bucketed_messages: DataFrame, by: list[str], seq: str = "seq", value: str = "data") -> DataFrame:
    """One row a (by, bucket, feature): the value that arrived last. Both sides of the shuffle combine."""
    return bucketed_messages.groupBy(*by, "bucket_ns", "feature").agg(F.max_by(value, seq).alias(value), F.count("*").alias("n_messages"))


def frames(messages: DataFrame, by: list[str], emit: str = "per_bucket", seq: str = "seq", value: str = "data") -> DataFrame:
    """Frames with map columns states, actions and timestamps, indexed from 0 within `by`.

    per_bucket folds a bucket's messages into a frame, the last message of a feature winning; per_message makes each
    message a frame of its own bucket time. messages needs bucket_ns, feature, role and log_time_ns. If it has a struct
    column `image` (and rows of role image), frames have a map column images of it, with the message's time added.
    """
    kinds = {"states": "state", "actions": "action"}
    with_images = "image" in messages.columns
    own = [F.col("image")] if with_images else []
    last = F.struct(F.col(value).alias("v"), F.col("log_time_ns").alias("t"), *own)
    if emit == "per_message":
        cells = messages.select(*by, "bucket_ns", F.col(seq).alias("__seq"), "feature", "role", last.alias("cell"))
    elif emit == "per_bucket":
        cells = messages.groupBy(*by, "bucket_ns", "feature").agg(F.max_by(last, seq).alias("cell"), F.max_by("role", seq).alias("role"))
        cells = cells.withColumn("__seq", F.lit(0).cast("long"))
    else:
        raise ValueError(f"no emit {emit}")
    entry = F.struct(F.col("feature").alias("k"), F.col("cell.v").alias("v"))
    maps = [F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("role") == role, entry)))).alias(name) for name, role in kinds.items()]
    times = F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("feature").alias("k"), F.col("cell.t").alias("v"))))).alias("timestamps")
    if with_images:
        shot = F.struct(F.col("cell.t").alias("t"), "cell.image.*")
        shots = F.collect_list(F.when(F.col("role") == "image", F.struct(F.col("feature").alias("k"), shot.alias("v"))))
        maps.append(F.map_from_entries(F.array_sort(shots)).alias("images"))
        kinds["images"] = "image"
    out = cells.groupBy(*by, "bucket_ns", "__seq").agg(*maps, times)
    order = Window.partitionBy(*by).orderBy("bucket_ns", "__seq")
    out = out.withColumn("frame_index", (F.row_number().over(order) - 1).cast("long"))
    return out.select(*by, "frame_index", F.col("bucket_ns").alias("timestamp_ns"), *kinds, "timestamps")


def not_empty(framed: DataFrame, maps: tuple = ("states", "actions", "images", "audio")) -> DataFrame:
    """Frames with something in any of those of the maps that there are."""
    some = F.lit(False)
    for m in (m for m in maps if m in framed.columns):
        some = some | F.coalesce(F.size(m) > 0, F.lit(False))
    return framed.where(some)


def is_complete(features: Column, required: list[str], counts: Column | None = None, needed: dict[str, int] | None = None) -> Column:
    """All required features are there; with none required, any will do. needed: least messages of a feature."""
    if needed:
        return F.forall(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(v).alias("n")) for k, v in needed.items()]), lambda r: F.coalesce(F.element_at(counts, r["k"]), F.lit(0)) >= r["n"])
    if not required:
        return F.size(features) > 0
    return F.size(F.array_except(F.array(*map(F.lit, required)), features)) == 0


def completeness(bucketed_messages: DataFrame, by: list[str], required: list[str]) -> DataFrame:
    found = bucketed_messages.groupBy(*by, "bucket_ns").agg(F.array_sort(F.collect_set("feature")).alias("features"), F.count("*").alias("n_messages"))
    return found.withColumn("complete", is_complete(F.col("features"), required))


def alignment_stats(completed: DataFrame) -> DataFrame:
    """Frames complete by their data, those forced out by time or the end, and the share of the former (1 without frames)."""
    out = completed.agg(F.count_if("complete").alias("normal"), F.count_if(~F.col("complete")).alias("forced"))
    total = F.col("normal") + F.col("forced")
    return out.withColumn("completion_rate", F.when(total > 0, F.col("normal") / total).otherwise(F.lit(1.0)))
