"""Camera frames on their way to video: which fit, which fragment they go to, and the list an encoder works from."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framelake.functions.names import video_path
from framelake.shipping import ship
from framelake.sorted_groups import folded
from framelake.sources.recordings import UnsupportedFormat


def sized(images: DataFrame, by: list[str], order: str = "frame_index") -> DataFrame:
    """images(width, height) with `fits`: the first image with a size sets it for its episode and camera; others are skipped."""
    real = F.coalesce((F.col("width") > 0) & (F.col("height") > 0), F.lit(False))
    size = F.when(real, F.struct("width", "height"))
    first = F.first(size, ignorenulls=True).over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return images.withColumn("fits", real & F.coalesce(size == first, F.lit(False)))


def skipped(images: DataFrame, by: list[str]) -> DataFrame:
    return images.groupBy(*by).agg(F.count_if("fits").alias("kept"), F.count_if(~F.col("fits")).alias("skipped"))


def fragments(images: DataFrame, by: list[str], order: str, frames: int, seconds: float, fps: int) -> DataFrame:
    """images with the fragment they belong to: one is full at `frames` frames or `seconds` of them, whichever comes first."""
    full = max(1, min(frames, int(-(-seconds * fps // 1))))
    place = F.row_number().over(Window.partitionBy(*by).orderBy(order)) - 1
    return images.withColumn("fragment", F.floor(place / full).cast("long"))


def fragment_full(frames: Column, held_bytes: Column, most_frames: int, most_bytes: int, seconds: float, fps: int) -> Column:
    return (frames >= most_frames) | (held_bytes >= most_bytes) | (frames / F.lit(fps) >= seconds)


def fragments_by_bytes(images: DataFrame, by: list[str], order: str, frames: int, most_bytes: int, seconds: float, fps: int, size: str = "size") -> DataFrame:
    """(by, order, fragment): as fragments(), and full too once its frames hold most_bytes.

    Where a fragment ends depends on where the one before did, so a fold runs over an episode's frames in order; it carries
    the fragment's number, frames and bytes, and a batch of frames is in memory. A null size counts as 0.
    """
    rows = images.select(*by, order, F.coalesce(F.col(size).cast("long"), F.lit(0).cast("long")).alias("__size"))
    full = max(1, min(frames, -(-int(seconds * fps * 10**6) // 10**6)))

    def fold():
        n = held = k = 0

        def step(key: tuple, new: bool, piece: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal n, held, k
            if new:
                n = held = k = 0
            out = []
            for own in piece.column("__size").to_pylist():
                out.append(k)
                n, held = n + 1, held + own
                if n >= full or held >= most_bytes:
                    n, held, k = 0, 0, k + 1
            return pa.RecordBatch.from_arrays([*[piece.column(c) for c in (*by, order)], pa.array(out, pa.int64())], [*by, order, "fragment"])

        return step

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in (*by, order))
    ship(images.sparkSession)
    return folded(rows, by, [order], fold, f"{kinds}, fragment long")


def manifest(images: DataFrame, per_chunk: int = 500) -> DataFrame:
    """(path, episode_index, camera, frames, width, height) a video: what an encoder outside of Spark is given."""
    kept = images.where("fits").groupBy("episode_index", "camera").agg(
        F.count("*").alias("frames"), F.max("width").alias("width"), F.max("height").alias("height"), F.min("timestamp_ns").alias("start_ns"), F.max("timestamp_ns").alias("end_ns")
    )
    return kept.withColumn("path", video_path(F.col("episode_index"), F.col("camera"), per_chunk))


def encode(*_, **__):
    """No codec is installed; manifest() lists what to encode."""
    raise UnsupportedFormat("video can't be encoded here: no codec")
