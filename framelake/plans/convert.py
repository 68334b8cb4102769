"""Conversion end to end: messages in, a dataset directory out, as one logical plan and a few actions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framelake.functions import media, values
from framelake.functions.names import video_path
from framelake.operators import align, episodes, frames, mapping, metadata, stats, video
from framelake.shared import fixed
from framelake.sources.config import Config
from framelake.sources.recordings import IMAGE
from framelake.sources.writer import Files, write_calibrations, write_episodes, write_metadata


def messages_of(typed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed messages of recordings -> (frame messages, calibration messages), by the rules for message values.

    data is the vector of numbers whose type counts; image, of messages with bytes, is how these have to be read, without
    the bytes: they stay in the recording, where source_file and seq find them. Messages with neither contribute nothing.
    """
    info = values.is_camera_info(F.col("keys"))
    rest, infos = mapping.split_camera_info(typed, info, ["seq"], ["source_file", "topic"])
    size = F.octet_length("bytes")
    named = F.col("format").isNotNull()
    found = F.when(media.image_format(F.col("bytes")) == "png", media.png_size(F.col("bytes"))).when(
        media.image_format(F.col("bytes")) == "jpeg", media.jpeg_size(F.when(media.is_jpeg(F.col("bytes")), F.col("bytes")))
    )
    width, height = (F.when(named, F.coalesce(found[c], F.lit(0).cast("long"))).otherwise(F.col(c)) for c in ("width", "height"))
    kind = values.image_kind(F.col("format"), F.col("width"), F.col("height"), size)
    image = F.struct(width.alias("width"), height.alias("height"), kind.alias("kind"), size.cast("long").alias("size"), F.col("source_file").alias("file"), F.col("seq").alias("seq"))
    types = F.transform("numbers", lambda _: F.col("number_type"))
    out = rest.select(
        F.col("source_file").alias("source"), "topic", "seq", "log_time_ns", values.vector_of(F.col("numbers"), types).alias("data"),
        F.when(kind.isNotNull(), image).cast(IMAGE).alias("image"),
    )
    return out.where("data IS NOT NULL OR image IS NOT NULL"), infos


def framed(messages: DataFrame, config: Config, by: list[str]) -> DataFrame:
    """messages(by, topic, seq, log_time_ns, data ARRAY<FLOAT> and, if there are any, image) to frames with episodes inside each source.

    Frames are numbered from 0 in each episode. The limit of frames holds for each source, over all its episodes.
    """
    spark = messages.sparkSession
    table = mapping.mapping_table(spark, [(m.topic, m.feature, m.type) for m in config.mappings])
    images = "image" in messages.columns
    messages = mapping.filtered(messages, table) if config.mappings else messages
    some = F.size("data") > 0
    messages = mapping.with_role(mapping.renamed(messages.where(some | F.col("image").isNotNull() if images else some), table))
    if images:
        messages = messages.withColumn("role", F.when(F.col("image").isNotNull(), F.lit("image")).otherwise(F.col("role")))
    if config.gap_ns is not None:
        messages = episodes.by_gap(messages, config.gap_ns, by, ["seq"])
    else:
        messages = episodes.single(messages)
    bucketed = align.bucketed(messages, fps=config.fps, mode=config.mode)
    out = align.not_empty(align.frames(bucketed, [*by, "episode"], emit=config.emit))
    if config.frames_per_episode is not None:
        has_image = F.size("images") > 0 if images else F.lit(False)  # frames without images don't count
        out = episodes.by_frame_count(out.drop("episode"), config.frames_per_episode, by, ["frame_index"], has_image)
        place = F.row_number().over(Window.partitionBy(*by, "episode").orderBy("frame_index")) - 1
        out = out.withColumn("frame_index", place.cast("long"))
    return mapping.first_frames(out, config.max_frames, by, ["episode", "frame_index"])


def rows(framed_df: DataFrame, by: list[str]) -> DataFrame:
    """Frames with dense episode numbers, state and action vectors as recorded, and images if there are any."""
    keys = [*by, "episode"]
    numbers = episodes.dense_numbers(framed_df.select(*keys).distinct(), keys)
    more = ["images"] if "images" in framed_df.columns else []
    return frames.project(framed_df.join(numbers, keys)).select("episode_index", "frame_index", "timestamp", "timestamp_ns", "state", "action", *more)


def with_cameras(rows_df: DataFrame, cameras: list[str], per_chunk: int) -> DataFrame:
    """rows with {camera}_path, the video that the episode's images go to, and {camera}_timestamp; images go."""
    for camera in cameras:
        path = video_path(F.col("episode_index"), F.lit(camera), per_chunk)
        rows_df = rows_df.withColumn(f"{camera}_path", path).withColumn(f"{camera}_timestamp", F.col("timestamp"))
    return rows_df.drop("images")


def shots(recorded: DataFrame) -> DataFrame:
    """(episode_index, camera, frame_index, timestamp_ns, width, height, ...) an image, and whether it fits its video."""
    own = recorded.select("episode_index", "frame_index", "timestamp_ns", F.explode("images").alias("camera", "i"))
    return video.sized(own.select("episode_index", "frame_index", "timestamp_ns", "camera", "i.*"), ["episode_index", "camera"])


def convert(spark: SparkSession, messages: DataFrame, root: str, config: Config, by: list[str], task: str | None = None, infos: DataFrame | None = None) -> dict:
    """Write a dataset and return a report: episodes, frames, files, and episodes left out as none of their frames has a state.

    Columns are as wide as the widest episode's vectors; narrower ones have zeros there. With images, rows name the video
    of each camera, and meta/videos.jsonl lists what an encoder has to make. infos(camera, ...) are calibration messages.
    """
    recorded = fixed(rows(framed(messages, config, by), by))  # decoded once, whatever is lost later
    filled = frames.filled(recorded, ["episode_index"])
    found = filled.agg(F.max("state_dim").alias("state"), F.max("action_dim").alias("action")).head()
    if found["state"] is None:
        raise ValueError("no frame has a state")
    widths = {"observation.state": found["state"], "action": found["action"]}
    out = filled.drop("state_dim", "action_dim", "timestamp_ns").withColumn("index", F.col("frame_index")).withColumn("task_index", F.lit(0).cast("long"))
    sizes: dict[str, tuple[int, int]] = {}
    if "images" in recorded.columns:
        listed = shots(recorded)
        largest = listed.where("fits").groupBy("camera").agg(F.max("width").alias("w"), F.max("height").alias("h")).collect()  # a row a camera
        names = [r[0] for r in listed.select("camera").distinct().orderBy("camera").collect()]
        sizes = {r["camera"]: (r["w"], r["h"]) for r in largest}
        out = with_cameras(out, names, config.per_chunk)
        lines = metadata.as_lines(video.manifest(listed, config.per_chunk), "path")
        Files(spark, root).write_lines("meta/videos.jsonl", (r["value"] for r in lines.toLocalIterator()))
    out = frames.pivoted(out, {"state": ("observation.state", widths["observation.state"]), "action": ("action", widths["action"])})
    n_files = write_episodes(out, root, config.per_chunk)
    lines = recorded.join(filled.select("episode_index").distinct(), "episode_index", "left_semi").groupBy("episode_index").agg(F.count("*").alias("length"))
    lines = lines.withColumn("tasks", F.array(F.lit(0)) if task else F.array().cast("array<int>"))
    parts = stats.episode_stats(recorded, ["episode_index"], {"observation.state": "state", "action": "action"})
    totals = stats.totals(lines).head().asDict()
    features = metadata.feature_specs(widths, sizes)
    tasks = spark.createDataFrame([(0, task)] if task else [], "task_index long, task string")
    write_metadata(spark, root, metadata.info(totals, config.fps, features, config.name, config.robot_type), lines, tasks, parts)
    if infos is not None:
        table = mapping.mapping_table(spark, [(m.topic, m.feature, m.type) for m in config.mappings])
        write_calibrations(mapping.calibrations(mapping.renamed(infos, table)), root)
    left = frames.without_state(recorded, ["episode_index"]).count()
    return {**totals, "files": n_files, "without_state": left}
