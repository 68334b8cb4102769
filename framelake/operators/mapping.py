"""Topics to features: rename, filter, roles, and camera calibration messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framelake.functions.media import extrinsics, intrinsics
from framelake.functions.names import feature_of
from framelake.functions.values import role

MAPPING = "topic string, feature string, type string"


def mapping_table(spark, rows: list[tuple]) -> DataFrame:
    """(topic, feature, type) rows of a configuration; a topic may be mapped once."""
    topics = [r[0] for r in rows]
    if len(set(topics)) != len(topics):
        raise ValueError("a topic is mapped twice")
    return spark.createDataFrame(rows, MAPPING)


def merge_mappings(configured: DataFrame, added: DataFrame) -> DataFrame:
    """Configured topics win; further ones come in as images."""
    more = added.join(configured, "topic", "left_anti").select("topic", "feature", F.lit("image").alias("type"))
    return configured.select("topic", "feature", "type").unionByName(more)


def renamed(messages: DataFrame, mapping: DataFrame) -> DataFrame:
    """Adds feature and declared type. Spark broadcasts the mapping when its size allows."""
    out = messages.join(mapping.select("topic", F.col("feature").alias("mapped"), F.col("type").alias("declared")), "topic", "left")
    return out.withColumn("feature", F.coalesce("mapped", feature_of(F.col("topic")))).drop("mapped")


def filtered(messages: DataFrame, mapping: DataFrame) -> DataFrame:
    """With any mapping, unmapped topics go; with none, all pass."""
    return messages if mapping.isEmpty() else messages.join(mapping, "topic", "left_semi")


def with_role(messages: DataFrame) -> DataFrame:
    return messages.withColumn("role", role(F.col("feature"), F.col("declared")))


def split_camera_info(messages: DataFrame, is_info: Column, order: list[str], by: list[str]) -> tuple[DataFrame, DataFrame]:
    """(frame messages, the first calibration message of each source and topic)."""
    marked = messages.withColumn("__info", F.coalesce(is_info, F.lit(False)))
    first = Window.partitionBy(*by).orderBy(*order)
    infos = marked.where("__info").withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n", "__info")
    return marked.where("NOT __info").drop("__info"), infos


def calibrations(infos: DataFrame, camera: str = "feature") -> DataFrame:
    """(camera, intrinsic, extrinsic) of calibration messages with arrays K, D and P in a struct column `camera`, one a camera.

    Of a camera with several, the one that came first counts, by source order of `seq`.
    """
    c = F.col("camera")
    first = infos.groupBy(F.col(camera).alias("__name")).agg(F.min_by(F.struct(c["K"].alias("K"), c["D"].alias("D"), c["P"].alias("P")), "seq").alias("c"))
    return first.select(F.col("__name").alias("camera"), intrinsics(F.col("c.K"), F.col("c.D")).alias("intrinsic"), extrinsics(F.col("c.K"), F.col("c.P")).alias("extrinsic"))


def first_frames(frames: DataFrame, limit: int | None, by: list[str], order: list[str]) -> DataFrame:
    """The first `limit` frames of each `by`, a recording's run, over all its episodes: the deterministic form of a limit."""
    if limit is None:
        return frames
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return frames.withColumn("__place", place).where(F.col("__place") <= limit).drop("__place")
