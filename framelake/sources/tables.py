"""Existing tables in the roles of recordings, and generators of messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framelake.functions.clock import NS, event_ns


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as messages: a user is a source, an event type a topic, the id the order of arrival."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("source"), F.col("event_type").alias("topic"), event_ns("ts").alias("log_time_ns"), F.col("event_id").alias("seq"),
        F.array(F.col("value").cast("float")).alias("data"),
    )


def line_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as frames: an order is an episode, its lines in order are frames; every third has no state, every fourth no action."""
    n = F.col("l_linenumber")
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    vector = lambda *c: F.array(*[F.col(x).cast("float") for x in c])
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("episode_index"), (place - 1).cast("long").alias("frame_index"),
        F.when(n % 3 != 0, vector("l_quantity", "l_extendedprice")).alias("state"), F.when(n % 4 != 0, vector("l_discount", "l_tax")).alias("action"),
    )


def counted(spark: SparkSession, n: int, topic: str = "/test") -> DataFrame:
    """n messages without data, one a second."""
    return spark.range(n).select(F.lit(0).cast("long").alias("source"), F.lit(topic).alias("topic"), (F.col("id") * NS).alias("log_time_ns"), F.col("id").alias("seq"), F.lit(None).cast("array<float>").alias("data"))


def vectors(spark: SparkSession, n: int, dim: int, fps: int = 30, topic: str = "/state") -> DataFrame:
    """n frames of [i * dim + j]."""
    data = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda j: (F.col("id") * dim + j).cast("float"))
    return spark.range(n).select(F.lit(0).cast("long").alias("source"), F.lit(topic).alias("topic"), (F.col("id") * (NS // fps)).alias("log_time_ns"), F.col("id").alias("seq"), data.alias("data"))


def multi_topic(spark: SparkSession, n: int, dim: int = 3, fps: int = 30) -> DataFrame:
    """A state and an action of equal times in each frame."""
    a, b = vectors(spark, n, dim, fps, "/observation/state"), vectors(spark, n, dim, fps, "/action")
    return a.withColumn("seq", F.col("seq") * 2).unionByName(b.withColumn("seq", F.col("seq") * 2 + 1))
