"""Episodes: where they begin, how they and their frames are numbered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framelake.operators.intervals import interval_join
from framelake.shared import fixed


def single(df: DataFrame) -> DataFrame:
    return df.withColumn("episode", F.lit(0).cast("long"))


def by_gap(messages: DataFrame, threshold_ns: int, by: list[str], order: list[str], ns: str = "log_time_ns") -> DataFrame:
    """A new episode where a message is more than threshold_ns after the one that arrived before it.

    A source is one sorted stream; sources run side by side.
    """
    arrival = Window.partitionBy(*by).orderBy(*order)
    jump = F.coalesce((F.col(ns) - F.lag(ns).over(arrival)) > threshold_ns, F.lit(False)).cast("long")
    return messages.withColumn("__jump", jump).withColumn("episode", F.sum("__jump").over(arrival)).drop("__jump")


def by_frame_count(frames: DataFrame, most: int, by: list[str], order: list[str], has_image: Column) -> DataFrame:
    """A new episode once the running one has `most` frames with images; frames without don't count."""
    before = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    seen = F.coalesce(F.sum(has_image.cast("long")).over(before), F.lit(0))
    return frames.withColumn("episode", F.floor(seen / most).cast("long"))


def changes(frames: DataFrame, by: list[str], order: list[str], episode: str = "episode") -> DataFrame:
    """Rows where a stream of episode numbers starts or changes, with the number before."""
    w = Window.partitionBy(*by).orderBy(*order)
    out = frames.withColumn("previous", F.lag(episode).over(w))
    return out.where(F.col("previous").isNull() | (F.col("previous") != F.col(episode)))


def dense_numbers(keys: DataFrame, order: list[str], out: str = "episode_index") -> DataFrame:
    """0.. over the distinct keys in order. keys is a table of episodes or files, not of rows.

    Keys are dealt to ranges by sampled boundaries, whatever they look like; a range's first number is the running sum of
    the sizes of those before it, so only the list of ranges, a row a partition, comes to the driver.
    """
    return numbered(keys.select(*order).distinct(), order, out)


def numbered(table: DataFrame, order: list[str], out: str, amount: str | None = None, base: str = "__before") -> DataFrame:
    """table, a row a key, with places in order and, if asked for, the sum of amount over all rows before as base."""
    # sampled boundaries may differ from run to run: what they make is fixed before it is counted
    ranged = fixed(table.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()))
    inside = Window.partitionBy("__range").orderBy(*order)
    more = [F.sum(amount).alias("__sum")] if amount else []
    sizes = ranged.groupBy("__range").agg(F.count("*").alias("__size"), *more).collect()
    bases, n, total = [], 0, 0
    for r in sorted(sizes, key=lambda r: r["__range"]):
        bases.append((r["__range"], n, total))
        n, total = n + r["__size"], total + (r["__sum"] or 0 if amount else 0)
    first = table.sparkSession.createDataFrame(bases, "__range int, __base long, __total long")
    found = ranged.withColumn("__n", F.row_number().over(inside))
    if amount:
        found = found.withColumn("__in", F.coalesce(F.sum(amount).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    found = found.join(F.broadcast(first), "__range")
    columns = [F.col(c) for c in table.columns] + [(F.col("__base") + F.col("__n") - 1).cast("long").alias(out)]
    if amount:
        columns.append((F.col("__total") + F.col("__in")).cast("long").alias(base))
    return found.select(*columns)


def reindexed(rows: DataFrame, episode: str, order: list[str]) -> DataFrame:
    """Merged numbering: episode_index in order of `episode` without holes, index over all rows, frame_in_episode from 0.

    Global row numbers are an episode's offset, from sums over ranges of the table of episodes, and the row's own place.
    """
    place = Window.partitionBy(episode).orderBy(*order)
    sizes = rows.groupBy(episode).agg(F.count("*").alias("__size"))
    bases = numbered(sizes, [episode], "episode_index", "__size").drop("__size")
    out = rows.withColumn("frame_in_episode", (F.row_number().over(place) - 1).cast("long")).join(bases, episode)
    return out.withColumn("index", F.col("__before") + F.col("frame_in_episode")).withColumn("frame_index", F.col("index")).drop("__before")


def annotated(frames: DataFrame, segments: DataFrame, ns: str, by: list[str]) -> DataFrame:
    """frames ⋈ segments(by, start, end, label) with start <= time < end; segments may overlap."""
    return interval_join(frames, segments, ns, by)
