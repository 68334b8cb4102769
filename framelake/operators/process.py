"""Hooks for code of one's own: per-frame processors and transformers, run on batches of frames."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.shipping import ship
from framelake.sorted_groups import pieces

Frames = Callable[[pd.DataFrame], pd.DataFrame]


def processed(frames: DataFrame, process: Frames, added: str) -> DataFrame:
    """frames with the columns `added` (a DDL list) that process gives each batch, and should_write (true unless given).

    process takes and returns a pandas frame, keeps rows and their order, and may hold no state between batches. Frames
    that shouldn't be written stay, with should_write false, so that they can be counted.
    """
    extra = T.StructType.fromDDL(added)
    schema = T.StructType([*frames.schema.fields, *[f for f in extra.fields if f.name != "should_write"], T.StructField("should_write", T.BooleanType())])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = process(batch)
            if len(out) != len(batch):
                raise ValueError("a processor must return a row for each frame")
            yield (out if "should_write" in out else out.assign(should_write=True))[names]

    return frames.mapInPandas(run, schema)


def passthrough(batch: pd.DataFrame) -> pd.DataFrame:
    return batch


def transformed(frames: DataFrame, transform: Callable[[pd.DataFrame], Iterable[bytes]], out: str = "bytes") -> DataFrame:
    """frames with a binary column of what transform makes of each batch, an entry a row; order and partitions stay."""
    return processed(frames, lambda b: b.assign(**{out: list(transform(b))}), f"`{out}` binary").drop("should_write")


class Hooks:
    """A processor with a life: start once an episode, process on its frames in order, batch by batch, end after the last.

    What process needs of earlier batches it keeps in itself.
    """

    def start(self, episode) -> None: ...

    def process(self, frames: pd.DataFrame) -> pd.DataFrame:
        return frames

    def end(self, episode) -> None: ...


def per_episode(frames: DataFrame, make: Callable[[], Hooks], added: str = "", episode: str = "episode_index", order: str = "frame_index") -> DataFrame:
    """frames through hooks of one's own, made anew for each episode. An episode streams through a task in batches, so it may be of any length."""
    extra = T.StructType.fromDDL(added) if added else T.StructType()
    schema = T.StructType([*frames.schema.fields, *extra.fields])
    names = [f.name for f in schema.fields]
    ship(frames.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        hooks, last = None, None
        for (key,), new, piece in pieces(batches, [episode]):
            if new:
                if hooks:
                    hooks.end(last)
                hooks, last = make(), key
                hooks.start(key)
            yield hooks.process(piece.to_pandas())[names]
        if hooks:
            hooks.end(last)

    def in_order(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return run(pa.RecordBatch.from_pandas(p, preserve_index=False) for p in parts)

    return frames.repartition(episode).sortWithinPartitions(episode, order).mapInPandas(in_order, schema)


def processor_stats(out: DataFrame) -> DataFrame:
    """(frames, written, skipped, success_rate); the rate of no frames is 1."""
    n = out.agg(F.count("*").alias("frames"), F.count_if("should_write").alias("written"))
    n = n.withColumn("skipped", F.col("frames") - F.col("written"))
    return n.withColumn("success_rate", F.when(F.col("frames") > 0, F.col("written") / F.nullif(F.col("frames"), F.lit(0))).otherwise(F.lit(1.0)))
