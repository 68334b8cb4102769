"""The frame aligner as a stream, with a watermark as the completion window.

`closed` emits a frame when the watermark passes its window: an aggregation on the JVM, whose state is Spark's own.
`aligned` also lets a frame go as soon as all required features are there (with none required, at its first message),
on keyed state in Python. Spark's watermark is the largest event time so far less the window, where a buffered aligner
takes the last message's time; and rows behind the watermark are dropped and counted in the query's progress, where the
buffer would open the bucket a second time. On ordered input the results agree. Event times have microseconds; bucket
arithmetic stays in nanoseconds. Frames behind the last watermark stay in state, as more may come; `replayed` streams a
table to its end, where all that is left leaves.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from framelake.functions.clock import interval_ns
from framelake.operators.align import bucketed
from framelake.shared import shared_path
from framelake.shipping import ship

OUT = "source long, bucket_ns long, features array<string>, data array<array<float>>, n_messages long, complete boolean"
STATE = "seqs array<long>, features array<string>, data array<array<float>>, n long, done boolean"


def _fold(required: frozenset[str], window_ns: int):
    def emit(key: tuple, features: list, data: list, n: int, complete: bool) -> pd.DataFrame:
        order = sorted(range(len(features)), key=features.__getitem__)
        row = {"source": key[0], "bucket_ns": key[1], "features": [features[k] for k in order], "data": [data[k] for k in order], "n_messages": n, "complete": complete}
        return pd.DataFrame([row])

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seqs, features, data, n, done = state.get if state.exists else ([], [], [], 0, False)
        seqs, features, data = list(seqs), list(features), [list(x) for x in data]
        if state.hasTimedOut:
            state.remove()
            if not done and n:
                yield emit(key, features, data, n, False)
            return
        for rows in batches:
            n += len(rows)
            last = rows.sort_values("seq").drop_duplicates("feature", keep="last")  # a row a feature
            for feature, seq, own in zip(last["feature"], last["seq"].astype(int), last["data"], strict=True):
                at = features.index(feature) if feature in features else len(features)
                if at == len(features):
                    features.append(feature)
                    seqs.append(seq)
                    data.append([float(x) for x in own])
                elif seq >= seqs[at]:
                    seqs[at], data[at] = seq, [float(x) for x in own]
        if not done and n and required <= set(features):
            done = True
            yield emit(key, features, data, n, True)
        state.update((seqs, features, data, n, done))
        closes = -(-(int(key[1]) + window_ns) // 1_000_000)
        state.setTimeoutTimestamp(max(int(state.getCurrentWatermarkMs()) + 1, closes))

    return step


def aligned(messages: DataFrame, fps: int, required: list[str], window_frames: int = 3, mode: str = "floor", interval: int | None = None) -> DataFrame:
    """Stream of messages(source, feature, seq, event_time, log_time_ns, data) to stream of frames.

    complete tells frames whose features all came from those that the window closed. Per-feature data is in feature
    order; of a feature's messages the one with the highest seq counts.
    """
    ship(messages.sparkSession)
    step_ns = interval or interval_ns(fps)
    window = window_frames * step_ns
    step = _fold(frozenset(required), window)
    timed = messages.withWatermark("event_time", f"{max(1, window // 1000)} microseconds")
    timed = bucketed(timed, interval=step_ns, mode=mode).select("source", "bucket_ns", "event_time", "feature", "seq", "data")
    return timed.groupBy("source", "bucket_ns").applyInPandasWithState(step, OUT, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def _frames(cells: DataFrame, required: list[str]) -> DataFrame:
    """Frames of rows(source, bucket_ns, e, n_messages), e the sorted (feature, data) entries."""
    missing = F.size(F.array_except(F.array(*map(F.lit, required)).cast("array<string>"), F.col("e.feature")))
    complete = (missing == 0) if required else F.size("e") > 0
    return cells.select("source", "bucket_ns", F.col("e.feature").alias("features"), F.col("e.data").alias("data"), "n_messages", complete.alias("complete"))


def closed(messages: DataFrame, fps: int, required: list[str], window_frames: int = 3, mode: str = "floor", interval: int | None = None) -> DataFrame:
    """Stream of messages to frames that leave when their window has passed, early ones too. No Python runs."""
    step_ns = interval or interval_ns(fps)
    cut = bucketed(messages, interval=step_ns, mode=mode)
    cut = cut.withColumn("bucket_time", F.timestamp_micros(F.expr("bucket_ns div 1000"))).withWatermark("bucket_time", f"{max(1, window_frames * step_ns // 1000)} microseconds")
    cells = cut.groupBy("source", "bucket_ns", "bucket_time").agg(F.collect_list(F.struct("feature", "seq", "data")).alias("m"), F.count("*").alias("n_messages"))
    names = F.array_sort(F.array_distinct(F.col("m.feature")))
    last = lambda f: F.get(F.reverse(F.array_sort(F.filter("m", lambda x: x["feature"] == f))), F.lit(0))
    entries = F.transform(names, lambda f: F.struct(f.alias("feature"), last(f)["data"].alias("data")))
    return _frames(cells.select("source", "bucket_ns", "n_messages", entries.alias("e")), required)


#: Source of the message that ends a replay.
END = -1


def replayed(messages: DataFrame, fps: int, required: list[str], window_frames: int = 3, interval: int | None = None, early: bool = False, steps: int = 4) -> DataFrame:
    """A table's frames by the stream, read in `steps` files in order of time, to the end: frames that are left leave oldest first.

    A last message of its own source, a day after all windows, moves the watermark past them.
    """
    spark = messages.sparkSession
    source, out, notes = (shared_path(spark, kind) for kind in ("replay", "aligned", "notes"))
    own = messages.select("source", "feature", "seq", F.timestamp_micros(F.expr("log_time_ns div 1000")).alias("event_time"), "log_time_ns", "data")
    cuts = own.approxQuantile("log_time_ns", [k / steps for k in range(1, steps)], 0.01)
    edges = [None, *map(int, cuts), None]
    for lo, hi in zip(edges, edges[1:], strict=False):
        part = own.where(F.lit(True) if lo is None else F.col("log_time_ns") >= lo).where(F.lit(True) if hi is None else F.col("log_time_ns") < hi)
        part.coalesce(1).write.mode("append").parquet(source)
    top = own.agg(F.max("log_time_ns")).head()[0] or 0
    last = top + 2 * window_frames * (interval or interval_ns(fps)) + 86_400 * 10**9
    end = spark.range(1).select(
        F.lit(END).cast("long").alias("source"), F.lit("").alias("feature"), F.lit(0).cast("long").alias("seq"), F.timestamp_micros(F.lit(last // 1000)).alias("event_time"),
        F.lit(last).cast("long").alias("log_time_ns"), F.array(F.lit(0).cast("float")).alias("data"),
    )
    end.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(own.schema).option("maxFilesPerTrigger", 1).parquet(source)
    frames = (aligned if early else closed)(stream, fps, required, window_frames, interval=interval)
    query = frames.writeStream.format("parquet").option("path", out).option("checkpointLocation", notes).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(OUT).parquet(out).where(F.col("source") != END)


def batch_aligned(messages: DataFrame, fps: int, required: list[str], mode: str = "floor", interval: int | None = None) -> DataFrame:
    """The same frames from a table: what the stream gives on ordered input when no frame completes before its last message."""
    cut = bucketed(messages, interval=interval or interval_ns(fps), mode=mode)
    cells = cut.groupBy("source", "bucket_ns", "feature").agg(F.max_by("data", "seq").alias("data"), F.count("*").alias("n"))
    entries = F.array_sort(F.collect_list(F.struct("feature", "data")))
    out = cells.groupBy("source", "bucket_ns").agg(entries.alias("e"), F.sum("n").alias("n_messages"))
    return _frames(out, required)
