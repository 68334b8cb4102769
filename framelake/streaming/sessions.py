"""Episodes by gap as a stream: session windows with a gap of each message's own, and a watermark.

A session ends when no message has come for the gap that its messages asked for. Sessions leave when the watermark has
passed them; state holds a session's ends and counts, not its messages. Messages get their episode afterwards, by an
interval join with the sessions, which are a row an episode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framelake.operators.intervals import interval_join


def sessions(messages: DataFrame, by: list[str], gap: Column | str, delay: str = "0 seconds", time: str = "event_time") -> DataFrame:
    """Stream of messages(by, time, seq) -> stream of (by, start, end, n, first_seq, last_seq), an episode a row; end is the last message's time plus its gap.

    gap is an interval, by text or by an expression of the message; delay is what messages may be behind the latest one.
    Two messages whose times differ by exactly the gap are in two sessions.
    """
    timed = messages.withWatermark(time, delay)
    found = timed.groupBy(*by, F.session_window(time, gap).alias("w")).agg(F.count("*").alias("n"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"))
    return found.select(*by, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "first_seq", "last_seq")


def numbered(found: DataFrame, by: list[str]) -> DataFrame:
    """Finished sessions with their number in time order, from 0, in each `by`."""
    return found.withColumn("episode", (F.row_number().over(Window.partitionBy(*by).orderBy("start")) - 1).cast("long"))


def assigned(messages: DataFrame, found: DataFrame, by: list[str], time: str = "event_time") -> DataFrame:
    """Messages with the number of their session; found as `sessions` gave it, all of it."""
    spans = numbered(found, by).select(*by, F.unix_micros(F.col("start").cast("timestamp")).alias("__start"), F.unix_micros(F.col("end").cast("timestamp")).alias("__end"), "episode")
    met = interval_join(messages.withColumn("__at", F.unix_micros(F.col(time).cast("timestamp"))), spans, "__at", by, "__start", "__end")
    return met.drop("__at", "__start", "__end")
