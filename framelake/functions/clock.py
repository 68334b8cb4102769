"""Nanosecond clock arithmetic on BIGINT; Spark's own timestamps stop at microseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NS = 1_000_000_000
LAST = (1 << 63) - 1


def interval_ns(fps: int) -> int:
    """Length of a frame, cut to whole nanoseconds: 30 fps is 33 333 333."""
    if fps <= 0:
        raise ValueError("fps must be positive")
    return NS // fps


def event_ns(ts: str) -> Column:
    """Nanoseconds of a TIMESTAMP or TIMESTAMP_NTZ column, read as UTC (the session's zone)."""
    return F.unix_micros(F.col(ts).cast("timestamp")) * 1000


def floor_bucket(ns: Column, interval: int) -> Column:
    """The multiple of interval at or below ns, also for negative ns."""
    return ns - F.pmod(ns, F.lit(interval))


def round_bucket(ns: Column, interval: int) -> Column:
    """Nearest multiple, halves up; stops at the largest BIGINT instead of running over."""
    half = (interval + 1) // 2
    return floor_bucket(F.when(ns <= LAST - half, ns + half).otherwise(F.lit(LAST)), interval)


def seconds(ns: Column) -> Column:
    return ns.cast("double") / F.lit(1e9)
