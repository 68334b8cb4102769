"""Queries and rules of batch control: what a scheduler would ask of its tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Phases a batch may go to from each phase; any may stay.
BATCH_MOVES = {
    "Pending": ("Discovering", "Failed", "Cancelled"),
    "Discovering": ("Running", "Failed", "Cancelled"),
    "Running": ("Merging", "Failed", "Suspending", "Cancelled"),
    "Merging": ("Complete", "Failed"),
    "Suspending": ("Suspended", "Failed", "Cancelled"),
    "Suspended": ("Running", "Failed", "Cancelled"),
    "Complete": (),
    "Failed": (),
    "Cancelled": (),
}
#: The same for work units.
UNIT_MOVES = {
    "Pending": ("Processing", "Failed", "Cancelled"),
    "Processing": ("Complete", "Failed", "Dead", "Cancelled"),
    "Failed": ("Processing", "Cancelled"),
    "Complete": (),
    "Dead": (),
    "Cancelled": (),
}
#: Phases in which a batch may be cancelled on request.
CANCELLABLE = ("Pending", "Discovering", "Running", "Merging", "Suspending")
MAX_ATTEMPTS = 3


def moves(spark: SparkSession, table: dict) -> DataFrame:
    rows = [(a, b) for a, to in table.items() for b in (a, *to)]
    return spark.createDataFrame(rows, "from_state string, to_state string")


def allowed(changes: DataFrame, table: dict) -> DataFrame:
    """Changes (from_state, to_state) that the table allows."""
    return changes.join(moves(changes.sparkSession, table), ["from_state", "to_state"], "left_semi")


def claimable(status: Column, attempts: Column, most: int = MAX_ATTEMPTS) -> Column:
    return status.isin("Pending", "Failed") & (attempts < most)


def after_failure(attempts: Column, most: int = MAX_ATTEMPTS) -> Column:
    return F.when(attempts >= most, F.lit("Dead")).otherwise(F.lit("Failed"))


def after_cancel(phase: Column) -> Column:
    return F.when(phase.isin(*CANCELLABLE), F.lit("Cancelled")).otherwise(phase)


def unit_counts(units: DataFrame, by: list[str]) -> DataFrame:
    """Completed, failed (Failed and Dead) and processing units; total has only these."""
    n = lambda *s: F.count_if(F.col("status").isin(*s))
    out = units.groupBy(*by).agg(n("Complete").alias("completed"), n("Failed", "Dead").alias("failed"), n("Processing").alias("processing"))
    return out.withColumn("total", F.col("completed") + F.col("failed") + F.col("processing"))


def failed_units(units: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    return units.where(F.col("status").isin("Failed", "Dead")).groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("failed_units"))


def progress(done: Column, total: Column) -> Column:
    return F.when(total > 0, done * 100.0 / F.nullif(total, F.lit(0))).otherwise(F.lit(0.0))


def remaining(elapsed: Column, percent: Column) -> Column:
    """Time left at the rate so far; null before any progress."""
    return F.when(percent > 0, F.greatest(F.lit(0.0), elapsed * 100 / F.nullif(percent, F.lit(0.0)) - elapsed))


def verdict(counts: DataFrame, backoff_limit: int) -> DataFrame:
    """Failed when more units failed than the limit or all are done and some failed; Merging when all are complete."""
    done = F.col("completed") + F.col("failed")
    over = F.col("failed") > backoff_limit
    out = F.when(over, F.lit("Failed")).when((done >= F.col("total")) & (F.col("total") > 0), F.when(F.col("failed") > 0, F.lit("Failed")).otherwise(F.lit("Merging")))
    return counts.withColumn("phase", F.coalesce(out, F.lit("Running")))


def stale(heartbeats: DataFrame, now: Column, threshold: int) -> DataFrame:
    return heartbeats.where(now - F.col("last_heartbeat") > threshold)


def orphans(units: DataFrame, stale_workers: DataFrame) -> DataFrame:
    """Processing units whose owner is stale."""
    return units.where("status = 'Processing'").join(stale_workers.select(F.col("worker").alias("owner")), "owner", "left_semi")


def reclaimed(orphaned: DataFrame, limit: int, order: str = "id") -> DataFrame:
    """At most limit units, failed with a note."""
    taken = orphaned.orderBy(order).limit(limit)
    return taken.withColumn("status", after_failure(F.col("attempts"))).withColumn("error", F.concat(F.lit("Worker died: "), "owner"))


def new_files(listed: DataFrame, units: DataFrame, key: str = "id") -> DataFrame:
    return listed.join(units, key, "left_anti")


def known_files(listed: DataFrame, units: DataFrame, key: str = "id") -> DataFrame:
    return listed.join(units, key, "left_semi")


def first_pending(units: DataFrame, by: list[str]) -> DataFrame:
    return units.where("status = 'Pending'").groupBy(*by).agg(F.min("id").alias("id"))


def ready_to_finalize(batches: DataFrame) -> DataFrame:
    return batches.where("phase = 'Running' AND total > 0 AND completed + failed >= total")


def merge_ready(merges: DataFrame) -> DataFrame:
    return merges.where("status = 'Pending' AND completed >= expected")


def checkpoint_due(frames: Column, seconds: Column, every_frames: int, every_seconds: float) -> Column:
    return (frames >= every_frames) | (seconds >= every_seconds)


def upload_progress(uploaded: Column, failed: Column, total: Column) -> Column:
    return F.when(total == 0, F.lit(100.0)).otherwise((uploaded + failed) * 100.0 / F.nullif(total, F.lit(0)))


def upload_complete(uploaded: Column, failed: Column, total: Column) -> Column:
    return uploaded + failed >= total


def files_progress(completed: Column, failed: Column, total: Column) -> Column:
    """Percent of files that are done, well or not; 0 of none."""
    return progress(completed + failed, total)


def batch_summaries(specs: DataFrame, statuses: DataFrame, key: str = "id") -> DataFrame:
    """Batches that have both a specification and a status; others are passed over."""
    return specs.join(statuses, key)


def unit_sizes(units: DataFrame, by: list[str], size: str = "size") -> DataFrame:
    """Bytes and files of each unit of work."""
    return units.groupBy(*by).agg(F.coalesce(F.sum(size), F.lit(0)).alias("bytes"), F.count("*").alias("files"))


def staged_frames(staged: DataFrame) -> DataFrame:
    """Frames of a batch's workers, each worker's last report once."""
    last = staged.groupBy("batch", "worker").agg(F.max_by("frames", "reported_at").alias("frames"))
    return last.groupBy("batch").agg(F.sum("frames").alias("frames"), F.count("*").alias("workers"))


def listed(batches: DataFrame, phase: str | None = None, namespace: str | None = None, limit: int = 100, key: str = "id") -> DataFrame:
    if phase is not None:
        batches = batches.where(F.col("phase") == phase)
    if namespace is not None:
        batches = batches.where(F.col("namespace") == namespace)
    return batches.orderBy(key).limit(limit)


def eviction_candidate(entries: DataFrame, policy: str = "lru") -> DataFrame:
    """The entry to evict: least recently used, least often used, or oldest."""
    by = {"lru": "last_accessed", "lfu": "access_count", "fifo": "created_at"}[policy]
    return entries.agg(F.min_by("path", F.struct(by, "path")).alias("path"))
