"""Tables as streams that arrive in parts: each part is added to a folder and streamed to its end, from the same checkpoint.

A part is written by as many tasks as it has partitions; a stopped query goes on from its checkpoint when the next part is
there, as a job does that runs each hour.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from framelake.shared import shared_path


def run_in_parts(parts: list[DataFrame], start: Callable[[DataFrame, str], object]) -> None:
    """start(stream, checkpoint) -> a running query with an availableNow trigger; run once for each part, to its end."""
    spark = parts[0].sparkSession
    source, notes = shared_path(spark, "arrivals"), shared_path(spark, "notes")
    for part in parts:
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(parts[0].schema).parquet(source)
        start(stream, notes).awaitTermination()
